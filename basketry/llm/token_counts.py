"""Token counts by section: a document is encoded once, as a whole, and its tokens are dealt out.

Tokens carry their byte spans, sections their character spans; both are sorted, so matching them
is a merge inside the document's own task, and no token becomes a row. A token that crosses a
boundary belongs to one section, by an explicit rule:

* ``first``: the section of the token's first character,
* ``last``: the section of its last character,
* ``largest``: the section with most of its bytes, the earlier one of equals.

A token whose deciding character lies in no section is counted under the section number -1, so
the counts of a document always add up to its tokens.

Defined results. A null or empty text has no tokens and one row: section 0, no characters. The
default sections are the lines, each with its line break, numbered from 0. Spans are cut to the
text and must not overlap; empty spans get no tokens. Rows that repeat a doc_id are counted one
by one. An empty table gives an empty result. Extra columns are not read.
"""

import base64

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import utf8

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's own tokenizer splits a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("first", "last", "largest")


class Counter:
    """A byte-level BPE vocabulary and the lengths of its tokens."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.lengths = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.lengths[rank] = len(token)

    def spans(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and last byte + 1 of every token."""
        ids = self.encoding.encode_ordinary(text.decode("utf-8", "replace"))
        ends = np.cumsum(self.lengths[np.array(ids, np.int64)])
        return np.concatenate([[0], ends[:-1]]) if ends.size else ends, ends


def line_spans(text: bytes) -> np.ndarray:
    """Byte spans of the lines, each with its line break."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A) + 1
    edges = np.concatenate([[0], ends, [len(text)]])
    return np.stack([edges[:-1], edges[1:]], axis=1)


def byte_spans(text: bytes, spans: list[tuple[int, int]]) -> np.ndarray:
    """Character spans as byte spans, cut to the text."""
    begins = np.append(np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80), len(text))
    places = np.clip(np.array(spans, np.int64).reshape(-1, 2), 0, begins.size - 1)
    return begins[places]


def deal(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section by the rule; the last figure counts those outside all sections."""
    order = np.argsort(spans[:, 0], kind="stable")
    filled = order[spans[order, 1] > spans[order, 0]]
    if not filled.size:
        return np.append(np.zeros(len(spans), np.int64), starts.size)
    lows, highs = spans[filled, 0], spans[filled, 1]

    def section(place: np.ndarray) -> np.ndarray:
        at = np.searchsorted(lows, place, "right") - 1
        return np.where((at >= 0) & (place < highs[at]), filled[at], len(spans))

    if rule == "first":
        owner = section(starts)
    elif rule == "last":
        owner = section(ends - 1)
    else:
        owner = section(starts)
        from_, to = np.searchsorted(highs, starts, "right"), np.searchsorted(lows, ends, "left")
        for token in np.flatnonzero(to - from_ > (owner < len(spans))):
            parts = np.arange(from_[token], to[token])
            shared = np.minimum(ends[token], highs[parts]) - np.maximum(starts[token], lows[parts])
            owner[token] = filled[parts[shared.argmax()]]
    return np.bincount(owner, minlength=len(spans) + 1)


def count_tokens(documents: DataFrame, sections: str | None = None, rule: str = "first", ranks: str = RANKS) -> DataFrame:
    """(doc_id, section, n_chars, n_tokens) of every section of every document.

    ``sections`` names a column array<struct<begin, end>> of character spans, numbered in their
    order; without it the lines are the sections. ``ranks`` is a file that the driver reads.
    """
    if rule not in RULES:
        raise ValueError(f"the rule must be one of {', '.join(RULES)}")
    with open(ranks, "rb") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())
    spans = F.col(sections).cast("array<struct<begin:long,end:long>>") if sections else F.lit(None).cast("array<struct<begin:long,end:long>>")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            spans.alias("spans"))

    def run(batches):
        counter = Counter(shared.value)
        for batch in batches:
            ids, numbers, chars, tokens = [], [], [], []
            given = batch.column(2).to_pylist() if sections else [None] * batch.num_rows
            for doc_id, text, own in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), given):
                text = text or b""
                spans = line_spans(text) if not sections else byte_spans(text, [
                    (s["begin"] or 0, s["end"] or 0) for s in own or [] if s])
                held = deal(*counter.spans(text), spans, rule)
                continued = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                some = len(spans) + (held[-1] > 0)
                ids += [doc_id] * some
                numbers += [*range(len(spans)), -1][:some]
                chars += [*(continued[spans[:, 1]] - continued[spans[:, 0]]).clip(0).tolist(), None][:some]
                tokens += held[:some].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(chars, pa.int64()),
                 pa.array(tokens, pa.int64())], ["doc_id", "section", "n_chars", "n_tokens"])

    return rows.mapInArrow(run, "doc_id long, section long, n_chars long, n_tokens long")


def with_fields(documents: DataFrame, fields: list[str], text: str = "text", sections: str = "sections") -> DataFrame:
    """(doc_id, text, sections): fields joined by line breaks, and the span of each; a null
    field is an empty one."""
    parts = [F.coalesce(F.col(field).cast("string"), F.lit("")) for field in fields]
    spans, at = [], F.lit(0)
    for part in parts:
        spans.append(F.struct(at.alias("begin"), (at + F.char_length(part)).alias("end")))
        at = at + F.char_length(part) + 1
    return documents.select("doc_id", F.concat_ws("\n", *parts).alias(text), F.array(*spans).alias(sections))
