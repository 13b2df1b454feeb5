"""Line dedup: a sharded minimal perfect hash over distinct line hashes, probed by documents.

1. Every document gives the 128-bit hashes of its distinct long lines (one written table).
2. One aggregate counts the documents of each hash and finds the largest id.
3. All distinct hashes are dealt into shards by hash. A shard is one row: the bits of a minimal perfect
   hash, and arrays of 64-bit fingerprints, counts and keepers in slot order.
4. Document lines are dealt to the shards, and the lines of a busy shard to several blocks that
   each get a copy of its arrays, so one very common line loads no single task. A line reads
   its slot: the fingerprint tells whether the line is in the index at all, the count whether
   enough documents hold it.
5. The hashes to drop go back to their documents, which are split into lines once more.

Defined results. A null text counts as one empty line and stays null. Each row is a document:
rows that repeat a doc_id count as documents of their own, and a line stays in all rows that have
the largest id. A null doc_id is smaller than every other. A row gathers the losses of its own
text only, whichever rows share its id. An empty table gives an empty result. Columns beyond
``doc_id`` and ``text`` pass through untouched, whatever their names.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import mph
from basketry.llm.common import free_name, give_back, shuffle_width, utf8
from basketry.session import materialize, small_broadcast

MIN_DOCUMENTS = 3
MIN_CODE_POINTS = 20
KEYS_PER_SHARD = 1 << 16
# Lines that one probing task takes at most, and the fewest worth a block of their own.
LINES_PER_BLOCK = 1 << 20
SMALL_BLOCK = 1 << 10
# The shards' numbers of blocks are broadcast up to so many shards.
SMALL_SIDE = 1 << 20
BLANKS = b" \t\n\v\f\r"


def line_key(line: bytes) -> bytes:
    """ASCII blanks stripped at both ends, A-Z lower-cased: bytes.lower() leaves the rest."""
    return line.strip(BLANKS).lower()


def key_hash(key: bytes, min_length: int) -> int | None:
    """128-bit hash of a key of at least ``min_length`` code points, None for a shorter one."""
    if len(key) < min_length or (len(key) < 4 * min_length and len(key.decode("utf-8", "replace")) < min_length):
        return None
    return xxhash.xxh3_128_intdigest(key)


def _halves(digests) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(d.to_bytes(16, "little") for d in digests), "<i8")
    return both[::2], both[1::2]


def text_mark(text: Column) -> Column:
    """Tells the rows of a repeated id apart. Should two of their texts have one mark, they share
    a list of hashes to drop, each of which is right for both."""
    return F.xxhash64(text)


def line_hashes(documents: DataFrame, min_length: int) -> DataFrame:
    """(doc_id, mark, h1, h2) once for each document and distinct long line."""

    def run(batches):
        for batch in batches:
            ids, marks, digests = [], [], []
            for doc_id, text, mark in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
                found = {key_hash(line_key(line), min_length) for line in (text or b"").split(b"\n")}
                found.discard(None)
                ids += [doc_id] * len(found)
                marks += [mark] * len(found)
                digests += found
            h1, h2 = _halves(digests)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(h1), pa.array(h2)],
                ["doc_id", "mark", "h1", "h2"])
            del ids, marks, digests, h1, h2
        give_back()

    text = F.col("text").cast("string")
    texts = documents.select(F.col("doc_id").cast("long"), text, text_mark(text).alias("mark"))
    return texts.mapInArrow(run, "doc_id long, mark long, h1 long, h2 long")


def build_index(distinct: DataFrame, shards: int) -> DataFrame:
    """One row per shard from (h1, h2, n, keeper): the perfect hash and its arrays."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = (rows[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
        sizes, bits = mph.build(a, b)
        order = np.argsort(mph.slots(a, b, sizes, bits))
        return pd.DataFrame([{
            "shard": rows["shard"].iloc[0], "sizes": sizes, "bits": np.packbits(bits).tobytes(),
            "prints": b[order].tobytes(), "counts": rows["n"].to_numpy(np.int64)[order].tobytes(),
            "keepers": rows["keeper"].to_numpy(np.int64)[order].tobytes(),
            "kept": rows["has_keeper"].to_numpy(bool)[order].tobytes(),
        }])

    # An id may be null: pandas would turn such a column into doubles.
    plain = distinct.select(
        shard_of(shards).alias("shard"), "h1", "h2", "n",
        F.coalesce("keeper", F.lit(0)).alias("keeper"), F.col("keeper").isNotNull().alias("has_keeper"))
    return plain.groupBy("shard").applyInPandas(
        build, "shard int, sizes array<int>, bits binary, prints binary, counts binary, keepers binary, kept binary")


def shard_of(shards: int):
    return F.pmod(F.col("h1"), F.lit(shards)).cast("int")


def _probe(lines: pd.DataFrame, index: pd.DataFrame, min_documents: int) -> np.ndarray:
    """Which of the lines the arrays of one shard say to drop."""
    row = index.iloc[0]
    a, b = (lines[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    sizes = [int(size) for size in row["sizes"]]
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:sum(sizes)].astype(bool)
    slot = mph.slots(a, b, sizes, bits)
    prints, counts, keepers = (np.frombuffer(row[c], t) for c, t in (
        ("prints", np.uint64), ("counts", np.int64), ("keepers", np.int64)))
    known = (slot >= 0) & (prints[slot] == b)
    keeps = np.frombuffer(row["kept"], bool)[slot]
    own = np.where(keeps, lines["has_id"].to_numpy(bool) & (keepers[slot] == lines["doc_id"].to_numpy()),
                   ~lines["has_id"].to_numpy(bool))
    return known & (counts[slot] >= min_documents) & ~own


def lines_to_drop(lines: DataFrame, min_documents: int) -> DataFrame:
    """(doc_id, mark, h1, h2) of the lines that a document loses."""
    width = shuffle_width(lines.sparkSession)
    distinct = materialize(
        lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")), "lines-distinct")
    shards = max(-(-distinct.count() // KEYS_PER_SHARD), width)
    # How many lines each shard will be asked for: one row per shard.
    load = lines.groupBy(shard_of(shards).alias("shard")).count()
    even = min(LINES_PER_BLOCK, max(SMALL_BLOCK, -(-lines.count() // shards)))
    blocks = materialize(
        load.select("shard", F.ceil(F.col("count") / even).cast("int").alias("blocks")), "lines-blocks")
    index = build_index(distinct, shards).join(blocks, "shard").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    probes = lines.select(
        shard_of(shards).alias("shard"), "h1", "h2", F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("has_id"), "mark"
    ).join(small_broadcast(blocks, SMALL_SIDE), "shard").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "mark", "h2"), F.col("blocks")).cast("int")).drop("blocks")

    def probe(lines: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        empty = lines.iloc[:0] if not len(index) or not len(lines) else lines[_probe(lines, index, min_documents)]
        return empty[["doc_id", "has_id", "mark", "h1", "h2"]]

    found = probes.groupBy("shard", "block").cogroup(index.groupBy("shard", "block")).applyInPandas(
        probe, "doc_id long, has_id boolean, mark long, h1 long, h2 long")
    return found.select(F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id"), "mark", "h1", "h2")


def dedup_lines(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, min_length: int = MIN_CODE_POINTS,
                n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``documents`` with the text that is kept, and two counts of lines beside it.

    Every column of ``documents`` stays. The counts are named by ``n_lines`` and
    ``n_dropped``; a name that is taken gets an underscore.
    """
    lines = materialize(line_hashes(documents, min_length), "lines")
    key = free_name(documents.columns, "dropped_of")
    mark = free_name([*documents.columns, key], "dropped_mark")
    gone = free_name([*documents.columns, key, mark], "gone")
    dropped = lines_to_drop(lines, min_documents).groupBy("doc_id", "mark").agg(
        F.collect_set(F.struct("h1", "h2")).alias("gone"))
    dropped = materialize(dropped, "lines-dropped").toDF(key, mark, gone)
    both = documents.join(
        dropped, documents["doc_id"].cast("long").eqNullSafe(dropped[key])
        & (text_mark(documents["text"].cast("string")) == dropped[mark]), "left").drop(key, mark)
    n_lines = free_name(documents.columns, n_lines)
    n_dropped = free_name([*documents.columns, n_lines], n_dropped)
    at = [name.lower() for name in documents.columns].index("text")
    schema = T.StructType([
        *(T.StructField(f.name, T.StringType() if i == at else f.dataType) for i, f in enumerate(documents.schema)),
        T.StructField(n_lines, T.LongType()), T.StructField(n_dropped, T.LongType())])

    def run(batches):
        for batch in batches:
            texts, totals, losses = [], [], []
            for text, hashes in zip(utf8(batch.column(at)), batch.column(batch.num_columns - 1).to_pylist()):
                rows = (text or b"").split(b"\n")
                gone = {(h["h2"] % (1 << 64)) << 64 | h["h1"] % (1 << 64) for h in hashes or ()}
                kept = [row for row in rows if not gone or key_hash(line_key(row), min_length) not in gone]
                texts.append(text if len(kept) == len(rows) else b"\n".join(kept))
                totals.append(len(rows))
                losses.append(len(rows) - len(kept))
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int64()), pa.array(losses, pa.int64())], schema.names)
            del texts, columns, totals, losses
        give_back()

    return both.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)
