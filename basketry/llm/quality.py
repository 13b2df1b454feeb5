"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text is a sparse vector: its words, hashed to buckets and scaled to unit length, a dozen
figures of its structure, and the character count that its row carries. The machine adds to a
linear score the interactions of all pairs of features, whose strength is the inner product of
two short factor vectors. The sum over all pairs follows in linear time from the identity
2 * sum_{i<j} <v_i, v_j> x_i x_j = sum_f (sum_i v_if x_i)^2 - sum_i (v_if x_i)^2.

Training takes at most ``TRAIN_ROWS`` labelled documents, drawn by a hash of the id; their
feature vectors meet in one task, which is bounded by that number. The model has a fixed size
(``BUCKETS`` and ``FACTORS``) and is sent to all tasks. Scoring reads every document once.

Defined results. Labels, language, source and id are never inputs. A null, empty or blank text
has structure features only and gets a score like any other. Rows of ``labels`` that contradict
each other, or hold a null, are not learned from; a null doc_id is never learned from. Without
any label all scores are 0.5. Rows that repeat a doc_id are scored one by one. An empty table
gives an empty result. Columns of documents pass through; a result column whose name is taken
gets an underscore.
"""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import free_name, give_back, utf8

TRAIN_ROWS = 8_000
BUCKETS = 1 << 16
FACTORS = 8
EPOCHS = 12
BATCH = 128
RATE = 0.08
PENALTY = 2e-5
THRESHOLD = 0.5
_MARKS = np.zeros((256, 6), bool)
for _code in range(256):
    _char = chr(_code)
    _MARKS[_code] = (
        _char in "ABCDEFGHIJKLMNOPQRSTUVWXYZ", _char in "0123456789", _char in ".,;:", _char in "!?",
        _char in "#$%&*@^~_=+<>|/\\{}[]()\"'`-", _code >= 0x80)
STATISTICS = _MARKS.shape[1] + 7


def statistics(text: bytes, words: Counter, n_chars: int | None) -> list[float]:
    """Structure of a text as figures between about 0 and 1; the last is the metadata."""
    size, n = max(1, len(text)), max(1, sum(words.values()))
    lines = text.split(b"\n")
    shares = (np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _MARKS / size) if text else np.zeros(_MARKS.shape[1])
    return [
        *(np.sqrt(shares)), math.log1p(size) / 12, min(1.0, size / n / 20), len(words) / n,
        max(words.values(), default=0) / n, min(1.0, len(lines) / n), len(set(lines)) / len(lines),
        math.log1p(max(0, len(text) if n_chars is None else n_chars)) / 12]


def features(text: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): hashed words first, then the statistics."""
    text = text or b""
    words = Counter(text.lower().split())
    index = np.fromiter((zlib.crc32(word) % BUCKETS for word in words), np.int64, len(words))
    value = np.sqrt(np.fromiter(words.values(), np.float64, len(words)))
    value /= max(1.0, math.sqrt((value ** 2).sum()))
    return (np.concatenate([index, np.arange(BUCKETS, BUCKETS + STATISTICS)]),
            np.concatenate([value, statistics(text, words, n_chars)]))


def pair_score(weights: np.ndarray, factors: np.ndarray, value: np.ndarray) -> float:
    """Linear part plus all pairs, for the rows of weights and factors of a text's features."""
    scaled = factors * value[:, None]
    return float(weights @ value + 0.5 * ((scaled.sum(axis=0) ** 2).sum() - (scaled ** 2).sum()))


def fit(rows: list[tuple[float, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Bias, weights and factors, one row per feature: adaptive gradient steps on log loss."""
    random = np.random.default_rng(11)
    size = BUCKETS + STATISTICS
    model = np.zeros((size + 1, FACTORS + 1))
    model[:size, 1:] = random.normal(0, 0.05, (size, FACTORS))
    if not rows:
        model[:] = 0
        return model.astype(np.float32)
    seen = np.full_like(model, 1e-6)
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            batch = [rows[i] for i in order[at:at + BATCH]]
            label = np.array([row[0] for row in batch])
            lengths = np.array([row[1].size for row in batch])
            starts = np.cumsum(lengths) - lengths
            index, value = (np.concatenate([row[k] for row in batch]) for k in (1, 2))
            owner = np.repeat(np.arange(len(batch)), lengths)
            scaled = model[index, 1:] * value[:, None]
            sums = np.add.reduceat(scaled, starts)
            score = model[size, 0] + np.add.reduceat(model[index, 0] * value, starts) + 0.5 * (
                sums ** 2 - np.add.reduceat(scaled ** 2, starts)).sum(axis=1)
            slope = (1 / (1 + np.exp(-score)) - label) / len(batch)
            pull = slope[owner, None] * value[:, None]
            change = np.concatenate([pull, pull * (sums[owner] - scaled)], axis=1)
            used, place = np.unique(index, return_inverse=True)
            step = np.stack([np.bincount(place, change[:, f], used.size) for f in range(FACTORS + 1)], axis=1)
            step += PENALTY * model[used]
            seen[used] += step ** 2
            model[used] -= RATE * step / np.sqrt(seen[used])
            seen[size, 0] += slope.sum() ** 2
            model[size, 0] -= RATE * slope.sum() / math.sqrt(seen[size, 0])
    return model.astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """The third of all ids that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _inputs(documents: DataFrame) -> DataFrame:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in documents.columns else F.lit(None).cast("long")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            n_chars.alias("n_chars"))


def training_rows(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, label, text, n_chars): at most ``limit`` labelled documents outside the held-out
    third. The draw goes by a hash of the id, so it needs no sort and the same rows give the
    same sample."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("label"), F.max("quality").alias("most"),
        F.count("quality").alias("n"), F.count("*").alias("rows"))
    known = known.where("label = most and n = rows").where(~held_out(F.col("doc_id"))).select(
        "doc_id", F.col("label").cast("double").alias("label"))
    parts = 1 << 30
    share = int(parts * min(1.0, 0.97 * limit / max(1, known.count())))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share).limit(limit)
    return _inputs(documents).join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label").agg(
        F.min("text").alias("text"), F.min("n_chars").alias("n_chars"))


def train(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> np.ndarray:
    """The model, learned in one task from the vectors of the bounded sample."""

    def lists(column):
        """The rows of a list column as arrays that share its memory, without a Python object a value."""
        ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def vectors(batches):
        for batch in batches:
            made = [features(t, n) for t, n in zip(utf8(batch.column(2)), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([i.astype(np.int32) for i, _ in made], pa.list_(pa.int32())),
                pa.array([v.astype(np.float32) for _, v in made], pa.list_(pa.float32()))], ["doc_id", "label", "index", "value"])
            made = None
        give_back()

    def learn(batches):
        # As before, sums over a text's values are those of double precision.
        rows = [(label, i, v.astype(np.float64)) for batch in batches for label, i, v in zip(
            batch.column(1).to_pylist(), lists(batch.column(2)), lists(batch.column(3)))]
        model = fit(rows).tobytes()
        rows = None
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])
        give_back()

    made = training_rows(documents, labels, limit).select("doc_id", "label", "text", "n_chars").mapInArrow(
        vectors, "doc_id long, label double, index array<int>, value array<float>")
    # One task takes the sample, which ``limit`` bounds.
    found = made.repartition(1).sortWithinPartitions("doc_id").mapInArrow(learn, "model binary").collect()
    model = np.frombuffer(found[0].model, np.float32) if found else fit([])
    return model.reshape(BUCKETS + STATISTICS + 1, FACTORS + 1)


def score(documents: DataFrame, model: np.ndarray, name: str = "score") -> DataFrame:
    """``documents`` with the probability of label 1 in a last column."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    name = free_name(documents.columns, name)
    text = [c.lower() for c in documents.columns].index("text")
    n_chars = next((i for i, c in enumerate(documents.columns) if c.lower() == "n_chars"), None)
    schema = T.StructType([*documents.schema, T.StructField(name, T.DoubleType())])

    def run(batches):
        weights, factors, bias = shared.value[:-1, 0], shared.value[:-1, 1:], float(shared.value[-1, 0])
        for batch in batches:
            counts = batch.column(n_chars).to_pylist() if n_chars is not None else [None] * batch.num_rows
            found = []
            for body, count in zip(utf8(batch.column(text).cast(pa.string())), counts):
                index, value = features(body, count)
                z = bias + pair_score(weights[index], factors[index], value)
                found.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], schema.names)
        give_back()

    return documents.mapInArrow(run, schema)


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without those that score below ``threshold``."""
    scored = score(documents, train(documents, labels), "quality_score")
    return scored.where(F.col(scored.columns[-1]) >= threshold).drop(scored.columns[-1])
