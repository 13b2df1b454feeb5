"""Exact top-k search: distributed histogram selection over integer inner products.

Vectors are packed into blocks, and every block of queries meets every block of candidates in a
task of its own. Nothing keeps the scores: each round scores everything again.

1. Norms bound the scores of a query, which gives the first interval.
2. A round counts each query's scores in equal bins of its interval and in one bin above it. The
   counts of all blocks are added; the bin that holds the k-th best score is the next interval.
   Rounds end when the interval is one score wide or holds few scores more than are wanted.
3. The last round keeps the scores from the interval's lower edge on. A block gives at most k of
   a query, by score and then by smaller id, so a score that very many candidates share stays
   small; ranks over those settle ties the same way.

Defined results. Vectors that are null, empty or hold a null or a non-finite component, and rows
without an id, take no part. Vectors of different length never meet. Rows that repeat an id are
candidates of their own, but none of them is a candidate of the query with that id; a repeated
query id asks once, with the smallest of its vectors. Scores outside the range of a long are
clipped to it. Empty tables give an empty result. Extra columns are not read.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import materialize

K = 10
SCALE = 1024
BINS = 256
BLOCK_ROWS = 512
# Histograms of blocks of queries that a task adds up at once, of about one MB each.
HISTOGRAMS = 64
EXACT_DOUBLE = 1 << 53
LONG = (1 << 63) - 1


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(id, dims, vector): floor(scale * component) of the vectors that take part."""
    vector = F.col("embedding").cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), vector.alias("embedding"))
    return rows.where(F.col("id").isNotNull() & (F.size("embedding") > 0)).where(sound).select(
        "id", F.size("embedding").alias("dims"),
        F.transform("embedding", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("vector"))


def _pack(rows: DataFrame, name: str) -> DataFrame:
    """(dims, <name>, ids, vectors): blocks of about BLOCK_ROWS vectors as two byte strings."""
    full = rows.groupBy("dims").count()
    block = F.pmod(F.xxhash64("id"), F.ceil(F.col("count") / BLOCK_ROWS)).alias(name)
    placed = rows.join(F.broadcast(full), "dims").select("dims", block, "id", "vector")

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(part["vector"].to_numpy()).astype(np.int64)
        return pd.DataFrame([{
            "dims": part["dims"].iloc[0], name: part[name].iloc[0],
            "ids": part["id"].to_numpy(np.int64).tobytes(), "vectors": vectors.tobytes()}])

    return materialize(placed.groupBy("dims", name).applyInPandas(
        pack, f"dims int, {name} long, ids binary, vectors binary"), name)


def _matrix(row, ids: str, vectors: str) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(row[ids], np.int64)
    return found, np.frombuffer(row[vectors], np.int64).reshape(found.size, -1)


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where all sums stay below 2**53, else in whole numbers."""
    largest = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
    if largest(queries) * largest(vectors) * queries.shape[1] < EXACT_DOUBLE:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    exact = queries.astype(object) @ vectors.T.astype(object)
    return np.clip(exact, -LONG - 1, LONG).astype(np.int64)


def _cells(candidates: DataFrame, queries: DataFrame, state: DataFrame) -> DataFrame:
    """One row per pair of blocks, with the queries' intervals; all pairs go to tasks evenly."""
    spread = lambda df, other, name: df.join(F.broadcast(other), "dims").withColumn(
        name, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    of = lambda df, name: df.groupBy("dims").agg((F.max(name) + 1).alias("blocks"))
    asked = queries.withColumnsRenamed({"ids": "query_ids", "vectors": "query_vectors"}).join(
        state, ["dims", "query_block"])
    left = spread(candidates, of(queries, "query_block"), "query_block")
    right = spread(asked, of(candidates, "candidate_block"), "candidate_block")
    return left.join(right, ["dims", "query_block", "candidate_block"])


def _histogram(row) -> np.ndarray:
    """Scores of one cell per query and bin; bin BINS is everything above the interval."""
    ids, vectors = _matrix(row, "ids", "vectors")
    asked, queries = _matrix(row, "query_ids", "query_vectors")
    found = scores(queries, vectors)
    low, width = (np.frombuffer(row[c], np.int64)[:, None] for c in ("low", "width"))
    at = np.minimum((found - low) // width, BINS)
    counts = np.ones_like(found)
    counts[(asked[:, None] == ids) | (at < 0)] = 0
    flat = np.arange(asked.size)[:, None] * (BINS + 1) + np.maximum(at, 0)
    return np.bincount(flat.ravel(), weights=counts.ravel(), minlength=asked.size * (BINS + 1)).astype(np.int64)


def _counts(frames):
    """(dims, query_block, slot, bin, n): the histograms of a task's cells, added up by block of
    queries before they leave it, with a bounded number of blocks in memory."""
    held = {}

    def summed():
        for (dims, block), counts in held.items():
            some = np.flatnonzero(counts)
            yield pd.DataFrame({"dims": dims, "query_block": block, "slot": some // (BINS + 1),
                                "bin": some % (BINS + 1), "n": counts[some]})
        held.clear()

    for frame in frames:
        for _, row in frame.iterrows():
            key, counts = (row["dims"], row["query_block"]), _histogram(row)
            if key not in held and len(held) >= HISTOGRAMS:
                yield from summed()
            held[key] = held[key] + counts if key in held else counts
    yield from summed()


def _best(row, k: int) -> pd.DataFrame:
    """The k best of one cell per query among the scores from the interval's lower edge on."""
    ids, vectors = _matrix(row, "ids", "vectors")
    asked, queries = _matrix(row, "query_ids", "query_vectors")
    found = scores(queries, vectors)
    keep = (found >= np.frombuffer(row["low"], np.int64)[:, None]) & (asked[:, None] != ids)
    query, at = np.nonzero(keep)
    value = found[query, at]
    # ~value orders like -value and has no overflow.
    order = np.lexsort((ids[at], ~value, query))
    query, at, value = query[order], at[order], value[order]
    first = np.searchsorted(query, query)
    top = np.arange(query.size) - first < k
    return pd.DataFrame({"query_id": asked[query[top]], "vec_id": ids[at[top]], "score": value[top]})


def _each(function, *arguments):
    def run(frames):
        for frame in frames:
            for _, row in frame.iterrows():
                yield function(row, *arguments)

    return run


def _first_state(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """An interval per query that all its scores lie in, from the largest norm of candidates."""

    def norms(row) -> pd.DataFrame:
        _, vectors = _matrix(row, "ids", "vectors")
        return pd.DataFrame({"dims": [row["dims"]],
                             "norm": [float(np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1).max()))]})

    largest = candidates.mapInPandas(_each(norms), "dims int, norm double").groupBy("dims").agg(
        F.max("norm").alias("norm"))

    def start(row) -> pd.DataFrame:
        _, vectors = _matrix(row, "ids", "vectors")
        reach = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)) * row["norm"]
        reach = np.minimum(reach * (1 + 1e-9) + 2, float(1 << 62)).astype(np.int64)
        return pd.DataFrame({"dims": [row["dims"]], "query_block": [row["query_block"]],
                             "low": [(-reach).tobytes()],
                             "width": [(2 * (reach // BINS) + 2).tobytes()],
                             "done": [False]})

    return materialize(queries.join(F.broadcast(largest), "dims").mapInPandas(_each(start), _STATE), "intervals")


_STATE = "dims int, query_block long, low binary, width binary, done boolean"


def _narrow(state: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The next interval of every query: the bin with its k-th best score."""

    def narrow(old: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        row = old.iloc[0]
        low, width = (np.frombuffer(row[c], np.int64).copy() for c in ("low", "width"))
        held = np.zeros((low.size, BINS + 1), np.int64)
        held[counts["slot"].to_numpy(), counts["bin"].to_numpy()] = counts["n"].to_numpy()
        # From the top: how many scores are in a bin or above it.
        down = held[:, ::-1].cumsum(axis=1)[:, ::-1]
        reach = down >= k
        # The highest bin that reaches k; the lowest if there are fewer scores than k.
        at = np.where(reach.any(axis=1), BINS - reach[:, ::-1].argmax(axis=1), 0)
        seen = down[np.arange(low.size), at]
        # A bin above the interval can only reach k once a query is settled: it stays as it is.
        settled = (at == BINS) | (width == 1) | (seen <= 4 * k)
        low = np.where(at == BINS, low, low + at * width)
        width = np.where(settled, 1, np.maximum(1, -(-width // BINS)))
        return pd.DataFrame([{
            "dims": row["dims"], "query_block": row["query_block"], "low": low.tobytes(),
            "width": width.tobytes(), "done": bool(settled.all())}])

    summed = counts.groupBy("dims", "query_block", "slot", "bin").agg(F.sum("n").alias("n")).toDF(
        "of_dims", "of_block", "slot", "bin", "n")
    return state.groupBy("dims", "query_block").cogroup(summed.groupBy("of_dims", "of_block")).applyInPandas(
        narrow, _STATE)


def search(embeddings: DataFrame, queries: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """The k best candidates of every row for which ``queries`` holds (a condition on vec_id):
    query_id, rank, vec_id, score."""
    vectors = materialize(whole_vectors(embeddings, scale), "whole-vectors")
    asked = vectors.withColumnRenamed("id", "vec_id").where(queries).withColumnRenamed("vec_id", "id")
    asked = asked.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dims", F.size("vector"))
    candidates, blocks = _pack(vectors, "candidate_block"), _pack(asked, "query_block")
    state = _first_state(blocks, candidates)
    while state.where("not done").limit(1).count():
        counts = _cells(candidates, blocks, state).mapInPandas(
            _counts, "dims int, query_block long, slot long, bin long, n long")
        state = materialize(_narrow(state, counts, k), "intervals")
    best = _cells(candidates, blocks, state).mapInPandas(
        _each(_best, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
