"""Connected components of a graph whose edges are rows, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every vertex learns the smallest vertex near it, and hands it to its larger
    (large star) or smaller (small star) neighbours. A hub is only ever aggregated and joined,
    never collected."""
    if large:
        sided = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sided = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sided.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    met = sided.join(least, "u")
    handed = met.where(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        handed = handed.unionAll(least.select("u", F.col("m").alias("v")))
    return handed.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for every vertex that is not the smallest of its component ``v``.

    ``edges`` has columns u and v. Every round is written, so a lost executor costs one round;
    the number of rounds grows with the logarithm of the longest path. A round is the last when
    it changes nothing, which its row count and a sum over its rows show.
    """
    now, before = materialize(edges.select("u", "v").where("u <> v").distinct(), "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now
        before = mark
        now = materialize(_star(_star(now, True), False), "edges")
