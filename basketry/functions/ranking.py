"""Positions inside groups and seeded samples that hold when one group is huge."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import materialize

# A window task sorts at most this many rows of one group; larger groups are split.
GROUP_LIMIT = 1_000_000


def split_hot(rows: DataFrame, group: list[str], sizes: DataFrame, limit: int):
    """(rows of ordinary groups, rows of hot groups or None).

    ``sizes`` holds one row per group with its count ``n`` (or an upper bound of it). At
    most ``total / limit`` groups can be hot, which bounds what is broadcast.
    """
    hot = sizes.where(F.col("n") > limit).select(*group)
    if hot.isEmpty():
        return rows, None
    hot = materialize(hot, "hot-groups")
    keys = F.broadcast(hot)
    return rows.join(keys, group, "left_anti"), rows.join(keys, group, "left_semi")


def rank_in_pieces(rows: DataFrame, group: list[str], levels: list[str], name: str) -> DataFrame:
    """1-based position of each row in its group, without ever sorting a whole group.

    ``levels`` are columns from coarse to fine that together order the group totally. The
    rows are counted at every coarser level; a running sum of those counts says how many
    rows come before, so only the rows that share all coarser levels are sorted together.
    """
    *coarse, finest = levels
    counts = rows.groupBy(*group, *coarse).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts
    for depth in range(len(coarse)):
        above, here = group + coarse[:depth], group + coarse[: depth + 1]
        window = (
            Window.partitionBy(*above).orderBy(coarse[depth])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        before = (
            counts.groupBy(*here).agg(F.sum("_rows").alias("_rows"))
            .select(*here, F.coalesce(F.sum("_rows").over(window), F.lit(0)).alias(f"_b{depth}"))
        )
        offsets = offsets.join(before, here)
    total = reduce(lambda a, b: a + b, [F.col(f"_b{d}") for d in range(len(coarse))])
    offsets = offsets.select(*group, *coarse, total.alias("_before"))
    local = F.row_number().over(Window.partitionBy(*group, *coarse).orderBy(finest))
    return (
        rows.withColumn("_local", local)
        .join(offsets, group + coarse)
        .withColumn(name, (F.col("_before") + F.col("_local")).cast("int"))
        .drop("_before", "_local")
    )


def seeded_key(identifier: Column, seed: int) -> Column:
    """Pseudo-random but reproducible 32-bit number of an identifier."""
    text = F.concat_ws(":", identifier.cast("string"), F.lit(str(seed)))
    return F.crc32(text.cast("binary"))


def seeded_sample(rows: DataFrame, identifier: str, size: int, seed: int) -> DataFrame:
    """The ``size`` rows that come first by (seeded key, identifier).

    A counting pass over the key's top 16 bits finds the bucket in which the sample ends.
    Everything below it is taken as it is and only that one bucket, about 1/65536 of the
    rows, is sorted, so no task ever merges the candidates of all partitions.
    """
    keyed = rows.withColumn("_key", seeded_key(F.col(identifier), seed))
    bucket = F.shiftright(F.col("_key"), 16)
    running = F.sum("n").over(
        Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = (
        keyed.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("reached", running)
        .where(F.col("reached") >= size)
        .orderBy("bucket")
        .select("bucket", (F.col("reached") - F.col("n")).alias("taken"))
        .first()
    )
    if last is None:
        return rows
    edge = last.bucket << 16
    sure = keyed.where(F.col("_key") < edge)
    border = (
        keyed.where(F.col("_key").between(edge, edge + 0xFFFF))
        .orderBy("_key", identifier)
        .limit(size - last.taken)
    )
    return sure.unionByName(border).drop("_key")
