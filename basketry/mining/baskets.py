"""Baskets: whole orders, optionally sampled, pruned to the items worth mining."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.errors import BasketDataError
from basketry.functions.ranking import seeded_sample
from basketry.session import materialize, materialize_dealt

DEFAULT_SEED = 42
# Largest item list that is broadcast; longer lists are joined by a shuffle.
BROADCAST_ITEMS = 100_000


@dataclass(frozen=True)
class Baskets:
    """Mined baskets: ``frame`` holds (order_id, items), each cut to the ``top_items`` leading
    items if that is a number; ``count`` is the denominator of every support, emptied baskets
    included. ``buckets`` is how many the frame lies in by order, if it does."""

    frame: DataFrame
    count: int
    top_items: int | None
    min_items: int
    buckets: int | None = None


def sample_orders(wh, limit: int | None, seed: int = DEFAULT_SEED) -> DataFrame:
    """Ids of a reproducible sample of whole orders; ``None`` takes all of them."""
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive or None for all orders")
    ids = wh.fact_orders.select("order_id")
    return ids if limit is None else seeded_sample(ids, "order_id", limit, seed)


def basket_lines(
    wh, *, item: str = "product", limit: int | None = None, seed: int = DEFAULT_SEED
) -> DataFrame:
    """(order_id, position, item) of the chosen orders; ``item`` is 'product' or 'aisle'."""
    if item not in ("product", "aisle"):
        raise ValueError("item must be one of: product, aisle")
    chosen = sample_orders(wh, limit, seed)
    lines = wh.fact_order_details.select("order_id", "product_id", "add_to_cart_order")
    if limit is not None:
        lines = lines.join(chosen, "order_id", "left_semi")
    column = F.col("product_id")
    if item == "aisle":
        lines = lines.join(wh.dim_product.select("product_id", "aisle_id"), "product_id")
        column = F.col("aisle_id")
    return lines.select(
        "order_id", F.col("add_to_cart_order").alias("position"), column.cast("string").alias("item")
    )


def baskets(lines: DataFrame, min_items: int = 2) -> DataFrame:
    """(order_id, items in cart order) of baskets with at least ``min_items`` lines.

    The load gate limits a basket to 32,767 lines, which bounds the array.
    """
    if min_items < 1:
        raise ValueError("min_items must be at least 1")
    placed = F.array_sort(F.collect_list(F.struct("position", "item")))
    return (
        lines.groupBy("order_id").agg(placed.alias("placed"))
        .where(F.size("placed") >= min_items)
        .select("order_id", F.col("placed.item").alias("items"))
    )


def _kept_lines(lines: DataFrame, min_items: int) -> DataFrame:
    """Distinct (order, item) of baskets that are large enough, after one shuffle by order.

    The load gate limits an order to 32,767 lines, so the window never meets a larger one.
    """
    if min_items > 1:
        size = F.count(F.lit(1)).over(Window.partitionBy("order_id"))
        lines = lines.withColumn("n", size).where(F.col("n") >= min_items)
    return lines.select("order_id", "item").distinct()


def top_items(lines: DataFrame, n: int, min_items: int = 2) -> DataFrame:
    """The ``n`` items found in most baskets; ties go to the smaller text."""
    if n <= 0:
        raise ValueError("top_n must be positive")
    return (
        _kept_lines(lines, min_items)
        .groupBy("item").agg(F.count(F.lit(1)).alias("baskets"))
        .orderBy(F.desc("baskets"), "item")
        .limit(n)
    )


def prune_baskets(
    lines: DataFrame, top: DataFrame, min_items: int = 2, width: int | None = None
) -> DataFrame:
    """(order_id, items) with only top items; emptied baskets stay, as empty arrays.

    Lines are flagged before they are collected, so an array never grows beyond the top
    list, whatever the size of the order. The one shuffle has a fixed ``width``: mining
    costs far more than the bytes of a basket, by which Spark would merge small tasks.
    """
    chosen = top.select("item", F.lit(True).alias("is_top"))
    width = width or lines.sparkSession.sparkContext.defaultParallelism
    flagged = lines.join(chosen, "item", "left").repartition(width, "order_id")
    kept = F.collect_set(F.when(F.col("is_top"), F.col("item")))
    return (
        flagged.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"), kept.alias("items"))
        .where(F.col("n") >= min_items)
        .select("order_id", F.array_sort("items").alias("items"))
    )


def whole_baskets(lines: DataFrame, min_items: int = 2) -> DataFrame:
    """(order_id, items) with all distinct items, sorted. Stored lines are grouped where their
    bucket lies, others after one shuffle by order."""
    return (
        lines.groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("n"), F.collect_set("item").alias("items"))
        .where(F.col("n") >= min_items)
        .select("order_id", F.array_sort("items").alias("items"))
    )


def prepare_baskets(
    lines: DataFrame, *, top_n: int | None = None, min_items: int = 2, width: int | None = None,
    buckets: int | None = None,
) -> Baskets:
    """Baskets on shared storage, with their exact number: whole ones, or pruned to the
    ``top_n`` leading items. With ``buckets``, those of the stored lines, whole ones stay where
    their lines lie, and mining joins them by order without moving them."""
    if min_items < 1:
        raise ValueError("min_items must be at least 1")
    if top_n is None:
        frame = whole_baskets(lines, min_items)
    else:
        top = materialize(top_items(lines, top_n, min_items), "top-items")
        if top_n <= BROADCAST_ITEMS:
            top = F.broadcast(top)
        frame = prune_baskets(lines, top, min_items, width)
    buckets = buckets if top_n is None else None
    frame = materialize_dealt(frame, "baskets", "order_id", buckets) if buckets else materialize(frame, "baskets")
    count = frame.count()
    if not count:
        raise BasketDataError(f"No baskets satisfy min_items={min_items}")
    return Baskets(frame, count, top_n, min_items, buckets)
