"""Page-level reshaping of the repository aggregates; every input is already small."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.labels import SEGMENT_ORDER
from basketry.operators import kpis

REMAINDER = "All other departments"

# Compared department metrics and their display names.
COMPARISON_METRICS = {
    "orders": "Order reach",
    "total_items": "Item volume",
    "unique_products": "Product breadth",
    "reorder_rate_pct": "Reorder rate",
}
# Display names of the two segment shares.
SHARE_NAMES = {"user_share_pct": "Customer share", "order_share_pct": "Order contribution"}


def condense_departments(departments: DataFrame, top_n: int = 8) -> DataFrame:
    """The ``top_n`` departments by share, with the others folded into one row.

    The folded reorder rate is weighted by items; without a rest there is no such row.
    """
    by_share = Window.orderBy(F.desc("market_share_pct"), "department_name")
    place = F.row_number().over(by_share)
    kept = departments.withColumn("place", F.least(place, F.lit(top_n + 1)))
    name = F.when(F.col("place") <= top_n, F.col("department_name")).otherwise(REMAINDER)
    weighted = F.sum(F.col("reorder_rate_pct") * F.col("total_items")) / F.sum("total_items")
    rate = F.when(F.count(F.lit(1)) == 1, F.max("reorder_rate_pct")).otherwise(weighted)
    return (
        kept.groupBy("place", name.alias("department_name"))
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("total_items").alias("total_items"),
            rate.alias("reorder_rate_pct"),
            F.sum("unique_products").alias("unique_products"),
            F.sum("market_share_pct").alias("market_share_pct"),
        )
        .drop("place")
        .orderBy("market_share_pct", "department_name")
    )


def normalized_comparison(departments: DataFrame, *names: str) -> DataFrame:
    """Selected departments on a 0-100 index against the best of all departments."""
    metrics = list(COMPARISON_METRICS)
    indexed = departments.select(
        "department_name",
        *[F.coalesce(
            F.when(F.max(metric).over(kpis.everything()) > 0,
                   F.col(metric).cast("double") / F.max(metric).over(kpis.everything()) * 100),
            F.lit(0.0),
        ).alias(COMPARISON_METRICS[metric]) for metric in metrics],
    )
    return indexed.where(F.col("department_name").isin(*names)).unpivot(
        "department_name", list(COMPARISON_METRICS.values()), "metric", "relative_index"
    )


def ordered_segments(segments: DataFrame) -> DataFrame:
    """Segments from the most to the least active; unknown names last, by name."""
    known = F.array(*[F.lit(name) for name in SEGMENT_ORDER])
    place = F.array_position(known, F.col("user_segment"))
    rank = F.when(place > 0, place).otherwise(len(SEGMENT_ORDER) + 1)
    return segments.withColumn("segment_rank", rank).orderBy("segment_rank", "user_segment")


def contribution_gap(segments: DataFrame) -> DataFrame:
    """Order share minus user share, and whether it is the largest (first on ties)."""
    gap = F.col("order_share_pct") - F.col("user_share_pct")
    ranked = ordered_segments(segments).withColumn("gap", gap)
    strongest = Window.orderBy(F.desc("gap"), "segment_rank", "user_segment")
    return ranked.select(
        "user_segment", "gap", (F.row_number().over(strongest) == 1).alias("is_strongest")
    )


def segment_share_long(segments: DataFrame) -> DataFrame:
    return segments.select(
        "user_segment", *[F.col(column).alias(name) for column, name in SHARE_NAMES.items()]
    ).unpivot("user_segment", list(SHARE_NAMES.values()), "measure", "share_pct")


def weekend_lift(comparison: DataFrame) -> DataFrame:
    """Weekend orders per day against weekday orders per day, in percent."""
    def per_day(day_type):
        return F.max(F.when(F.col("day_type") == day_type, F.col("avg_orders_per_day")))

    totals = comparison.agg(per_day("Weekend").alias("weekend"), per_day("Weekday").alias("weekday"))
    lift = F.when(F.col("weekday") != 0, (F.col("weekend") / F.col("weekday") - 1) * 100)
    return totals.where("weekend IS NOT NULL AND weekday IS NOT NULL").select(
        F.coalesce(lift, F.lit(0.0)).alias("lift_pct")
    )


def _extreme(df: DataFrame, insight: str, label: str, value: str, tie: str, lowest=False):
    """(insight, label, value) of the largest or smallest value, first by ``tie``."""
    order = F.asc(value) if lowest else F.desc(value)
    return df.orderBy(order, tie).limit(1).select(
        F.lit(insight).alias("insight"),
        F.col(label).cast("string").alias("label"),
        F.col(value).cast("double").alias("value"),
    )


def extremes(wh, min_items: int = 10_000) -> DataFrame:
    """Peaks and leaders that the pages call out."""
    days, hours = kpis.day_trends(wh), kpis.hour_trends(wh)
    departments, bands = kpis.departments(wh), kpis.basket_distribution(wh)
    aisles = kpis.aisles(wh, min_items=min_items)
    found = [
        _extreme(days, "peak day", "dow_name", "orders", "order_dow"),
        _extreme(days, "quiet day", "dow_name", "orders", "order_dow", lowest=True),
        _extreme(hours, "peak hour", "order_hour", "orders", "order_hour"),
        _extreme(bands, "common band", "basket_size", "orders", "bucket_order"),
        _extreme(departments, "volume leader", "department_name", "total_items",
                 "department_name"),
        _extreme(departments, "reorder leader", "department_name", "reorder_rate_pct",
                 "department_name"),
        _extreme(departments, "share leader", "department_name", "market_share_pct",
                 "department_name"),
        _extreme(aisles, "best aisle", "aisle_name", "reorder_rate_pct", "aisle_name"),
    ]
    result = found[0]
    for row in found[1:]:
        result = result.unionAll(row)
    return result


def contains_text(column, term: str):
    """Literal search without regard to case; NULL never matches."""
    return F.coalesce(F.contains(F.lower(column), F.lower(F.lit(term))), F.lit(False))


def search_products(wh, term: str, n: int = 15, department: str | None = None) -> DataFrame:
    """The ``n`` leading matches of the whole catalogue, in ranking order."""
    ranking = kpis.ranked_products(wh, department)
    term = term.strip()
    if term:
        ranking = ranking.where(contains_text(F.col("product_name"), term))
    return ranking.limit(n)


def largest_departments(departments: DataFrame, n: int = 12) -> DataFrame:
    return departments.orderBy(F.desc("total_items"), "department_name").limit(n)


def department_gap(departments: DataFrame, first: str, second: str) -> DataFrame:
    """Item difference of two departments and the larger one (the first on ties)."""
    def items(name):
        return F.max(F.when(F.col("department_name") == name, F.col("total_items")))

    gap = F.col("a") - F.col("b")
    return (
        departments.agg(items(first).alias("a"), items(second).alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL")
        .select(
            gap.alias("difference"),
            F.abs(gap).alias("absolute_difference"),
            F.when(gap >= 0, F.lit(first)).otherwise(F.lit(second)).alias("larger"),
        )
    )
