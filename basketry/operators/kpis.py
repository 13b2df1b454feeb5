"""Repository aggregates: unrounded measures behind the overview pages."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import labels
from basketry.functions.exact import mean, share, units
from basketry.operators.measures import (
    catalogued, order_totals, product_sales, roll_up, sales_by, with_time,
)

MAX_ROWS = 100
MAX_AISLES = 134


def everything():
    """Window over all rows. It is only ever laid over frames that are already grouped by
    weekday, hour, segment, band, department or day type, that is over a handful of rows."""
    return Window.partitionBy()


def bounded(value: int, high: int) -> int:
    """A row limit within [1, high]; booleans are not numbers here."""
    if isinstance(value, bool) or not isinstance(value, int):
        raise TypeError("limit must be an integer")
    if not 1 <= value <= high:
        raise ValueError(f"limit must be between 1 and {high}")
    return value


def not_negative(value: int, name: str) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise TypeError(f"{name} must be an integer")
    if value < 0:
        raise ValueError(f"{name} must be non-negative")
    return value


def share_of_all(column: str):
    return share(F.col(column), F.sum(column).over(everything()))


def mean_ratio_pct():
    """Mean reorder ratio in percent from its stored 4-digit units."""
    return mean(F.col("ratio_units"), F.col("orders") * 100)


def overview_kpis(wh) -> DataFrame:
    """One row of totals, from three scalar aggregates that never meet row by row."""
    orders = order_totals(wh.fact_orders).select(
        F.col("orders").alias("total_orders"),
        F.col("items").alias("total_items"),
        mean(F.col("items"), F.col("filled_orders")).alias("avg_basket_size"),
        mean_ratio_pct().alias("avg_reorder_rate_pct"),
    )
    users = wh.dim_user.agg(F.count(F.lit(1)).alias("total_users"))
    products = wh.dim_product.groupBy("department_id", "aisle_id").agg(
        F.count(F.lit(1)).alias("n")
    ).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_products"),
        F.count_distinct("department_id").alias("total_departments"),
        F.count_distinct("aisle_id").alias("total_aisles"),
    )
    stacked = orders.unionByName(users, allowMissingColumns=True).unionByName(
        products, allowMissingColumns=True
    )
    columns = (
        "total_orders", "total_users", "total_products", "total_items", "avg_basket_size",
        "avg_reorder_rate_pct", "total_departments", "total_aisles",
    )
    return stacked.agg(*[F.max(name).alias(name) for name in columns])


def _timed_orders(wh, *by) -> DataFrame:
    return roll_up(with_time(order_totals(wh.fact_orders, "time_id"), wh), *by)


def day_trends(wh) -> DataFrame:
    return (
        _timed_orders(wh, "order_dow", "dow_name")
        .select("order_dow", "dow_name", "orders", share_of_all("orders").alias("share_pct"))
        .orderBy("order_dow")
    )


def hour_trends(wh) -> DataFrame:
    return (
        _timed_orders(wh, "order_hour")
        .select("order_hour", "orders", share_of_all("orders").alias("share_pct"))
        .orderBy("order_hour")
    )


def weekend_comparison(wh) -> DataFrame:
    """Both day types, normalised by the weekdays that actually occur in each."""
    days = F.count_distinct("order_dow")
    timed = with_time(order_totals(wh.fact_orders, "time_id"), wh)
    return (
        roll_up(timed, "day_type", days_in_group=days)
        .select(
            "day_type",
            "orders",
            "days_in_group",
            mean(F.col("orders"), F.col("days_in_group")).alias("avg_orders_per_day"),
            mean(F.col("items"), F.col("filled_orders")).alias("avg_basket_size"),
            mean_ratio_pct().alias("avg_reorder_rate_pct"),
        )
        .orderBy(F.desc("day_type"))
    )


def department_orders(wh) -> DataFrame:
    """Distinct orders per department.

    Lines are reduced to (department, order) pairs before they are counted, so the work is
    spread by order however few departments there are. The join to products stays a plain
    scan on both sides, which lets adaptive execution split a dominant product.
    """
    pairs = (
        wh.fact_order_details.select("order_id", "product_id")
        .join(wh.dim_product.select("product_id", "department_id"), "product_id")
        .select("department_id", "order_id")
        .distinct()
    )
    return pairs.groupBy("department_id").agg(F.count(F.lit(1)).alias("orders"))


def departments(wh) -> DataFrame:
    """Reach, volume, reorder rate, breadth and share of every department."""
    return (
        sales_by(wh, "department_id")
        .join(department_orders(wh), "department_id")
        .join(wh.dim_department.select("department_id", "department_name"), "department_id")
        .select(
            "department_id",
            "department_name",
            "orders",
            F.col("items").alias("total_items"),
            share(F.col("reordered_items"), F.col("items")).alias("reorder_rate_pct"),
            F.col("products").alias("unique_products"),
            share_of_all("items").alias("market_share_pct"),
        )
        .orderBy(F.desc("total_items"), "department_id")
        .drop("department_id")
    )


def products(wh, limit: int = 20, department: str | None = None) -> DataFrame:
    """Products with the most orders, optionally of one department.

    (order, product) is unique, so a product's lines are its orders.
    """
    bounded(limit, MAX_ROWS)
    return ranked_products(wh, department).limit(limit)


def ranked_products(wh, department: str | None = None) -> DataFrame:
    """All sold products, those with the most orders first."""
    rows = catalogued(product_sales(wh), wh, "department", "aisle")
    if department:
        rows = rows.where(F.lower(F.trim("department_name")) == department.strip().lower())
    return rows.orderBy(F.desc("items"), "product_id").select(
        "product_name",
        "department_name",
        "aisle_name",
        F.col("items").alias("orders"),
        F.col("items").alias("total_items"),
        share(F.col("reordered_items"), F.col("items")).alias("reorder_rate_pct"),
    )


def aisles(wh, limit: int = 15, min_items: int = 10_000) -> DataFrame:
    """Aisles of at least ``min_items`` lines with the highest reorder rate."""
    bounded(limit, MAX_AISLES)
    not_negative(min_items, "min_items")
    rate = share(F.col("reordered_items"), F.col("items")).alias("reorder_rate_pct")
    return (
        sales_by(wh, "aisle_id")
        .where(F.col("items") >= min_items)
        .join(wh.dim_aisle.select("aisle_id", "aisle_name"), "aisle_id")
        .select("aisle_id", "aisle_name", rate, "items")
        .orderBy(F.desc("reorder_rate_pct"), F.desc("items"), "aisle_id")
        .limit(limit)
        .drop("aisle_id")
    )


def customer_segments(wh) -> DataFrame:
    named = wh.dim_user.where(F.col("user_segment").isNotNull() & (F.col("user_segment") != ""))
    return (
        named.groupBy("user_segment")
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.sum("total_orders").alias("total_orders"),
            F.sum(units(F.col("avg_basket_size"), 2)).alias("basket_units"),
        )
        .select(
            "user_segment",
            "users",
            "total_orders",
            mean(F.col("total_orders"), F.col("users")).alias("avg_orders"),
            mean(F.col("basket_units"), F.col("users") * 100).alias("avg_basket_size"),
            share_of_all("users").alias("user_share_pct"),
            share_of_all("total_orders").alias("order_share_pct"),
        )
        .orderBy(F.desc("avg_orders"), "user_segment")
    )


def basket_distribution(wh) -> DataFrame:
    """Order bands by size; orders without items are left out."""
    items = F.col("total_items")
    banded = wh.fact_orders.where(items > 0).select(
        "*",
        labels.band_order(items).alias("bucket_order"),
        labels.basket_band(items, "31+ items").alias("basket_size"),
    )
    return (
        order_totals(banded, "bucket_order", "basket_size")
        .select(
            "bucket_order",
            "basket_size",
            "orders",
            mean_ratio_pct().alias("avg_reorder_rate_pct"),
            share_of_all("orders").alias("order_share_pct"),
        )
        .orderBy("bucket_order")
    )
