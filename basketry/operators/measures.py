"""Shared measures. Facts are reduced to their grouping key before they meet a dimension,
so a product, user or hour that dominates the data is combined on the map side."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import labels
from basketry.functions.exact import units

# dim_time always has 168 rows, so this broadcast does not grow with the data.
def with_time(df: DataFrame, wh) -> DataFrame:
    """Rows with the calendar columns of their ``time_id``."""
    columns = [name for name in wh.dim_time.columns if name == "time_id" or name not in df.columns]
    times = wh.dim_time.select(*columns)
    if "is_weekend" in columns:
        times = times.withColumn("day_type", labels.day_type(F.col("is_weekend")))
    return df.join(F.broadcast(times), "time_id")


def order_totals(df: DataFrame, *by) -> DataFrame:
    """Order measures per ``by`` as whole-number sums, so they can be summed again.

    ``orders`` counts rows: the load gate holds ``order_id`` unique, which makes it the
    distinct count without a shuffle of every id.
    """
    items, gap = F.col("total_items").cast("bigint"), F.col("days_since_prior_order")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum(items), F.lit(0)).alias("items"),
        F.count_if(items != 0).alias("filled_orders"),
        F.sum(units(F.col("reorder_ratio"), 4)).alias("ratio_units"),
        F.sum(units(gap, 2)).alias("gap_units"),
        F.count(gap).alias("gaps"),
    )


TOTALS = ("orders", "items", "filled_orders", "ratio_units", "gap_units", "gaps")


def roll_up(totals: DataFrame, *by, **extra) -> DataFrame:
    """Totals of a coarser key."""
    sums = [F.sum(name).alias(name) for name in TOTALS]
    return totals.groupBy(*by).agg(*sums, *[c.alias(name) for name, c in extra.items()])


def order_reach(df: DataFrame, *by) -> DataFrame:
    """Order measures per ``by`` with the exact number of users.

    Orders are first combined per (by, user): the user count is then a row count, with no
    row expanded for a distinct aggregate.
    """
    return roll_up(order_totals(df, *by, "user_id"), *by, users=F.count("user_id"))


def product_sales(wh, *by) -> DataFrame:
    """Lines and reordered lines per product (and any line or calendar columns)."""
    lines = wh.fact_order_details
    if any(name not in lines.columns for name in by):
        lines = with_time(lines, wh)
    return lines.groupBy("product_id", *by).agg(
        F.count(F.lit(1)).alias("items"), F.sum("reordered").alias("reordered_items")
    )


def catalogued(sales: DataFrame, wh, *dimensions) -> DataFrame:
    """Product sales with product columns and those of the named dimensions."""
    products = wh.dim_product.select("product_id", "product_name", "aisle_id", "department_id")
    result = sales.join(products, "product_id")
    if "department" in dimensions:
        result = result.join(wh.dim_department, "department_id")
    if "aisle" in dimensions:
        result = result.join(wh.dim_aisle, "aisle_id")
    return result


def sales_by(wh, key: str, *by) -> DataFrame:
    """Sales per aisle or department key, summed from product sales."""
    return (
        product_sales(wh, *by)
        .join(wh.dim_product.select("product_id", key), "product_id")
        .groupBy(key, *by)
        .agg(
            F.sum("items").alias("items"),
            F.sum("reordered_items").alias("reordered_items"),
            F.count(F.lit(1)).alias("products"),
        )
    )
