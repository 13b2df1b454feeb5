"""Business queries with measures rounded to two digits, half up."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import labels
from basketry.functions.exact import half_up, percent, ratio, units
from basketry.operators.kpis import everything
from basketry.operators.measures import (
    catalogued, order_reach, order_totals, product_sales, roll_up, sales_by, with_time,
)
from basketry.session import materialize, together


def _reorder_pct():
    return percent(F.col("reordered_items"), F.col("items")).alias("reorder_rate_pct")


def _basket(name="avg_basket_size"):
    return ratio(F.col("items"), F.col("orders")).alias(name)


def _mean_ratio(name="avg_reorder_pct"):
    # 4-digit units over orders are hundredths of a percent
    return (half_up(F.col("ratio_units"), F.col("orders"), 0) / F.lit(100.0)).alias(name)


def _gap(name):
    return ratio(F.col("gap_units"), F.col("gaps") * 100).alias(name)


def top_products(wh, n: int = 20) -> DataFrame:
    return (
        catalogued(product_sales(wh), wh)
        .orderBy(F.desc("items"), "product_id")
        .limit(n)
        .select(
            "product_id",
            "product_name",
            F.col("items").alias("total_quantity"),
            F.col("reordered_items").alias("times_reordered"),
            _reorder_pct(),
        )
    )


def peak_hours(wh) -> DataFrame:
    by = ("order_hour", "hour_range", "day_type")
    return (
        order_reach(with_time(wh.fact_orders, wh), *by)
        .select(
            *by,
            F.col("orders").alias("total_orders"),
            F.col("users").alias("unique_users"),
            _basket(),
            _mean_ratio(),
        )
        .orderBy(F.desc("total_orders"), "order_hour", "day_type")
    )


def day_of_week(wh) -> DataFrame:
    by = ("order_dow", "dow_name", "is_weekend")
    return (
        order_reach(with_time(wh.fact_orders.drop("order_dow"), wh), *by)
        .select(
            *by,
            F.col("orders").alias("total_orders"),
            F.col("users").alias("unique_users"),
            _basket(),
            _gap("avg_days_between_orders"),
            _mean_ratio(),
        )
        .orderBy("order_dow")
    )


def department_performance(wh) -> DataFrame:
    return (
        sales_by(wh, "department_id")
        .join(wh.dim_department, "department_id")
        .select(
            "department_id",
            "department_name",
            "dept_category",
            F.col("items").alias("total_items_sold"),
            "reordered_items",
            _reorder_pct(),
        )
        .orderBy(F.desc("total_items_sold"), "department_id")
    )


def _pct_of_all(column):
    return percent(F.col(column), F.sum(column).over(everything()))


def customer_segmentation(wh) -> DataFrame:
    basket, gap = F.col("avg_basket_size"), F.col("avg_days_between_orders")
    return (
        wh.dim_user.groupBy("user_segment")
        .agg(
            F.count(F.lit(1)).alias("total_users"),
            F.sum("total_orders").alias("orders"),
            F.sum(units(basket, 2)).alias("basket_units"),
            F.sum(units(gap, 2)).alias("gap_units"),
            F.count(gap).alias("gaps"),
        )
        .select(
            "user_segment",
            "total_users",
            _pct_of_all("total_users").alias("pct_users"),
            ratio(F.col("orders"), F.col("total_users")).alias("avg_orders_per_user"),
            ratio(F.col("basket_units"), F.col("total_users") * 100).alias("avg_basket_size"),
            _gap("avg_frequency_days"),
            F.col("orders").alias("total_orders_by_segment"),
            _pct_of_all("orders").alias("order_contribution_pct"),
        )
        .orderBy(F.desc("avg_orders_per_user"), "user_segment")
    )


def aisle_reorder(wh, min_items: int = 10_000, n: int = 20) -> DataFrame:
    return (
        sales_by(wh, "aisle_id")
        .where(F.col("items") >= min_items)
        .join(wh.dim_aisle, "aisle_id")
        .select(
            "aisle_id",
            "aisle_name",
            "aisle_type",
            F.col("items").alias("total_items"),
            "reordered_items",
            _reorder_pct(),
        )
        .orderBy(F.desc("reorder_rate_pct"), "aisle_id")
        .limit(n)
    )


def basket_size_distribution(wh) -> DataFrame:
    """Bands over all orders; the last band also takes what the closed bands miss."""
    items = F.col("total_items")
    banded = wh.fact_orders.select(
        "*",
        labels.band_order(items).alias("band_order"),
        labels.basket_band(items, "30+ items").alias("basket_size_group"),
    )
    return (
        order_totals(banded, "band_order", "basket_size_group")
        .select(
            "band_order",
            "basket_size_group",
            F.col("orders").alias("total_orders"),
            _pct_of_all("orders").alias("pct_of_orders"),
            _basket("avg_items_in_group"),
            _mean_ratio(),
            _gap("avg_days_between"),
        )
        .orderBy("band_order")
        .drop("band_order")
    )


def weekend_vs_weekday(wh) -> DataFrame:
    """Order measures per day type with the department that sold most.

    A line carries its order's ``time_id``, so volume needs no join between the facts.
    """
    periods = order_reach(with_time(wh.fact_orders, wh), "day_type")
    volume = (
        sales_by(wh, "department_id", "day_type")
        .join(wh.dim_department, "department_id")
        .groupBy("day_type", "department_name").agg(F.sum("items").alias("items"))
    )
    ranked = Window.partitionBy("day_type").orderBy(F.desc("items"), "department_name")
    top = volume.withColumn("place", F.row_number().over(ranked)).where("place = 1").select(
        "day_type", F.col("department_name").alias("top_department")
    )
    return (
        periods.join(top, "day_type", "left")
        .select(
            "day_type",
            F.col("orders").alias("total_orders"),
            F.col("users").alias("unique_users"),
            _basket(),
            _mean_ratio(),
            _gap("avg_days_between"),
            "top_department",
        )
        .orderBy("day_type")
    )


def product_reorder_patterns(wh, min_purchases: int = 5_000, n: int = 30) -> DataFrame:
    """The threshold is applied before any dimension is joined."""
    popular = product_sales(wh).where(F.col("items") >= min_purchases)
    return (
        catalogued(popular, wh, "department", "aisle")
        .select(
            "product_id",
            "product_name",
            "department_name",
            "aisle_name",
            F.col("items").alias("total_purchases"),
            (F.col("items") - F.col("reordered_items")).alias("first_time_purchases"),
            F.col("reordered_items").alias("reorder_purchases"),
            _reorder_pct(),
        )
        .orderBy(F.desc("reorder_rate_pct"), "product_id")
        .limit(n)
    )


def sunday_orders(wh) -> DataFrame:
    """One day's summary; only that day's directory is read."""
    orders = wh.fact_orders.where(F.col("order_dow") == 0)
    timed = with_time(order_totals(orders, "time_id"), wh)
    return roll_up(timed, "order_dow", "dow_name").select(
        "order_dow",
        "dow_name",
        F.col("orders").alias("total_orders"),
        (F.col("items").cast("double") / F.col("orders")).alias("avg_basket_size"),
        (F.col("ratio_units").cast("double") / (F.col("orders") * 100)).alias("avg_reorder_pct"),
    )


def _orders_per_day(orders) -> DataFrame:
    return orders.groupBy("order_dow").agg(F.count(F.lit(1)).alias("cnt"))


def weekend_counts(wh) -> DataFrame:
    """Orders of the two weekend directories."""
    return _orders_per_day(wh.fact_orders.where(F.col("order_dow").isin(0, 6)))


def all_day_counts(wh) -> DataFrame:
    return _orders_per_day(wh.fact_orders).orderBy("order_dow")


def order_range_lines(wh, low: int, high: int) -> DataFrame:
    """Lines of an order id range, from the directories that can hold them."""
    return wh.details_in_range(low, high).agg(F.count(F.lit(1)).alias("line_items"))


# Metric and description texts of the summary, in report order.
SUMMARY = (
    ("Total Orders", "Tổng số đơn hàng"),
    ("Total Users", "Tổng số khách hàng"),
    ("Total Products", "Tổng số sản phẩm"),
    ("Total Items Sold", "Tổng số items đã bán"),
    ("Avg Basket Size", "Số sản phẩm trung bình/đơn"),
    ("Avg Reorder Rate", "Tỷ lệ mua lại trung bình"),
    ("Most Popular Day", "Ngày có nhiều đơn nhất"),
    ("Most Popular Hour", "Giờ có nhiều đơn nhất"),
    ("Top Department", "Ngành hàng bán chạy nhất"),
    ("Top Product", "Sản phẩm bán chạy nhất"),
)


def summary_statistics(wh) -> DataFrame:
    """Ten (metric, value, description) rows.

    Orders are read once at the 168-bucket grain and lines once at the product grain; both
    results are written, and every metric is a small step on one of those two.
    """
    by_time, sales = together(
        lambda: materialize(order_totals(wh.fact_orders, "time_id"), "orders-by-time"),
        lambda: materialize(product_sales(wh), "product-sales"),
    )
    timed = with_time(by_time, wh)
    totals = roll_up(by_time)

    def count(df):
        return df.agg(F.format_number(F.count(F.lit(1)), 0).alias("value"))

    def first(df, label, *tie):
        return df.orderBy(F.desc("volume"), *tie).limit(1).select(label.alias("value"))

    days = timed.groupBy("dow_name").agg(F.sum("orders").alias("volume"))
    hours = timed.groupBy("order_hour").agg(F.sum("orders").alias("volume"))
    departments = (
        sales.join(wh.dim_product.select("product_id", "department_id"), "product_id")
        .groupBy("department_id").agg(F.sum("items").alias("volume"))
        .join(wh.dim_department, "department_id")
    )
    products = catalogued(sales, wh).withColumnRenamed("items", "volume")
    values = (
        totals.select(F.format_number(F.coalesce("orders", F.lit(0)), 0).alias("value")),
        count(wh.dim_user),
        count(wh.dim_product),
        sales.agg(F.format_number(F.coalesce(F.sum("items"), F.lit(0)), 0).alias("value")),
        totals.select(F.format_number(_basket(), 2).alias("value")),
        totals.select(F.concat(F.format_number(_mean_ratio(), 2), F.lit("%")).alias("value")),
        first(days, F.col("dow_name"), "dow_name"),
        first(hours, F.concat(F.col("order_hour").cast("string"), F.lit(":00")), "order_hour"),
        first(departments, F.col("department_name"), "department_id"),
        first(products, F.col("product_name"), "product_id"),
    )
    rows = [
        value.select(F.lit(metric).alias("metric"), "value", F.lit(text).alias("description"))
        for (metric, text), value in zip(SUMMARY, values, strict=True)
    ]
    return reduce(DataFrame.unionAll, rows)
