"""From validated sources to dimension and fact rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import labels
from basketry.functions.exact import decimal_ratio, units
from basketry.functions.numbers import number, whole

LOADED_SETS = ("prior", "train")


def dim_time(spark: SparkSession) -> DataFrame:
    """All 168 weekday and hour buckets."""
    day, hour = F.col("order_dow"), F.col("order_hour")
    return (
        spark.range(7 * 24, numPartitions=1)
        .select(
            F.floor(F.col("id") / 24).cast("int").alias("order_dow"),
            (F.col("id") % 24).cast("int").alias("order_hour"),
        )
        .select(
            (day * 100 + hour).alias("time_id"),
            "order_dow",
            labels.pick(labels.DAY_NAMES, day).alias("dow_name"),
            "order_hour",
            labels.pick(labels.HOUR_RANGES, F.floor(hour / 6).cast("int")).alias("hour_range"),
            day.isin(0, 6).alias("is_weekend"),
        )
    )


def transform_departments(df: DataFrame) -> DataFrame:
    return df.select(
        whole(df, "department_id", "bigint").alias("department_id"),
        F.col("department").alias("department_name"),
        labels.classify(F.col("department"), labels.DEPARTMENT_RULES).alias("dept_category"),
    )


def transform_aisles(df: DataFrame) -> DataFrame:
    return df.select(
        whole(df, "aisle_id", "bigint").alias("aisle_id"),
        F.col("aisle").alias("aisle_name"),
        labels.classify(F.col("aisle"), labels.AISLE_RULES).alias("aisle_type"),
    )


def transform_products(df: DataFrame) -> DataFrame:
    return df.select(
        whole(df, "product_id", "bigint").alias("product_id"),
        "product_name",
        whole(df, "aisle_id", "bigint").alias("aisle_id"),
        whole(df, "department_id", "bigint").alias("department_id"),
        F.lit(labels.DEFAULT_LABEL).alias("product_category"),
    )


def transform_orders(df: DataFrame) -> DataFrame:
    """Prior and train orders; the metrics start at zero until the lines are known."""
    dow, hour = whole(df, "order_dow", "int"), whole(df, "order_hour_of_day", "int")
    return df.where(F.col("eval_set").isin(*LOADED_SETS)).select(
        whole(df, "order_id", "bigint").alias("order_id"),
        whole(df, "user_id", "bigint").alias("user_id"),
        (dow * 100 + hour).alias("time_id"),
        whole(df, "order_number", "int").alias("order_number"),
        number(df, "days_since_prior_order").cast("decimal(6,2)").alias("days_since_prior_order"),
        F.lit(0).alias("total_items"),
        F.lit(0).cast("decimal(5,4)").alias("reorder_ratio"),
        dow.alias("order_dow"),
    )


def transform_order_details(df: DataFrame) -> DataFrame:
    """Lines with an open ``time_id``, which comes from the parent order."""
    return df.select(
        whole(df, "order_id", "bigint").alias("order_id"),
        whole(df, "product_id", "bigint").alias("product_id"),
        F.lit(None).cast("int").alias("time_id"),
        whole(df, "add_to_cart_order", "int").alias("add_to_cart_order"),
        whole(df, "reordered", "int").alias("reordered"),
        F.lit(1).alias("quantity"),
    )


def resolve_detail_times(details: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with their parent's ``time_id``; lines without a parent keep what they had.

    ``changed`` tells which lines were open or differed. A dominant order is left to the
    adaptive join, which splits its lines and repeats the one order row.
    """
    parents = orders.select("order_id", F.col("time_id").alias("parent_time"))
    found = F.col("parent_time").isNotNull()
    return details.join(parents, "order_id", "left").select(
        *[F.coalesce("parent_time", "time_id").alias("time_id") if name == "time_id"
          else F.col(name) for name in details.columns],
        (found & ~F.col("parent_time").eqNullSafe(F.col("time_id"))).alias("changed"),
    )


def order_metrics(details: DataFrame) -> DataFrame:
    """Item count and reorder ratio of every order that has lines."""
    lines = F.count(F.lit(1))
    return details.groupBy("order_id").agg(
        lines.cast("int").alias("total_items"),
        decimal_ratio(F.sum("reordered"), lines, 5, 4).alias("reorder_ratio"),
    )


def apply_order_metrics(orders: DataFrame, metrics: DataFrame) -> DataFrame:
    """Orders with their metrics; an order without lines keeps its zeros."""
    fresh = metrics.select(
        "order_id", F.col("total_items").alias("_items"), F.col("reorder_ratio").alias("_ratio")
    )
    replaced = {"total_items": "_items", "reorder_ratio": "_ratio"}
    return orders.join(fresh, "order_id", "left").select(
        *[F.coalesce(replaced[name], name).alias(name) if name in replaced else F.col(name)
          for name in orders.columns]
    )


def populate_users(orders: DataFrame) -> DataFrame:
    """One row per user from that user's loaded orders, in one combining aggregate."""
    count = F.count(F.lit(1))
    gap = units(F.col("days_since_prior_order"), 2)
    items = F.col("total_items").cast("bigint")
    return orders.groupBy("user_id").agg(
        labels.user_segment(count).alias("user_segment"),
        F.max(F.when(F.col("order_number") == 1, F.col("order_dow"))).alias("first_order_dow"),
        decimal_ratio(F.sum(items), count, 6, 2).alias("avg_basket_size"),
        count.alias("total_orders"),
        F.sum(items).alias("total_products_purchased"),
        decimal_ratio(F.sum(gap), F.count("days_since_prior_order") * 100, 6, 2)
        .alias("avg_days_between_orders"),
        F.max_by("time_id", "order_number").alias("last_order_date_id"),
    )
