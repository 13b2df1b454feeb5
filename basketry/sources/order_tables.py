"""The six sources derived from an order / line item / part star schema.

Keys of that schema start at 0 and are shifted by one, because every source id is at
least 1. A customer's orders are numbered by calendar day, then by order key.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.ranking import GROUP_LIMIT, rank_in_pieces, split_hot
from basketry.session import materialize, size_packed, together
from basketry.sources import storage

# Part types in alphabetical order are departments 1 to 6.
DEPARTMENT_OF_TYPE = {
    "ECONOMY": "produce",
    "LARGE": "dairy eggs",
    "MEDIUM": "personal care",
    "PROMO": "household",
    "SMALL": "frozen",
    "STANDARD": "international",
}
# The brand number is the aisle id, and its place in this list.
AISLE_NAMES = (
    "fresh fruits", "fresh vegetables", "packaged cheese", "yogurt", "milk",
    "juice nectars", "dry pasta", "cookies cakes", "international", "frozen meals",
    "ice cream toppings", "soft drinks", "water seltzer", "chips pretzels", "candy chocolate",
    "canned goods", "rice grains", "tea", "coffee", "soda",
    "cream", "eggs", "bread", "packaged produce", "baby food",
)
LONGEST_GAP = 30
# Ids are unique, so a range of 2^20 ids never holds more rows than a task sorts.
ID_RANGE_BITS = 20
LINE_RANGE_BITS = 10


def _id_range(column: Column) -> Column:
    return F.shiftright(column, ID_RANGE_BITS)


def _aisle_id(brand: Column) -> Column:
    return F.regexp_extract(brand, r"(\d+)$", 1).try_cast("bigint")


def _department_id(part_type: Column) -> Column:
    names = F.array(*[F.lit(name) for name in DEPARTMENT_OF_TYPE])
    return F.nullif(F.array_position(names, part_type), F.lit(0))


def departments(part: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(name) for name in DEPARTMENT_OF_TYPE.values()])
    return (
        part.select(_department_id(F.col("p_type")).alias("department_id")).distinct()
        .select("department_id", F.get(names, F.col("department_id") - 1).alias("department"))
    )


def aisles(part: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(name) for name in AISLE_NAMES])
    return (
        part.select(_aisle_id(F.col("p_brand")).alias("aisle_id")).distinct()
        .select("aisle_id", F.get(names, F.col("aisle_id") - 1).alias("aisle"))
    )


def products(part: DataFrame) -> DataFrame:
    product_id = F.col("p_partkey") + 1
    return part.select(
        product_id.alias("product_id"),
        F.concat(F.col("p_name"), F.lit(", #"), product_id.cast("string")).alias("product_name"),
        _aisle_id(F.col("p_brand")).alias("aisle_id"),
        _department_id(F.col("p_type")).alias("department_id"),
    )


def number_orders(orders: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """Orders with their number per user, the gap in days, and whether they are the last.

    Ordinary users need one window. A user with more than ``limit`` orders is ranked in
    pieces, and finds the previous and next order by an equi-join on (user, number).
    """
    rows = orders.select(
        (F.col("o_orderkey") + 1).alias("order_id"),
        (F.col("o_custkey") + 1).alias("user_id"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    sizes = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    cold, hot = split_hot(rows, ["user_id"], sizes, limit)

    history = Window.partitionBy("user_id").orderBy("day", "order_id")
    numbered = cold.select(
        "*",
        F.row_number().over(history).alias("order_number"),
        F.lag("day").over(history).alias("previous_day"),
        F.lead("order_id").over(history).isNull().alias("is_last"),
    )
    if hot is not None:
        ranked = materialize(
            rank_in_pieces(
                hot.withColumn("id_range", _id_range(F.col("order_id"))),
                ["user_id"], ["day", "id_range", "order_id"], "order_number",
            ).drop("id_range"),
            "hot-users",
        )
        place = ["user_id", "order_number"]
        previous = ranked.select(
            "user_id", (F.col("order_number") + 1).alias("order_number"),
            F.col("day").alias("previous_day"),
        )
        following = ranked.select(
            "user_id", (F.col("order_number") - 1).alias("order_number"),
            F.lit(False).alias("is_last"),
        )
        numbered = numbered.unionByName(
            ranked.join(previous, place, "left").join(following, place, "left")
            .withColumn("is_last", F.coalesce("is_last", F.lit(True)))
        )
    gap = F.datediff("day", "previous_day")
    return numbered.select(
        "order_id", "user_id", "day", "order_number", "is_last",
        # least() skips NULL, so the first order needs its own branch to stay NULL
        F.when(F.col("previous_day").isNotNull(), F.least(gap, F.lit(LONGEST_GAP)))
        .alias("days_since_prior_order"),
    )


def count_lines(lineitem: DataFrame) -> DataFrame:
    """(order_id, n): lines per order as stored, combined on the map side."""
    return lineitem.groupBy((F.col("l_orderkey") + 1).alias("order_id")).agg(
        F.count(F.lit(1)).alias("n")
    )


def orders_source(numbered: DataFrame, sizes: DataFrame) -> DataFrame:
    """``test`` orders have no lines; a user's last order is ``train``, the others ``prior``."""
    return numbered.join(sizes, "order_id", "left").select(
        "order_id",
        "user_id",
        F.when(F.col("n").isNull(), F.lit("test"))
        .when(F.col("is_last"), F.lit("train")).otherwise(F.lit("prior")).alias("eval_set"),
        "order_number",
        (F.dayofweek("day") - 1).alias("order_dow"),
        ((F.col("order_id") - 1) % 24).cast("int").alias("order_hour_of_day"),
        "days_since_prior_order",
    )


def cart_lines(lineitem: DataFrame, sizes: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """Distinct products per order with their place in the cart.

    Ordinary orders take one shuffle by order: duplicates, position and the later join to
    the order all use it. Orders with more than ``limit`` lines are combined before the
    shuffle and ranked in pieces.
    """
    raw = lineitem.select(
        (F.col("l_orderkey") + 1).alias("order_id"),
        (F.col("l_partkey") + 1).alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
    )
    cold, hot = split_hot(raw, ["order_id"], sizes, limit)
    first_line = F.min("line_number").alias("line_number")

    cart = Window.partitionBy("order_id").orderBy("line_number", "product_id")
    lines = (
        cold.repartition("order_id").groupBy("order_id", "product_id").agg(first_line)
        .select("order_id", "product_id", F.row_number().over(cart).alias("add_to_cart_order"))
    )
    if hot is not None:
        distinct = materialize(
            hot.groupBy("order_id", "product_id").agg(first_line)
            .withColumn("line_range", F.shiftright("line_number", LINE_RANGE_BITS))
            .withColumn("id_range", _id_range(F.col("product_id"))),
            "hot-orders",
        )
        levels = ["line_range", "line_number", "id_range", "product_id"]
        lines = lines.unionByName(
            rank_in_pieces(distinct, ["order_id"], levels, "add_to_cart_order")
            .select("order_id", "product_id", "add_to_cart_order")
        )
    return lines


def order_lines_source(
    numbered: DataFrame, lineitem: DataFrame, sizes: DataFrame, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Lines of all orders; ``reordered`` marks products the user bought in an earlier order.

    A user's lines of one product meet in one shuffle, which finds their first purchase; there are
    no more of them than the user has orders. For users with more than ``limit`` orders it is found
    by a combining aggregate, and is then matched on (order, product), which is unique on both
    sides: a product or user that dominates the data meets no other row on its key.
    """
    bought = cart_lines(lineitem, sizes, limit).join(
        numbered.select("order_id", "user_id", "order_number", "is_last"), "order_id", "left")
    # Numbers have no gaps, so each user beyond the limit has one order with this one.
    users = numbered.where(F.col("order_number") == limit + 1).select(
        "user_id", F.col("order_number").alias("n"))
    if not users.isEmpty():
        bought = materialize(bought, "bought")
    cold, hot = split_hot(bought, ["user_id"], users, limit)
    # Lines without an order have no user to share; their own order keeps them apart.
    mine = Window.partitionBy(F.coalesce("user_id", -F.col("order_id")), "product_id")
    marked = cold.withColumn("first_order", F.min_by("order_id", "order_number").over(mine))
    if hot is not None:
        firsts = (
            hot.groupBy("user_id", "product_id")
            .agg(F.min_by("order_id", "order_number").alias("order_id"))
            .select("order_id", "product_id", F.col("order_id").alias("first_order"))
        )
        marked = marked.unionByName(hot.join(firsts, ["order_id", "product_id"], "left"))
    return marked.select(
        "order_id", "product_id", "add_to_cart_order",
        F.when(F.col("first_order") == F.col("order_id"), 0).otherwise(1).alias("reordered"),
        F.when(F.col("is_last"), F.lit("train")).otherwise(F.lit("prior")).alias("eval_set"),
    )


def read_sources(spark: SparkSession, folder: str, limit: int = GROUP_LIMIT):
    """The six sources, with the derived order and line tables written to shared storage."""
    folder = folder.rstrip("/")
    paths = {name: f"{folder}/{name}.parquet" for name in ("orders", "lineitem", "part")}
    size_packed(spark, sum(storage.size_bytes(spark, path) for path in paths.values()))
    orders, lineitem, part = (spark.read.parquet(path) for path in paths.values())
    numbered, sizes = together(
        lambda: materialize(number_orders(orders, limit), "numbered-orders"),
        lambda: materialize(count_lines(lineitem), "line-counts"),
    )
    lines, order_rows = together(
        lambda: materialize(
            order_lines_source(numbered, lineitem, sizes, limit), "order-lines", "eval_set"
        ),
        lambda: materialize(orders_source(numbered, sizes), "orders"),
    )
    loaded = {name: lines.where(F.col("eval_set") == name).drop("eval_set")
              for name in ("prior", "train")}
    return {
        "departments": departments(part),
        "aisles": aisles(part),
        "products": products(part),
        "orders": order_rows,
        "order_products_prior": loaded["prior"],
        "order_products_train": loaded["train"],
    }
