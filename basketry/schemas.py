"""Fixed schemas of the six sources and the seven warehouse tables."""

from pyspark.sql import types as T

_STRING, _INT, _LONG, _BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _schema(*fields):
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# Source file contract: dataset -> (file name, required columns).
SOURCES = {
    "departments": ("departments.csv", ("department_id", "department")),
    "aisles": ("aisles.csv", ("aisle_id", "aisle")),
    "products": ("products.csv", ("product_id", "product_name", "aisle_id", "department_id")),
    "orders": (
        "orders.csv",
        ("order_id", "user_id", "eval_set", "order_number", "order_dow",
         "order_hour_of_day", "days_since_prior_order"),
    ),
    "order_products_prior": (
        "order_products__prior.csv",
        ("order_id", "product_id", "add_to_cart_order", "reordered"),
    ),
    "order_products_train": (
        "order_products__train.csv",
        ("order_id", "product_id", "add_to_cart_order", "reordered"),
    ),
}

TABLES = {
    "dim_time": _schema(
        ("time_id", _INT), ("order_dow", _INT), ("dow_name", _STRING),
        ("order_hour", _INT), ("hour_range", _STRING), ("is_weekend", _BOOL),
    ),
    "dim_department": _schema(
        ("department_id", _LONG), ("department_name", _STRING), ("dept_category", _STRING),
    ),
    "dim_aisle": _schema(
        ("aisle_id", _LONG), ("aisle_name", _STRING), ("aisle_type", _STRING),
    ),
    "dim_product": _schema(
        ("product_id", _LONG), ("product_name", _STRING), ("aisle_id", _LONG),
        ("department_id", _LONG), ("product_category", _STRING),
    ),
    "dim_user": _schema(
        ("user_id", _LONG), ("user_segment", _STRING), ("first_order_dow", _INT),
        ("avg_basket_size", T.DecimalType(6, 2)), ("total_orders", _LONG),
        ("total_products_purchased", _LONG),
        ("avg_days_between_orders", T.DecimalType(6, 2)), ("last_order_date_id", _INT),
    ),
    "fact_orders": _schema(
        ("order_id", _LONG), ("user_id", _LONG), ("time_id", _INT), ("order_number", _INT),
        ("days_since_prior_order", T.DecimalType(6, 2)), ("total_items", _INT),
        ("reorder_ratio", T.DecimalType(5, 4)), ("order_dow", _INT),
    ),
    "fact_order_details": _schema(
        ("order_id", _LONG), ("product_id", _LONG), ("time_id", _INT),
        ("add_to_cart_order", _INT), ("reordered", _INT), ("quantity", _INT),
        ("order_range", _LONG),
    ),
}

# Directory column of each partitioned fact; the column comes last in the schema.
PARTITION_COLUMN = {"fact_orders": "order_dow", "fact_order_details": "order_range"}

# Both facts are dealt into the same number of buckets by this column, sorted by it inside.
BUCKET_COLUMN = "order_id"

# Tables a load writes and a reset replaces; dim_time is generated, not loaded.
MUTABLE_TABLES = tuple(name for name in TABLES if name != "dim_time")

TABLE_KIND = {
    "dim_time": ("dimension", "Recurring weekday and hour buckets"),
    "dim_department": ("dimension", "Departments with their category"),
    "dim_aisle": ("dimension", "Aisles with their type"),
    "dim_product": ("dimension", "Products with their aisle and department"),
    "dim_user": ("dimension", "Customers with behaviour derived from their orders"),
    "fact_orders": ("fact", "One prior or train order per row"),
    "fact_order_details": ("fact", "One product of one order per row"),
}
