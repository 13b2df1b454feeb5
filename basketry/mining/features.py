"""Behaviour of users as numbers, and their standard scores."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.errors import ClusteringDataError
from basketry.functions.exact import mean
from basketry.operators.measures import order_totals

FEATURES = ("total_orders", "avg_basket_size", "avg_reorder_ratio", "avg_days_between_orders")


def scaled_name(feature: str) -> str:
    return f"z_{feature}"


SCALED = tuple(scaled_name(name) for name in FEATURES)


def user_features(wh, min_orders: int = 3) -> DataFrame:
    """One row per user with at least ``min_orders`` filled orders."""
    if min_orders < 2:
        raise ValueError("min_orders must be at least 2")
    orders = F.col("orders")
    return (
        order_totals(wh.fact_orders.where(F.col("total_items") > 0), "user_id")
        .where(orders >= min_orders)
        .join(wh.dim_user.select("user_id"), "user_id", "left_semi")
        .select(
            "user_id",
            orders.alias("total_orders"),
            mean(F.col("items"), orders).alias("avg_basket_size"),
            mean(F.col("ratio_units"), orders * 10_000).alias("avg_reorder_ratio"),
            mean(F.col("gap_units"), F.col("gaps") * 100).alias("avg_days_between_orders"),
        )
    )


def feature_violations(features: DataFrame) -> DataFrame:
    """Row count, and per feature the values that are missing or not finite, as one row."""
    missing = [name for name in FEATURES if name not in features.columns]
    if missing:
        raise ClusteringDataError(f"Missing feature columns: {', '.join(missing)}")
    text = [n for n in FEATURES if not isinstance(features.schema[n].dataType, T.NumericType)]
    if text:
        raise ClusteringDataError(f"Features must be numeric: {', '.join(text)}")

    def broken(name):
        value = F.col(name).cast("double")
        return value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))

    return features.agg(
        F.count(F.lit(1)).alias("users"),
        *[F.count_if(broken(name)).alias(name) for name in FEATURES],
    )


def require_features(features: DataFrame) -> int:
    """Number of users, after checking that all features are there and finite."""
    row = feature_violations(features).first()
    if row["users"] < 3:
        raise ClusteringDataError("At least three users are required")
    bad = [name for name in FEATURES if row[name]]
    if bad:
        raise ClusteringDataError(f"Features must be finite numbers: {', '.join(bad)}")
    return row["users"]


def fit_scaler(features: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per feature; 1 stands in for no variance.

    These eight numbers are all that passes through the driver.
    """
    row = features.agg(
        *[F.avg(name).alias(f"m_{name}") for name in FEATURES],
        *[F.stddev_pop(name).alias(f"s_{name}") for name in FEATURES],
    ).first()
    return {name: (float(row[f"m_{name}"]), float(row[f"s_{name}"]) or 1.0) for name in FEATURES}


def scale(features: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    """Add the standard scores of a fitted scaler."""
    return features.select("*", *[
        ((F.col(name) - center) / spread).alias(scaled_name(name))
        for name, (center, spread) in scaler.items()
    ])


def standardize(features: DataFrame) -> DataFrame:
    """Centred features in units of the population standard deviation."""
    return scale(features, fit_scaler(features))
