"""Contracts of the loaded warehouse; every result is a small frame of named counts."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.errors import DataQualityError, PipelineError
from basketry.operators import kpis
from basketry.operators.contracts import MAX_POSITION

TIME_BUCKETS = 168


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _named_counts(df: DataFrame, counts: dict) -> DataFrame:
    """Several counts of one table in one pass, as (name, actual) rows."""
    totals = df.agg(*[count.alias(name) for name, count in counts.items()])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(name).cast("bigint").alias("actual"))
        for name in counts
    ])))


def _scalar(df: DataFrame, name: str, count=None) -> DataFrame:
    return df.agg((F.count(F.lit(1)) if count is None else count).alias("actual")).select(
        F.lit(name).alias("check_name"), F.coalesce("actual", F.lit(0)).alias("actual")
    )


def _repeated_keys(df: DataFrame, keys, name: str) -> DataFrame:
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _scalar(groups, name)


def _missing_products(wh):
    """Lines per product first, so that the anti-join sees each product once."""
    sold = wh.fact_order_details.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    return sold.join(wh.dim_product.select("product_id"), "product_id", "left_anti")


_FIRST_WITH_GAP = "order_number = 1 AND days_since_prior_order IS NOT NULL"
_LATER_WITHOUT_GAP = "order_number > 1 AND days_since_prior_order IS NULL"


def warehouse_checks(wh) -> DataFrame:
    """(check_name, actual, expected, passed) of the load gate."""
    checks = _union([
        _scalar(wh.dim_time, "time_dimension_rows"),
        _repeated_keys(wh.fact_orders, ["order_id"], "duplicate_orders"),
        _named_counts(wh.fact_orders, {
            "orders_without_items": F.count_if(F.col("total_items") <= 0),
            "invalid_order_intervals":
                F.count_if(F.expr(f"({_FIRST_WITH_GAP}) OR ({_LATER_WITHOUT_GAP})")),
        }),
        _named_counts(wh.fact_order_details, {
            "unresolved_detail_times": F.count_if(F.col("time_id").isNull()),
        }),
        _scalar(_missing_products(wh), "orphan_detail_products", F.sum("n")),
        _named_counts(wh.dim_user, {
            "users_without_orders": F.count_if(F.col("total_orders") <= 0),
        }),
    ])
    expected = F.when(F.col("check_name") == "time_dimension_rows", TIME_BUCKETS).otherwise(0)
    return checks.select(
        "check_name", "actual", expected.cast("bigint").alias("expected"),
        (F.col("actual") == expected).alias("passed"),
    )


def line_parents(wh) -> DataFrame:
    """Per line: open, different from the parent, or without a parent, as counts."""
    parents = wh.fact_orders.select(
        "order_id", F.col("time_id").alias("parent_time"), F.lit(True).alias("has_parent")
    )
    joined = wh.fact_order_details.select("order_id", "time_id").join(parents, "order_id", "left")
    return joined.agg(
        F.count_if(F.col("time_id").isNull()).alias("unresolved"),
        F.count_if(F.col("has_parent") & (F.col("time_id") != F.col("parent_time")))
        .alias("mismatched"),
        F.count_if(F.col("has_parent").isNull()).alias("orphaned"),
    )


def detail_time_reconciliation(wh) -> DataFrame:
    """Open, mismatched and orphaned lines from one join."""
    return _unpivot(line_parents(wh), ("unresolved", "mismatched", "orphaned"))


def _unpivot(totals: DataFrame, names) -> DataFrame:
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(name).alias("violations"))
        for name in names
    ])))


def sql_quality_checks(wh) -> DataFrame:
    """The eight post-load contracts as (check_name, violations)."""
    parents = line_parents(wh).select(
        F.col("unresolved").alias("unresolved_detail_time"),
        F.col("mismatched").alias("detail_time_mismatch"),
        F.col("orphaned").alias("orphan_detail_order"),
    )
    counts = _union([
        _repeated_keys(wh.fact_orders, ["order_id"], "duplicate_order_grain"),
        _repeated_keys(
            wh.fact_order_details, ["order_id", "product_id"], "duplicate_order_product_grain"
        ),
        _unpivot(parents, parents.columns),
        _scalar(_missing_products(wh), "orphan_detail_product", F.sum("n")),
        _named_counts(wh.fact_orders, {
            "invalid_first_order_interval": F.count_if(F.expr(_FIRST_WITH_GAP)),
            "invalid_repeat_order_interval": F.count_if(F.expr(_LATER_WITHOUT_GAP)),
        }),
    ])
    return counts.toDF("check_name", "violations")


def derived_metric_checks(wh) -> DataFrame:
    return _union([
        _named_counts(wh.fact_orders, {
            "orders without line items": F.count_if(F.col("total_items") <= 0),
            "invalid reorder ratios": F.count_if(~F.col("reorder_ratio").between(0, 1)),
        }),
        _named_counts(wh.dim_user, {
            "users without orders": F.count_if(F.col("total_orders") <= 0),
        }),
    ]).toDF("check_name", "violations")


# Column checks per table: name -> predicate that a stored row may not break.
COLUMN_CHECKS = {
    "dim_time": {
        "chk_time_dow": "order_dow BETWEEN 0 AND 6",
        "chk_time_hour": "order_hour BETWEEN 0 AND 23",
    },
    "dim_user": {
        "chk_user_orders": "total_orders >= 0",
        "chk_user_products": "total_products_purchased >= 0",
        "chk_user_first_dow": "first_order_dow IS NULL OR first_order_dow BETWEEN 0 AND 6",
    },
    "fact_orders": {
        "chk_order_number": "order_number > 0",
        "chk_order_dow": "order_dow BETWEEN 0 AND 6",
        "chk_days_since_prior": "days_since_prior_order IS NULL OR days_since_prior_order >= 0",
        "chk_reorder_ratio": "reorder_ratio BETWEEN 0 AND 1",
    },
    "fact_order_details": {
        "chk_cart_position": f"add_to_cart_order BETWEEN 1 AND {MAX_POSITION}",
        "chk_reordered": "reordered IN (0, 1)",
        "chk_quantity": "quantity > 0",
    },
}


def column_checks(wh) -> DataFrame:
    """(table_name, check_name, violations) of the stored column ranges."""
    reports = [
        _named_counts(
            wh.table(table),
            {name: F.count_if(~F.expr(predicate)) for name, predicate in checks.items()},
        ).select(F.lit(table).alias("table_name"), "check_name",
                 F.col("actual").alias("violations"))
        for table, checks in COLUMN_CHECKS.items()
    ]
    return _union(reports)


def foreign_key_checks(wh) -> DataFrame:
    """Products that name an aisle or department that does not exist."""
    def orphans(key, parent):
        used = wh.dim_product.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        missing = used.join(parent.select(key), key, "left_anti")
        return _scalar(missing, f"product_{key}", F.sum("n"))

    return _union([
        orphans("aisle_id", wh.dim_aisle), orphans("department_id", wh.dim_department),
    ]).toDF("check_name", "violations")


def reconcile_totals(wh) -> DataFrame:
    """(identity, actual, expected, passed): all breakdowns add up to the same totals."""
    totals = wh.fact_orders.agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_items").alias("items")
    )

    def summed(df, identity, column, target):
        return df.agg(F.sum(column).cast("bigint").alias("actual")).select(
            F.lit(identity).alias("identity"), "actual", F.lit(target).alias("target")
        )

    def shares(df, identity, column):
        # shares are compared in millionths of a percent
        total = F.round(F.sum(column) * 1_000_000).cast("bigint")
        return df.agg(total.alias("actual")).select(
            F.lit(identity).alias("identity"), "actual", F.lit("share").alias("target")
        )

    days, hours = kpis.day_trends(wh), kpis.hour_trends(wh)
    segments, bands = kpis.customer_segments(wh), kpis.basket_distribution(wh)
    departments = kpis.departments(wh)
    rows = _union([
        summed(days, "day orders", "orders", "orders"),
        summed(hours, "hour orders", "orders", "orders"),
        summed(segments, "segment orders", "total_orders", "orders"),
        summed(bands, "band orders", "orders", "orders"),
        summed(departments, "department items", "total_items", "items"),
        shares(days, "day shares", "share_pct"),
        shares(hours, "hour shares", "share_pct"),
        shares(segments, "segment user shares", "user_share_pct"),
        shares(segments, "segment order shares", "order_share_pct"),
        shares(bands, "band shares", "order_share_pct"),
        shares(departments, "department shares", "market_share_pct"),
    ])
    targets = totals.select(F.inline(F.array(
        F.struct(F.lit("orders").alias("target"), F.col("orders").alias("expected")),
        F.struct(F.lit("items").alias("target"), F.col("items").alias("expected")),
        F.struct(F.lit("share").alias("target"),
                 F.lit(100_000_000).cast("bigint").alias("expected")),
    )))
    return rows.join(F.broadcast(targets), "target").select(
        "identity", "actual", "expected", (F.col("actual") == F.col("expected")).alias("passed")
    )


def require_warehouse(wh) -> list[dict]:
    """Run the load gate; raise once with every failed check."""
    results = [row.asDict() for row in warehouse_checks(wh).collect()]
    failed = [
        f"{r['check_name']}: expected {r['expected']:,}, got {r['actual']:,}"
        for r in results if not r["passed"]
    ]
    if failed:
        raise DataQualityError(f"Warehouse validation failed: {'; '.join(failed)}")
    return results


def require_resolved_details(wh) -> None:
    counts = line_parents(wh).first().asDict()
    failed = [f"{name}={count:,}" for name, count in counts.items() if count]
    if failed:
        raise DataQualityError(f"fact_order_details reconciliation failed: {', '.join(failed)}")


def require_derived_metrics(wh) -> None:
    failed = [
        f"{row.check_name}: {row.violations:,}"
        for row in derived_metric_checks(wh).collect() if row.violations
    ]
    if failed:
        raise PipelineError(f"Derived metric validation failed: {'; '.join(failed)}")
