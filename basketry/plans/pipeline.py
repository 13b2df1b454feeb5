"""The load: validate sources, write seven tables, check them, then make them current.

A load writes into a folder of its own. Readers follow a small pointer file that is only
written after the gate has passed, so a failed load is never visible.
"""

import json
import time
import uuid
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.errors import DataQualityError, PipelineError
from basketry.operators import checks, transforms
from basketry.operators.contracts import enforce_sources
from basketry.plans.warehouse import (
    CURRENT, Warehouse, catalog_name, current_run, forget_facts, open_fact, open_warehouse,
    read_run, table_counts,
)
from basketry.schemas import BUCKET_COLUMN, MUTABLE_TABLES, PARTITION_COLUMN, TABLES
from basketry.session import materialize, together
from basketry.sources import storage

# Lines are stored by range of order id: steps of half a million orders, but no fewer than 8
# ranges (small data). Each directory holds a file per bucket, so there are few directories.
RANGE_STEP = 500_000
MIN_RANGES, MAX_RANGES = 8, 64
# Half a million orders to a bucket, which one task reads, as long as there are not too many.
BUCKET_STEP = 500_000
MIN_BUCKETS, MAX_BUCKETS = 8, 16_384


def range_width(max_order_id: int) -> int:
    ranges = min(max(max_order_id // RANGE_STEP + 1, MIN_RANGES), MAX_RANGES)
    return max_order_id // ranges + 1


def bucket_count(orders: int) -> int:
    return min(max(orders // BUCKET_STEP + 1, MIN_BUCKETS), MAX_BUCKETS)


def dealt(df: DataFrame, buckets: int) -> DataFrame:
    """Rows where their bucket's one writing task finds them; joins and groups on the bucket
    column that follow need no exchange."""
    return df.repartition(buckets, BUCKET_COLUMN)


def write_table(df: DataFrame, name: str, folder: str, buckets: int = MIN_BUCKETS) -> int:
    """Write one table and return its row count, which comes from the file footers.

    Facts go through the catalog, in directories and buckets; ``df`` should be ``dealt``, so that
    a bucket is written by one task, in one file per directory.
    """
    schema, path, spark = TABLES[name], f"{folder}/{name}", df.sparkSession
    df = df.select(*[F.col(field.name).cast(field.dataType) for field in schema])
    directory = PARTITION_COLUMN.get(name)
    if directory is None:
        df.write.parquet(path)
    else:
        (
            df.write.partitionBy(directory).bucketBy(buckets, BUCKET_COLUMN).sortBy(BUCKET_COLUMN)
            .option("path", path).saveAsTable(catalog_name(folder, name))
        )
    rows = spark.read.schema(schema).parquet(path).count()
    if not rows:
        raise DataQualityError(f"{name}: no rows were loaded")
    return rows


def count_rows(wh: Warehouse) -> dict[str, int]:
    return {row.table_name: row.row_count for row in table_counts(wh).collect()}


def ensure_empty_target(spark: SparkSession, root: str) -> None:
    """Refuse to load over a warehouse that already holds data."""
    if current_run(spark, root) is None:
        return
    filled = [
        f"{name}={rows:,}" for name, rows in count_rows(open_warehouse(spark, root)).items()
        if name in MUTABLE_TABLES and rows
    ]
    if filled:
        raise PipelineError(
            f"Warehouse already contains load data ({', '.join(filled)}); "
            "reset it explicitly to replace them"
        )


def _write_tables(sources: dict[str, DataFrame], folder: str, stages: list) -> tuple[int, int]:
    spark = sources["orders"].sparkSession

    def stage(name, operation):
        started = time.perf_counter()
        rows = operation()
        seconds = round(time.perf_counter() - started, 3)
        stages.append({"name": name, "rows": rows, "elapsed_seconds": seconds})

    def dimensions():
        frames = {
            "dim_time": transforms.dim_time(spark),
            "dim_department": transforms.transform_departments(sources["departments"]),
            "dim_aisle": transforms.transform_aisles(sources["aisles"]),
            "dim_product": transforms.transform_products(sources["products"]),
        }
        _, *rows = together(*[
            partial(write_table, df, name, folder) for name, df in frames.items()
        ])
        return sum(rows)

    sizes = sources["orders"].agg(
        F.max(F.col("order_id").cast("bigint")).alias("top"), F.count(F.lit(1)).alias("n")).first()
    width, buckets = range_width(sizes["top"]), bucket_count(sizes["n"])
    orders = dealt(transforms.transform_orders(sources["orders"]), buckets)

    def details():
        lines = transforms.transform_order_details(sources["order_products_prior"]).unionByName(
            transforms.transform_order_details(sources["order_products_train"])
        )
        # The join leaves the lines where they were dealt, which is where they are written.
        resolved = transforms.resolve_detail_times(dealt(lines, buckets), orders).withColumn(
            "order_range", F.call_function("div", F.col("order_id"), F.lit(width))
        )
        return write_table(resolved, "fact_order_details", folder, buckets)

    def order_facts():
        metrics = transforms.order_metrics(open_fact(spark, folder, "fact_order_details", buckets))
        facts = transforms.apply_order_metrics(orders, metrics)
        return write_table(facts, "fact_orders", folder, buckets)

    def users():
        facts = open_fact(spark, folder, "fact_orders", buckets)
        return write_table(transforms.populate_users(facts), "dim_user", folder)

    stage("dimensions", dimensions)
    stage("order_details", details)
    stage("orders", order_facts)
    stage("derived_metrics", users)
    return width, buckets


def build_warehouse(
    sources: dict[str, DataFrame],
    root: str,
    *,
    reset: bool = False,
    confirmed: bool = False,
    validate: bool = True,
) -> tuple[Warehouse, dict]:
    """Load the six sources into ``root``; returns the warehouse and the run report.

    ``reset`` replaces an earlier load and needs ``confirmed`` as well; the replaced tables go
    once the new ones are visible, and those of a failed run go at once. The report is written
    for failed runs too.
    """
    if reset and not confirmed:
        raise PipelineError("reset replaces loaded data and must be confirmed")
    spark = sources["orders"].sparkSession
    root = root.rstrip("/")
    run_id = uuid.uuid4().hex
    folder = f"{root}/{run_id}"
    stages: list[dict] = []
    report = {"run_id": run_id, "mode": "load", "started_at": _now(), "stages": stages}
    started = time.perf_counter()
    try:
        if not reset:
            ensure_empty_target(spark, root)
        if validate:
            enforce_sources(sources)
        pointer = f"{root}/{CURRENT}"
        replaced = json.loads(storage.read_text(spark, pointer))["run_id"] if (
            reset and storage.exists(spark, pointer)) else None
        width, buckets = _write_tables(sources, folder, stages)
        wh = read_run(spark, folder, width, buckets)
        _, _, report["quality_checks"], report["table_counts"] = together(
            lambda: checks.require_resolved_details(wh),
            lambda: checks.require_derived_metrics(wh),
            lambda: checks.require_warehouse(wh),
            lambda: count_rows(wh),
        )
        current = {"run_id": run_id, "range_width": width, "buckets": buckets}
        storage.write_text(spark, pointer, json.dumps(current))
        if replaced:
            forget_facts(spark, f"{root}/{replaced}")
            storage.delete(spark, f"{root}/{replaced}")
        report["status"] = "succeeded"
        return wh, report
    except Exception as error:
        report.update(status="failed", error_type=type(error).__name__, error=str(error))
        forget_facts(spark, folder)
        storage.delete(spark, folder)
        raise
    finally:
        report["finished_at"] = _now()
        report["elapsed_seconds"] = round(time.perf_counter() - started, 3)
        storage.write_text(
            spark, f"{root}/_reports/{run_id}.json", json.dumps(report, sort_keys=True)
        )


def resolve_stored_times(wh: Warehouse, orders: DataFrame | None = None) -> DataFrame:
    """Bring the stored lines' time keys up to those of ``orders`` (the stored ones unless given);
    (order_range, updated_lines) of the ranges that were rewritten.

    Lines meet their orders bucket by bucket. Only ranges with a line that is open or differs are
    read again, written aside and then swapped in by a dynamic overwrite; all other directories
    stay as they are, and so does everything on a second run. Swapping is a rename per directory:
    a run that ends in between leaves whole directories, old or new, and can be repeated. Raises
    if a line is still open, differs or has no order afterwards.
    """
    spark, name = wh.spark, "fact_order_details"
    parents = wh.fact_orders if orders is None else orders
    changes = materialize(
        transforms.resolve_detail_times(wh.fact_order_details, parents).where("changed")
        .groupBy("order_range").agg(F.count(F.lit(1)).alias("updated_lines")), "changed-ranges")
    ranges = [row.order_range for row in changes.select("order_range").collect()]
    if ranges:
        columns = [field.name for field in TABLES[name]]
        stale = wh.fact_order_details.where(F.col("order_range").isin(ranges))
        fresh = materialize(
            transforms.resolve_detail_times(stale, parents).select(*columns), "resolved-lines")
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            dealt(fresh, wh.buckets).write.insertInto(catalog_name(wh.folder, name), overwrite=True)
        finally:
            spark.conf.set(mode, before)
    stored = wh.replaced(fact_order_details=open_fact(spark, wh.folder, name, wh.buckets))
    checks.require_resolved_details(stored if orders is None else stored.replaced(fact_orders=orders))
    return changes


def validate_warehouse(spark: SparkSession, root: str) -> dict:
    """Check an existing load without loading anything."""
    wh = open_warehouse(spark, root)
    return {
        "mode": "validate",
        "quality_checks": checks.require_warehouse(wh),
        "table_counts": count_rows(wh),
    }


def run_report(spark: SparkSession, root: str) -> DataFrame:
    """All run reports of a warehouse, one row per stage."""
    stage = "array<struct<name:string,rows:bigint,elapsed_seconds:double>>"
    schema = (
        f"run_id string, status string, error string, elapsed_seconds double, stages {stage}"
    )
    reports = spark.read.schema(schema).json(f"{root.rstrip('/')}/_reports")
    return reports.select("run_id", "status", "error", F.explode_outer("stages").alias("stage")).select(
        "run_id", "status", "error",
        F.col("stage.name").alias("stage"), F.col("stage.rows").alias("stage_rows"),
        F.col("stage.elapsed_seconds").alias("elapsed_seconds"),
    )


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")
