"""Looking at the warehouse itself: samples, profiles, readiness and statistics."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.kpis import MAX_ROWS, bounded
from basketry.plans.warehouse import Warehouse, table_counts
from basketry.schemas import PARTITION_COLUMN, TABLE_KIND, TABLES


def table_sample(wh: Warehouse, table: str, limit: int = 10) -> DataFrame:
    """The first rows of a known table, by its columns in order, so that it can be repeated."""
    bounded(limit, MAX_ROWS)
    return wh.table(table).orderBy(*TABLES[table].fieldNames()).limit(limit)


def table_catalog(wh: Warehouse) -> DataFrame:
    """Name, kind, description and exact row count of every table."""
    kinds = F.create_map(*[F.lit(v) for name, (kind, _) in TABLE_KIND.items() for v in (name, kind)])
    texts = F.create_map(*[F.lit(v) for name, (_, text) in TABLE_KIND.items() for v in (name, text)])
    name = F.col("table_name")
    return table_counts(wh).select(
        "table_name", kinds[name].alias("kind"), texts[name].alias("description"), "row_count"
    )


def table_columns(wh: Warehouse, table: str) -> DataFrame:
    """Column name, type, nullability and the number of values that are there."""
    schema = wh.table(table).schema
    held = wh.table(table).agg(*[F.count(f.name).alias(f.name) for f in schema])
    return held.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.lit(f.nullable).alias("nullable"), F.col(f.name).alias("value_count"))
        for f in schema
    ])))


def table_partitions(wh: Warehouse, table: str) -> DataFrame:
    """Exact rows per directory of a partitioned table."""
    if table not in PARTITION_COLUMN:
        raise ValueError(f"table_name must be one of: {', '.join(PARTITION_COLUMN)}")
    column = PARTITION_COLUMN[table]
    return (
        wh.table(table).groupBy(F.col(column).cast("bigint").alias("partition_value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(table).alias("table_name"), "partition_value", "row_count")
        .orderBy("partition_value")
    )


def readiness_check(wh: Warehouse) -> DataFrame:
    """(check_name, passed), ending with ``healthy``, which needs all the others."""
    def filled(table):
        probe = wh.table(table).limit(1).agg(F.count(F.lit(1)).alias("n"))
        return probe.select(
            F.lit(f"{table}_has_data").alias("check_name"), (F.col("n") > 0).alias("passed")
        )

    structure = wh.spark.range(1, numPartitions=1).select(F.inline(F.array(
        F.struct(F.lit("required_tables").alias("check_name"),
                 F.lit(set(wh._tables) == set(TABLES)).alias("passed")),
        F.struct(F.lit("user_segment_column").alias("check_name"),
                 F.lit("user_segment" in wh.dim_user.columns).alias("passed")),
    )))
    checks = structure
    for table in ("fact_orders", "fact_order_details", "dim_user"):
        checks = checks.unionAll(filled(table))
    verdict = checks.agg(F.bool_and("passed").alias("passed")).select(
        F.lit("healthy").alias("check_name"), "passed"
    )
    return checks.unionAll(verdict)


def register_tables(wh: Warehouse, prefix: str = "basketry_") -> list[str]:
    """Catalog tables over the stored files, which SQL and statistics can name."""
    names = []
    for table, schema in TABLES.items():
        name = f"{prefix}{table}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        directory = PARTITION_COLUMN.get(table)
        layout = f"PARTITIONED BY ({directory})" if directory else ""
        wh.spark.sql(f"DROP TABLE IF EXISTS {name}")
        wh.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {layout} "
            f"LOCATION '{wh.folder}/{table}'"
        )
        if directory:
            wh.spark.sql(f"MSCK REPAIR TABLE {name}")
        names.append(name)
    return names


def refresh_statistics(wh: Warehouse, prefix: str = "basketry_") -> DataFrame:
    """Collect table, partition and column statistics; one row per table with its counts."""
    spark: SparkSession = wh.spark
    collected = []
    for name in register_tables(wh, prefix):
        table = name.removeprefix(prefix)
        if table in PARTITION_COLUMN:
            directory = PARTITION_COLUMN[table]
            spark.sql(f"ANALYZE TABLE {name} PARTITION ({directory}) COMPUTE STATISTICS")
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
        text = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").first()
        collected.append((table, text.data_type))
    rows = spark.createDataFrame(collected, "table_name string, statistics string")
    return rows.select(
        "table_name",
        F.regexp_extract("statistics", r"(\d+) rows", 1).cast("bigint").alias("row_count"),
        F.regexp_extract("statistics", r"(\d+) bytes", 1).cast("bigint").alias("size_bytes"),
    )
