"""A loaded warehouse: seven tables on shared storage, read with fixed schemas.

Both facts are bucketed by order id, which only the catalog can tell Spark. Their tables are
entered in the session's catalog as external ones, named by their folder; a session that does
not know them yet enters them when it opens the warehouse.
"""

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.errors import PipelineError
from basketry.schemas import BUCKET_COLUMN, PARTITION_COLUMN, TABLES
from basketry.session import size_packed
from basketry.sources import storage

CURRENT = "current.json"
BYTES_PER_TASK = 32 * 1024 * 1024


class Warehouse:
    """The seven tables as attributes; nothing is read before an action needs it."""

    def __init__(self, tables: dict[str, DataFrame], range_width: int, folder: str | None = None,
                 buckets: int | None = None):
        missing = [name for name in TABLES if name not in tables]
        if missing:
            raise PipelineError(f"Missing warehouse tables: {', '.join(missing)}")
        self._tables = {name: tables[name] for name in TABLES}
        self.range_width = range_width
        self.folder = folder
        self.buckets = buckets

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        return self._tables[name]

    @property
    def spark(self) -> SparkSession:
        return self._tables["dim_time"].sparkSession

    @property
    def task_width(self) -> int:
        """Tasks for work that costs more than its bytes: every core, and enough for the lines."""
        lines = f"{self.folder}/fact_order_details"
        stored = storage.size_bytes(self.spark, lines) if self.folder else 0
        return max(self.spark.sparkContext.defaultParallelism, -(-stored // BYTES_PER_TASK))

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise ValueError(f"table_name must be one of: {', '.join(TABLES)}")
        return self._tables[name]

    def replaced(self, **tables: DataFrame) -> "Warehouse":
        """The same warehouse with some tables swapped."""
        return Warehouse({**self._tables, **tables}, self.range_width, self.folder, self.buckets)

    def details_in_range(self, low: int, high: int) -> DataFrame:
        """Lines with ``low <= order_id < high``, naming the directories that can hold them."""
        order_id, bucket = F.col("order_id"), F.col("order_range")
        return self.fact_order_details.where(
            (order_id >= low) & (order_id < high)
            & bucket.between(low // self.range_width, (high - 1) // self.range_width)
        )


def current_run(spark: SparkSession, root: str) -> dict | None:
    path = f"{root.rstrip('/')}/{CURRENT}"
    if not storage.exists(spark, path):
        return None
    return json.loads(storage.read_text(spark, path))


def catalog_name(folder: str, table: str) -> str:
    return f"basketry_{hashlib.md5(folder.encode()).hexdigest()[:16]}_{table}"


def open_fact(spark: SparkSession, folder: str, table: str, buckets: int) -> DataFrame:
    """A bucketed fact through the catalog, entered there if the session does not know it."""
    name = catalog_name(folder, table)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[table])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({PARTITION_COLUMN[table]}) CLUSTERED BY ({BUCKET_COLUMN}) "
            f"SORTED BY ({BUCKET_COLUMN}) INTO {buckets} BUCKETS LOCATION '{folder}/{table}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def forget_facts(spark: SparkSession, folder: str) -> None:
    """Take the facts of a folder out of the catalog; their files are left alone."""
    for table in PARTITION_COLUMN:
        spark.sql(f"DROP TABLE IF EXISTS {catalog_name(folder, table)}")


def read_run(spark: SparkSession, folder: str, range_width: int, buckets: int | None = None) -> Warehouse:
    size_packed(spark, storage.size_bytes(spark, folder))
    tables = {
        name: open_fact(spark, folder, name, buckets) if buckets and name in PARTITION_COLUMN
        else spark.read.schema(schema).parquet(f"{folder}/{name}")
        for name, schema in TABLES.items()
    }
    return Warehouse(tables, range_width, folder, buckets)


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """The last load of ``root`` that passed its gate."""
    run = current_run(spark, root)
    if run is None:
        raise PipelineError(f"No loaded warehouse in {root}")
    folder = f"{root.rstrip('/')}/{run['run_id']}"
    return read_run(spark, folder, run["range_width"], run.get("buckets"))


def table_counts(wh: Warehouse) -> DataFrame:
    """Exact row count of all seven tables."""
    counts = [
        wh.table(name).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in TABLES
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionAll(count)
    return result
