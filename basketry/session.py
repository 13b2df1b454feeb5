"""Where intermediate tables go, and how shuffles are sized to the input."""

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.errors import PipelineError
from basketry.sources.storage import delete_on_exit

_ROOTS: dict[str, str] = {}

# One shuffle partition per this many input bytes keeps a task well inside executor memory.
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024
# Stored columns are packed: a row being sorted or combined takes about this many times its bytes.
UNPACKED = 8
# Pieces of a packed table that one task reads, or gets from merged partitions.
BYTES_PER_PIECE = 16 * 1024 * 1024


def work_folder(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables, on storage all executors share.

    The cluster names the shared folder in ``spark.checkpoint.dir``. A machine-local
    folder is used only when that is unset and the session itself runs in local mode.
    """
    application = spark.sparkContext.applicationId
    if application not in _ROOTS:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not spark.sparkContext.master.startswith("local"):
                raise PipelineError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="basketry-")
        root = f"{shared.rstrip('/')}/basketry/{application}-{uuid.uuid4().hex[:8]}"
        delete_on_exit(spark, root)
        _ROOTS[application] = root
    return _ROOTS[application]


def materialize(df: DataFrame, name: str, *directories: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back, optionally split into directories.

    A written table cuts the lineage: nothing upstream runs again, whichever executors
    are lost later, and both sides of a later join start from a plain scan.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(*directories).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize_dealt(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """The same in buckets of ``column``: joins and groups on it that follow leave these rows where
    they are. Only the catalog can tell Spark, so the table is there until the frame knows."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    table = f"basketry_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
        .option("path", path).saveAsTable(table)
    )
    found = spark.table(table).select(*df.columns)
    spark.sql(f"DROP TABLE {table}")
    return found


def together(*operations):
    """Results of independent jobs that run side by side on the cluster."""
    with ThreadPoolExecutor(len(operations)) as pool:
        return [future.result() for future in [pool.submit(run) for run in operations]]


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise (never lower) the shuffle width so that one partition stays near 128 MB.

    Adaptive execution merges what turns out small, so the width only has to be large
    enough for the biggest shuffle, which carries about as many bytes as the input.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION)
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


def size_packed(spark: SparkSession, stored_bytes: int) -> int:
    """Shuffle width for ``stored_bytes`` of packed columns, whose rows are unpacked in a task; a
    task's memory then stays the same as tables grow. Sizes of pieces that a user has set are kept.
    """
    for key, default in (
        ("spark.sql.files.maxPartitionBytes", 128), ("spark.sql.adaptive.advisoryPartitionSizeInBytes", 64),
    ):
        if spark.conf.get(key) in (f"{default}MB", f"{default << 20}", f"{default << 20}b"):
            spark.conf.set(key, str(BYTES_PER_PIECE))
    return size_shuffles(spark, UNPACKED * stored_bytes)


def small_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only after checking that ``df`` has no more than ``rows`` rows.

    A larger frame is left as it is and joins through a shuffle. ``df`` is counted, so it
    should be cheap to read: a written table or a short aggregate.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
