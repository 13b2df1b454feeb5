"""The six source files, read as text so that contracts see what the file really holds."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketry.errors import DataQualityError
from basketry.schemas import SOURCES
from basketry.sources import storage

# Quotes inside a cell are doubled and a cell may hold line breaks. A row that does not fit the
# header stops the read, and every file of a folder is held to its own header.
QUOTING = {"header": True, "quote": '"', "escape": '"'}
READING = {**QUOTING, "multiLine": True, "mode": "FAILFAST", "enforceSchema": False,
           "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def source_paths(folder: str) -> dict[str, str]:
    return {key: f"{folder.rstrip('/')}/{name}" for key, (name, _) in SOURCES.items()}


def require_source_files(spark: SparkSession, paths: dict[str, str], keys) -> None:
    """Every requested source must be known and present before any job starts."""
    unknown = sorted(key for key in keys if key not in paths)
    if unknown:
        raise DataQualityError(f"No such sources: {', '.join(unknown)}")
    missing = [paths[key] for key in keys if not storage.exists(spark, paths[key])]
    if missing:
        raise DataQualityError(f"Source files not found: {', '.join(missing)}")


def read_csv(spark: SparkSession, path: str, columns) -> DataFrame:
    """The required columns of one headed CSV as text; other columns are not parsed.

    Only an empty field is NULL. A header without a required column is a contract error.
    """
    header = spark.read.options(**READING).csv(path).columns
    missing = [name for name in columns if name not in header]
    if missing:
        name = path.rsplit("/", 1)[-1]
        raise DataQualityError(f"{name} lacks columns: {', '.join(missing)}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return spark.read.schema(schema).options(**READING).csv(path).select(*columns)


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All six sources of a folder."""
    paths = source_paths(folder)
    require_source_files(spark, paths, list(paths))
    return {key: read_csv(spark, paths[key], columns) for key, (_, columns) in SOURCES.items()}
