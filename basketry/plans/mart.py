"""One loaded warehouse per session and input folder, shared by all queries on it."""

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from basketry.plans.pipeline import build_warehouse
from basketry.plans.warehouse import Warehouse
from basketry.session import work_folder
from basketry.sources import order_tables, storage

_INPUTS = ("orders", "lineitem", "part")
_MARTS: dict[tuple, "Mart"] = {}


@dataclass(frozen=True)
class Mart:
    sources: dict[str, DataFrame]
    warehouse: Warehouse
    report: dict[str, Any]
    root: str


def _version(spark: SparkSession, folder: str) -> tuple:
    """Size and time of the inputs: changed files are loaded again."""
    paths = [f"{folder.rstrip('/')}/{name}.parquet" for name in _INPUTS]
    return tuple(
        (storage.size_bytes(spark, path), storage.modified_at(spark, path)) for path in paths
    )


def load(spark: SparkSession, folder: str, name: str) -> Mart:
    """Derive the sources of ``folder`` and load them into the work folder."""
    root = f"{work_folder(spark)}/{name}"
    sources = order_tables.read_sources(spark, folder)
    warehouse, report = build_warehouse(sources, root)
    return Mart(sources, warehouse, report, root)


def open_mart(spark: SparkSession, folder: str) -> Mart:
    key = (spark.sparkContext.applicationId, folder, _version(spark, folder))
    if key not in _MARTS:
        _MARTS[key] = load(spark, folder, f"mart-{len(_MARTS)}")
    return _MARTS[key]
