import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

DEPARTMENTS = [(1, "produce"), (2, "dairy eggs")]
AISLES = [(1, "fresh fruits"), (2, "milk")]
PRODUCTS = [
    (10, "Banana", 1, 1), (11, "Honeycrisp Apple", 1, 1),
    (20, "Whole Milk", 2, 2), (21, "Plain Yogurt", 2, 2),
]
ORDERS = [
    (1, 100, "prior", 1, 0, 0, None), (2, 100, "prior", 2, 1, 10, 7),
    (3, 100, "train", 3, 6, 18, 5), (4, 200, "prior", 1, 3, 9, None),
    (5, 200, "train", 2, 4, 15, 14), (6, 300, "test", 1, 2, 12, None),
]
PRIOR = [(1, 10, 1, 0), (1, 20, 2, 0), (2, 10, 1, 1), (2, 11, 2, 0), (4, 20, 1, 0), (4, 21, 2, 0)]
TRAIN = [(3, 10, 1, 1), (3, 20, 2, 1), (3, 21, 3, 0), (5, 20, 1, 1), (5, 11, 2, 0)]

ROWS = {
    "departments": DEPARTMENTS, "aisles": AISLES, "products": PRODUCTS, "orders": ORDERS,
    "order_products_prior": PRIOR, "order_products_train": TRAIN,
}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def text_rows(rows):
    return [tuple(None if value is None else str(value) for value in row) for row in rows]


def make_sources(spark, **changes):
    """The fixture as text columns, the way files hold it; ``changes`` replace whole sources."""
    from basketry.schemas import SOURCES

    frames = {}
    for key, (_, columns) in SOURCES.items():
        schema = ", ".join(f"{name} string" for name in columns)
        frames[key] = spark.createDataFrame(text_rows(changes.get(key, ROWS[key])), schema)
    return frames


@pytest.fixture(scope="session")
def csv_folder(tmp_path_factory):
    """The fixture as six CSV files, one with a column nobody asked for."""
    from basketry.schemas import SOURCES

    folder = tmp_path_factory.mktemp("sources")
    for key, (name, columns) in SOURCES.items():
        lines = [",".join(columns) + (",note" if key == "products" else "")]
        for row in ROWS[key]:
            cells = ["" if value is None else str(value) for value in row]
            lines.append(",".join(cells + (["extra"] if key == "products" else [])))
        (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.fixture(scope="session")
def loaded(spark, csv_folder, tmp_path_factory):
    from basketry.plans.pipeline import build_warehouse
    from basketry.sources.files import read_sources

    root = str(tmp_path_factory.mktemp("warehouse"))
    wh, report = build_warehouse(read_sources(spark, csv_folder), root)
    return wh, report, root


@pytest.fixture(scope="session")
def wh(loaded):
    return loaded[0]


def rows(df):
    return [tuple(row) for row in df.collect()]
