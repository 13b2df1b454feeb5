"""Facts that lie in the same buckets: plans without an exchange on the order."""

import json

import pytest
from pyspark.sql import functions as F

from basketry.errors import DataQualityError
from basketry import registry
from basketry.mining import baskets as B
from basketry.mining import itemsets
from basketry.mining import recommend as R
from basketry.operators import checks, transforms
from basketry.plans.pipeline import MAX_BUCKETS, MIN_BUCKETS, bucket_count, build_warehouse, resolve_stored_times
from basketry.plans.warehouse import CURRENT, catalog_name, current_run, forget_facts, open_warehouse
from basketry.session import materialize
from basketry.sources import storage

from conftest import make_sources


def exchanges(df):
    """What the plan is dealt by, as text, one entry per exchange."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange" in line]


@pytest.fixture
def shuffled(spark):
    """Broadcasts of small tables would hide exchanges that large ones need."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def segments(wh):
    return wh.dim_user.selectExpr("user_id", "0L AS cluster")


@pytest.mark.parametrize("query", [
    checks.detail_time_reconciliation,
    lambda wh: B.baskets(B.basket_lines(wh)),
    lambda wh: transforms.order_metrics(wh.fact_order_details),
    lambda wh: transforms.apply_order_metrics(wh.fact_orders, transforms.order_metrics(wh.fact_order_details)),
    lambda wh: checks._repeated_keys(wh.fact_order_details, ["order_id", "product_id"], "n"),
    lambda wh: R.cluster_popularity(wh, segments(wh), 5),
])
def test_no_exchange_of_lines_by_order(wh, shuffled, query):
    assert not [line for line in exchanges(query(wh)) if "hashpartitioning(order_id" in line]


def test_a_session_that_does_not_know_the_tables_enters_them(spark, loaded):
    wh, _, root = loaded
    forget_facts(spark, wh.folder)
    again = open_warehouse(spark, root)
    assert spark.catalog.tableExists(catalog_name(wh.folder, "fact_orders"))
    assert sorted(map(tuple, again.fact_order_details.collect())) == sorted(map(tuple, wh.fact_order_details.collect()))
    assert not [line for line in exchanges(transforms.order_metrics(again.fact_order_details)) if "order_id" in line]


def test_a_pointer_without_buckets_still_opens(spark, tmp_path):
    root = str(tmp_path / "w")
    build_warehouse(make_sources(spark), root)
    run = current_run(spark, root)
    del run["buckets"]
    storage.write_text(spark, f"{root}/{CURRENT}", json.dumps(run))
    assert open_warehouse(spark, root).fact_order_details.count() == 11


def test_each_bucket_has_one_file_in_a_directory(spark, loaded):
    from collections import Counter
    from pathlib import Path

    wh, _, root = loaded
    files = [p for p in Path(wh.folder, "fact_order_details").rglob("*.parquet")]
    found = Counter((p.parent.name, p.name.split("_")[-1].split(".")[0]) for p in files)
    assert found and max(found.values()) == 1


def test_bucket_count_is_bounded():
    assert bucket_count(0) == MIN_BUCKETS and bucket_count(10 ** 13) == MAX_BUCKETS
    assert bucket_count(5_000_000) == 11


def directories(wh):
    """The files of every range of lines."""
    from pathlib import Path

    found = {}
    for path in Path(wh.folder, "fact_order_details").rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add(path.name)
    return found


def test_only_ranges_whose_keys_change_are_rewritten(spark, tmp_path):
    wh, _ = build_warehouse(make_sources(spark), str(tmp_path / "w"))
    before = directories(wh)
    assert len(before) > 2
    assert resolve_stored_times(wh).count() == 0 and directories(wh) == before
    # One order moves to another hour: its lines follow, in its own range.
    moved = wh.fact_orders.withColumn("time_id", F.when(F.col("order_id") == 3, 619).otherwise(F.col("time_id")))
    first = {r.order_range: r.updated_lines for r in resolve_stored_times(wh, moved).collect()}
    after = directories(wh)
    assert first == {3 // wh.range_width: 3}
    assert {name for name in before if before[name] != after[name]} == {f"order_range={3 // wh.range_width}"}
    again = open_warehouse(spark, str(tmp_path / "w"))
    assert {r.time_id for r in again.fact_order_details.where("order_id = 3").collect()} == {619}
    assert resolve_stored_times(again, moved).count() == 0 and directories(wh) == after
    assert not [line for line in exchanges(transforms.order_metrics(again.fact_order_details)) if "order_id" in line]


def test_lines_without_an_order_are_reported(spark, tmp_path):
    wh, _ = build_warehouse(make_sources(spark), str(tmp_path / "w"))
    with pytest.raises(DataQualityError, match="orphaned=2"):
        resolve_stored_times(wh, wh.fact_orders.where("order_id <> 1"))


def test_baskets_of_products_stay_where_their_lines_lie(spark, wh, shuffled):
    """Mining meets the baskets by order more than once: only the other side moves."""
    prepared = registry._baskets(wh, "product")
    keys = materialize(wh.fact_orders.select("order_id"), "keys")
    joined = keys.join(prepared.frame, "order_id")
    assert len(exchanges(joined)) == 1 and joined.count() == prepared.count == 5
    assert "Exchange" not in prepared.frame.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert all("_fact_" in table.name for table in spark.catalog.listTables())


@pytest.mark.parametrize("support", [1 / 5, 2 / 5, 3 / 5])
def test_closed_itemsets_of_baskets_in_buckets(wh, support):
    """With and without rare items, the same sets as from baskets that lie anywhere."""
    there, anywhere = [
        {(tuple(r["items"]), r.freq, r.support) for r in itemsets.closed_itemsets(
            B.prepare_baskets(B.basket_lines(wh), buckets=buckets), support).collect()}
        for buckets in (wh.buckets, None)]
    assert there == anywhere and there
