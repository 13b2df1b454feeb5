"""The six-file fixture, from CSV to the seven tables and the run report."""

import json
from decimal import Decimal as D
from pathlib import Path

import pytest
from conftest import make_sources, rows

from basketry.errors import DataQualityError, PipelineError
from basketry.operators import checks, explorer
from basketry.plans import pipeline
from basketry.plans.warehouse import current_run, open_warehouse, table_counts
from basketry.sources import files


def test_counts_of_all_tables(wh):
    assert dict(rows(table_counts(wh))) == {
        "dim_time": 168, "dim_department": 2, "dim_aisle": 2, "dim_product": 4, "dim_user": 2,
        "fact_orders": 5, "fact_order_details": 11,
    }


def test_dimensions(wh):
    assert sorted(rows(wh.dim_department)) == [
        (1, "produce", "Food"), (2, "dairy eggs", "Beverage")]
    assert sorted(rows(wh.dim_aisle)) == [(1, "fresh fruits", "Fresh"), (2, "milk", "Dairy")]
    assert {row.product_category for row in wh.dim_product.collect()} == {"General"}


def test_time_dimension(wh):
    found = {row.time_id: row for row in wh.dim_time.collect()}
    assert len(found) == 168
    assert found[618].dow_name == "Saturday" and found[618].hour_range == "18-24 Evening"
    assert found[618].is_weekend and not found[305].is_weekend
    assert found[305].hour_range == "00-06 Night" and found[6].hour_range == "06-12 Morning"


def test_fact_orders(wh):
    assert sorted(rows(wh.fact_orders)) == [
        (1, 100, 0, 1, None, 2, D("0.0000"), 0),
        (2, 100, 110, 2, D("7.00"), 2, D("0.5000"), 1),
        (3, 100, 618, 3, D("5.00"), 3, D("0.6667"), 6),
        (4, 200, 309, 1, None, 2, D("0.0000"), 3),
        (5, 200, 415, 2, D("14.00"), 2, D("0.5000"), 4),
    ]


def test_lines_carry_their_orders_time(wh):
    times = {row.order_id: row.time_id for row in wh.fact_orders.collect()}
    lines = wh.fact_order_details.collect()
    assert all(line.time_id == times[line.order_id] and line.quantity == 1 for line in lines)


def test_users(wh):
    assert sorted(rows(wh.dim_user)) == [
        (100, "New", 0, D("2.33"), 3, 7, D("6.00"), 618),
        (200, "New", 3, D("2.00"), 2, 4, D("14.00"), 415),
    ]


def test_all_checks_pass(wh):
    assert all(row.passed for row in checks.warehouse_checks(wh).collect())
    assert all(row.passed for row in checks.reconcile_totals(wh).collect())
    for report in (checks.sql_quality_checks, checks.column_checks, checks.foreign_key_checks,
                   checks.derived_metric_checks, checks.detail_time_reconciliation):
        assert all(row.violations == 0 for row in report(wh).collect())


def test_report_lists_stages_and_counts(spark, loaded):
    wh, report, root = loaded
    assert report["status"] == "succeeded"
    assert [s["name"] for s in report["stages"]] == [
        "dimensions", "order_details", "orders", "derived_metrics"]
    assert [s["rows"] for s in report["stages"]] == [8, 11, 5, 2]
    assert report["table_counts"]["fact_order_details"] == 11
    assert {row.stage for row in pipeline.run_report(spark, root).collect()} >= {"orders"}
    assert pipeline.validate_warehouse(spark, root)["table_counts"]["dim_user"] == 2


def test_second_load_is_refused_until_reset_is_confirmed(spark, tmp_path):
    root = str(tmp_path / "w")
    pipeline.build_warehouse(make_sources(spark), root)
    first = current_run(spark, root)
    with pytest.raises(PipelineError, match="fact_orders=5"):
        pipeline.build_warehouse(make_sources(spark), root)
    with pytest.raises(PipelineError, match="confirmed"):
        pipeline.build_warehouse(make_sources(spark), root, reset=True)
    assert current_run(spark, root) == first
    pipeline.build_warehouse(make_sources(spark), root, reset=True, confirmed=True)
    assert current_run(spark, root) != first
    assert open_warehouse(spark, root).fact_orders.count() == 5


def test_failed_load_is_reported_and_stays_invisible(spark, tmp_path):
    root = str(tmp_path / "w")
    lines = [(1, 10, 1, 0), (99, 20, 1, 0)]  # order 99 does not exist
    with pytest.raises(DataQualityError, match="orphaned=1"):
        pipeline.build_warehouse(make_sources(spark, order_products_prior=lines), root)
    assert current_run(spark, root) is None
    (report,) = [json.loads(p.read_text()) for p in Path(root, "_reports").glob("*.json")]
    assert report["status"] == "failed" and "unresolved=1" in report["error"]


def test_only_test_orders_cannot_be_loaded(spark, tmp_path):
    orders = [(6, 300, "test", 1, 2, 12, None)]
    with pytest.raises(DataQualityError):
        pipeline.build_warehouse(make_sources(spark, orders=orders), str(tmp_path / "w"))


def test_source_files_must_exist(spark, csv_folder, tmp_path):
    paths = files.source_paths(csv_folder)
    files.require_source_files(spark, paths, ["orders"])
    with pytest.raises(DataQualityError, match="a, z"):
        files.require_source_files(spark, paths, ["z", "orders", "a"])
    with pytest.raises(DataQualityError, match="aisles.csv.*products.csv"):
        files.require_source_files(
            spark, files.source_paths(str(tmp_path)), ["aisles", "products"])


def test_csv_without_a_required_column(spark, tmp_path):
    (tmp_path / "x.csv").write_text("order_id\n1\n")
    with pytest.raises(DataQualityError, match="product_id"):
        files.read_csv(spark, str(tmp_path / "x.csv"), ["order_id", "product_id"])


def test_explorer(wh):
    assert len(explorer.table_sample(wh, "fact_order_details", 3).collect()) == 3
    assert [r.row_count for r in explorer.table_partitions(wh, "fact_orders").collect()] == [1] * 5
    assert explorer.readiness_check(wh).where("NOT passed").count() == 0
    empty = wh.replaced(dim_user=wh.dim_user.where("false"))
    failed = [r.check_name for r in explorer.readiness_check(empty).where("NOT passed").collect()]
    assert failed == ["dim_user_has_data", "healthy"]
    assert explorer.table_columns(wh, "dim_aisle").count() == 3
    counts = {r.table_name: r.row_count for r in explorer.refresh_statistics(wh, "t_").collect()}
    assert counts["fact_order_details"] == 11 and counts["dim_time"] == 168


@pytest.mark.parametrize("table, limit, error", [
    ("secrets", 5, ValueError), ("dim_time", 0, ValueError), ("dim_time", 101, ValueError),
    ("dim_time", True, TypeError), ("dim_time", 2.0, TypeError),
])
def test_sample_guards(wh, table, limit, error):
    with pytest.raises(error):
        explorer.table_sample(wh, table, limit)


def test_broken_warehouse_names_every_failure(wh):
    orders = wh.fact_orders
    broken = wh.replaced(
        fact_orders=orders.unionAll(orders.where("order_id = 1")).selectExpr(
            "order_id", "user_id", "time_id", "order_number",
            "if(order_id = 2, null, days_since_prior_order) AS days_since_prior_order",
            "if(order_id = 4, 0, total_items) AS total_items", "reorder_ratio", "order_dow"),
        dim_product=wh.dim_product.where("product_id <> 10"),
        dim_time=wh.dim_time.where("order_dow > 0"),
    )
    with pytest.raises(DataQualityError) as error:
        checks.require_warehouse(broken)
    text = str(error.value)
    for part in ("time_dimension_rows: expected 168, got 144", "duplicate_orders: expected 0, got 1",
                 "orders_without_items: expected 0, got 1",
                 "invalid_order_intervals: expected 0, got 1",
                 "orphan_detail_products: expected 0, got 3"):
        assert part in text
    assert "users_without_orders" not in text
    with pytest.raises(PipelineError, match="orders without line items: 1"):
        checks.require_derived_metrics(broken)


def test_failed_and_replaced_loads_leave_no_tables(spark, tmp_path):
    import os

    from conftest import make_sources

    root = str(tmp_path / "w")

    def runs():
        return sorted(name for name in os.listdir(root) if not name.startswith(("_", ".")) and os.path.isdir(f"{root}/{name}"))

    pipeline.build_warehouse(make_sources(spark), root)
    first = runs()
    with pytest.raises(Exception):
        pipeline.build_warehouse(make_sources(spark, departments=[(1, " ")]), root, reset=True, confirmed=True)
    assert runs() == first and len(first) == 1
    pipeline.build_warehouse(make_sources(spark), root, reset=True, confirmed=True)
    assert len(runs()) == 1 and runs() != first
