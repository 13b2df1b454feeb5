"""Business queries, aggregates and reshaping on rows whose answers are known."""

import pytest
from conftest import rows

from basketry.functions import labels as L
from basketry.operators import analysis, kpis, reshape, transforms


def test_top_products(wh):
    assert [(r[0], r[2], r[3], r[4]) for r in rows(analysis.top_products(wh))] == [
        (20, 4, 2, 50.0), (10, 3, 2, 66.67), (11, 2, 0, 0.0), (21, 2, 0, 0.0)]


def test_departments(wh):
    found = rows(kpis.departments(wh).select(
        "department_name", "total_items", "orders", "unique_products"))
    assert found == [("dairy eggs", 6, 4, 2), ("produce", 5, 4, 2)]
    performance = rows(analysis.department_performance(wh).select(
        "department_name", "reordered_items", "reorder_rate_pct"))
    assert performance == [("dairy eggs", 2, 33.33), ("produce", 2, 40.0)]


def test_weekend_split(wh):
    assert rows(kpis.weekend_comparison(wh).select(
        "day_type", "orders", "days_in_group", "avg_basket_size")) == [
        ("Weekend", 2, 2, 2.5), ("Weekday", 3, 3, 2.0)]


def test_category_filter_ignores_case_and_spaces(wh):
    found = kpis.products(wh, 100, "  DAIRY Eggs ").collect()
    assert {r.department_name for r in found} == {"dairy eggs"} and len(found) == 2
    assert kpis.products(wh, 100, "dairy").count() == 0


@pytest.mark.parametrize("call, error", [
    (lambda wh: kpis.products(wh, 0), ValueError), (lambda wh: kpis.products(wh, 101), ValueError),
    (lambda wh: kpis.products(wh, True), TypeError), (lambda wh: kpis.aisles(wh, 135), ValueError),
    (lambda wh: kpis.aisles(wh, 5, -1), ValueError), (lambda wh: kpis.aisles(wh, 5, "1"), TypeError),
])
def test_argument_guards(wh, call, error):
    with pytest.raises(error):
        call(wh)


def test_search_is_literal_and_ignores_case(wh):
    assert [r.product_name for r in reshape.search_products(wh, " MILK ").collect()] == ["Whole Milk"]
    assert reshape.search_products(wh, "mi.k").count() == 0
    assert reshape.search_products(wh, "  ", 2).count() == 2


def test_search_skips_missing_names(spark):
    df = spark.createDataFrame([("Milk",), (None,)], "product_name string")
    assert df.where(reshape.contains_text(df.product_name, "milk")).count() == 1


@pytest.mark.parametrize("name, expected", [
    (" Fresh Produce ", "Food"), ("DAIRY EGGS", "Beverage"), ("personal care", "Personal Care"),
    ("pets", "Household"), ("international", "General"),
])
def test_department_labels(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(L.classify(df.n, L.DEPARTMENT_RULES)).first()[0] == expected


@pytest.mark.parametrize("name, expected", [
    ("Frozen Desserts", "Frozen"), ("Sparkling Water", "Beverage"), ("cookies cakes", "Snacks"),
    ("juice nectars", "Frozen"), ("rice grains", "Frozen"), ("milk", "Dairy"),
    ("dry pasta", "Dry Goods"), ("international", "General"), ("fresh fruits", "Fresh"),
])
def test_aisle_labels(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(L.classify(df.n, L.AISLE_RULES)).first()[0] == expected


def test_bands(spark):
    df = spark.createDataFrame([(i,) for i in (0, 5, 6, 10, 11, 20, 21, 30, 31)], "n int")
    found = rows(df.select("n", L.band_order(df.n), L.basket_band(df.n, "31+ items")))
    assert [r[1] for r in found] == [5, 1, 2, 2, 3, 3, 4, 4, 5]
    assert found[0][2] == "31+ items" and found[5][2] == "11-20 items"


def test_segments_and_cluster_names(spark):
    df = spark.createDataFrame([(n,) for n in (9, 10, 19, 20, 49, 50)], "n int")
    assert [r[0] for r in rows(df.select(L.user_segment(df.n)))] == [
        "New", "Regular", "Regular", "Frequent", "Frequent", "VIP"]
    assert [r[0] for r in rows(df.select(L.cluster_name(df.n)))] == [
        "Occasional Buyers", "Regular Customers", "Regular Customers", "Frequent Shoppers",
        "Frequent Shoppers", "VIP Customers"]


def test_only_test_orders_give_an_empty_typed_frame(spark):
    df = spark.createDataFrame(
        [("6", "300", "test", "1", "2", "12", None)],
        "order_id string, user_id string, eval_set string, order_number string, "
        "order_dow string, order_hour_of_day string, days_since_prior_order string")
    result = transforms.transform_orders(df)
    assert result.count() == 0 and len(result.columns) == 8
    assert dict(result.dtypes)["days_since_prior_order"] == "decimal(6,2)"


def test_orders_without_lines_keep_zero_metrics(spark, wh):
    metrics = transforms.order_metrics(wh.fact_order_details.where("order_id <> 1"))
    fresh = wh.fact_orders.selectExpr(
        "order_id", "0 AS total_items", "cast(0 as decimal(5,4)) AS reorder_ratio")
    found = {r.order_id: r.total_items
             for r in transforms.apply_order_metrics(fresh, metrics).collect()}
    assert found == {1: 0, 2: 2, 3: 3, 4: 2, 5: 2}


def test_resolving_twice_changes_nothing(wh):
    again = transforms.resolve_detail_times(wh.fact_order_details, wh.fact_orders)
    assert again.where("changed").count() == 0


@pytest.fixture(scope="module")
def shares(spark):
    return spark.createDataFrame(
        [("A", 5, 100, 70.0, 1, 45.45), ("B", 4, 80, 60.0, 2, 36.36),
         ("C", 3, 30, 50.0, 3, 13.64), ("D", 2, 10, 20.0, 4, 4.55)],
        "department_name string, orders bigint, total_items bigint, reorder_rate_pct double, "
        "unique_products bigint, market_share_pct double")


def test_condense_weights_the_folded_rate(shares):
    found = reshape.condense_departments(shares, 2).collect()
    assert [r.department_name for r in found] == ["All other departments", "B", "A"]
    assert found[0].reorder_rate_pct == pytest.approx(42.5)
    assert sum(r.market_share_pct for r in found) == pytest.approx(100)
    assert found[0].total_items == 40 and found[0].unique_products == 7
    assert reshape.condense_departments(shares, 4).count() == 4


def test_normalized_comparison(spark):
    df = spark.createDataFrame(
        [("A", 50, 100, 10, 60.0), ("B", 25, 50, 40, 30.0), ("C", 100, 80, 20, 40.0)],
        "department_name string, orders bigint, total_items bigint, unique_products bigint, "
        "reorder_rate_pct double")
    found = {(r.department_name, r.metric): r.relative_index
             for r in reshape.normalized_comparison(df, "A", "B").collect()}
    assert len(found) == 8
    assert found["A", "Order reach"] == 50 and found["B", "Order reach"] == 25
    assert found["A", "Item volume"] == 100 and found["B", "Product breadth"] == 100
    zero = df.selectExpr("department_name", "0L AS orders", "total_items", "unique_products",
                         "cast(null as double) AS reorder_rate_pct")
    flat = {(r.department_name, r.metric): r.relative_index
            for r in reshape.normalized_comparison(zero, "A", "B").collect()}
    assert flat["A", "Order reach"] == 0 and flat["A", "Reorder rate"] == 0


def test_segment_reshaping(spark):
    df = spark.createDataFrame(
        [("New", 60.0, 20.0), ("Odd", 0.0, 0.0), ("VIP", 10.0, 50.0), ("Regular", 30.0, 30.0)],
        "user_segment string, user_share_pct double, order_share_pct double")
    assert [r.user_segment for r in reshape.ordered_segments(df).collect()] == [
        "VIP", "Regular", "New", "Odd"]
    strongest = reshape.contribution_gap(df).where("is_strongest").collect()
    assert [(r.user_segment, r.gap) for r in strongest] == [("VIP", 40.0)]
    assert reshape.segment_share_long(df).count() == 8


def test_weekend_lift(spark):
    def lift(*pairs):
        df = spark.createDataFrame(list(pairs), "day_type string, avg_orders_per_day double")
        return [r.lift_pct for r in reshape.weekend_lift(df).collect()]

    assert lift(("Weekend", 15.0), ("Weekday", 10.0)) == [50.0]
    assert lift(("Weekend", 15.0), ("Weekday", 0.0)) == [0.0]
    assert lift(("Weekend", 15.0)) == []


def test_empty_warehouse_gives_zero_totals(wh):
    empty = wh.replaced(
        fact_orders=wh.fact_orders.where("false"), dim_user=wh.dim_user.where("false"))
    row = kpis.overview_kpis(empty).first()
    assert (row.total_orders, row.total_users, row.total_items) == (0, 0, 0)
    assert row.avg_basket_size is None and row.total_products == 4
