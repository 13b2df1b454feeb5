"""Source contracts: what each rule accepts and rejects."""

import pytest
from conftest import ORDERS, PRIOR, make_sources

from basketry.errors import DataQualityError
from basketry.operators import contracts as C


def frame(spark, values, schema="x string"):
    return spark.createDataFrame([(v,) for v in values], schema)


def violations(spark, values, *rules, schema="x string"):
    report = C.rule_violations(frame(spark, values, schema), "t", rules)
    return [row.violations for row in report.orderBy("rule_no").collect()]


def test_fixture_is_clean(spark):
    sources = make_sources(spark)
    C.enforce_sources(sources)
    assert C.source_violations(sources).where("violations > 0").count() == 0


@pytest.mark.parametrize("values, rule, expected", [
    (["1", "1.0", " 2 ", "1e2"], C.integer("x"), 0),
    (["1.5", "abc", None, "NaN", "1d", ""], C.integer("x"), 6),
    ([None, "3"], C.integer("x", allow_null=True), 0),
    (["1", "10"], C.in_range("x", 1, 10), 0),
    (["0", "11", "z", None], C.in_range("x", 1, 10), 4),
    (["999999999999"], C.in_range("x", 1), 0),
    ([None, "31", "5"], C.in_range("x", 0, 30, allow_null=True), 1),
    (["prior", "later", None], C.allowed("x", "prior", "train"), 2),
    (["0", "1", "1.0", "2", None], C.allowed("x", 0, 1), 2),
    (["a", "a", "b", "c", "c", "c"], C.unique("x"), 5),
    ([None, None, "a"], C.unique("x"), 2),
    (["a", None], C.not_null("x"), 1),
    (["a", "  ", None], C.not_blank("x")[1], 1),
])
def test_rules(spark, values, rule, expected):
    assert violations(spark, values, rule) == [expected]


def test_numeric_keys_are_compared_as_numbers(spark):
    assert violations(spark, ["1", "1.0", "2"], C.integer("x"), C.unique("x")) == [0, 2]


def test_empty_source(spark):
    assert violations(spark, [], C.NOT_EMPTY) == [1]
    with pytest.raises(DataQualityError, match="orders: no rows"):
        C.enforce_sources(make_sources(spark, orders=[]))


def test_missing_column_is_named(spark):
    with pytest.raises(DataQualityError, match="t lacks columns: y"):
        C.enforce(frame(spark, ["1"]), "t", (C.integer("y"),))


def test_first_broken_rule_is_reported_with_a_sample(spark):
    orders = [(i, 100, "prior", 1, 9, 25, None) for i in range(1, 9)]
    with pytest.raises(DataQualityError) as error:
        C.enforce_sources(make_sources(spark, orders=orders))
    assert "orders: order_dow leaves the range from 0 to 6" in str(error.value)
    assert str(error.value).count("'order_dow': '9'") == 5


@pytest.mark.parametrize("order", [
    (7, 400, "prior", 1, 0, 0, 3), (7, 400, "prior", 2, 0, 0, None),
])
def test_only_first_orders_lack_a_gap(spark, order):
    with pytest.raises(DataQualityError, match="only a first order may"):
        C.enforce_sources(make_sources(spark, orders=[*ORDERS, order]))


@pytest.mark.parametrize("line, message", [
    ((1, 10, 3, 0), r"rows share a key \(order_id, product_id\)"),
    ((1, 11, 1, 0), r"rows share a key \(order_id, add_to_cart_order\)"),
    ((1, 21, 40_000, 0), "add_to_cart_order leaves the range from 1 to 32767"),
    ((1, 21, 3, 2), "reordered holds something else than 0, 1"),
])
def test_line_contract(spark, line, message):
    with pytest.raises(DataQualityError, match=message):
        C.enforce_sources(make_sources(spark, order_products_prior=[*PRIOR, line]))


def test_blank_and_duplicate_names(spark):
    with pytest.raises(DataQualityError, match="department is blank in some rows"):
        C.enforce_sources(make_sources(spark, departments=[(1, "  "), (2, "a")]))
    with pytest.raises(DataQualityError, match=r"rows share a key \(aisle\)"):
        C.enforce_sources(make_sources(spark, aisles=[(1, "a"), (2, "a")]))


def test_csv_cells_survive_a_round_trip(spark, tmp_path):
    from basketry.sources import artifacts, files

    names = ['Ham "Deli" Style, Sliced', "two\nlines", "back\\slash", "\tTAB ", '"', ",", "NA", "é"]
    given = spark.createDataFrame([(str(i), n, "2", "3") for i, n in enumerate(names)],
                                  "product_id string, product_name string, aisle_id string, department_id string")
    artifacts.export_csv(given.repartition(3), str(tmp_path / "out"))
    found = files.read_csv(spark, str(tmp_path / "out"), given.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, given.collect()))


def test_files_of_a_folder_keep_their_own_header(spark, tmp_path):
    from basketry.sources import files

    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n4,3\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path), ["x", "y"]).collect()


@pytest.mark.parametrize("blank", ["\t", "\u00a0\u2003", " \n"])
def test_white_space_of_any_kind_is_blank(spark, blank):
    assert violations(spark, [blank, "a", ""], *C.not_blank("x")) == [0, 2]
