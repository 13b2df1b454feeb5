"""Data contracts of the six sources.

A contract is an ordered list of rules. All row rules of a dataset are counted in one
aggregate, every uniqueness rule in one combining aggregate of its key; the lowest
violated rule is the one reported.
"""

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.errors import DataQualityError
from basketry.functions.numbers import number
from basketry.session import together

SAMPLE_ROWS = 5
MAX_POSITION = 32_767

REPORT_COLUMNS = ("dataset", "rule_no", "rule", "column_name", "violations")


# Nothing, or white space of any script.
BLANK = r"(?U)^\s*$"


@dataclass(frozen=True)
class Rule:
    """One rule; ``kind`` picks the test and ``columns`` what it looks at."""

    kind: str
    columns: tuple[str, ...]
    low: int | None = None
    high: int | None = None
    allowed: tuple = ()
    allow_null: bool = False

    def violation(self, df: DataFrame) -> Column:
        """Row predicate of a row rule; never NULL."""
        name = self.columns[0]
        value = F.col(name)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "not_blank":
            return value.cast("string").rlike(BLANK)
        if self.kind == "allowed":
            return value.isNull() | ~_member(df, name, self.allowed)
        if self.kind == "first_order":
            first = F.coalesce(number(df, "order_number") == 1, F.lit(False))
            return first == F.col("days_since_prior_order").isNotNull()
        numeric = number(df, name)
        if self.kind == "integer":
            broken = numeric.isNull() | (numeric % 1 != 0)
        else:
            broken = numeric.isNull() | (numeric < self.low)
            if self.high is not None:
                broken = broken | (numeric > self.high)
        if self.allow_null:
            return value.isNotNull() & F.coalesce(broken, F.lit(True))
        return value.isNull() | F.coalesce(broken, F.lit(True))

    def message(self) -> str:
        column = ", ".join(self.columns)
        high = "any height" if self.high is None else self.high
        allowed = ", ".join(sorted(str(value) for value in self.allowed))
        return {
            "not_empty": "no rows",
            "not_null": f"{column} is empty in some rows",
            "not_blank": f"{column} is blank in some rows",
            "integer": f"{column} is no whole number in some rows",
            "range": f"{column} leaves the range from {self.low} to {high}",
            "allowed": f"{column} holds something else than {allowed}",
            "unique": f"rows share a key ({column})",
            "first_order": "only a first order may, and must, lack days_since_prior_order",
        }[self.kind]


def _member(df: DataFrame, name: str, allowed) -> Column:
    if all(isinstance(value, int) for value in allowed):
        return F.coalesce(number(df, name).isin(*allowed), F.lit(False))
    return F.col(name).isin(*allowed)


NOT_EMPTY = Rule("not_empty", ())


def not_null(name):
    return Rule("not_null", (name,))


def not_blank(name):
    """NULL is tested before blank text."""
    return (not_null(name), Rule("not_blank", (name,)))


def integer(name, allow_null=False):
    return Rule("integer", (name,), allow_null=allow_null)


def in_range(name, low, high=None, allow_null=False):
    return Rule("range", (name,), low=low, high=high, allow_null=allow_null)


def allowed(name, *values):
    return Rule("allowed", (name,), allowed=values)


def unique(*names):
    return Rule("unique", names)


_LINE_KEYS = ("order_id", "product_id", "add_to_cart_order", "reordered")
_ORDER_INTEGERS = ("order_id", "user_id", "order_number", "order_dow", "order_hour_of_day")
_LINES = (
    NOT_EMPTY,
    *(integer(name) for name in _LINE_KEYS),
    in_range("order_id", 1),
    in_range("product_id", 1),
    in_range("add_to_cart_order", 1, MAX_POSITION),
    allowed("reordered", 0, 1),
    unique("order_id", "product_id"),
    unique("order_id", "add_to_cart_order"),
)


def _named(key: str, name: str):
    return (NOT_EMPTY, integer(key), in_range(key, 1), *not_blank(name), unique(key), unique(name))


CONTRACTS = {
    "departments": _named("department_id", "department"),
    "aisles": _named("aisle_id", "aisle"),
    "products": (
        NOT_EMPTY,
        *(integer(name) for name in ("product_id", "aisle_id", "department_id")),
        *(in_range(name, 1) for name in ("product_id", "aisle_id", "department_id")),
        *not_blank("product_name"),
        unique("product_id"),
    ),
    "orders": (
        NOT_EMPTY,
        *(integer(name) for name in _ORDER_INTEGERS),
        *(in_range(name, 1) for name in ("order_id", "user_id", "order_number")),
        in_range("order_dow", 0, 6),
        in_range("order_hour_of_day", 0, 23),
        in_range("days_since_prior_order", 0, 30, allow_null=True),
        allowed("eval_set", "prior", "train", "test"),
        unique("order_id"),
        Rule("first_order", ("order_id", "order_number", "days_since_prior_order")),
    ),
    "order_products_prior": _LINES,
    "order_products_train": _LINES,
}


def require_columns(df: DataFrame, columns, dataset: str) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise DataQualityError(f"{dataset} lacks columns: {', '.join(missing)}")


def _key(df: DataFrame, name: str, rules) -> Column:
    """Key column as its number where the contract says it is one, so 1 equals 1.0."""
    numeric = any(rule.kind == "integer" and rule.columns == (name,) for rule in rules)
    return (number(df, name) if numeric else F.col(name)).alias(name)


def rule_violations(df: DataFrame, dataset: str, rules) -> DataFrame:
    """(dataset, rule_no, rule, column_name, violations), one row per rule."""
    def line(place, rule, count):
        return F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(place).alias("rule_no"),
            F.lit(rule.kind).alias("rule"),
            F.lit(", ".join(rule.columns)).alias("column_name"),
            count.alias("violations"),
        )

    row_rules = [(p, r) for p, r in enumerate(rules, start=1) if r.kind != "unique"]
    counts = {
        place: F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint")
        if rule.kind == "not_empty" else F.count_if(rule.violation(df))
        for place, rule in row_rules
    }
    reports = []
    if counts:
        totals = df.agg(*[count.alias(f"v{place}") for place, count in counts.items()])
        reports.append(totals.select(F.inline(F.array(
            *[line(place, rule, F.col(f"v{place}")) for place, rule in row_rules]
        ))))
    for place, rule in enumerate(rules, start=1):
        if rule.kind == "unique":
            repeated = (
                df.select(*[_key(df, name, rules) for name in rule.columns])
                .groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n"))
                .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n"))
            )
            reports.append(repeated.select(F.inline(F.array(line(place, rule, F.col("n"))))))
    return reduce(DataFrame.unionAll, reports)


def _sample(df: DataFrame, rule: Rule, rules) -> list[dict]:
    """At most five offending rows; a duplicate key is shown once for every row it has."""
    if rule.kind == "unique":
        keys = list(rule.columns)
        bad = (
            df.select(*[_key(df, name, rules) for name in keys])
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
            .limit(SAMPLE_ROWS)
            .select(*keys, F.explode(F.sequence(F.lit(1), F.least("n", F.lit(SAMPLE_ROWS)))))
            .select(*keys)
        )
    else:
        bad = df.where(rule.violation(df)).select(*rule.columns)
    return [row.asDict() for row in bad.limit(SAMPLE_ROWS).collect()]


def _raise(df: DataFrame, dataset: str, rules, rule_no: int) -> None:
    rule = rules[rule_no - 1]
    text = f"{dataset}: {rule.message()}"
    if rule.kind != "not_empty":
        text += f"; sample={_sample(df, rule, rules)}"
    raise DataQualityError(text)


def enforce(df: DataFrame, dataset: str, rules) -> None:
    """Raise for the first rule that some row breaks."""
    require_columns(df, {name for rule in rules for name in rule.columns}, dataset)
    broken = rule_violations(df, dataset, rules).where("violations > 0").orderBy("rule_no").first()
    if broken is not None:
        _raise(df, dataset, rules, broken.rule_no)


def source_violations(sources: dict[str, DataFrame]) -> DataFrame:
    """Violation counts of all datasets in one frame."""
    reports = [rule_violations(sources[name], name, rules) for name, rules in CONTRACTS.items()]
    return reduce(DataFrame.unionAll, reports)


def enforce_sources(sources: dict[str, DataFrame]) -> None:
    """Check all datasets side by side; raise for the first broken rule in contract order."""
    for dataset, rules in CONTRACTS.items():
        columns = {name for rule in rules for name in rule.columns}
        require_columns(sources[dataset], columns, dataset)

    def first_broken(dataset):
        report = rule_violations(sources[dataset], dataset, CONTRACTS[dataset])
        return report.where("violations > 0").orderBy("rule_no").first()

    broken = together(*[partial(first_broken, dataset) for dataset in CONTRACTS])
    for dataset, row in zip(CONTRACTS, broken, strict=True):
        if row is not None:
            _raise(sources[dataset], dataset, CONTRACTS[dataset], row.rule_no)
