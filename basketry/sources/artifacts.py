"""Mining results as files: itemsets are JSON arrays inside CSV cells."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.errors import BasketDataError, RecommendationDataError
from basketry.functions.itemsets import itemset_from_json, itemset_json
from basketry.mining.recommend import require_labels
from basketry.mining.rules import METRICS, ordered_rules, with_names
from basketry.mining.itemsets import ordered_itemsets
from basketry.sources.files import QUOTING, READING


def export_csv(df: DataFrame, path: str) -> None:
    """Any result as headed CSV files; white space in cells is kept."""
    df.write.options(**QUOTING, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**READING).csv(path)


def save_rules(rules: DataFrame, path: str, names: DataFrame | None = None) -> None:
    """Rules, strongest first, with id itemsets and optionally name itemsets."""
    if rules.isEmpty():
        raise BasketDataError("Cannot save empty rules")
    extra = []
    if names is not None:
        columns = {"antecedents": "antecedent_names", "consequents": "consequent_names"}
        rules = with_names(rules, columns, names)
        extra = [itemset_json(F.col(name)).alias(f"{name}_json") for name in columns.values()]
    export_csv(
        ordered_rules(rules).select(
            itemset_json(F.col("antecedents")).alias("antecedents_json"),
            itemset_json(F.col("consequents")).alias("consequents_json"),
            *METRICS, *extra,
        ),
        path,
    )


def save_frequent_itemsets(itemsets: DataFrame, path: str, names: DataFrame | None = None) -> None:
    extra = []
    if names is not None:
        itemsets = with_names(itemsets, {"items": "item_names"}, names)
        extra = [itemset_json(F.col("item_names")).alias("item_names_json")]
    export_csv(
        ordered_itemsets(itemsets).select(
            itemset_json(F.col("items")).alias("itemsets_json"), "support", "length", *extra
        ),
        path,
    )


def _require(df: DataFrame, columns, what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise RecommendationDataError(f"{what} missing: {', '.join(missing)}")


def load_association_rules(spark: SparkSession, path: str) -> DataFrame:
    """Saved rules with real arrays and numbers; anything malformed is an error."""
    text = read_text_csv(spark, path)
    numbers = ("support", "confidence", "lift")
    _require(text, ("antecedents_json", "consequents_json", *numbers), "Association rules")
    sets = {"antecedents_json": "antecedents", "consequents_json": "consequents"}
    names = {"antecedent_names_json": "antecedent_names",
             "consequent_names_json": "consequent_names"}
    if set(names) <= set(text.columns):
        sets |= names
    rules = text.select(
        *[itemset_from_json(F.col(cell)).alias(name) for cell, name in sets.items()],
        *[F.col(name).cast("double").alias(name) for name in numbers],
    )
    facts = rules.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.array_contains(F.array(*[F.isnull(name) for name in sets.values()]), True))
        .alias("broken"),
    ).first()
    if not facts["n"]:
        raise RecommendationDataError("Association rules are empty")
    if facts["broken"]:
        raise RecommendationDataError(
            f"{facts['broken']:,} rules do not hold JSON arrays of string or integer items"
        )
    return rules


def save_cluster_labels(labels: DataFrame, path: str) -> None:
    export_csv(labels.select("user_id", "cluster").orderBy("user_id"), path)


def load_cluster_labels(spark: SparkSession, path: str) -> DataFrame:
    """Saved labels, one per user, sorted by user."""
    text = read_text_csv(spark, path)
    _require(text, ("user_id", "cluster"), "Cluster labels")
    return require_labels(text).orderBy("user_id")
