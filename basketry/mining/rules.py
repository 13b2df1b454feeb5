"""Association rules, grown consequent by consequent, and their text form."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.errors import BasketDataError
from basketry.functions.itemsets import itemset_json
from basketry.session import materialize

METRICS = ("support", "confidence", "lift", "leverage", "conviction")


def _measured(cuts: DataFrame, known: DataFrame) -> DataFrame:
    """Cut itemsets (items, support, consequents) with their antecedent, its support and the
    confidence. Items of a set are sorted, so what a consequent leaves is again a key of the input."""
    cuts = cuts.withColumn("antecedents", F.array_except("items", "consequents"))
    left = known.select(F.col("items").alias("antecedents"), F.col("support").alias("_left"))
    return cuts.join(left, "antecedents").select(
        "items", "antecedents", "consequents", "support", "_left", (F.col("support") / F.col("_left")).alias("confidence"))


def _longer_consequents(level: DataFrame, length: int) -> DataFrame:
    """(items, support, consequents) with one item more than ``level`` has: of two consequents of
    an itemset that differ in their last item only, if all others they hold are there as well.

    A consequent longer by one item has a shorter antecedent, whose support is no smaller, so a
    rule that fails takes every longer consequent with it.
    """
    sides = level.select("items", "support", F.slice("consequents", 1, length - 1).alias("head"),
                         F.element_at("consequents", -1).alias("last"))
    other = sides.select("items", "head", F.col("last").alias("further"))
    grown = sides.join(other, ["items", "head"]).where(F.col("last") < F.col("further")).select(
        "items", "support", F.concat("head", F.array("last", "further")).alias("consequents")
    ).where(F.size("consequents") < F.size("items"))
    if length < 2:
        return grown
    # Without its last item, or the one before it, a consequent is one of the two it came from.
    shorter = grown.select("items", "consequents", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(length - 1)),
        lambda gap: F.filter("consequents", lambda _, i: i + 1 != gap))).alias("shorter"))
    broken = shorter.join(level.select("items", F.col("consequents").alias("shorter")),
                          ["items", "shorter"], "left_anti")
    return grown.join(broken.select("items", "consequents").distinct(), ["items", "consequents"], "left_anti")


def _confident_cuts(itemsets: DataFrame, known: DataFrame, min_confidence: float | None) -> DataFrame:
    """Cuts of all itemsets, level by level of their consequents. With ``min_confidence`` only
    cuts that reach it, and rows made are those plus the ones that fail just beyond them."""
    singles = itemsets.where(F.col("length") >= 2).select(
        "items", "support", F.explode("items").alias("item")).select(
        "items", "support", F.array("item").alias("consequents"))
    found, cuts, length = None, singles, 1
    while True:
        level = _measured(cuts, known)
        if min_confidence is not None:
            level = level.where(F.col("confidence") >= min_confidence)
        level = materialize(level, "rule-level")
        found = level if found is None else found.unionAll(level)
        if level.isEmpty():
            return found
        cuts, length = _longer_consequents(level, length), length + 1


def generate_rules(
    itemsets: DataFrame, metric: str = "confidence", min_threshold: float = 0.3
) -> DataFrame:
    """Rules whose ``metric`` reaches the threshold, over (items, support, length) itemsets.

    By confidence, a consequent only grows while its rule holds, so the work follows the rules
    that are kept. No other metric bounds longer consequents: for those every cut is looked at.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of: {', '.join(METRICS)}")
    known = itemsets.select("items", "support")
    rights = known.select(F.col("items").alias("consequents"), F.col("support").alias("_right"))
    cuts = _confident_cuts(itemsets, known, min_threshold if metric == "confidence" else None)
    both, confidence = F.col("support"), F.col("confidence")
    left, right = F.col("_left"), F.col("_right")
    rules = (
        cuts.join(rights, "consequents")
        .select(
            "antecedents",
            "consequents",
            "support",
            "confidence",
            (confidence / right).alias("lift"),
            (both - left * right).alias("leverage"),
            F.when(confidence >= 1, F.lit(float("inf")))
            .otherwise((1 - right) / F.nullif(1 - confidence, F.lit(0.0)))
            .alias("conviction"),
        )
        .where(F.col(metric) >= min_threshold)
    )
    return rules


def require_rules(rules: DataFrame, metric: str = "confidence", min_threshold: float = 0.3):
    if rules.isEmpty():
        raise BasketDataError(f"No association rules satisfy {metric}>={min_threshold}")
    return rules


def rule_json(rules: DataFrame) -> DataFrame:
    """Rules with both sides as JSON text."""
    return rules.select(
        itemset_json(F.col("antecedents")).alias("antecedents_json"),
        itemset_json(F.col("consequents")).alias("consequents_json"),
        *METRICS,
    )


def ordered_rules(rules: DataFrame) -> DataFrame:
    """Strongest first: lift, confidence, support, then the text of both sides."""
    return rules.orderBy(
        F.desc("lift"), F.desc("confidence"), F.desc("support"),
        itemset_json(F.col("antecedents")), itemset_json(F.col("consequents")),
    )


def top_rules(rules: DataFrame, n: int = 20) -> DataFrame:
    if n <= 0:
        raise ValueError("n must be positive")
    return ordered_rules(rules).limit(n)


def item_names(wh, item: str = "product") -> DataFrame:
    """(item, item_name) of the catalogue that baskets draw from."""
    if item == "aisle":
        return wh.dim_aisle.select(
            F.col("aisle_id").cast("string").alias("item"), F.col("aisle_name").alias("item_name")
        )
    return wh.dim_product.select(
        F.col("product_id").cast("string").alias("item"), F.col("product_name").alias("item_name")
    )


def with_names(sets: DataFrame, columns: dict[str, str], names: DataFrame) -> DataFrame:
    """Add name arrays for id arrays (``columns``: id column -> name column).

    Ids without a name become ``product:<id>``. Only the ids that occur are looked up, and
    each distinct set is translated once.
    """
    for ids, target in columns.items():
        distinct = sets.select(ids).distinct()
        named = (
            distinct.select(ids, F.explode(ids).alias("item"))
            .join(names, "item", "left")
            .groupBy(ids)
            .agg(F.array_sort(F.collect_list(
                F.coalesce("item_name", F.concat(F.lit("product:"), "item"))
            )).alias(target))
        )
        sets = sets.join(named, ids, "left")
    return sets


def rules_with_names(rules: DataFrame, names: DataFrame) -> DataFrame:
    columns = {"antecedents": "antecedent_names", "consequents": "consequent_names"}
    return with_names(rules, columns, names)
