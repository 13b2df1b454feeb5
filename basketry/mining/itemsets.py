"""Frequent itemsets, by pattern growth, level by level, and from the closed ones among them."""

from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.errors import BasketDataError
from basketry.functions.itemsets import itemset_json
from basketry.mining.baskets import Baskets
from basketry.session import materialize, materialize_dealt, small_broadcast

# Levels and candidate lists up to this many rows are broadcast.
SMALL_LEVEL = 100_000
# The extensions of a set in more baskets than this are counted before they are shuffled.
BUSY_NODE = 100_000
# Held baskets that meet in one task, where each has a row for every item that extends its set.
HELD_PER_TASK = 250_000


def _require_support(min_support: float) -> None:
    if not 0 < min_support <= 1:
        raise ValueError("min_support must be in (0, 1]")


def smallest_count(min_support: float, baskets: int) -> int:
    """Fewest baskets whose share reaches ``min_support``, the boundary included."""
    count = max(ceil(min_support * baskets) - 1, 1)
    while count / baskets < min_support:
        count += 1
    return count


def _finished(counts: DataFrame, baskets: Baskets, min_support: float) -> DataFrame:
    """(items, freq, support, length), most supported and shortest first."""
    result = materialize(
        counts.where(F.col("freq") >= smallest_count(min_support, baskets.count)).select(
            "items", "freq", (F.col("freq") / F.lit(baskets.count)).alias("support"),
            F.size("items").alias("length"),
        ),
        "itemsets",
    )
    if result.isEmpty():
        raise BasketDataError("No frequent itemsets; lower min_support")
    return result


def ordered_itemsets(itemsets: DataFrame) -> DataFrame:
    return itemsets.orderBy(F.desc("support"), "length", itemset_json(F.col("items")))


def frequent_itemsets(baskets: Baskets, min_support: float = 0.01) -> DataFrame:
    """Itemsets of any length with enough support, by Spark's distributed FP-Growth."""
    _require_support(min_support)
    # A hair below the bound, so that floating point never loses a boundary itemset; the
    # exact count decides afterwards.
    floor = smallest_count(min_support, baskets.count)
    growth = FPGrowth(itemsCol="items", minSupport=(floor - 0.5) / baskets.count)
    found = growth.fit(baskets.frame).freqItemsets
    return _finished(found.select(F.array_sort("items").alias("items"), "freq"), baskets, min_support)


def _candidates(level: DataFrame, length: int) -> DataFrame:
    """(parent, item, items) of one more item than ``level`` has: two sets that differ in their
    last item only, all of whose other subsets are frequent as well."""
    sides = level.select(
        "items", F.slice("items", 1, length - 1).alias("head"), F.element_at("items", -1).alias("item")
    )
    right = sides.select("head", "item")
    joined = sides.withColumnRenamed("item", "last").join(right, "head").where(
        F.col("last") < F.col("item")
    ).select(F.col("items").alias("parent"), "item", F.concat("items", F.array("item")).alias("items"))
    if length < 2:
        return joined
    # without its last item a set is its parent, without the one before it the other parent
    subsets = joined.select("items", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(length - 1)),
        lambda gap: F.filter("items", lambda _, i: i + 1 != gap))).alias("subset"))
    broken = subsets.join(level.select(F.col("items").alias("subset")), "subset", "left_anti")
    return joined.join(broken.select("items").distinct(), "items", "left_anti")


def _extensions(held: DataFrame, *keys: str) -> DataFrame:
    """(*keys, item, rest): every later item of the baskets that hold a set, and what follows it."""
    return held.select(*keys, "rest", F.posexplode("rest").alias("at", "item")).select(
        *keys, "item", F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"))


def _baskets_of(rows: DataFrame, *key: str) -> DataFrame:
    """(*key, freq, low, high): the number of baskets, the first and the last."""
    return rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("freq"), F.min("order_id").alias("low"), F.max("order_id").alias("high"))


def _frequent_baskets(baskets: Baskets, floor: int) -> tuple[DataFrame, DataFrame, bool]:
    """Written: (item, freq, low, high) of the frequent items, with the first and last basket. Then (order_id, rest), each basket's frequent items,
    sorted, and whether that is more than a look at the written baskets, as some items are rare."""
    lines = baskets.frame.select("order_id", F.explode(F.array_distinct("items")).alias("item"))
    counts = materialize(_baskets_of(lines, "item"), "items")
    singles = counts.where(F.col("freq") >= floor)
    if counts.where(F.col("freq") < floor).isEmpty():
        whole = F.array_sort(F.array_distinct("items"))
        return singles, baskets.frame.select("order_id", whole.alias("rest")), False
    kept = lines.join(small_broadcast(singles.select("item"), SMALL_LEVEL), "item", "left_semi")
    return singles, kept.groupBy("order_id").agg(F.array_sort(F.collect_list("item")).alias("rest")), True


def apriori_itemsets(baskets: Baskets, min_support: float = 0.01) -> DataFrame:
    """The same itemsets level by level: every frequent set is extended by later items.

    A level is a frame, and so are the baskets that hold its sets: a row is a set's number and
    the frequent items of the basket behind it, so an extension is held where its last item is
    among them, and no level meets the orders again. Nothing but row counts reaches the driver.
    """
    _require_support(min_support)
    floor = smallest_count(min_support, baskets.count)
    singles, frequent, _ = _frequent_baskets(baskets, floor)
    nothing = F.lit(0).cast("bigint").alias("parent")
    held = frequent.select(nothing, "rest")
    level = singles.select(nothing, "item", F.array("item").alias("items"), "freq")
    found, length = None, 1
    while True:
        level = materialize(level.withColumn("id", F.monotonically_increasing_id()), "level")
        found = level.select("items", "freq") if found is None else found.unionAll(level.select("items", "freq"))
        if level.isEmpty():
            return _finished(found, baskets, min_support)
        known = small_broadcast(level.select("parent", "item", "id"), SMALL_LEVEL)
        held = materialize(
            _extensions(held, "parent").where(F.size("rest") > 0).join(known, ["parent", "item"])
            .select(F.col("id").alias("parent"), "rest"),
            "held",
        )
        extended = materialize(
            _candidates(level.select("items"), length).withColumnRenamed("parent", "head")
            .join(level.select(F.col("items").alias("head"), F.col("id").alias("parent")), "head")
            .select("parent", "item", "items"),
            "candidates",
        )
        counts = (
            _extensions(held, "parent").select("parent", "item")
            .join(small_broadcast(extended.select("parent", "item"), SMALL_LEVEL), ["parent", "item"])
            .groupBy("parent", "item").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= floor)
        )
        level = counts.join(extended, ["parent", "item"]).select("parent", "item", "items", "freq")
        length += 1


def _counted(held: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, item, freq, low, high): the extensions of held sets, the number of their baskets, and
    the first and last of these.

    A node's baskets meet in one place as they are, and are only taken apart there: few of a large
    catalogue's extensions are ever held twice, so counts combined before the shuffle would be no
    fewer. Those of a node with many baskets are, so they are counted that way. Tasks follow the
    number of baskets: bytes say little, as the rows of a held basket are made after the shuffle.
    """
    def counts(rows):
        return _baskets_of(_extensions(rows, "node", "order_id"), "node", "item")

    busy = nodes.where(F.col("freq") > BUSY_NODE).select("node")
    few = nodes.where(F.col("freq") <= BUSY_NODE).agg(F.sum("freq")).first()[0] or 0
    # A number of its own, because Spark would merge tasks by bytes.
    width = max(-(-few // HELD_PER_TASK), held.sparkSession.sparkContext.defaultParallelism)
    if busy.isEmpty():
        return counts(held.repartition(width, "node"))
    keys = F.broadcast(busy)
    met = held.join(keys, "node", "left_anti").repartition(width, "node")
    return counts(met).unionAll(counts(held.join(keys, "node", "left_semi")))


def _closures(counts: DataFrame, held: DataFrame, frequent: DataFrame) -> DataFrame:
    """``counts``, extensions (node, item, freq, low, high, above), with the ``items`` that all their
    baskets hold; ``low`` and ``high`` are the first and last of these, and ``above`` holds the items
    of the node that was extended. ``held`` are the nodes' baskets, ``frequent`` all baskets.

    Only what both of two baskets hold can be in all. It is little beyond the set itself, so the
    other baskets are asked about few items, and only where there are others.
    """
    low, high = [frequent.select(F.col("order_id").alias(name), F.col("rest").alias(f"{name}_items"))
                 for name in ("low", "high")]
    shared = F.array_except(F.array_intersect("low_items", "high_items"), F.col("above"))
    both = materialize(
        counts.join(low, "low").join(high, "high").select(*counts.columns, shared.alias("shared")),
        "shared-by-two")
    key, two = ["node", "item"], F.col("freq") <= 2
    asked = materialize(
        both.where(~two).select(*key, "freq", F.explode("shared").alias("other"))
        .where(F.col("other") != F.col("item")), "asked")
    # What is extended and by what is in all baskets, and two baskets have no others to ask.
    sure = F.concat("above", F.when(two, F.col("shared")).otherwise(F.array("item")))
    if asked.isEmpty():
        return both.select(*counts.columns, F.array_sort(sure).alias("items"))
    some = asked.select(*key).distinct()
    grown = _extensions(held, "node", "order_id").join(small_broadcast(some, SMALL_LEVEL), key, "left_semi")
    lines = grown.select(*key, "order_id").join(frequent, "order_id").select(*key, F.explode("rest").alias("other"))
    more = (
        lines.join(small_broadcast(asked, SMALL_LEVEL), [*key, "other"])
        .groupBy(*key, "freq", "other").agg(F.count(F.lit(1)).alias("n")).where("n = freq")
        .groupBy(*key).agg(F.collect_list("other").alias("more"))
    )
    nothing = F.array().cast("array<string>")
    return both.join(more, key, "left").select(
        *counts.columns, F.array_sort(F.concat(sure, F.coalesce("more", nothing))).alias("items"))


def _held_by_items(held: DataFrame, counts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, order_id, rest) of the sets grown from one item, which is their number: all but the few
    that another item stands for, without what the few that were filled up hold."""
    gone = small_broadcast(counts.join(nodes, counts["item"] == nodes["last"], "left_anti").select(
        F.col("item").alias("node")), SMALL_LEVEL)
    filled = small_broadcast(nodes.where(F.size("items") > F.size("above") + 1).select("node", "items"), SMALL_LEVEL)
    rows = _extensions(held, "order_id").where(F.size("rest") > 0).withColumnRenamed("item", "node")
    return rows.join(gone, "node", "left_anti").join(filled, "node", "left").select(
        "node", "order_id",
        F.when(F.col("items").isNull(), F.col("rest")).otherwise(F.array_except("rest", "items")).alias("rest")
    ).where(F.size("rest") > 0)


def _held_by_nodes(held: DataFrame, nodes: DataFrame, frequent: DataFrame) -> DataFrame:
    """Written: (node, order_id, rest) of ``nodes``, extensions of the sets in ``held``. Two baskets
    are known by their ids; only where there are more are the held rows asked again."""
    ends = F.explode(F.array_distinct(F.array("low", "high"))).alias("order_id")
    beyond = F.filter("rest", lambda item: item > F.col("last"))
    few = nodes.where(F.col("freq") <= 2).select("node", "last", "items", ends).join(frequent, "order_id").select(
        "node", "order_id", F.array_except(beyond, "items").alias("rest"))
    named = nodes.where(F.col("freq") > 2).select(
        F.col("node").alias("child"), F.col("parent").alias("node"), F.col("last").alias("item"), "items")
    many = _extensions(held, "node", "order_id").join(small_broadcast(named, SMALL_LEVEL), ["node", "item"]).select(
        F.col("child").alias("node"), "order_id", F.array_except("rest", "items").alias("rest"))
    return materialize(few.unionAll(many).where(F.size("rest") > 0), "held")


def closed_itemsets(baskets: Baskets, min_support: float = 0.01) -> DataFrame:
    """(items, freq, support, length) of the frequent itemsets that no item can join without
    losing a basket.

    They hold the count of every frequent itemset: that of the smallest closed set around it. Two
    equal baskets of forty items have one closed set, and 2^40 frequent ones.

    A closed set is extended by an item beyond the one it was extended by last, and then filled
    up with all that its baskets share. It is kept if that adds nothing before the item: so each
    closed set is reached along one path, once. A round works on rows of a set's number, a basket
    that holds the set, and what the basket has to extend it by.
    """
    _require_support(min_support)
    floor = smallest_count(min_support, baskets.count)
    singles, frequent, aggregated = _frequent_baskets(baskets, floor)
    if aggregated and baskets.buckets:
        frequent = materialize_dealt(frequent, "frequent-baskets", "order_id", baskets.buckets)
    elif aggregated:
        frequent = materialize(frequent, "frequent-baskets")
    everywhere = F.col("freq") == baskets.count
    root = materialize(singles.where(everywhere).agg(F.array_sort(F.collect_list("item")).alias("items")).select(
        F.lit("").alias("node"), F.lit(baskets.count).cast("bigint").alias("freq"), "items"), "closed")
    above = F.broadcast(root.select("node", F.col("items").alias("above")))
    held = frequent.crossJoin(above).select("node", "order_id", F.array_except("rest", "above").alias("rest"))
    counts = materialize(singles.where(~everywhere).crossJoin(above), "extensions")
    found, number, nodes = root.where(F.size("items") > 0).select("items", "freq"), F.col("item"), None
    while not counts.isEmpty():
        added = F.array_except("items", "above")
        closed = materialize(
            _closures(counts, held, frequent)
            .where(~F.exists(added, lambda item: item < F.col("item")))
            .select(number.alias("node"), F.col("node").alias("parent"), F.col("item").alias("last"),
                    "freq", "low", "high", "above", "items"), "closed")
        found = found.unionAll(closed.select("items", "freq"))
        held = _held_by_items(held, counts, closed) if nodes is None else _held_by_nodes(held, closed, frequent)
        nodes, number = closed, F.monotonically_increasing_id().cast("string")
        above = small_broadcast(nodes.select("node", F.col("items").alias("above")), SMALL_LEVEL)
        counts = materialize(
            _counted(held, nodes).where(F.col("freq") >= floor).join(above, "node"), "extensions")
    return _finished(found, baskets, min_support)


def itemsets_of_closed(closed: DataFrame, baskets: Baskets, max_length: int | None = None) -> DataFrame:
    """The frequent itemsets, up to ``max_length`` items, that closed ones stand for: their
    subsets, each with the largest count of a closed set around it.

    Sets of one length come from those a single item longer, so every set is made once from each
    of its neighbours above. Without ``max_length`` a long closed set has two to its length.
    """
    if max_length is not None and max_length < 1:
        raise ValueError("max_length must be positive")
    longest = closed.agg(F.max("length")).first()[0] or 0
    wanted, found, level = min(longest, max_length or longest), None, None
    if wanted < longest:
        # What a longer set has of the wanted length, without the lengths between.
        level = _cut_to(closed.where(F.col("length") > wanted).select("items", "freq"), wanted)
    for length in range(wanted, 0, -1):
        here = closed.where(F.col("length") == length).select("items", "freq")
        if level is not None:
            here = here.unionAll(level)
        here = materialize(here.groupBy("items").agg(F.max("freq").alias("freq")), "subsets")
        found = here if found is None else found.unionAll(here)
        level = here.select("freq", F.explode(F.transform("items", lambda _, i: F.filter(
            "items", lambda _, j: j != i))).alias("items")).select("items", "freq")
    if found is None:
        raise BasketDataError("No frequent itemsets; lower min_support")
    return _finished(found, baskets, 1 / baskets.count)


def _cut_to(sets: DataFrame, length: int) -> DataFrame:
    """(items, freq) of all subsets with so many items, grown item by item in the sets' order."""
    grown = sets.select("items", "freq", F.array().cast("array<string>").alias("part"), F.lit(0).alias("from"))
    for _ in range(length):
        grown = grown.select("items", "freq", "part", F.posexplode("items").alias("at", "item"), "from").where(
            F.col("at") >= F.col("from")).select(
            "items", "freq", F.concat("part", F.array("item")).alias("part"), (F.col("at") + 1).alias("from"))
    return grown.groupBy("part").agg(F.max("freq").alias("freq")).select(F.col("part").alias("items"), "freq")


def frequent_itemsets_by_closure(baskets: Baskets, min_support: float = 0.01) -> DataFrame:
    """The same itemsets as pattern growth gives, by way of the closed ones: for low counts,
    where long baskets that repeat hold more frequent sets than pattern growth can visit."""
    return itemsets_of_closed(closed_itemsets(baskets, min_support), baskets)
