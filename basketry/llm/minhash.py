"""MinHash near-duplicates: bottom-k sketches of one hash function, inverted lists, exact Jaccard.

1. A text's set of word shingles is hashed once; its ``SKETCH`` smallest values are its sketch.
   Texts with one set form a class, and only classes are compared.
2. Retained values that two classes hold make inverted lists. Sets of the similarity share at
   least t values of their sketches: all that the similarity asks for while a union fits in a
   sketch, else the tail bound below. So a class is listed under all its shared values but its
   t - 1 commonest: a passage that very many texts share puts none of them in a list unless it
   fills their sketches.
3. Every member of a list is compared with the list's first member (a star, one row a member).
   Lists that meet make families; links make components.
4. Families whose members lie in one component are settled. Of the others, members of different
   components are compared in blocks: small families several to a block, large ones in blocks by
   component, star and size, and two blocks meet if a list holds members of both.
5. A comparison inverts the sketches of a block. The values below the smaller of two sketch
   ends are an even sample of the union: the shared part of it estimates the similarity. Pairs
   below the estimate's tail bound are dropped, the others counted exactly on their whole sets. A
   task gives a forest of its links, never all pairs.

The bounds leave out a pair of the similarity with a chance of ``RISK`` at most, whatever the data;
sets that fit in their sketches are compared exactly.

Defined results. A null, empty or blank text has no shingles and is linked with nothing. A text
of fewer than five words is one shingle. Rows that repeat a doc_id are documents of their own; a
null doc_id is never the smallest of a component unless no other is there. An empty table gives
an empty result. Extra columns are not read, or pass through untouched.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import free_name, utf8
from basketry.llm.components import components
from basketry.llm.shingles import Shingler
from basketry.session import materialize, small_broadcast

WORDS = 5
PERCENT = 85
SKETCH = 64
RISK = 1e-12
# A block of a comparison holds at most about so many sets, and so many shingles.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 19
# Families and stars up to this size share blocks.
SMALL_FAMILY = 64
# The list of documents whose sets are compared is broadcast up to this many rows of 60 bytes.
SMALL_SIDE = 1 << 18


def least_shared(sample: int, percent: int, risk: float = RISK) -> int:
    """How many of ``sample`` values drawn from a union both sets hold, but for a chance of
    ``risk``, if they have the similarity. Draws without replacement stay closer to their mean
    than the binomial draws that are summed here."""
    p, below = percent / 100, 0.0
    for t in range(sample + 1):
        below += math.comb(sample, t) * p ** t * (1 - p) ** (sample - t)
        if below > risk:
            return t
    return sample


def text_mark(text: Column) -> Column:
    """Tells the texts of a repeated id apart; the class decides where two have one mark."""
    return F.xxhash64(text)


def _texts(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark(text).alias("mark"), text.alias("text"))


def _digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def sketches(documents: DataFrame, words: int, k: int) -> DataFrame:
    """(doc_id, mark, class, n, sketch): the k smallest hash values of every set."""

    def run(batches):
        shingler = Shingler(words)
        for batch in batches:
            classes, sizes, kept = [], [], []
            for text in utf8(batch.column(2)):
                tokens = shingler.shingles(text)
                classes.append(_digest(tokens))
                sizes.append(tokens.size)
                kept.append(tokens[:k].view(np.int64))
            starts = np.cumsum([0, *map(len, kept)], dtype=np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *kept])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(classes, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(starts), pa.array(flat))], ["doc_id", "mark", "class", "n", "sketch"])

    return _texts(documents).mapInArrow(run, "doc_id long, mark long, class binary, n long, sketch array<long>")


def inverted_lists(classes: DataFrame, percent: int, k: int) -> DataFrame:
    """(value, node, n): the lists that a class has to be in."""
    values = classes.select("node", "n", F.explode("sketch").alias("value"))
    held = materialize(values.groupBy("value").agg(F.count("*").alias("held")).where("held > 1"), "retained-values")
    shared = values.join(held, "value").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("held", "value"))).alias("shared"))
    # Where any union of the similarity fits in a sketch, sketches are the sets.
    need = F.when(F.col("n") * 100 <= k * percent, F.ceil(F.col("n") * percent / 100)).otherwise(least_shared(k, percent))
    rarest = F.col("size") - need.cast("int") + 1
    listed = shared.withColumn("size", F.size("shared")).where(rarest > 0).select(
        "node", "n", F.explode(F.slice("shared", F.lit(1), rarest)).alias("entry"))
    return materialize(listed.select(F.col("entry.value").alias("value"), "node", "n"), "inverted-lists")


def stars(lists: DataFrame) -> DataFrame:
    """(node, n, leader): every member of a list and the list's first member."""
    leaders = lists.groupBy("value").agg(F.min("node").alias("leader"), F.count("*").alias("held")).where("held > 1")
    return materialize(lists.join(leaders.drop("held"), "value").where(F.col("node") > F.col("leader")).select(
        "node", "n", "leader").distinct(), "stars")


def whole_sets(documents: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, n, tokens) of the ``wanted`` classes (node, class, doc_id, mark), written."""
    named = small_broadcast(materialize(wanted.toDF("node", "class", "of", "by"), "sets-wanted"), SMALL_SIDE)
    texts = _texts(documents)
    rows = texts.join(named, texts["doc_id"].eqNullSafe(named["of"]) & (texts["mark"] == named["by"])).select(
        "text", "class", "node")

    def run(batches):
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler.shingles(text) for text in utf8(batch.column(0))]
            same = pa.array([_digest(s) == c for s, c in zip(sets, batch.column(1).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array([s.size for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "n", "tokens"]).filter(same)

    found = rows.mapInArrow(run, "node long, n long, tokens binary")
    # A row may be repeated; its set is kept once.
    return materialize(found.groupBy("node").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")), "whole-sets")


def _parts(count: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(count / BLOCK_SETS, shingles / BLOCK_SHINGLES))


def _packs(total) -> int:
    """How many blocks hold the small families or stars with so many sets and shingles."""
    return max(1, -(-(total["sets"] or 0) // BLOCK_SETS), -(-(total["shingles"] or 0) // BLOCK_SHINGLES))


def star_places(pairs: DataFrame) -> DataFrame:
    """(gid, node, guest, home): leaders are at home where their members come as guests. Large
    stars come in parts, small ones share a block."""
    hubs = materialize(pairs.groupBy("leader").agg(
        F.count("*").alias("sets"), F.sum("n").alias("shingles")), "star-sizes")
    small = F.col("sets") <= SMALL_FAMILY
    packs = _packs(hubs.where(small).agg(F.sum("sets").alias("sets"), F.sum("shingles").alias("shingles")).first())
    sized = hubs.select(
        "leader", F.when(small, -1).otherwise(_parts(F.col("sets"), F.col("shingles"))).alias("parts"))
    gid = lambda part: F.when(F.col("parts") < 0, F.xxhash64(
        F.lit("pack"), F.pmod(F.xxhash64("leader"), F.lit(packs)))).otherwise(F.xxhash64("leader", part))
    guests = pairs.join(sized, "leader").select(
        gid(F.pmod(F.xxhash64("node"), F.greatest("parts", F.lit(1)))).alias("gid"), "node")
    homes = sized.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("parts", F.lit(1)) - 1))).select(
        gid(F.col("part")).alias("gid"), F.col("leader").alias("node"))
    sided = guests.withColumns({"guest": F.lit(True), "home": F.lit(False)}).unionByName(
        homes.withColumns({"guest": F.lit(False), "home": F.lit(True)}))
    return sided.groupBy("gid", "node").agg(F.max("guest").alias("guest"), F.max("home").alias("home"))


def family_places(members: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """(gid, node, guest, home) of the ``members`` (node, n, family, star, component) of families
    that lie in several components: where they meet members of other components."""
    families = members.groupBy("family").agg(
        F.count("*").alias("sets"), F.sum("n").alias("shingles"), F.min("component").alias("low"),
        F.max("component").alias("high")).where("low <> high").drop("low", "high")
    families = materialize(families, "open-families")
    small = families.where(F.col("sets") <= SMALL_FAMILY)
    packs = _packs(small.agg(F.sum("sets").alias("sets"), F.sum("shingles").alias("shingles")).first())
    pack = F.xxhash64(F.lit("pack"), F.pmod(F.xxhash64("family"), F.lit(packs)))
    shared = members.join(small.select("family"), "family").select(
        pack.alias("gid"), "node", F.lit(True).alias("guest"), F.lit(True).alias("home"))
    large = members.join(families.where(F.col("sets") > SMALL_FAMILY).select("family"), "family")
    # Sets that are alike differ in size by one step at most.
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent))
    kinds = large.withColumn("step", step)
    for name in ("component", "star"):
        often = kinds.groupBy("family", name).agg((F.count("*") >= BLOCK_SETS).alias("fills"))
        kinds = kinds.join(often, ["family", name]).withColumn(
            name, F.when(F.col("fills"), F.col(name)).otherwise(-1)).drop("fills")
    kind = ["family", "component", "star", "step"]
    sizes = kinds.groupBy(*kind).agg(_parts(F.count("*"), F.sum("n")).alias("parts"))
    placed = materialize(kinds.join(sizes, kind).select(
        "node", "component", "step",
        F.xxhash64(*kind, F.pmod(F.xxhash64("node"), F.col("parts"))).alias("block")), "family-blocks")
    listed = lists.join(placed.select("node", "component", "step", "block"), "node").select(
        "value", "block", "component", "step").distinct()
    other = listed.toDF("value", "to_block", "to_component", "to_step")
    meets = materialize(listed.join(other, "value").where(
        (F.col("block") <= F.col("to_block")) & (F.abs(F.col("step") - F.col("to_step")) <= 1)
        & ((F.col("component") == -1) | (F.col("component") != F.col("to_component")))
    ).select("block", "to_block").distinct(), "block-meetings")
    gid = F.xxhash64("block", "to_block").alias("gid")
    homes = placed.join(meets, "block").select(gid, "node", F.lit(False).alias("guest"), F.lit(True).alias("home"))
    guests = placed.withColumnRenamed("block", "to_block").join(meets, "to_block").select(
        gid, "node", F.lit(True).alias("guest"), F.lit(False).alias("home"))
    return homes.unionByName(guests).unionByName(shared).groupBy("gid", "node").agg(
        F.max("guest").alias("guest"), F.max("home").alias("home"))


class _Inverted:
    """Inverted lists of some sets: how many values of another set each of them holds."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [s.size for s in sets])
        order = np.argsort(flat, kind="stable")
        self.values, first = np.unique(flat[order], return_index=True)
        self.owner, self.first, self.n = owner[order], np.append(first, flat.size), len(sets)

    def overlaps(self, tokens: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.values, tokens), self.values.size - 1)
        at = at[self.values[at] == tokens]
        spans = self.first[at + 1] - self.first[at]
        steps = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        return np.bincount(self.owner[np.repeat(self.first[at], spans) + steps], minlength=self.n)


def compare_block(rows: pd.DataFrame, percent: int, k: int, least: np.ndarray) -> list[tuple[int, int]]:
    """Links between guests and those at home, of different components: a forest of them.
    ``least`` says how many shared values a sample of a union must have, by its size."""
    home = rows[rows["home"]]
    nodes, kinds = home["node"].to_numpy(np.int64), home["component"].to_numpy(np.int64)
    sets = [np.frombuffer(t, np.uint64) for t in home["tokens"]]
    if not sets:
        return []
    sizes = np.array([s.size for s in sets], np.int64)
    whole = sizes <= k
    ends = np.array([s[-1] if s.size <= k else s[k - 1] for s in sets], np.uint64)
    padded = np.full((len(sets), k), np.iinfo(np.uint64).max, np.uint64)
    for i, s in enumerate(sets):
        padded[i, :min(k, s.size)] = s[:k]
    short, full = _Inverted([s[:k] for s in sets]), None
    forest, links = {}, []

    def root(x):
        while forest.setdefault(x, x) != x:
            forest[x] = x = forest[forest[x]]
        return x

    guests = rows[rows["guest"]]
    for node, kind, tokens in zip(guests["node"].tolist(), guests["component"].tolist(), guests["tokens"]):
        tokens = np.frombuffer(tokens, np.uint64)
        n, sketch = tokens.size, tokens[:k]
        met = short.overlaps(sketch)
        able = (met > 0) & (kinds != kind) & (100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes))
        if not able.any():
            continue
        # The sample: values of both sketches up to the lower of their ends; a whole set has no end.
        own_end = np.iinfo(np.uint64).max if n <= k else sketch[-1]
        their_end = np.where(whole, np.iinfo(np.uint64).max, ends)
        low = np.minimum(own_end, their_end)
        seen = np.searchsorted(sketch, low, "right") + (padded <= low[:, None]).sum(axis=1)
        seen = np.where(low == np.iinfo(np.uint64).max, sketch.size + np.minimum(sizes, k), seen) - met
        exact = whole & (n <= k)
        able &= np.where(exact, 100 * met >= percent * seen, met >= least[np.minimum(seen, least.size - 1)])
        if not able.any():
            continue
        full = full or _Inverted(sets)
        overlap = full.overlaps(tokens)
        for i in np.flatnonzero(able & (overlap * 100 >= percent * (n + sizes - overlap))):
            u, v = root(kind), root(int(kinds[i]))
            if u != v:
                forest[max(u, v)] = min(u, v)
                links.append((node, int(nodes[i])))
    return links


def compare(places: DataFrame, members: DataFrame, sets: DataFrame, percent: int, k: int) -> DataFrame:
    """(u, v): links found at the ``places``; ``members`` give each node its component."""
    least = np.array([least_shared(sample, percent) for sample in range(2 * k + 1)])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(compare_block(rows, percent, k, least), columns=["u", "v"], dtype="int64")

    dealt = places.join(members.select("node", "component"), "node").join(sets.select("node", "tokens"), "node")
    return materialize(dealt.groupBy("gid").applyInPandas(run, "u long, v long"), "links")


def _labels(edges: DataFrame, name: str) -> DataFrame:
    """(node, name) of every node on an edge: its component's smallest node."""
    found = components(edges)
    return found.select(F.col("u").alias("node"), F.col("v").alias(name)).unionByName(
        found.select(F.col("v").alias("node"), F.col("v").alias(name)).distinct())


def link_classes(documents: DataFrame, percent: int = PERCENT, words: int = WORDS, k: int = SKETCH):
    """(documents with their class, classes with their node, links between nodes)."""
    rows = materialize(sketches(documents, words, k), "sketches")
    alike = rows.where("n > 0").groupBy("class").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(F.struct("doc_id", "mark")).alias("stands"))
    classes = materialize(alike.withColumn("node", F.monotonically_increasing_id()), "sketch-classes")
    lists = inverted_lists(classes, percent, k)
    pairs = stars(lists)
    families = materialize(_labels(pairs.select(F.col("node").alias("u"), F.col("leader").alias("v")), "family"), "families")
    stood = classes.select("node", "class", "stands.doc_id", "stands.mark")
    sets = whole_sets(documents, families.select("node").join(stood, "node"), words)
    alone = families.select("node", F.col("node").alias("component"))
    first = compare(star_places(pairs), alone, sets, percent, k)
    led = pairs.groupBy("node").agg(F.min("leader").alias("star"))
    members = families.join(sets.select("node", "n"), "node").join(led, "node", "left").join(
        _labels(first, "component"), "node", "left").select(
        "node", "n", "family", F.coalesce("star", "node").alias("star"), F.coalesce("component", "node").alias("component"))
    members = materialize(members, "family-members")
    second = compare(family_places(members, lists, percent), members, sets, percent, k)
    return rows.select("doc_id", "mark", "class", "n"), classes.select("class", "node"), first.unionByName(second)


def marked_components(documents: DataFrame, percent: int, words: int, k: int) -> DataFrame:
    """One row per document: doc_id, mark, n_shingles, component_id (its smallest doc_id)."""
    placed, classes, links = link_classes(documents, percent, words, k)
    ids = placed.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    rooted = classes.join(ids, "class").join(_labels(links, "root"), "node", "left").select(
        "class", "least", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "class-roots")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = materialize(rooted.join(smallest, "root").select("class", "component_id"), "class-components")
    return placed.join(found, "class", "left").select(
        "doc_id", "mark", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicates(documents: DataFrame, percent: int = PERCENT, words: int = WORDS, k: int = SKETCH) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links
    reach), kept (whether that is its own)."""
    return marked_components(documents, percent, words, k).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(documents: DataFrame, percent: int = PERCENT, words: int = WORDS, k: int = SKETCH) -> DataFrame:
    """``documents`` without those whose component has a smaller doc_id. A row is told from
    others of its id by its text; a row without an id stays."""
    found = marked_components(documents, percent, words, k)
    key = free_name(documents.columns, "copy_of")
    mark = free_name([*documents.columns, key], "copy_mark")
    gone = found.where("component_id <> doc_id").select(
        F.col("doc_id").alias(key), F.col("mark").alias(mark)).distinct()
    return documents.join(
        materialize(gone, "near-duplicates"),
        (documents["doc_id"].cast("long") == F.col(key)) & (text_mark(documents["text"].cast("string")) == F.col(mark)),
        "left_anti")
