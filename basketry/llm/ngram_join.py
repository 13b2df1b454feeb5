"""N-gram Jaccard join: a token-group matrix finds the groups that a document must open.

Tokens are word shingles; a text is the set of its shingles. Texts with one set form a class,
and only classes are compared.

1. Tokens that are common among the documents of any Arrow batch are gathered; the commonest (a
   bounded number) come last in the order of tokens, which is by hash otherwise. Any order gives
   the same links; this one keeps passages that many texts share out of the lists below.
2. Two sets of similarity ``percent`` share one of their first n - ceil(n * percent / 100) + 1
   tokens in that order. Lists are a little longer than that, which sharpens the bound below.
   Of the lists, tokens that occur in a single class are dropped.
3. A class joins a group by the commonest token of its list and its size class. A group takes
   ``GROUP_MEMBERS`` at most, and fewer the less its members' lists have in common.
4. The token-group matrix holds, for each group, the union of its members' list tokens. A class
   counts how many of its tokens a group's column holds. What the lists do not show is at most
   the rest of the larger set, so the count bounds the overlap with any member of the group, and
   a group that cannot reach the similarity stays closed.
5. Opened groups get the whole sets of members and visitors. The union of all members' tokens
   bounds the overlap once more, then overlaps with single members are counted exactly. A group
   gives a spanning forest of its links, never all pairs.
6. Components of the forests are components of all links.

Defined results. A null, empty or blank text has no shingles and is linked with nothing. A text
of fewer than five words is one shingle. Rows that repeat a doc_id are documents of their own;
a null doc_id is never the smallest of a component unless no other is there. An empty table
gives an empty result. Extra columns are not read, or pass through untouched.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import free_name, give_back, utf8
from basketry.llm.components import components
from basketry.llm.shingles import Shingler
from basketry.session import materialize, small_broadcast

WORDS = 5
PERCENT = 80
GROUP_MEMBERS, LEAST_MEMBERS = 256, 4
# A batch of documents reports tokens that this many of its documents hold.
COMMON_IN_BATCH = 8
# At most so many common tokens are sent to all tasks (eight bytes each).
COMMON_TOKENS = 1 << 20
SIZE_STEP = 1.1
# A list holds one token in so many more than it needs: without these spare tokens a single
# shared one would open a group of sets a fifth smaller.
SPARE = 20
# The list of documents whose sets are compared is broadcast up to this many rows.
SMALL_SIDE = 1 << 18


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def text_mark(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("string").cast("binary"), 256))


def digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def needed(n: int, percent: int) -> int:
    """The least overlap of a set of ``n`` with any set of the similarity."""
    return -(-n * percent // 100)


def list_length(n: int, percent: int) -> int:
    """How many first tokens of a set of ``n`` are listed."""
    return n - needed(n, percent) + 1 + n // SPARE


def repeated(tokens: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that occur at least so many times, sorted, and how often; sorts in place, for
    a batch holds millions."""
    tokens.sort()
    last = times - 1
    often = np.unique(tokens[last:][tokens[last:] == tokens[:max(0, tokens.size - last)]])
    return often, np.searchsorted(tokens, often, "right") - np.searchsorted(tokens, often)


def among(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which tokens are in a sorted array."""
    if not known.size:
        return np.zeros(tokens.size, bool)
    return known[np.minimum(np.searchsorted(known, tokens), known.size - 1)] == tokens


def classify(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, mark, class, n, token, held): a row per document, and rows of common tokens with
    the number of documents of a batch that hold them (their class is null). ``mark`` tells the
    texts of a repeated id apart."""

    def run(batches):
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler.shingles(text) for text in utf8(batch.column(1))]
            n, sizes, digests = len(sets), [s.size for s in sets], [digest(s) for s in sets]
            tokens, held = repeated(np.concatenate([np.zeros(0, np.uint64), *sets]), COMMON_IN_BATCH)
            del sets
            none = pa.nulls(len(tokens))
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column(0), none.cast(pa.int64())]),
                pa.concat_arrays([batch.column(2), none.cast(pa.binary())]),
                pa.concat_arrays([pa.array(digests, pa.binary()), none.cast(pa.binary())]),
                pa.concat_arrays([pa.array(sizes, pa.int64()), none.cast(pa.int64())]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(tokens.view(np.int64))]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(held, pa.int64())]),
            ], ["doc_id", "mark", "class", "n", "token", "held"])
            del digests, tokens, held
        give_back()

    marked = _texts(documents).withColumn("mark", text_mark(F.col("text")))
    return marked.mapInArrow(run, "doc_id long, mark binary, class binary, n long, token long, held long")


def common_tokens(rows: DataFrame) -> np.ndarray:
    """The commonest tokens, sorted: at most ``COMMON_TOKENS`` of them come to the driver."""
    found = rows.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("held").alias("held"))
    top = found.orderBy(F.desc("held"), "token").limit(COMMON_TOKENS).select("token").toArrow()
    return np.sort(top.column("token").to_numpy().view(np.uint64))


def first_tokens(documents: DataFrame, common: np.ndarray, words: int, percent: int) -> DataFrame:
    """(class, n, tokens): the first tokens of each set, common ones last. One row per document."""
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        shingler, common = Shingler(words), shared.value
        for batch in batches:
            classes, sizes, lists = [], [], []
            for text in utf8(batch.column(1)):
                tokens = shingler.shingles(text)
                if not tokens.size:
                    continue
                late = among(tokens, common)
                order = np.concatenate([tokens[~late], tokens[late]])
                classes.append(digest(tokens))
                sizes.append(tokens.size)
                lists.append(order[:list_length(tokens.size, percent)].view(np.int64))
            starts = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *lists])
            yield pa.RecordBatch.from_arrays([
                pa.array(classes, pa.binary()), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(starts), pa.array(flat))], ["class", "n", "tokens"])
            del classes, sizes, lists, starts, flat
        give_back()

    return _texts(documents).mapInArrow(run, "class binary, n long, tokens array<long>")


def shared_tokens(classes: DataFrame) -> DataFrame:
    """(node, token, held, n): list tokens that at least two classes hold. Only node and token
    are dealt out, for nearly all tokens end here."""
    listed = classes.select("node", F.explode("tokens").alias("token"))
    held = F.count("*").over(Window.partitionBy("token"))
    return listed.withColumn("held", held).where(F.col("held") > 1).join(classes.select("node", "n"), "node")


def make_groups(shared: DataFrame) -> DataFrame:
    """(node, n, gid): the group of every class that shares a token.

    A group's token union should stay close to its members' own lists, else it bounds nothing.
    So a group takes more members the more often they hold the same tokens: near copies fill
    it, texts that share a passage or two stay in small groups.
    """
    home = shared.groupBy("node", "n").agg(F.max(F.struct("held", "token")).alias("top"))
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(SIZE_STEP)))
    # Kinds and groups whose hashed names fall together merely make one larger kind or group.
    placed = home.select("node", "n", F.xxhash64(F.col("top.token"), step).alias("kind"))
    alike = shared.join(placed.select("node", "kind"), "node").groupBy("kind", "token").agg(
        F.count("*").alias("rows")).groupBy("kind").agg((F.sum("rows") / F.count("*")).alias("repeats"))
    room = F.least(F.lit(GROUP_MEMBERS), F.greatest(F.lit(LEAST_MEMBERS), F.ceil(2 * F.col("repeats"))))
    full = placed.groupBy("kind").count().join(alike, "kind").select(
        "kind", F.ceil(F.col("count") / room).alias("parts"))
    return placed.join(full, "kind").select(
        "node", "n", F.xxhash64("kind", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("gid"))


def groups_to_open(shared: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(node, gid, target): the groups, its own among them, that a class has to open."""
    placed = shared.join(nodes.select("node", "gid"), "node").select("node", "n", "token", "gid")
    matrix = placed.groupBy("token", F.col("gid").alias("target")).agg(F.count("*").alias("members"))
    sizes = nodes.groupBy(F.col("gid").alias("target")).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    columns = matrix.join(sizes, "target")
    # Of two groups the one with the larger number visits the other.
    met = placed.join(columns, "token").where(
        ((F.col("target") < F.col("gid")) | ((F.col("target") == F.col("gid")) & (F.col("members") > 1)))
        & (F.col("most") * 100 >= F.col("n") * percent) & (F.col("least") * percent <= F.col("n") * 100))
    counted = met.groupBy("node", "n", "gid", "target", "least", "most").agg(F.count("*").alias("seen"))
    low = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    high = F.least("most", F.floor(F.col("n") * 100 / percent))
    # What a list leaves out of a set; one more for a member slightly below the highest size.
    rest = lambda n: F.ceil(n * percent / 100) - 1 - F.floor(n / SPARE)
    unseen = F.greatest(rest(F.col("n")), rest(high) + 1)
    return counted.where(
        (F.col("seen") + unseen) * (100 + percent) >= percent * (F.col("n") + low)).select("node", "gid", "target")


def places_to_go(nodes: DataFrame, visits: DataFrame) -> DataFrame:
    """(node, places): where the whole set of a class has to be. A place is a part of an opened
    group; guests of a busy group come in parts, and each part gets all members."""
    away = visits.where("gid <> target").select("node", "target")
    parts = away.groupBy("target").agg(F.ceil(F.count("*") / GROUP_MEMBERS).alias("parts"))
    guests = away.join(parts, "target").select(
        "node", F.col("target").alias("gid"), F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"),
        F.lit(True).alias("asks"), F.lit(True).alias("guest"))
    opened = visits.select("target").distinct().join(parts, "target", "left").select(
        F.col("target").alias("gid"), F.coalesce("parts", F.lit(1)).alias("parts"))
    homes = visits.where("gid = target").select("node", F.lit(True).alias("at_home"))
    members = nodes.join(opened, "gid").join(homes, "node", "left").select(
        "node", "gid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.coalesce("at_home", F.lit(False)).alias("asks"), F.lit(False).alias("guest"))
    # One part is enough for members to ask each other.
    members = members.withColumn("asks", F.col("asks") & (F.col("part") == 0))
    return members.unionByName(guests).groupBy("node").agg(
        F.collect_list(F.struct("gid", "part", "asks", "guest")).alias("places"))


def dealt_sets(documents: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, tokens, gid, part, asks, guest): the sets of the ``wanted`` classes (doc_id,
    class, node, places) at their places.

    Only documents that stand for a wanted class are read; a row that has the id but another
    set is passed over. A small list of them is broadcast, a longer one joined by shuffle.
    """
    texts = _texts(documents)
    named = small_broadcast(wanted.withColumnRenamed("doc_id", "stands_for"), SMALL_SIDE)
    rows = texts.join(named, texts["doc_id"].eqNullSafe(named["stands_for"])).select("text", "class", "node", "places")

    def run(batches):
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler.shingles(text) for text in utf8(batch.column(0))]
            same = pa.array([digest(s) == c for s, c in zip(sets, batch.column(1).to_pylist())], pa.bool_())
            tokens = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], tokens], ["node", "places", "tokens"]).filter(same)
            del sets, same, tokens
        give_back()

    sets = rows.mapInArrow(
        run, "node long, places array<struct<gid:long,part:long,asks:boolean,guest:boolean>>, tokens binary")
    return sets.select("node", "tokens", F.inline("places"))


class _Forest:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def open_group(rows: pd.DataFrame, percent: int, every: bool) -> list[tuple[int, int]]:
    """Links from the rows that ask, members or guests, to members: all of them if ``every``,
    else enough to connect what they connect."""
    members = rows[~rows["guest"]]
    nodes = members["node"].to_numpy(np.int64)
    sets = [np.frombuffer(t, np.uint64) for t in members["tokens"]]
    sizes = np.array([s.size for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    union, first = np.unique(flat[order], return_index=True)
    owner, ends = owner[order], np.append(first[1:], flat.size)
    asking = [(r.node, np.frombuffer(r.tokens, np.uint64), not r.guest) for r in rows[rows["asks"]].itertuples()]
    forest, links = _Forest(), []
    for node, tokens, home in asking:
        at = np.minimum(np.searchsorted(union, tokens), union.size - 1)
        at = at[union[at] == tokens]
        if at.size < needed(tokens.size, percent):
            continue
        spans = ends[at] - first[at]
        steps = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        overlap = np.bincount(owner[np.repeat(first[at], spans) + steps], minlength=len(sets))
        linked = overlap * 100 >= percent * (tokens.size + sizes - overlap)
        for other in nodes[linked]:
            if other != node and (every and (not home or other < node) or not every and forest.join(node, other)):
                links.append((int(node), int(other)))
    return links


def link_classes(documents: DataFrame, percent: int = PERCENT, words: int = WORDS, every: bool = False):
    """(documents with their class, classes with their node, links between nodes).

    With ``every`` the links are all pairs of similar classes, else a forest that connects them.
    """
    rows = materialize(classify(documents, words), "shingle-rows")
    placed = rows.where(F.col("class").isNotNull()).select("doc_id", "mark", "class", "n")
    lists = first_tokens(documents, common_tokens(rows), words, percent)
    alike = lists.groupBy("class").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    classes = materialize(alike.withColumn("node", F.monotonically_increasing_id()), "shingle-classes")
    shared = materialize(shared_tokens(classes), "shared-tokens")
    nodes = materialize(make_groups(shared), "token-groups")
    visits = materialize(groups_to_open(shared, nodes, percent), "group-visits")
    stand = placed.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    places = places_to_go(nodes.select("node", "gid"), visits)
    wanted = materialize(places.join(classes.select("node", "class"), "node").join(stand, "class"), "sets-wanted")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame(open_group(rows, percent, every), columns=["u", "v"], dtype="int64")
        if len(rows) >= GROUP_MEMBERS:
            give_back()
        return found

    links = dealt_sets(documents, wanted, words).groupBy("gid", "part").applyInPandas(compare, "u long, v long")
    return placed, classes, materialize(links, "links")


def similar_pairs(documents: DataFrame, percent: int = PERCENT, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(membership: doc_id, node; pairs: u, v of similar nodes). Copies share a node."""
    placed, classes, links = link_classes(documents, percent, words, every=True)
    return placed.join(classes.select("class", "node"), "class", "left").select("doc_id", "node"), links


def marked_components(documents: DataFrame, percent: int, words: int) -> DataFrame:
    """One row per document: doc_id, mark, n_shingles, component_id (its smallest doc_id)."""
    placed, classes, links = link_classes(documents, percent, words)
    labels = components(links).select(F.col("u").alias("node"), F.col("v").alias("root"))
    ids = placed.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    rooted = classes.select("class", "node").join(ids, "class").join(labels, "node", "left").select(
        "class", "least", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = materialize(rooted.join(least, "root").select("class", "component_id"), "class-components")
    return placed.join(found, "class", "left").select(
        "doc_id", "mark", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def similar_components(documents: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (its smallest doc_id)."""
    return marked_components(documents, percent, words).drop("mark")


def keep_one_of_each(documents: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``documents`` with one document of each component: the one with the smallest doc_id.

    Rows that share that id and belong to the component all stay; a null id stays. A row is
    told from others of its id by its text, so a copy takes no other text of its id with it.
    """
    found = marked_components(documents, percent, words)
    key = free_name(documents.columns, "copy_of")
    mark = free_name([*documents.columns, key], "copy_mark")
    gone = found.where("component_id <> doc_id").select(
        F.col("doc_id").alias(key), F.col("mark").alias(mark)).distinct()
    return documents.join(
        materialize(gone, "near-copies"),
        (documents["doc_id"].cast("long") == F.col(key)) & (text_mark(documents["text"]) == F.col(mark)), "left_anti")
