"""Benchmark decontamination: a distributed positional inverted index, in DataFrame functions.

The index is one written table of postings (row, position, term), for every term that a test
item holds, plus one posting of term -1 per document whose position is the document's length.

A test window is a phrase of ten words. Its terms are ordered from the rarest in the corpus to
the commonest. The list of the rarest term, moved back by the term's offset, gives the places
where the window may start; the list of the second rarest, moved back by its own offset, is
intersected with them, and what is left is intersected with the lists of all other terms.
Postings are only ever matched on (row, position, term), which no hot term, source or passage
can make uneven, and only the small test side is broadcast, after its rows were counted.

Defined results. A null or empty text has no words. An item with fewer than ten words is one
window of its own length; an item without words matches nothing. A null item_id finds hits but
names no item. Rows with the same doc_id are looked at one by one. Empty tables give empty or
all-clean results. Columns beyond the named ones are not read, or pass through untouched.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import free_name
from basketry.llm.words import lower_ascii, raw_words
from basketry.session import materialize, small_broadcast

WINDOW_WORDS = 10
LENGTH_TERM = -1
# Test windows and terms are broadcast up to this many rows, beyond it joined by shuffles.
SMALL_SIDE = 200_000


def test_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(window, words, items): the distinct phrases of all items and the items that hold them."""
    words = F.transform(raw_words(F.col("text").cast("string")), lower_ascii)
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("words")).where(
        F.size("words") > 0)
    last = F.greatest(F.size("words") - size, F.lit(0))
    phrases = items.select("item", F.explode(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, size))).alias("words"))
    return phrases.groupBy("words").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("words").alias("window"), "words", "items")


def number_terms(windows: DataFrame) -> DataFrame:
    """(word, term): the distinct words of the windows, numbered from 0."""
    words = windows.select(F.explode("words").alias("word")).distinct()
    return words.withColumn("term", F.monotonically_increasing_id())


def store_postings(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(row, doc_id, term, position), written once; ``row`` tells documents apart.

    The row number is drawn and written in one step and never computed again, so a task that
    is repeated replaces its rows as a whole.
    """
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("doc_id"),
        raw_words(F.col("text").cast("string")).alias("words"))
    # The length comes as one more word after the last, which no real word can equal.
    placed = rows.select("row", "doc_id", F.size("words").cast("long").alias("length"), F.posexplode(
        F.concat("words", F.array(F.lit("")))).alias("position", "raw"))
    named = placed.withColumn("word", lower_ascii(F.col("raw")))
    known = named.join(small_broadcast(terms, SMALL_SIDE), "word", "left")
    term = F.when(F.col("raw") == "", F.lit(LENGTH_TERM).cast("long")).otherwise(F.col("term"))
    postings = known.select("row", "doc_id", term.alias("term"), F.col("position").cast("long"))
    return materialize(postings.where(F.col("term").isNotNull()), "postings")


def order_terms(windows: DataFrame, terms: DataFrame, postings: DataFrame) -> DataFrame:
    """(window, words, size, ranked): each window's (frequency, term, offset) from the rarest."""
    counts = postings.where(F.col("term") != LENGTH_TERM).groupBy("term").count()
    known = terms.join(counts, "term", "left")
    placed = windows.select("window", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word"))
    return placed.join(known, "word").groupBy("window", "size").agg(F.sort_array(F.collect_list(F.struct(
        F.coalesce("count", F.lit(0)).alias("count"), "term", "offset"))).alias("ranked")
    ).where(F.col("ranked")[0]["count"] > 0)


def _at(n: int, column: str) -> Column:
    return F.col("ranked")[n][column]


def phrase_starts(postings: DataFrame, ranked: DataFrame) -> DataFrame:
    """(row, window, size, start): all places where all terms of a window stand in order."""
    terms = postings.where(F.col("term") != LENGTH_TERM).select("row", "term", "position")
    queries = small_broadcast(ranked, SMALL_SIDE)
    # The list of the rarest term, moved back to the start of the window.
    first = terms.join(queries, terms["term"] == _at(0, "term")).select(
        "row", "window", "size", "ranked", (F.col("position") - _at(0, "offset")).alias("start")
    ).where(F.col("start") >= 0)
    # The second rarest: only the postings of such terms take part.
    second_terms = ranked.where(F.size("ranked") > 1).select(_at(1, "term").alias("term")).distinct()
    second = terms.join(small_broadcast(second_terms, SMALL_SIDE), "term", "left_semi")
    single = first.where(F.size("ranked") == 1)
    both = first.where(F.size("ranked") > 1).withColumns({
        "term": _at(1, "term"), "position": F.col("start") + _at(1, "offset")}
    ).join(second, ["row", "position", "term"]).select("row", "window", "size", "ranked", "start")
    candidates = materialize(both.unionByName(single.select(*both.columns)), "phrase-candidates")
    # All other terms: each must stand at its offset.
    wanted = candidates.where(F.size("ranked") > 2).select(
        "row", "window", "size", "start", F.explode(F.slice("ranked", 3, F.size("ranked"))).alias("t")).select(
        "row", "window", "size", "start", F.col("t.term").alias("term"),
        (F.col("start") + F.col("t.offset")).alias("position"))
    met = wanted.join(terms, ["row", "position", "term"]).groupBy("row", "window", "size", "start").count()
    whole = met.where(F.col("count") == F.col("size") - 2).drop("count")
    return whole.unionByName(candidates.where(F.size("ranked") <= 2).select(*whole.columns))


def index_benchmark(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS):
    """The written windows, terms and postings that searches share."""
    windows = materialize(test_windows(benchmark, size), "test-windows")
    terms = materialize(number_terms(windows), "test-terms")
    return windows, terms, store_postings(documents, terms)


def exact_matches(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: doc_id, row, n_words, n_hit, items (sorted texts of item ids)."""
    windows, terms, postings = index_benchmark(documents, benchmark, size)
    starts = materialize(
        phrase_starts(postings, order_terms(windows, terms, postings)), "phrase-starts")
    # Words under any window: what each window adds beyond the furthest end before it.
    before = Window.partitionBy("row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    fresh = end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0)))
    hit = starts.select("row", "start", "size").distinct().select(
        "row", F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    items = starts.select("row", "window").distinct().join(
        small_broadcast(windows.select("window", "items"), SMALL_SIDE), "window").select(
        "row", F.explode("items").alias("item")).groupBy("row").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    lengths = postings.where(F.col("term") == LENGTH_TERM).select(
        "row", "doc_id", F.col("position").alias("n_words"))
    return lengths.join(hit, "row", "left").join(items, "row", "left").select(
        "doc_id", "row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def proximity_matches(documents: DataFrame, benchmark: DataFrame, span: int = 2 * WINDOW_WORDS,
                      size: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, item, n_places): items with a window whose distinct terms all stand, in any
    order, within ``span`` words of a place of its rarest term."""
    windows, terms, postings = index_benchmark(documents, benchmark, size)
    ranked = order_terms(windows, terms, postings)
    known = postings.where(F.col("term") != LENGTH_TERM)
    first = known.join(small_broadcast(ranked, SMALL_SIDE), known["term"] == _at(0, "term")).select(
        "row", "doc_id", "window", F.col("position").alias("place"),
        F.array_distinct(F.transform("ranked", lambda t: t["term"])).alias("wanted"))
    wanted = first.select("row", "doc_id", "window", "place", F.size("wanted").alias("n"),
                          F.explode("wanted").alias("term"))
    near = wanted.join(known.select("row", "term", "position"), ["row", "term"]).where(
        F.abs(F.col("position") - F.col("place")) < span)
    met = near.groupBy("row", "doc_id", "window", "place", "n").agg(
        F.count_distinct("term").alias("met")).where(F.col("met") == F.col("n"))
    return met.join(small_broadcast(windows.select("window", "items"), SMALL_SIDE), "window").select(
        "doc_id", "row", "place", F.explode("items").alias("item")).groupBy("doc_id", "item").agg(
        F.count_distinct("row", "place").alias("n_places"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, max_share: float = 0.0,
                      size: int = WINDOW_WORDS) -> DataFrame:
    """``documents`` without those of whose words more than ``max_share`` lie in test windows.

    What a row loses depends on its text alone, so rows go by their text, not by their id: clean
    rows that share an id with a rejected one, or have none, all stay. Only the marks of rejected
    texts, two 64-bit hashes, are joined back.
    """
    text = F.col("text").cast("string")
    marks = {"m1": F.xxhash64(text), "m2": F.xxhash64(F.lit(1), text, F.length(text))}
    marked = documents.select(F.struct(*[mark.alias(name) for name, mark in marks.items()]).alias("doc_id"), "text")
    found = exact_matches(marked, benchmark, size).where(
        F.col("n_hit") > max_share * F.col("n_words")).select("doc_id.m1", "doc_id.m2").distinct()
    found = small_broadcast(materialize(found, "contaminated"), SMALL_SIDE)
    names = [free_name(documents.columns, name) for name in marks]
    return documents.join(
        found.toDF(*names), (marks["m1"] == F.col(names[0])) & (marks["m2"] == F.col(names[1])), "left_anti")
