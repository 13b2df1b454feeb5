"""Phrase collocation mining: phrases counted in HAT-tries, spilled as sorted runs, merged by prefix.

1. Words get 64-bit ids, hashes of language and word. One aggregate counts them by language and
   word; a phrase can only be frequent if its words are, and a long one if its pairs are. Bitmaps
   of fixed size say which words and pairs may be frequent: they spare work and decide nothing.
2. A task counts the phrases of its texts in a HAT-trie: a shallow trie over the first word ids
   whose leaves are hash containers of the remaining ids. A container that grows too large bursts
   into children by its next word. Beyond ``ROOM`` entries the largest subtrees are spilled whole,
   as a sorted run, cut into rows by prefix partition.
3. A prefix partition holds the phrases of some first words; a word that holds a large share of
   all words is spread over several by a hash of the rest. A partition's runs follow one another
   and are merged in memory, and phrases below the minimum count end there. A partition with more
   than ``MERGE_ROOM`` distinct phrases passes on partial counts, which one aggregate adds up.
4. What is left are the frequent phrases of one to five words, which hold both parts of every cut.
   Scores are whole numbers of up to 38 digits.
5. A phrase inside a longer one with as large a share is inside one that is a word longer, for
   counts do not grow with length; so only those are looked up.

Defined results. A null text is empty and has no words; a null lang is ``und``. Pieces end at
``. , ; : ! ?`` and line breaks, words at blanks and tabs; A-Z are lower-cased and nothing else.
Rows that repeat are counted as often as they are there; ids are not read, so null or repeated
ones change nothing. Equal scores go by count, then by phrase. An empty table gives an empty
result. Two words with one id would count as one; 64 bits make that improbable, not impossible.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import mix, utf8
from basketry.session import materialize, small_broadcast

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
SHARE = 100
NO_LANG = "und"
BURST = 1 << 12
ROOM = 1 << 19
CHUNK_BYTES = 1 << 22
# A row holds so many entries of a run at most, which bounds the batches that a merge reads.
RUN_ENTRIES = 1 << 8
# Bits of the bitmaps of frequent words and pairs: four and eight MB, however large the corpus.
WORD_BITS, PAIR_BITS = 1 << 25, 1 << 26
# Prefixes hold so many words at most, or this share of all; larger ones are split.
GRAIN, GRAIN_SHARE = 1 << 16, 1 << 20
# Prefix partitions: one per so many words of the corpus, and distinct phrases that one merges.
PART_WORDS, LEAST_PARTS, MOST_PARTS = 1 << 20, 12, 1 << 16
MERGE_ROOM = 1 << 20
# The totals of languages are broadcast up to so many rows.
SMALL_SIDE = 100_000

_RANDOM = np.random.default_rng(20250312)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(int(_RANDOM.integers(1, 1 << 62)) * 2 + 1)
_ENDS_WORD = np.zeros(256, bool)
_ENDS_WORD[list(b" \t.,;:!?\n\v\f\r")] = True
_ENDS_PIECE = _ENDS_WORD.copy()
_ENDS_PIECE[list(b" \t")] = False


def _hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes and of its seed."""
    if not starts.size:
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    begins = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
    powers = np.full(int(sizes.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.add.reduceat(_BYTES[raw[np.repeat(starts, sizes) + within]] * powers[within], begins)
    return mix(mix(sums + sizes.astype(np.uint64)) + seeds)


class Words:
    """The words of some texts: ids, numbers of their pieces, and where they stand in ``raw``."""

    def __init__(self, texts: list[bytes], seeds: list[np.uint64]):
        self.raw = np.frombuffer((b"\n".join(texts) + b"\n").lower(), np.uint8)
        inside = ~_ENDS_WORD[self.raw]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        first = np.cumsum([0, *(len(text) + 1 for text in texts)])
        self.text = np.searchsorted(first, self.starts, "right") - 1
        seeds = np.array(seeds, np.uint64)[self.text]
        # A very long text is hashed a few MB at a time.
        cuts = np.searchsorted(self.ends, np.arange(CHUNK_BYTES, self.raw.size, CHUNK_BYTES))
        slices = [slice(a, b) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), self.ends.size])]
        self.ids = np.concatenate([_hashes(self.raw, self.starts[s], self.ends[s], seeds[s]) for s in slices])
        self.pieces = np.searchsorted(np.flatnonzero(_ENDS_PIECE[self.raw]), self.starts)


def lang_seed(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode(), np.uint8)
    return _hashes(raw, np.array([0]), np.array([raw.size]), np.zeros(1, np.uint64))[0] if raw.size else np.uint64(1)


def _chunks(batches) -> Iterator[tuple[list[str], Words]]:
    """The texts of Arrow batches (lang, text), a few MB at a time, with their languages."""
    seeds: dict[str, np.uint64] = {}
    for batch in batches:
        texts, langs, size = [], [], 0
        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            if not text:
                continue
            if lang not in seeds:
                seeds[lang] = lang_seed(lang)
            texts.append(text)
            langs.append(lang)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield langs, Words(texts, [seeds[x] for x in langs])
                texts, langs, size = [], [], 0
        if texts:
            yield langs, Words(texts, [seeds[x] for x in langs])


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                            F.col("text").cast("string").alias("text"))


def count_words(documents: DataFrame) -> DataFrame:
    """(lang, word, id, f) of every word."""

    def run(batches):
        for langs, words in _chunks(batches):
            ids, first, counts = np.unique(words.ids, return_index=True, return_counts=True)
            raw = words.raw.tobytes()
            spans = zip(words.starts[first].tolist(), words.ends[first].tolist())
            yield pa.RecordBatch.from_arrays([
                pa.array([langs[i] for i in words.text[first].tolist()], pa.string()),
                pa.array([raw[a:b] for a, b in spans], pa.binary()), pa.array(ids.view(np.int64)),
                pa.array(counts, pa.int64())], ["lang", "word", "id", "f"])

    found = _texts(documents).mapInArrow(run, "lang string, word binary, id long, f long")
    return found.groupBy("lang", "word", "id").agg(F.sum("f").alias("f"))


def bitmap(ids: DataFrame, bits: int) -> np.ndarray:
    """The ids (a column ``id``) modulo ``bits``, as a bitmap: at most bits / 8 bytes come to the driver."""
    place = F.pmod("id", F.lit(bits)) + 1
    parts = ids.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).toArrow()
    held = np.zeros(bits // 8, np.uint8)
    for part, found in zip(parts.column("part").to_pylist(), parts.column("bits").to_pylist()):
        held[(part - 1) * 4096:(part - 1) * 4096 + len(found)] = np.frombuffer(found, np.uint8)
    return held


def among(ids: np.ndarray, held: np.ndarray) -> np.ndarray:
    at = ids % np.uint64(held.size * 8)
    return (held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) + second)


class HatTrie:
    """Counts of id sequences of one length: by first id, then by the bytes of the ids after it."""

    def __init__(self, size: int):
        self.size, self.roots, self.entries = size, {}, 0

    def add_rows(self, rows: np.ndarray) -> None:
        """Counts every row of a matrix of ids."""
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        tails = np.ascontiguousarray(rows[:, 1:]).view(f"V{8 * (self.size - 1)}").ravel().tolist()
        starts = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0])))
        for first, a, b in zip(rows[starts, 0].tolist(), starts.tolist(), [*starts[1:].tolist(), len(rows)]):
            node = self.roots.get(first)
            if node is None:
                node = self.roots[first] = Container()
            before = node.held
            self.roots[first] = node = node.counted(tails[a:b], self.size - 1)
            self.entries += node.held - before

    def spill(self, room: int) -> tuple[np.ndarray, np.ndarray]:
        """Takes out the largest subtrees until ``room`` entries are left: their rows in order, and counts."""
        firsts, lengths, tails, counts = [], [], [], []
        for first in sorted(self.roots, key=lambda first: self.roots[first].held, reverse=True):
            if self.entries <= room:
                break
            node = self.roots.pop(first)
            self.entries -= node.held
            firsts.append(first)
            lengths.append(node.held)
            node.collect(b"", tails, counts)
        rows = np.empty((len(tails), self.size), np.uint64)
        rows[:, 0] = np.repeat(np.array(firsts, np.uint64), lengths)
        rows[:, 1:] = np.frombuffer(b"".join(tails), np.uint64).reshape(len(tails), self.size - 1)
        order = np.lexsort(rows.T[::-1])
        return rows[order], np.array(counts, np.int64)[order]


class Container(Counter):
    """A hash container: the ids that are left of a phrase, as bytes, and how often they came."""

    @property
    def held(self) -> int:
        return len(self)

    def counted(self, tails: list[bytes], ids: int) -> "Container | Burst":
        """Itself with the tails of so many ids counted, or what it has burst into."""
        self.update(tails)
        if len(self) <= BURST or ids < 2:
            return self
        return Burst().grown(self.items(), ids)

    def collect(self, above: bytes, tails: list[bytes], counts: list[int]) -> None:
        tails += [above + tail for tail in self] if above else self
        counts += self.values()


class Burst(dict):
    """A container that has burst: nodes by the next id."""

    held = 0

    def grown(self, entries, ids: int) -> "Burst":
        for tail, count in entries:
            node = self.get(tail[:8])
            if node is None:
                node = self[tail[:8]] = Container()
            node[tail[8:]] = count
        self.held = sum(map(len, self.values()))
        return self

    def counted(self, tails: list[bytes], ids: int) -> "Burst":
        below = {}
        for tail in tails:
            below.setdefault(tail[:8], []).append(tail[8:])
        for head, rest in below.items():
            node = self.get(head)
            if node is None:
                node = Container()
            before = node.held
            self[head] = node = node.counted(rest, ids - 1)
            self.held += node.held - before
        return self

    def collect(self, above: bytes, tails: list[bytes], counts: list[int]) -> None:
        for head, node in self.items():
            node.collect(above + head, tails, counts)


def phrase_rows(words: Words, size: int, known: np.ndarray, pairs: np.ndarray | None) -> Iterator[np.ndarray]:
    """The phrases of ``size`` words inside pieces whose words (and pairs) may be frequent, one a
    row, ``ROOM`` rows at a time."""
    n = words.ids.size - size + 1
    if n <= 0:
        return
    step, length = (known, size) if pairs is None else (pairs, size - 1)
    sums = np.concatenate(([0], np.cumsum(step)))
    fit = (sums[length:length + n] - sums[:n] == length) & (words.pieces[size - 1:] == words.pieces[:n])
    at = np.flatnonzero(fit)
    for i in range(0, at.size, ROOM):
        yield words.ids[at[i:i + ROOM, None] + np.arange(size)]


_RUNS = "size int, part int, ids binary, counts binary"


def prefix_parts(rows: np.ndarray, parts: int, hot_ids: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """The prefix partition of every phrase: by its first word, or where that is ``hot`` (ids in
    order, and how many buckets each has) by the word and a bucket of the rest."""
    prefix = rows[:, 0].copy()
    if hot_ids.size:
        at = np.minimum(np.searchsorted(hot_ids, prefix), hot_ids.size - 1)
        hot = np.flatnonzero(hot_ids[at] == prefix)
        rest = rows[hot, 1]
        for column in range(2, rows.shape[1]):
            rest = pair_hash(rest, rows[hot, column])
        prefix[hot] = pair_hash(prefix[hot], mix(rest) % buckets[at[hot]].astype(np.uint64))
    return (mix(prefix) % np.uint64(parts)).astype(np.int32)


def count_in_tries(documents: DataFrame, sizes: tuple[int, ...], known: np.ndarray, pairs: np.ndarray | None,
                   hot: tuple[np.ndarray, np.ndarray], parts: int) -> DataFrame:
    """Sorted runs of the counts of phrases, cut by prefix partition: the ids column by column."""
    shared = documents.sparkSession.sparkContext.broadcast((known, pairs, *hot))

    def spilled(trie, room):
        rows, counts = trie.spill(room)
        if not len(rows):
            return
        part = prefix_parts(rows, parts, *shared.value[2:])
        order = np.argsort(part, kind="stable")
        rows, counts, part = rows[order], counts[order], part[order]
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        cuts = [(int(part[a]), i, min(i + RUN_ENTRIES, b)) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)])
                for i in range(a, b, RUN_ENTRIES)]
        yield pa.RecordBatch.from_arrays([
            pa.array([trie.size] * len(cuts), pa.int32()), pa.array([p for p, _, _ in cuts], pa.int32()),
            pa.array([rows[i:j].T.tobytes() for _, i, j in cuts], pa.binary()),
            pa.array([counts[i:j].tobytes() for _, i, j in cuts], pa.binary())], ["size", "part", "ids", "counts"])

    def run(batches):
        known, pairs = shared.value[:2]
        tries = [HatTrie(size) for size in sizes]
        for _, words in _chunks(batches):
            word_fits = among(words.ids, known)
            pair_fits = None if pairs is None else among(pair_hash(words.ids[:-1], words.ids[1:]), pairs)
            for trie in tries:
                for rows in phrase_rows(words, trie.size, word_fits, pair_fits):
                    trie.add_rows(rows)
                    if sum(trie.entries for trie in tries) > ROOM:
                        for full in tries:
                            yield from spilled(full, ROOM // (2 * len(tries)))
        for trie in tries:
            yield from spilled(trie, -1)

    return _texts(documents).mapInArrow(run, _RUNS)


def _compact(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, with the sum of their counts."""
    order = np.lexsort(rows.T)
    rows, counts = rows[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1))))
    return rows[starts], np.add.reduceat(counts, starts)


def merge_runs(runs: DataFrame, min_count: int) -> DataFrame:
    """(size, key, a): phrases with at least ``min_count`` occurrences; a key is the ids' bytes."""

    def phrases(size, rows, counts):
        keys = np.ascontiguousarray(rows).view(f"V{8 * size}").ravel().tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([size] * len(keys), pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.int64())],
            ["size", "key", "a"])

    def run(batches):
        name, rows, counts, held, whole = None, [], [], 0, True

        def merged(end):
            # A partition that is not whole in memory passes all its counts on, frequent or not.
            nonlocal rows, counts, held, whole
            found, n = _compact(np.concatenate(rows), np.concatenate(counts))
            if not end and len(n) <= MERGE_ROOM:
                rows, counts, held = [found], [n], 0
                return None
            whole = whole and end
            some = n >= (min_count if whole else 1)
            rows, counts, held, whole = [], [], 0, end or whole
            return phrases(name[0], found[some], n[some]) if some.any() else None

        for batch in batches:
            for size, part, ids, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (size, part) != name:
                    if rows and (found := merged(True)):
                        yield found
                    name, whole = (size, part), True
                rows.append(np.frombuffer(ids, np.uint64).reshape(size, -1).T)
                counts.append(np.frombuffer(n, np.int64))
                held += len(counts[-1])
                if held > ROOM and (found := merged(False)):
                    yield found
        if rows and (found := merged(True)):
            yield found

    dealt = runs.repartition("size", "part").sortWithinPartitions("size", "part")
    found = dealt.mapInArrow(run, "size int, key binary, a long")
    return found.groupBy("size", "key").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)


def id_bytes(number: Column) -> Column:
    """A long as eight bytes, lowest first, like the bytes of ids in tasks."""
    text = F.lpad(F.hex(number), 16, "0")
    return F.unhex(F.concat(*(F.substring(text, i, 2) for i in range(15, 0, -2))))


def frequent_phrases(documents: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST):
    """(words: lang, word, id, f, written, of all frequent words; totals: lang, n; phrases of two
    words and more: size, key, a)."""
    every = materialize(count_words(documents), "words")
    totals = materialize(every.groupBy("lang").agg(F.sum("f").alias("n")), "words-by-lang")
    words = every.where(F.col("f") >= min_count)
    known = bitmap(words.select("id"), WORD_BITS)
    n = totals.agg(F.sum("n")).first()[0] or 0
    grain, parts = max(GRAIN, n // GRAIN_SHARE), min(max(n // PART_WORDS, LEAST_PARTS), MOST_PARTS)
    # At most GRAIN_SHARE words hold more than this share of all.
    often = words.where(F.col("f") > grain).select("id", F.ceil(F.col("f") / grain).alias("buckets")).toArrow()
    ids = often.column("id").to_numpy().view(np.uint64)
    order = np.argsort(ids)
    hot = ids[order], often.column("buckets").to_numpy()[order]
    none = documents.sparkSession.createDataFrame([], "size int, key binary, a long")
    if longest < 2:
        return words, totals, none
    two = materialize(merge_runs(count_in_tries(documents, (2,), known, None, hot, parts), min_count), "phrases-of-two")
    if longest == 2:
        return words, totals, two

    def pair_ids(batches):
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pair_hash(rows[:, 0], rows[:, 1]).view(np.int64))], ["id"])

    pairs = bitmap(two.select("key").mapInArrow(pair_ids, "id long"), PAIR_BITS)
    more = count_in_tries(documents, tuple(range(3, longest + 1)), known, pairs, hot, parts)
    return words, totals, two.unionByName(materialize(merge_runs(more, min_count), "phrases-of-more"))


def best_cuts(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """(key, size, lang, a, n, l, r, score) of the lowest-scoring cut of every phrase."""
    parts = phrases.select("key", F.col("a").alias("f")).unionByName(words.select(id_bytes(F.col("id")).alias("key"), "f"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    left, right = (parts.select(F.col("key").alias(side), F.col("f").alias(count)) for side, count in (("head", "l"), ("rest", "r")))
    cuts = cuts.withColumns({"head": F.substring("key", F.lit(1), F.col("k") * 8),
                             "rest": F.substring("key", F.col("k") * 8 + 1, F.length("key"))})
    begins = words.select(id_bytes(F.col("id")).alias("begins"), "lang")
    met = cuts.join(left, "head").join(right, "rest").join(
        begins, F.substring("key", 1, 8) == begins["begins"]).join(small_broadcast(totals, SMALL_SIDE), "lang")
    big = lambda name: F.col(name).cast("decimal(19,0)")
    # Decimals hold 38 digits, so neither product can overflow; a quotient is below 10 n.
    over, under = (big("a") * big("n") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)"), (
        big("l") * big("r")).cast("decimal(38,0)")
    scored = met.withColumns({"over": over, "under": under}).withColumn("score", F.expr("over div under"))
    return scored.groupBy("key", "size", "lang", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")).select(
        "key", "size", "lang", "a", "n", "best.l", "best.r", "best.score")


def inside_longer(phrases: DataFrame, share: int) -> DataFrame:
    """(key) of phrases inside a longer one that has ``share`` percent of their occurrences."""
    ends = lambda start: F.substring("key", F.lit(start), F.length("key") - 8)
    inner = phrases.where("size > 2").select(
        F.col("a").alias("most"), F.explode(F.array(ends(1), ends(9))).alias("key")).groupBy("key").agg(F.max("most").alias("most"))
    return phrases.join(inner, "key").where(F.col("most") * 100 >= F.col("a") * share).select("key")


def collocations(documents: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP,
                 share: int = SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language."""
    words, totals, phrases = frequent_phrases(documents, min_count, longest)
    scored = materialize(
        best_cuts(phrases, words, totals).join(inside_longer(phrases, share), "key", "left_anti"), "scored-phrases")
    order = [F.desc("score"), F.desc("a")]
    place = Window.partitionBy("lang")
    # All that tie with the last place stay until they have their words.
    first = scored.withColumn("rank", F.rank().over(place.orderBy(*order))).where(F.col("rank") <= top).drop("rank")
    spelled = first.select("key", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.substring(F.col("key"), i * 8 + 1, F.lit(8)))).alias("i", "part"))
    spelled = spelled.join(words.select(id_bytes(F.col("id")).alias("part"), F.col("word").cast("string").alias("word")), "part")
    spelled = spelled.groupBy("key").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("i", "word"))), lambda s: s["word"]), " ").alias("phrase"))
    ranked = first.join(spelled, "key").withColumn("rank", F.row_number().over(place.orderBy(*order, "phrase")))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
