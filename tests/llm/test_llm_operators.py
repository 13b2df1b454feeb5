"""The operators against plain Python, on small tables with odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import (components, decontamination, license_scan, line_dedup, mph, ngram_join, quality,
                          secret_scan, sentence_pieces, token_counts, topk_search, url_filter)

import brute

LONG = "a long line that many documents share, É"
DOCS = [
    (1, f"{LONG}\nfirst\n\n"), (2, f"  {LONG.upper().replace('É', 'É')}\t\nsecond"), (3, f"x\n{LONG}\n{LONG}"),
    (4, None), (5, ""), (6, " \t \n"), (7, "short\nshort"), (8, "short"), (9, "Short"),
    (None, f"{LONG}\nno id"), (3, f"{LONG}\nthe same id"), (10, "word " * 3000 + "\n" + LONG),
    (11, "ünïcode line of twenty c"), (12, "ünïcode line of twenty c"), (13, "ünïcode line of twenty c "),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en", 7, "gone", i) for i, t in DOCS]
    return spark.createDataFrame(rows, f"{SCHEMA}, lang string, n_lines long, gone string, dropped_of long")


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.random.default_rng(3).integers(0, 1 << 62, (2, 5000), dtype=np.uint64)
    sizes, bits = mph.build(*keys)
    assert sorted(mph.slots(*keys, sizes, bits)) == list(range(5000))
    assert mph.build(keys[0][:0], keys[1][:0])[0] == []


def test_line_dedup(spark, odd):
    found = line_dedup.dedup_lines(odd)
    assert found.columns == [*odd.columns, "n_lines_", "n_dropped"]
    rows = found.select("doc_id", "n_lines_", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(brute.line_dedup(DOCS), key=repr)
    assert found.where("doc_id = 4").first().text is None
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_line_dedup_splits_a_busy_shard(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL_BLOCK", 4)
    rows = [(i, f"{LONG}\nown line number {i} of its document") for i in range(300)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert {(r.doc_id, r.n_dropped) for r in found.collect()} == {(i, int(i < 299)) for i in range(300)}


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Alpha, beta!"), (3, ""), (4, None),
         (None, "nobody owns these ten words but they still count here"), (5, "alpha beta"), (6, "the " * 12)]
TEXTS = [
    (1, "x one two three four five six seven eight nine ten y"), (2, "ALPHA beta gamma alpha-beta"), (3, None), (4, ""),
    (5, "one two three four five six seven eight nine TEN eleven eleven"), (6, "the " * 40),
    (7, "nobody owns these ten words but they still count here"), (8, "beta alpha ÀLPHA beta"), (2, "alpha beta again")]


def test_decontamination(spark):
    documents = spark.createDataFrame([(i, t, 0) for i, t in TEXTS], f"{SCHEMA}, term int")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in decontamination.exact_matches(documents, benchmark).collect()]
    assert sorted(found, key=repr) == sorted(brute.contaminated(TEXTS, ITEMS), key=repr)
    # The clean row that shares its id with a rejected one stays, "alpha beta again" is one of two that go.
    assert sorted(r.doc_id for r in decontamination.drop_contaminated(documents, benchmark).collect()) == [3, 4, 8]
    assert decontamination.exact_matches(empty(spark), benchmark).count() == 0
    clean = decontamination.exact_matches(documents, benchmark.where("false"))
    assert clean.where("n_hit > 0").count() == 0 and clean.count() == len(TEXTS)


def test_rows_are_rejected_by_their_text(spark):
    dirty, clean = "well, alpha beta it is", "nothing of that sort"
    rows = [(None, clean), (None, dirty), (5, clean), (5, dirty), (5, dirty), (6, clean), (None, None), (7, "")]
    documents = spark.createDataFrame([(*r, 1, 2) for r in rows], f"{SCHEMA}, m1 int, M2 int")
    kept = decontamination.drop_contaminated(documents, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == documents.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted(
        [r for r in rows if r[1] != dirty], key=repr)


def test_lines_of_repeated_and_missing_ids(spark):
    rows = [(1, f"{LONG}\na"), (1, f"{LONG}\nb"), (1, f"{LONG}\nb"), (None, f"{LONG}\nc"), (None, "c"), (0, f"x\n{LONG}")]
    only_null = [(None, f"another line that is long enough {i % 1}") for i in range(4)]
    for table in (rows, only_null, rows + only_null):
        found = line_dedup.dedup_lines(spark.createDataFrame(table, SCHEMA))
        found = found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()
        assert sorted(map(tuple, found), key=repr) == sorted(brute.line_dedup(table), key=repr)


def test_decontamination_needs_no_python(spark):
    documents = spark.createDataFrame(TEXTS, SCHEMA)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontamination.exact_matches(documents, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_proximity_finds_terms_in_any_order(spark):
    documents = spark.createDataFrame([(1, "five words four with three gaps two one"), (2, "one two three")], SCHEMA)
    benchmark = spark.createDataFrame([(9, "one two three four five")], "item_id long, text string")
    assert [tuple(r) for r in decontamination.proximity_matches(documents, benchmark).collect()] == [(1, "9", 1)]
    assert decontamination.proximity_matches(documents, benchmark, span=3).count() == 0


def near_copies():
    random.seed(5)
    rows, base = [], [f"w{random.randrange(400)}" for _ in range(120)]
    for i in range(120):
        words = list(base)
        for _ in range(random.randrange(6)):
            words[random.randrange(len(words))] = f"x{random.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, " ".join(f"u{i}-{k}" for k in range(40 + i)) + " " + passage) for i in range(60)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "a b"), (2004, "A  b"), (2005, "a b c"), (None, rows[3][1]),
             (3, "another text with the same id as one above"), (2006, " ".join(f"l{i}" for i in range(20000))),
             (2007, " ".join(f"l{i}" for i in range(19000)))]
    return rows


def test_ngram_join(spark, monkeypatch):
    rows = near_copies()
    documents = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], f"{SCHEMA}, node int, gid int").repartition(5)
    expected = sorted(brute.near_components(rows), key=repr)
    assert sorted(map(tuple, ngram_join.similar_components(documents).collect()), key=repr) == expected
    monkeypatch.setattr(ngram_join, "GROUP_MEMBERS", 8)
    monkeypatch.setattr(ngram_join, "COMMON_IN_BATCH", 3)
    assert sorted(map(tuple, ngram_join.similar_components(documents).collect()), key=repr) == expected
    assert ngram_join.similar_components(empty(spark)).count() == 0
    gone = sum(1 for i, _, c in expected if i is not None and c != i)
    assert ngram_join.keep_one_of_each(documents).count() == len(rows) - gone


def test_a_copy_takes_no_other_text_of_its_id_with_it(spark):
    t, u = (" ".join(f"{name}{i}" for i in range(30)) for name in "tu")
    rows = [(3, t), (7, t), (7, u), (9, u), (7, None), (None, u), (9, "only here")]
    kept = ngram_join.keep_one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted(
        [(3, t), (7, u), (7, None), (None, u), (9, "only here")], key=repr)


def test_all_similar_pairs(spark):
    rows = near_copies()
    sets = {brute.shingles(t) for _, t in rows} - {frozenset()}
    expected = sum(brute.similar(a, b) for a in sets for b in sets if a is not b) // 2
    membership, pairs = ngram_join.similar_pairs(spark.createDataFrame(rows, SCHEMA))
    assert pairs.count() == expected == pairs.select(F.least("u", "v"), F.greatest("u", "v")).distinct().count()
    assert membership.count() == len(rows)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (95, 100), (7, 7)]
    found = {tuple(r) for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {(i, 0) for i in range(1, 61)} | {(95, 90), (100, 90)}


VECTORS = [(i, [float(x) for x in np.random.default_rng(i).normal(0, 0.2, 6)]) for i in range(60)]
VECTORS += [(100 + i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(40)]
VECTORS += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] * 6),
            (204, []), (None, [1.0] * 6), (300, [1.0, 2.0]), (305, [1.0, 2.0]), (310, [1e30] * 6), (105, [0.1] * 6)]


def test_topk_search(spark):
    embeddings = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, topk_search.search(embeddings, F.col("vec_id") % 5 == 0).collect()))
    whole = [(i, [min(max(math.floor(1024 * x), -1 << 63), (1 << 63) - 1) for x in v]) for i, v in VECTORS
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q in sorted({i for i, _ in whole if i % 5 == 0}):
        vector = min(v for i, v in whole if i == q)
        scored = sorted((-min(max(sum(a * b for a, b in zip(vector, v)), -1 << 63), (1 << 63) - 1), i)
                        for i, v in whole if i != q and len(v) == len(vector))
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:10])]
    assert found == sorted(expected)
    assert topk_search.search(embeddings.where("false"), F.col("vec_id") % 5 == 0).count() == 0


PAGES = [(1, "http://a.Example.NET/en/x?y"), (2, "https://example.com/de/1"), (3, "http://x.org/fr/#a"), (4, "http://x.org/de/"),
         (5, None), (6, "no host"), (7, "ftp://net"), (8, "http://anet/"), (9, "http://bad.test/a"), (10, "http://bad.test/b"),
         (10, "http://bad.test/b"), (11, "http://q.net?/en/"), (12, "")]


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in PAGES], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(9, True), (10, True), (4, False), (4, None), (None, True)], "page_id long, bad boolean")
    found = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, outcomes).collect()}
    assert found >= {
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "example.com", "/de/1", "example.com/de/", "block"),
        (3, "x.org", "/fr/", "org/fr/", "allow"), (4, "x.org", "/de/", None, "allow"), (5, "", "", None, "allow"),
        (6, "", "", None, "allow"), (7, "net", "", None, "allow"), (8, "anet", "/", None, "allow"),
        (11, "q.net", "", None, "allow"), (12, "", "", None, "allow")}
    assert url_filter.judge(pages, outcomes).count() == len(PAGES)
    assert url_filter.judge(pages.where("false"), outcomes).count() == 0
    assert url_filter.judge(pages, outcomes.where("false")).where("verdict = 'block'").count() == 1


def test_url_filter_against_plain_python(spark):
    random.seed(8)
    hosts = ["a.test", "b.a.test", "www.c.co.uk", "d.c.co.uk", "10.0.0.1:8080", "10.0.0.1", "10.0.0.2", "one", "E.Test:443",
             "x.example.com", "[::1]:80", "bad.test", "worse.bad.test", "new.test", "q.unseen", ""]
    pages = [(i, random.choice(["http://", "https://", "x://"]) + random.choice(hosts) + random.choice(["", "/", "/en/a", "/de/b?x", "#/"]))
             for i in range(400)] + [(1000, None), (1001, "no scheme"), (3, "http://a.test/again"), (None, "http://bad.test/")]
    dirty = lambda url: url and ("bad" in url or "10.0.0.1" in url)
    outcomes = [(i, bool(dirty(u)) ^ (random.random() < .2)) for i, u in pages if i is not None and i % 3 and "new" not in (u or "") and "unseen" not in (u or "")]
    outcomes += [(4, None), (5, True), (5, False), (None, True)]
    found = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"),
                             spark.createDataFrame(outcomes, "page_id long, bad boolean"))
    found = sorted(map(tuple, found.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    assert found == sorted(brute.judged_urls(pages, outcomes), key=repr)
    assert any(v == "block" and r is None for *_, r, v in found)


def test_unseen_hosts_are_not_blocked_by_their_neighbours(spark):
    pages = [(i, f"http://h{i % 200}.test/{i}") for i in range(4000)] + [(9000 + i, f"http://new{i}.test/") for i in range(20)]
    pages += [(9100, None), (9101, "http://10.1.2.3:8080/")]
    outcomes = spark.createDataFrame([(i, i * 7919 % 100 < 55) for i in range(4000)], "page_id long, bad boolean")
    found = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"), outcomes)
    assert {r.verdict for r in found.where("page_id >= 9000").collect()} == {"allow"}


def test_url_filter_blocks_hosts_with_many_bad_pages(spark):
    pages = spark.createDataFrame(
        [(i, f"http://{'bad' if i < 60 else f'h{i % 20}'}.test/{i}") for i in range(460)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, i < 60) for i in range(10, 460)], "page_id long, bad boolean")
    found = {(r.host, r.verdict) for r in url_filter.judge(pages, outcomes).collect()}
    assert ("bad.test", "block") in found and sum(v == "block" for _, v in found) == 1


@pytest.fixture(scope="module")
def pieces():
    with open(sentence_pieces.MODEL, "rb") as file:
        return sentence_pieces.Pieces(file.read())


def scanned(pieces, text, chunk):
    text = sentence_pieces.normal(text)
    parts = max(1, len(text) // chunk)
    edges = [*range(0, parts * chunk, chunk), len(text)]
    spans = list(zip(edges, edges[1:]))
    states = sentence_pieces.fix_states([
        sentence_pieces.transfer(pieces, text, a, b, i == 0) for i, (a, b) in enumerate(spans)])
    return [x for (a, b), s, t in zip(spans, states, states[1:])
            for x in sentence_pieces.trace_chunk(pieces, text, a, b, s, t)[0].tolist()]


def test_max_plus_scan_gives_the_library_ids(pieces):
    random.seed(2)
    letters = ["  ", " ", "the", "ing", "é", "漢", "\n", "aa", "1", "==", "    ", "a", "er", "on"]
    for n in range(150):
        text = "".join(random.choice(letters if n % 2 else letters[2:3] + letters[7:8] + letters[11:]) for _ in range(100))
        assert scanned(pieces, text, random.choice([17, 20, 40])) == pieces.library.encode(text)


def test_transfer_matrices_combine_in_any_order(pieces):
    text = sentence_pieces.normal("inthestationerandtheon" * 5)
    spans = [(0, 25), (25, 50), (50, 75), (75, len(text))]
    a, b, c, d = (sentence_pieces.transfer(pieces, text, *s, i == 0) for i, s in enumerate(spans))
    join = sentence_pieces.combine
    left, right = join(join(join(a, b), c), d), join(a, join(b, join(c, d)))
    assert left[1] == right[1] and (left[2] == right[2]).all()


def test_encoding_round_trip(spark, pieces):
    texts = ["Hello  world\n\nabc é漢😀 ", "", " ", None, "\n", "tab\there", "x" * 3000, "the station " * 400, "a▁b", "no\0l"]
    documents = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(texts)], f"{SCHEMA}, row int")
    found = sentence_pieces.encode(documents, chunk=64)
    by_id = {r.doc_id: r for r in found.collect()}
    for i, text in enumerate(texts):
        row = by_id[i if i else None]
        assert (row.ids, row.n_tokens, row.round_trip) == (
            (None, None, None) if text is None else (lambda ids: (ids, len(ids), True))(pieces.library.encode(text)))
    texts[8] = "a b"
    assert {(r.doc_id, r.text) for r in sentence_pieces.decode(found).collect()} == {
        (i if i else None, t) for i, t in enumerate(texts)}
    assert sentence_pieces.encode(empty(spark)).count() == 0


def test_pair_scores_are_linear_time_sums():
    random = np.random.default_rng(1)
    weights, factors, value = random.normal(size=9), random.normal(size=(9, 4)), random.normal(size=9)
    slow = weights @ value + sum(factors[i] @ factors[j] * value[i] * value[j] for i in range(9) for j in range(i))
    assert quality.pair_score(weights, factors, value) == pytest.approx(slow)


def test_quality_of_odd_rows(spark):
    rows = [(i, ("buy!!! $$$ ### " * 9 if i % 3 == 0 else "a calm sentence about things, number %d. " % i * 4), "q", None) for i in range(120)]
    rows += [(500, None, "q", 3), (501, "", "q", None), (None, " ", "q", 1), (1, "twice", "q", 1)]
    documents = spark.createDataFrame(rows, f"{SCHEMA}, score string, n_chars long")
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0)) for i in range(120)] + [(4, 0), (5, None), (None, 1), (7, 1)], "doc_id long, quality int")
    scored = quality.score(documents, quality.train(documents, labels))
    found = scored.collect()
    assert len(found) == len(rows) and scored.columns == [*documents.columns, "score_"]
    assert all(0 <= r["score_"] <= 1 for r in found)
    held = [r for r in scored.where(quality.held_out(F.col("doc_id"))).collect() if r.doc_id < 120]
    assert held and all((r["score_"] >= 0.5) == (r.doc_id % 3 > 0) for r in held)
    assert quality.keep_good(documents, labels).columns == documents.columns
    untrained = quality.score(documents, quality.train(documents, labels.where("false")))
    assert {r["score_"] for r in untrained.collect()} == {0.5}
    assert quality.keep_good(documents.where("false"), labels).count() == 0


def test_training_is_bounded_and_blind_to_the_held_out_third(spark):
    documents = spark.range(3000).selectExpr("id AS doc_id", "'some text' AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    rows = quality.training_rows(documents, labels, 200)
    assert 120 <= rows.count() <= 200
    assert rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).count() == 0


def test_token_counts(spark):
    texts = ["one line\ntwo lines\n", None, "", "é漢😀\n\nx", "a" * 5000 + " b"]
    documents = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA)
    with open(token_counts.RANKS, "rb") as file:
        counter = token_counts.Counter(file.read())
    for rule in token_counts.RULES:
        found = token_counts.count_tokens(documents, rule=rule).collect()
        for i, text in enumerate(texts):
            own = [r for r in found if r.doc_id == i]
            assert sum(r.n_tokens for r in own) == len(counter.encoding.encode_ordinary(text or ""))
            assert sum(r.n_chars for r in own) == len(text or "")
            assert sorted(r.section for r in own) == list(range((text or "").count("\n") + 1))
    with pytest.raises(ValueError):
        token_counts.count_tokens(documents, rule="none")
    assert token_counts.count_tokens(empty(spark)).count() == 0


def test_tokens_across_boundaries_follow_the_rule():
    starts, ends = np.array([0, 2, 5]), np.array([2, 5, 9])
    spans = np.array([[0, 3], [3, 4], [4, 8], [8, 8]])
    deal = lambda rule: token_counts.deal(starts, ends, spans, rule).tolist()
    assert deal("first") == [2, 0, 1, 0, 0]
    assert deal("last") == [1, 0, 1, 0, 1]
    assert deal("largest") == [2, 0, 1, 0, 0]


def test_token_counts_of_fields(spark):
    rows = spark.createDataFrame([(1, "a title", "some é text"), (2, None, "x")], "doc_id long, title string, body string")
    found = token_counts.count_tokens(token_counts.with_fields(rows, ["title", "body"]), "sections", "last")
    chars = {(r.doc_id, r.section): r.n_chars for r in found.collect() if r.section >= 0}
    assert chars == {(1, 0): 7, (1, 1): 11, (2, 0): 0, (2, 1): 1}


def test_license_scan(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "code"), ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
            ("d/y.py", "text\n  Licensed under CC BY-NC 4.0.\nmore words than the header has in this text, so it is no such file"),
            ("d/z.py", None), (None, "code"), ("e/q", ""), ("e/r", "a license to nothing that a template would know of, ever")]
    documents = spark.createDataFrame([(i, p, t, 0.5) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, cosine double")
    found = {r.doc_id: (r.license, r.how) for r in license_scan.scan(documents, F.col("path")).collect()}
    assert found == {0: ("MIT", "file"), 1: ("GPL-3.0", "inherited"), 2: ("GPL-3.0", "file"), 3: ("CC-BY-NC-4.0", "header"),
                     4: (None, "none"), 5: (None, "none"), 6: (None, "none"), 7: (None, "none")}
    assert license_scan.scan(documents.where("false"), F.col("path")).count() == 0


def test_license_scan_without_paths_looks_for_no_directory(spark, monkeypatch):
    texts = ["Released under the MIT License.", "code", None, "",
             "text\n  Licensed under CC BY-NC 4.0.\nmore words than the header has in this text, so it is no such file"]
    documents = spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], f"{SCHEMA}, source string")
    columns = ["doc_id", "license", "how", "cosine"]
    placed = license_scan.scan(documents, F.concat_ws("/", "source", F.col("doc_id").cast("string")))
    expected = sorted(map(tuple, placed.select(columns).collect()))

    def ancestors(path):
        raise AssertionError("a directory was looked for")

    monkeypatch.setattr(license_scan, "ancestors", ancestors)
    found = license_scan.scan(documents)
    assert found.columns == columns and sorted(map(tuple, found.collect())) == expected
    assert [how for _, _, how, _ in expected] == ["file", "none", "none", "none", "header"]


def test_secret_scan(spark):
    random.seed(9)
    hexes = ["".join(random.choice("0123456789abcdef") for _ in range(40)) for _ in range(80)]
    rows = [(i, f'some words here token = "{h}" and more antidisestablishmentarianism of it') for i, h in enumerate(hexes)]
    rows += [(900, None), (901, ""), (902, "thisisaverylongwordwithoutanyend, yes"), (0, "a repeated id")]
    documents = spark.createDataFrame([(i, t, "src") for i, t in rows], f"{SCHEMA}, label string")
    found = secret_scan.scan(documents, F.col("label")).collect()
    assert sum(r.is_secret for r in found) == 80 and len(found) == 161
    assert all(r.is_secret == (r.length == 40) for r in found)
    assert secret_scan.scan(documents.where("false"), F.col("label")).count() == 0
    none = secret_scan.scan(documents.where("doc_id = 902"), F.col("label")).collect()
    assert [(r.score, r.is_secret) for r in none] == [(0.0, False)]


def secrets_in(spark, text):
    """(part, value, named, assigned) of the candidates of a text."""
    documents = spark.createDataFrame([(1, text)], SCHEMA)
    found = secret_scan.candidates(documents, F.lit("src")).orderBy("place", "part").collect()
    return [(r.part, r.value, r.named, r.assigned) for r in found]


def test_every_value_of_a_word_is_a_candidate(spark):
    a, b, c = "aaaabbbbccccdddd1111", "eeeeffff00001111zzzz", "QQQQwwwwRRRRttttYYYY"
    assert secrets_in(spark, f'{{"api_key":"{a}","other":"{b}","secret":"{c}"}}') == [
        (0, a, True, True), (1, b, False, True), (2, c, True, True)]
    assert secrets_in(spark, f"https://h.org/x?token={a}&page={b}") == [(0, a, True, True), (1, b, False, True)]
    assert secrets_in(spark, f"Server=db;Password={a};Trace={b}") == [(0, a, True, True), (1, b, False, True)]
    assert secrets_in(spark, f"1,{a},{b}") == [(0, a, False, False), (1, b, False, False)]
    # All segments of a web token go by its name.
    assert secrets_in(spark, f"token={a}.{b}.{c}") == [(0, a, True, True), (1, b, True, True), (2, c, True, True)]
    documents = spark.createDataFrame([(i, f"token={a}.{b}.{i:020d}") for i in range(5)], SCHEMA)
    assert secret_scan.scan(documents, F.lit("src")).select("value_sha256").distinct().count() == 7


def test_a_value_begins_after_its_assignment_mark(spark):
    v, padded = "abcdef0123456789abcd", "QUJDREVGR0hJSktMTU5PUA=="
    long_name = "MY_SERVICE_SECRET_TOKEN1"
    for text in (f"API_KEY={v}", f"api_key:{v}", f'API_KEY="{v}"', f"x token={v}", f"export API_KEY='{v}'"):
        assert secrets_in(spark, text) == [(0, v, True, True)]
    assert secrets_in(spark, f"COLOUR={v}") == [(0, v, False, True)]
    for mark in ("=", ":", '="'):
        assert secrets_in(spark, f"{long_name}{mark}{v}")[-1] == (1, v, True, True)
    assert secrets_in(spark, f"API_KEY={padded}") == [(0, padded, True, True)]
    assert secrets_in(spark, f'token="{padded}"') == [(0, padded, True, True)]
    documents = spark.createDataFrame([(1, f"API_KEY={v}"), (2, f"OTHER_TOKEN={v}")], SCHEMA)
    found = secret_scan.scan(documents, F.lit("src")).collect()
    assert len({r.value_sha256 for r in found}) == 1 and {r.length for r in found} == {len(v)}
    assert all(r.is_secret for r in found)


def test_license_scan_reads_wrapped_notices_and_whole_licences(spark):
    whole = {name: text for name, text in license_scan.all_templates() if text.count("\n") > 10}
    commented = lambda text, mark="# ": "\n".join((mark + line).rstrip() for line in text.splitlines())
    code = "\n\nimport os\n" + "".join(f"value{i} = call(value{i - 1}, {i})\n" for i in range(400))
    gpl = lambda n: (
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public "
        f"License as published by\nthe Free Software Foundation, either version {n} of the License, or\n(at your option) any later version.")
    short = "This work is licensed under the GNU\nGeneral Public License,\nversion 3."
    rows = [("a/x.py", commented("Copyright (c) 2020 Some One\n" + whole["BSD-2-Clause"]) + code, "BSD-2-Clause", "header"),
            ("b/x.py", commented("Copyright (c) 2020 Some One\n\n" + whole["BSD-3-Clause"], "// ") + code, "BSD-3-Clause", "header"),
            ("c/x.py", commented(whole["MIT"]) + code, "MIT", "header"), ("d/x.py", commented(gpl(3)) + code, "GPL-3.0", "header"),
            ("e/x.py", commented(gpl(2), " * ") + code, "GPL-2.0", "header"), ("f/x.py", commented(short) + code, "GPL-3.0", "header"),
            ("g/x.py", "/*\n" + whole["BSD-3-Clause"] + "*/" + code, "BSD-3-Clause", "header"),
            ("p/x.py", "Permission is hereby\ngranted, free of charge, to any person obtaining a copy of this software and associated\n"
             "documentation files, to deal in the Software without restriction" + code, "MIT", "header"),
            ("q/x.txt", "The history of the copyright in books is long, and many of the rules that courts follow were made by the printers "
             "of the towns, who had no wish to see the works that they paid for in the shops of others." + code, None, "none")]
    rows += [(f"h{i}/COPYING", "Copyright 2020\n\n" + text, name, "file") for i, (name, text) in enumerate(sorted(whole.items()))]
    rows += [(f"i{i}/terms", text, name, "file") for i, (name, text) in enumerate(sorted(whole.items()))]
    documents = spark.createDataFrame([(i, p, t) for i, (p, t, *_) in enumerate(rows)], "doc_id long, path string, text string")
    found = {r.doc_id: (r.license, r.how) for r in license_scan.scan(documents, F.col("path")).collect()}
    assert found == {i: (name, how) for i, (_, _, name, how) in enumerate(rows)}
