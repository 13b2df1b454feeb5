"""Phrase mining against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import collocations

import brute

SCHEMA = "lang string, text string"


def texts():
    random.seed(12)
    vocabulary = ["the", "of", "Über", "x", "new", "york", "mañana", "a-b", "nul\x00", " ", "É", "é", "ÀB"]
    rows = []
    for i in range(150):
        words = [random.choice(vocabulary[:random.choice([3, 6, 13])]) for _ in range(random.randrange(1, 60))]
        text = "".join(w + random.choice([" ", " ", "  ", "\t", " ", ", ", ".", "\n", "\x0b", " ! "]) for w in words)
        rows.append((random.choice(["en", "de", None, "und", ""]), text))
    rows += [("en", None), (None, ""), ("en", " \t.;"), ("en", "New York! new york"), ("fr", "alone"), ("en", "the of " * 400)]
    return rows + rows[:20]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, *r, 1) for i, r in enumerate(texts())], f"doc_id long, {SCHEMA}, key int").repartition(5)


def found(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("min_count, top, share", [(2, 40, 100), (5, 1000, 100), (3, 1000, 60)])
def test_collocations(frame, min_count, top, share):
    assert found(collocations.collocations(frame, min_count, top=top, share=share)) == sorted(
        brute.phrases(texts(), min_count, top, share=share))


def test_spills_bursts_and_split_prefixes(frame, monkeypatch):
    monkeypatch.setattr(collocations, "BURST", 4)
    monkeypatch.setattr(collocations, "ROOM", 64)
    monkeypatch.setattr(collocations, "RUN_ENTRIES", 3)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 200)
    monkeypatch.setattr(collocations, "GRAIN", 50)
    monkeypatch.setattr(collocations, "LEAST_PARTS", 3)
    monkeypatch.setattr(collocations, "MERGE_ROOM", 40)
    # Bitmaps that are almost full let everything through.
    monkeypatch.setattr(collocations, "WORD_BITS", 1 << 15)
    monkeypatch.setattr(collocations, "PAIR_BITS", 1 << 15)
    assert found(collocations.collocations(frame, 3, top=500)) == sorted(brute.phrases(texts(), 3, 500))
    assert found(collocations.collocations(frame, 3, longest=2)) == sorted(brute.phrases(texts(), 3, 2000, longest=2))


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None)], SCHEMA)).count() == 0


def test_products_beyond_64_bits(spark):
    key = lambda *ids: b"".join(np.int64(i).tobytes() for i in ids)
    a, n, l, r = 4 * 10 ** 12 + 7, 9 * 10 ** 12 + 1, 5 * 10 ** 12 + 3, 6 * 10 ** 12 + 5
    phrases = spark.createDataFrame([(2, key(-3, 9), a)], "size int, key binary, a long")
    words = spark.createDataFrame([("en", b"p", -3, l), ("en", b"q", 9, r)], "lang string, word binary, id long, f long")
    row = collocations.best_cuts(phrases, words, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert (row.l, row.r, row.n, row.score) == (l, r, n, 1000 * a * n // (l * r))


def test_id_bytes(spark):
    ids = [0, 1, -1, 255, 1 << 62, -(1 << 63), 123456789012345]
    rows = spark.createDataFrame([(i,) for i in ids], "id long").select("id", collocations.id_bytes(F.col("id")).alias("b")).collect()
    assert all(bytes(r.b) == np.int64(r.id).tobytes() for r in rows)
