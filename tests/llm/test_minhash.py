"""Bottom-k near-duplicates against comparing all pairs."""

import os
import random

import numpy as np
import pytest

from basketry.llm import minhash
from basketry.llm.queries import QUERIES, table

import brute

SCHEMA = "doc_id long, text string"
FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def texts():
    random.seed(13)
    rows, base = [], [f"w{random.randrange(400)}" for _ in range(150)]
    for i in range(160):
        words = list(base)
        for _ in range(random.randrange(5)):
            words[random.randrange(len(words))] = f"x{random.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, " ".join(f"u{i}-{k}" for k in range(20 + i)) + " " + passage) for i in range(60)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "a b"), (2004, "A  b"), (2005, "a b c"), (None, rows[3][1]),
             (None, "only without an id"), (None, "Only without an  id"), (3, "another text with the same id as one above"),
             (3, rows[3][1]), (2006, " ".join(f"l{i}" for i in range(20000))), (2007, " ".join(f"l{i}" for i in range(18000))),
             (2008, " ".join(f"l{i}" for i in range(15200)))]
    # Sets at the threshold: 85 of 100 shingles shared, and one fewer.
    long = [f"t{i}" for i in range(104)]
    rows += [(3000, " ".join(long)), (3001, " ".join(long[15:])), (3002, " ".join(long[:88]))]
    random.shuffle(rows)
    return rows


def expected(rows):
    return sorted(((d, n, c, d == c) for d, n, c in brute.near_components(rows, minhash.PERCENT)), key=repr)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in texts()], f"{SCHEMA}, node int, mark int").repartition(4)


def test_near_duplicates(frame):
    found = minhash.near_duplicates(frame)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(texts())


def test_blocks_and_parts_lose_no_link(frame, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SETS", 8)
    monkeypatch.setattr(minhash, "SMALL_FAMILY", 4)
    found = minhash.near_duplicates(frame, k=32)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(texts())


def test_dropping_keeps_one_of_each(spark, frame):
    rows = texts()
    gone = sum(1 for d, _, c, _ in expected(rows) if d is not None and c != d)
    kept = minhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns and kept.count() == len(rows) - gone
    assert kept.where("doc_id = 3 and text like 'another%'").count() == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.drop_near_duplicates(empty).count() == 0


def test_tail_bound():
    assert minhash.least_shared(64, 85) < 0.85 * 64 and minhash.least_shared(10, 100) == 10
    rng = np.random.default_rng(2)
    drawn = rng.hypergeometric(850, 150, 64, 200_000)
    assert drawn.min() >= minhash.least_shared(64, 85)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")
def test_query_matches_all_pairs(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_minhash_dedup"](spark, FOLDER).collect()), key=repr) == expected(rows)
