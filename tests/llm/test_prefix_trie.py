"""The conversation trie against plain Python."""

import random

import pytest

from basketry.functions import ranking
from basketry.llm import prefix_trie

import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def talks(n=70, longest=9):
    random.seed(11)
    rows = []
    for c in random.sample(range(-20, 400), n):
        for t in range(random.randrange(1, longest)):
            rows.append((c, t, random.choice(["user", "assistant", None]), random.choice(["a", "bé", "", None, "long " * 400])))
    rows += [(5, None, "user", "before all"), (5, 1, "user", "twice"), (5, 1, "user", "twice"), (5, 1, None, None),
             (None, 0, "user", "nobody's"), (1000, 3, "user", "late"), (1003, 0, "x", "only"), (1 << 60, 0, "user", "a")]
    rows += [(2000 + i, t, "user", "a hot first turn" if t < 3 else f"own {i % 4}") for i in range(60) for t in range(5)]
    random.shuffle(rows)
    return rows


def found(frame):
    assert frame.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, frame.collect()), key=repr)


def test_trie_of_rebuilt_conversations(spark):
    rows = talks()
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], f"{SCHEMA}, depth int, mark int").repartition(3)
    assert found(prefix_trie.rebuilt_trie(frame)) == sorted(brute.tries(rows), key=repr)


def test_trie_of_conversations_as_they_are(spark):
    rows = talks()
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == sorted(brute.tries(rows, 1, 1), key=repr)


@pytest.mark.parametrize("bits, strip", [(4, 2), (3, 3), (5, 256)])
def test_shards_and_strips_add_up(spark, monkeypatch, bits, strip):
    monkeypatch.setattr(prefix_trie, "SHARD_BITS", bits)
    monkeypatch.setattr(prefix_trie, "SHARD", 1 << bits)
    monkeypatch.setattr(prefix_trie, "STRIP", strip)
    monkeypatch.setattr(ranking, "GROUP_LIMIT", 6)
    rows = talks(40) + [(7, t, "user", str(t // 2)) for t in range(30)]
    assert found(prefix_trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA))) == sorted(brute.tries(rows), key=repr)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.rebuilt_trie(empty).count() == 0
    nobody = spark.createDataFrame([(None, 0, "user", "a")], SCHEMA)
    assert prefix_trie.prefix_trie(nobody).count() == 0
