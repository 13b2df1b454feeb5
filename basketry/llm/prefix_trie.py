"""Conversation prefix trie: vertical bitmaps over (depth, turn), intersected depth first.

1. Conversations are numbered in the order of their ids and dealt into shards of ``SHARD``
   neighbours; a shard's turns are cut into strips of ``STRIP`` depths, so neither very many
   conversations nor a very long one makes a large task. A path to a depth is named by the xor of
   128-bit hashes of its (depth, turn) pairs; where a strip begins, it follows from the strips before.
2. A strip indexes each (depth, turn) to the bitset of the shard's conversations that hold it.
   Depth first, a parent's bitset is intersected with the posting of its first member's next turn:
   that is a child, its popcount the members, and what is left of the bitset gives the next child.
   Members without a next turn are the node's end list.
3. Nodes of all shards with one name are added up: members, and the smallest member, which names
   the node together with its depth. A conversation names a contiguous run of its path's nodes.
4. Sums over subtrees need no descent. Every childless node is named by one conversation that
   ends there, so leaves are the popcount of a node's bitset and the bitset of those. A
   conversation saves the text of the nodes that others name: over the members of a node but the
   smallest, those bytes less the bytes above the node are the subtree's saving. Both are sums
   over stored bitsets, per shard, then added up.
5. End lists are packed per shard; shards follow the order of ids, so a digest is a stream over a
   node's pieces in the order of shards, with one piece in memory.

Defined results. A null role or text is empty. Turns are ordered by number, null first; turns of
one number by the hash of role and text (``mark``), so repeated rows all count. Rows without a
conversation id belong to no conversation. Conversations that ``rebuild`` leaves without turns end
at the root. Without conversations there is no node, not even a root. A text of any length is read
once, for its hash and length. Extra columns are not read.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import ranking
from basketry.session import materialize

SHARD_BITS = 12
SHARD = 1 << SHARD_BITS
STRIP = 256
# The contract's shared heads: a conversation takes its first turns from the one FAMILY leads.
FAMILY, HEADS = 5, 9
_KEY = ["depth", "k1", "k2"]
_LOCAL = ("shard long, strip long, depth long, k1 long, k2 long, p1 long, p2 long, n long, least long, "
          "size long, above long, members binary, ends binary")


def turn_mark(role: Column, text: Column) -> Column:
    """16 bytes that tell turns apart: the MD5 of the role's length, the role and the text."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.md5(whole.cast("binary")))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position from 0, mark, size in bytes of UTF-8) of every turn, written.

    A conversation above ``ranking.GROUP_LIMIT`` turns is counted and sorted in pieces.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    before_all = F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)")
    at = F.coalesce(F.col("turn").cast("long").cast("decimal(20,0)"), before_all)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), at.alias("at"), turn_mark(role, text).alias("mark"),
        F.octet_length(text).cast("long").alias("size"))
    turns = materialize(turns, "turns")
    plain, hot = ranking.split_hot(
        turns, ["conv_id"], turns.groupBy("conv_id").agg(F.count("*").alias("n")), ranking.GROUP_LIMIT)
    order = Window.partitionBy("conv_id").orderBy("at", "mark")
    placed = plain.withColumn("position", F.row_number().over(order))
    if hot is not None:
        levels = {"far": F.floor(F.col("at") / (1 << 20)), "first": F.substring(F.hex("mark"), 1, 4)}
        pieces = ranking.rank_in_pieces(
            hot.withColumns(levels), ["conv_id"], ["far", "at", "first", "mark"], "position")
        placed = placed.unionByName(pieces.select(*placed.columns))
    return materialize(placed.select(
        "conv_id", (F.col("position") - 1).cast("long").alias("position"), "mark", "size"), "turns-in-order")


def rebuild(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every conversation and its (conv_id, position, mark, size), rebuilt:
    the first h turns of conversation c - c % family, then the own turns after the first h, with
    h = crc32(c) % heads."""
    own = materialize(turns.groupBy("conv_id").agg(F.count("*").alias("own")), "own-lengths")
    named = F.col("conv_id").cast("string").cast("binary")
    plan = own.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % family).alias("head_of"),
                      (F.crc32(named) % heads).alias("h"))
    led = own.select(F.col("conv_id").alias("head_of"), F.col("own").alias("led"))
    plan = plan.join(led, "head_of", "left").select(
        "conv_id", "head_of", "h", F.least("h", F.coalesce("led", F.lit(0))).alias("taken"),
        F.greatest(F.col("own") - F.col("h"), F.lit(0)).alias("kept"))
    plan = materialize(plan, "rebuilding")
    heads_of = turns.where(F.col("position") < heads).withColumnRenamed("conv_id", "head_of")
    taken = heads_of.join(plan, "head_of").where(F.col("position") < F.col("taken"))
    kept = turns.join(plan, "conv_id").where(F.col("position") >= F.col("h")).withColumn(
        "position", F.col("taken") + F.col("position") - F.col("h"))
    columns = ["conv_id", "position", "mark", "size"]
    lengths = plan.select("conv_id", (F.col("taken") + F.col("kept")).alias("length"))
    return lengths, taken.select(*columns).unionByName(kept.select(*columns))


def _strips(lengths: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(numbered conversations, rows of all strips). A row is a conversation's turn at a depth, or,
    with a null ``size``, its path up to the depth above its strip."""
    numbered = materialize(
        lengths.orderBy("conv_id").withColumn("number", F.monotonically_increasing_id()), "numbered")
    depth = F.col("position") + 1
    rows = turns.join(numbered, "conv_id").select(
        "conv_id", "number", "length", depth.alias("depth"), F.xxhash64(depth, "mark").alias("c1"),
        F.xxhash64("mark", F.lit(1), depth).alias("c2"), "size")
    nothing = F.lit(0).cast("long")
    roots = numbered.select("conv_id", "number", "length", nothing.alias("depth"), nothing.alias("c1"),
                            nothing.alias("c2"), nothing.alias("size"))
    rows = materialize(rows.unionByName(roots).withColumn(
        "strip", F.floor(F.col("depth") / STRIP)), "trie-turns")
    # Only conversations that go on beyond their first strip need the paths before later ones.
    sums = rows.where(F.col("length") >= STRIP).groupBy("conv_id", "number", "length", "strip").agg(
        F.bit_xor("c1").alias("c1"), F.bit_xor("c2").alias("c2"), F.sum("size").alias("above"))
    before = Window.partitionBy("number").orderBy("strip").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "conv_id", "number", "length", "strip", (F.col("strip") * STRIP - 1).alias("depth"),
        F.bit_xor("c1").over(before).alias("c1"), F.bit_xor("c2").over(before).alias("c2"),
        F.lit(None).cast("long").alias("size"), F.sum("above").over(before).alias("above")).where("strip > 0")
    start0 = numbered.select(
        "conv_id", "number", "length", nothing.alias("strip"), F.lit(-1).cast("long").alias("depth"),
        nothing.alias("c1"), nothing.alias("c2"), F.lit(None).cast("long").alias("size"), nothing.alias("above"))
    every = rows.withColumn("above", nothing).unionByName(starts).unionByName(start0)
    shard = F.shiftright("number", SHARD_BITS)
    return numbered.withColumn("shard", shard), every.withColumn("shard", shard).withColumn(
        "bit", F.col("number").bitwiseAND(SHARD - 1).cast("int"))


def _to_bits(places: np.ndarray) -> int:
    if places.size < 4:
        return sum(1 << int(p) for p in places)
    held = np.zeros(SHARD, np.uint8)
    held[places] = 1
    return int.from_bytes(np.packbits(held, bitorder="little").tobytes(), "little")


def _to_places(bits: int, n: int) -> np.ndarray:
    if n < 4:
        found = []
        while bits:
            low = bits & -bits
            found.append(low.bit_length() - 1)
            bits ^= low
        return np.array(found, np.uint16)
    raw = np.frombuffer(bits.to_bytes(SHARD // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")).astype(np.uint16)


def _pack(bits: int, n: int) -> bytes:
    """Members as 16-bit numbers, or as the bitset itself where that is shorter."""
    return bits.to_bytes(SHARD // 8, "little") if 2 * n >= SHARD // 8 else _to_places(bits, n).tobytes()


def _unpack(members: bytes) -> np.ndarray:
    if len(members) == SHARD // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(members, np.uint8), bitorder="little"))
    return np.frombuffer(members, np.uint16).astype(np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def grow_strip(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one strip of one shard."""
    shard, strip = int(rows["shard"].iloc[0]), int(rows["strip"].iloc[0])
    first = strip * STRIP
    begins = rows[rows["size"].isna()]
    turns = rows[rows["size"].notna()]
    bit, depth = turns["bit"].to_numpy(np.int64), turns["depth"].to_numpy(np.int64) - first
    names = np.empty(len(turns), [("a", np.uint64), ("b", np.uint64)])
    names["a"], names["b"] = (turns[c].to_numpy(np.int64).view(np.uint64) for c in ("c1", "c2"))
    # A posting is a (depth, turn); its number stands for it below. The root's turn has no hash.
    _, some, posting = np.unique(names, return_index=True, return_inverse=True)
    order = np.argsort(posting, kind="stable")
    ends = np.cumsum(np.bincount(posting, minlength=some.size))
    postings = [_to_bits(part) for part in np.split(bit[order], ends[:-1])]
    hashes = [(int(a), int(b)) for a, b in names[some]]
    sizes = turns["size"].to_numpy(np.float64).astype(np.int64)[some].tolist()
    at = np.full((SHARD, STRIP), -1, np.int32)
    at[bit, depth] = posting
    going = [_to_bits(bit[depth == d]) for d in range(int(depth.max()) + 1)] + [0]
    last = turns["depth"].to_numpy() == turns["length"].to_numpy()
    ended = [_to_bits(bit[last & (depth == d)]) for d in range(len(going))]
    ids = np.zeros(SHARD, np.int64)
    ids[bit] = turns["conv_id"].to_numpy(np.int64)
    mask = (1 << 64) - 1
    stack = [(_to_bits(part["bit"].to_numpy(np.int64)), -1, int(a) & mask, int(b) & mask, int(part["above"].iloc[0]))
             for (a, b), part in begins.groupby(["c1", "c2"])]
    found = []
    while stack:
        bits, level, a, b, above = stack.pop()
        rest = bits & going[level + 1]
        while rest:
            turn = int(at[(rest & -rest).bit_length() - 1, level + 1])
            child = bits & postings[turn]
            rest ^= child
            x, y, n = a ^ hashes[turn][0], b ^ hashes[turn][1], child.bit_count()
            out = child & ended[level + 1]
            found.append((
                shard, strip, first + level + 1, _signed(x), _signed(y), _signed(a), _signed(b), n,
                int(ids[(child & -child).bit_length() - 1]), sizes[turn], above, _pack(child, n),
                ids[_to_places(out, out.bit_count())].tobytes() if out else None))
            if child != out:
                stack.append((child, level + 1, x, y, above + sizes[turn]))
    return pd.DataFrame(found, columns=[c.split()[0] for c in _LOCAL.split(", ")])


def _node_sums(nodes: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
    """Per node of a strip: its leaves, the bytes that its members share with others, and its
    smallest member with that member's bytes."""
    columns = [*_KEY, "leaves", "shared", "least", "least_shared"]
    if not len(nodes) or not len(values):
        return pd.DataFrame(columns=columns)
    shared = np.frombuffer(values["shared"].iloc[0], np.int64)
    leaf = np.frombuffer(values["leaf"].iloc[0], np.int64)
    members = [_unpack(m) for m in nodes["members"]]
    starts = np.cumsum([0, *(m.size for m in members[:-1])])
    flat = np.concatenate(members)
    found = nodes[_KEY].copy()
    found["leaves"] = np.add.reduceat(leaf[flat], starts)
    found["shared"] = np.add.reduceat(shared[flat], starts)
    found["least"], found["least_shared"] = nodes["least"], shared[flat[starts]]
    return found[columns]


def end_digests(local: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of nodes where conversations end."""

    def run(batches):
        key, digest = None, None
        for batch in batches:
            done = []
            for *now, ends in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                text = ",".join(map(str, np.frombuffer(ends, np.int64).tolist())).encode()
                if now == key:
                    digest.update(b"," + text)
                    continue
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256(text)
            if done:
                yield _digest_rows(done)
        if key is not None:
            yield _digest_rows([(*key, digest.hexdigest())])

    pieces = local.where(F.col("ends").isNotNull()).select(*_KEY, "shard", "ends")
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "shard").mapInArrow(
        run, "depth long, k1 long, k2 long, ends_sha256 string")


def _digest_rows(done: list[tuple]) -> pa.RecordBatch:
    depth, k1, k2, digest = zip(*done)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(x, pa.int64()) for x in (depth, k1, k2)), pa.array(digest)], [*_KEY, "ends_sha256"])


def grow(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie over conversations (conv_id, length) and their turns (conv_id,
    position, mark, size): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    numbered, rows = _strips(lengths, turns)
    local = materialize(rows.groupBy("shard", "strip").applyInPandas(grow_strip, _LOCAL), "trie-strips")
    nodes = materialize(local.groupBy(*_KEY).agg(
        F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.sum("n").alias("n_convs"),
        F.min("least").alias("conv_id"), F.first("above").alias("above")), "trie-nodes")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    nodes = materialize(nodes.join(children, _KEY, "left").fillna(0, ["n_children"]), "trie-parents")
    # Per conversation: the bytes of its path that others name, and whether it names a leaf.
    named = nodes.groupBy("conv_id").agg(
        F.min("above").alias("above"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    whole = turns.groupBy("conv_id").agg(F.sum("size").alias("whole"))
    values = numbered.join(named, "conv_id", "left").join(whole, "conv_id", "left").select(
        "shard", F.col("number").bitwiseAND(SHARD - 1).alias("bit"),
        F.coalesce("above", "whole", F.lit(0)).cast("long").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        arrays = np.zeros((2, SHARD), np.int64)
        arrays[:, rows["bit"].to_numpy(np.int64)] = rows["shared"].to_numpy(), rows["leaf"].to_numpy()
        return pd.DataFrame([{"shard": rows["shard"].iloc[0], "shared": arrays[0].tobytes(), "leaf": arrays[1].tobytes()}])

    arrays = values.groupBy("shard").applyInPandas(fill, "shard long, shared binary, leaf binary")
    arrays = arrays.join(local.select("shard", "strip").distinct(), "shard").toDF("of_shard", "shared", "leaf", "of_strip")
    sums = local.select("shard", "strip", *_KEY, "least", "members").groupBy("shard", "strip").cogroup(
        arrays.groupBy("of_shard", "of_strip")).applyInPandas(
        _node_sums, "depth long, k1 long, k2 long, leaves long, shared long, least long, least_shared long")
    totals = sums.groupBy(*_KEY).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("shared").alias("shared"),
        F.min(F.struct("least", "least_shared"))["least_shared"].alias("own"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    saved = F.col("shared") - F.col("own") - (F.col("n_convs") - 1) * F.col("above")
    return nodes.join(parents, ["depth", "p1", "p2"], "left").join(totals, _KEY).join(
        end_digests(local), _KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are; see ``grow``."""
    turns = ordered_turns(conversations)
    return grow(turns.groupBy("conv_id").agg(F.count("*").alias("length")), turns)


def rebuilt_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """The trie of conversations that share heads within their families; see ``rebuild``."""
    lengths, turns = rebuild(ordered_turns(conversations), family, heads)
    return grow(lengths, materialize(turns, "rebuilt-turns"))
