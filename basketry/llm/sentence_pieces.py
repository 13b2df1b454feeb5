"""SentencePiece encoding and decoding: exact BPE ids, giant texts by a max-plus scan of chunks.

BPE merges never cross a place that no piece of the vocabulary crosses, such as the one before a
word's leading blank, so a text falls into units (blanks and a word) that are encoded one by one
and remembered within a task.

A giant text is cut into chunks at fixed places, wherever they fall. A boundary state is a token
that begins before the boundary and ends at or after it. A sequence of tokens is the BPE encoding
of its text exactly if every two neighbours are the encoding of their own text, so an edge
between two tokens weighs 0 if they are and minus infinity if not, and a chunk becomes a max-plus
matrix from the states at its left boundary to those at its right. Where the chunk holds a unit
boundary, all paths pass it: the matrix is the sum of a column for the left end and a row for the
right end, and what lies between needs no search. The matrices of a text are combined in order,
which fixes its states at all boundaries, and every chunk is then traced back on its own.

Defined results. A null text gives null ids, an empty text no ids. A literal U+2581 reads as a
blank, as in the library; apart from that, decoding gives the text back. Rows are encoded one by
one, whatever their ids, and an empty table gives an empty result. The model file is a parameter
and must be a BPE model without text normalisation. Extra columns are not read.
"""

import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import materialize

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 15
# Encoded units that a task remembers.
REMEMBERED = 1 << 19
BLANK = "▁"
UNKNOWN = -1
START = (UNKNOWN, 0, 0)


class Pieces:
    """The vocabulary, encoding of units, and the lattice at chunk boundaries."""

    def __init__(self, model: bytes):
        self.library = p = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        plain = [i for i in range(len(names)) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        self.names, self.ids = names, {names[i]: i for i in plain}
        self.score = {names[i]: p.get_score(i) for i in plain}
        self.longest = max(map(len, self.ids))
        if any(BLANK in name.lstrip(BLANK) for name in self.ids):
            raise ValueError("a piece crosses the start of a word")
        if p.encode("a  b") != p.encode("a") + p.encode(" b"):
            raise ValueError("the model changes blanks before it encodes")
        # A line break that no piece holds ends a unit as well.
        self.apart = not any("\n" in name for name in self.ids)
        self.unit = re.compile(f"\n+|{BLANK}*[^{BLANK}\n]+|{BLANK}+" if self.apart else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.units, self.pairs, self.sound = {}, {}, {}
        self.bytes = {i: bytes([int(names[i][3:5], 16)]) if p.is_byte(i) else b"" if p.is_control(i) else
                      names[i].replace(BLANK, " ").encode() for i in range(len(names))}

    # --- units ------------------------------------------------------------------------

    def encode_unit(self, unit: str) -> tuple[int, ...]:
        found = self.units.get(unit)
        if found is None:
            # The library puts a blank before every text.
            found = tuple(self.library.encode(unit[1:]) if unit[0] == BLANK and unit[1:] else self.after_break(unit))
            if len(self.units) >= REMEMBERED:
                self.units.clear()
            self.units[unit] = found
        return found

    def after_break(self, unit: str) -> list[int]:
        if unit == BLANK:
            return self.library.encode("\n")[:1] if self.apart else [self.ids[BLANK]]
        return self.library.encode("\n" + unit)[2:] if self.apart else self.merge(unit)

    def encode_text(self, text: str) -> np.ndarray:
        """Ids of a normalised text (see ``normal``) that begins and ends at unit boundaries."""
        return np.fromiter(chain.from_iterable(map(self.encode_unit, self.unit.findall(text))), np.int32)

    def decode(self, ids) -> str:
        """The text of ids, with the blank that encoding puts first."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    # --- the lattice ------------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """Plain BPE of a short text: the best pair is merged first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = max(range(len(parts) - 1), key=lambda i: (self.score.get(parts[i] + parts[i + 1], -np.inf), -i))
            if parts[best] + parts[best + 1] not in self.ids:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def merge(self, text: str) -> list[int]:
        return [i for part in self.split(text) for i in self.emit(self.ids.get(part, UNKNOWN), part)]

    def emit(self, token: int, text: str) -> list[int]:
        """A token's ids: its own, or the bytes of a character that is in no piece."""
        if token != UNKNOWN:
            return [token]
        return self.library.encode("\n" + text)[2:] if self.apart else [self.library.unk_id()]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their text."""
        if UNKNOWN in (left, right):
            return True
        found = self.pairs.get((left, right))
        if found is None:
            a, b = self.names[left], self.names[right]
            found = self.pairs[left, right] = self.split(a + b) == [a, b]
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
        return found

    def tokens_at(self, text: str, at: int) -> list[tuple[int, int]]:
        """(token, end) of every token that may begin at a place of the text."""
        found = []
        for end in range(at + 1, min(at + self.longest, len(text)) + 1):
            name = text[at:end]
            token = self.ids.get(name)
            if token is not None:
                if token not in self.sound:
                    self.sound[token] = self.split(name) == [name]
                if self.sound[token]:
                    found.append((token, end))
            elif end == at + 1:
                found.append((UNKNOWN, end))
        return found

    def states(self, text: str, at: int) -> list[tuple[int, int, int]]:
        """(token, begin, end) of all tokens over or up to a boundary, places relative to it."""
        return [(token, begin - at, end - at) for begin in range(max(0, at - self.longest), at)
                for token, end in self.tokens_at(text, begin) if end >= at]

    def cuts(self, text: str, low: int, high: int) -> tuple[int, int] | None:
        """The first and last unit boundary at ``low`` or after it and before ``high``."""
        apart = "\n" if self.apart else BLANK
        is_cut = lambda i: (text[i] == BLANK and text[i - 1] != BLANK) or (text[i] == apart) != (text[i - 1] == apart) and self.apart
        first = next((i for i in range(max(low, 1), high) if is_cut(i)), None)
        if first is None:
            return None
        return first, next(i for i in range(high - 1, first - 1, -1) if is_cut(i))

    def walk(self, text: str, begin: dict, stop: int) -> tuple[dict, dict]:
        """All paths from ``begin``, {(token, begin, end): mask}, to the first token that ends
        at ``stop`` or beyond. Returns those tokens with their masks, and every step's masks."""
        at, ends, steps = {}, {}, {}
        for node, mask in begin.items():
            (ends if node[2] >= stop else at.setdefault(node[2], {}))[node] = mask
        for place in range(min(at, default=stop), stop):
            here = at.pop(place, None)
            if not here:
                continue
            for token, end in self.tokens_at(text, place):
                mask, back = 0, []
                for node, held in here.items():
                    if node[0] is None or self.neighbours(node[0], token):
                        mask |= held
                        back.append((node, held))
                if mask:
                    node = (token, place, end)
                    steps[node] = back
                    (ends if end >= stop else at.setdefault(end, {}))[node] = mask
        return ends, steps

    def trace(self, text: str, begin: tuple, goal: tuple | int) -> list[int]:
        """Ids of the tokens after ``begin`` up to ``goal``: a token, or a place to end at."""
        stop = goal if isinstance(goal, int) else goal[2]
        ends, steps = self.walk(text, {begin: 1}, stop if isinstance(goal, int) else goal[1] + 1)
        node = goal if not isinstance(goal, int) else next((n for n in sorted(ends) if n[2] == goal), None)
        found = []
        while node != begin:
            found.append(self.emit(node[0], text[node[1]:node[2]]))
            node = steps[node][0][0]
        return [i for ids in reversed(found) for i in ids]


def normal(text: str) -> str:
    return BLANK + text.replace(" ", BLANK)


def _moved(state: tuple, by: int) -> tuple:
    return state if state == START else (state[0], state[1] + by, state[2] + by)


def transfer(pieces: Pieces, text: str, low: int, high: int, first: bool) -> tuple[list, list, np.ndarray]:
    """(states in, states out, max-plus matrix) of the chunk [low, high) of ``text``."""
    entering = [START] if first else [_moved(s, low) for s in pieces.states(text, low)]
    begin = {state if not first else (None, low, low): 1 << i for i, state in enumerate(entering)}
    cut = pieces.cuts(text, low, high)
    matrix = lambda ends: (
        list(ends), np.array([[0.0 if mask >> i & 1 else -np.inf for mask in ends.values()]
                              for i in range(len(entering))]).reshape(len(entering), len(ends)))
    if cut is None:
        leaving, weights = matrix(pieces.walk(text, begin, high)[0])
    else:
        # A state that already ends behind the first cut crosses it, so no encoding holds it.
        ends, _ = pieces.walk(text, {n: m for n, m in begin.items() if n[2] <= cut[0]}, cut[0])
        reached = 0
        for node, mask in ends.items():
            reached |= mask if node[2] == cut[0] else 0
        column = np.array([0.0 if reached >> i & 1 else -np.inf for i in range(len(entering))])
        ends, _ = pieces.walk(text, {(None, cut[1], cut[1]): 1}, high)
        leaving = list(ends)
        weights = column[:, None] + np.zeros(len(leaving))
    return [_moved(s, -low) for s in entering], [_moved(s, -high) for s in leaving], weights


def combine(left, right):
    """The matrix of two neighbouring chunks; associative."""
    place = {state: i for i, state in enumerate(right[0])}
    shared = [(i, place[state]) for i, state in enumerate(left[1]) if state in place]
    if not shared:
        raise ValueError("two chunks share no state")
    a, b = left[2][:, [i for i, _ in shared]], right[2][[j for _, j in shared]]
    return left[0], right[1], (a[:, :, None] + b[None]).max(axis=1)


def fix_states(matrices: list) -> list[tuple]:
    """The state at every boundary, START first, of the best path through all chunks."""
    fronts = [matrices[0]]
    for matrix in matrices[1:]:
        fronts.append(combine(fronts[-1], matrix))
    states = [min(fronts[-1][1], key=lambda s: (-fronts[-1][2][0, fronts[-1][1].index(s)], s))]
    for front, matrix in zip(reversed(fronts[:-1]), reversed(matrices[1:])):
        entering, goal = {s: i for i, s in enumerate(matrix[0])}, matrix[1].index(states[-1])
        weight = {s: w + matrix[2][entering[s], goal] for s, w in zip(front[1], front[2][0]) if s in entering}
        states.append(min(weight, key=lambda s: (-weight[s], s)))
    return [START, *reversed(states)]


def trace_chunk(pieces: Pieces, text: str, low: int, high: int, entering: tuple, leaving: tuple) -> tuple[np.ndarray, int, int]:
    """Ids of a chunk between two fixed states, and the places of the text that they cover."""
    first = entering == START
    begin = (None, low, low) if first else _moved(entering, low)
    goal = _moved(leaving, high)
    cut = pieces.cuts(text, begin[2], goal[1] + 1)
    if cut is None:
        ids = np.array(pieces.trace(text, begin, goal), np.int32)
    else:
        head = pieces.trace(text, begin, cut[0]) if begin[2] < cut[0] else []
        tail = pieces.trace(text, (None, cut[1], cut[1]), goal)
        ids = np.concatenate([np.array(head, np.int32), pieces.encode_text(text[cut[0]:cut[1]]), np.array(tail, np.int32)])
    return ids, begin[2], goal[2]


def _lists(arrays: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if a is None else a.size for a in arrays]
    # A null offset makes its list null.
    offsets = pa.array(np.cumsum([0, *sizes], dtype=np.int32), mask=np.array([a is None for a in arrays] + [False]))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int32), *(a for a in arrays if a is not None)])))


def encode(documents: DataFrame, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): the ids of every whole text, and whether they decode
    to it. ``model`` is a file that the driver reads; its bytes go to all tasks."""
    with open(model, "rb") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    giant = F.coalesce(F.char_length("text") > 2 * chunk, F.lit(False))

    def whole(batches):
        pieces = Pieces(shared.value)
        for batch in batches:
            ids, same = [], []
            for text in batch.column(1).to_pylist():
                found = None if text is None else pieces.encode_text(normal(text)) if text else np.zeros(0, np.int32)
                ids.append(found)
                same.append(None if text is None else (pieces.decode(found.tolist())[1:] == text.replace(BLANK, " ")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if a is None else a.size for a in ids], pa.int64()), _lists(ids),
                 pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])

    schema = "doc_id long, n_tokens long, ids array<int>, round_trip boolean"
    return rows.where(~giant).mapInArrow(whole, schema).unionByName(_encode_giants(rows.where(giant), shared, chunk))


def _encode_giants(rows: DataFrame, shared, chunk: int) -> DataFrame:

    def cut(batches):
        around = Pieces(shared.value).longest
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = normal(text)
                parts = max(1, len(text) // chunk)
                edges = [*range(0, parts * chunk, chunk), len(text)]
                for part, (low, high) in enumerate(zip(edges, edges[1:])):
                    yield pa.RecordBatch.from_pylist([{
                        "row": row, "doc_id": doc_id, "part": part, "text": text[max(0, low - around):high + around],
                        "low": min(low, around), "high": high - low + min(low, around)}], _CHUNKS)

    # The row number is drawn and written in one step, and never computed again.
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    chunks = materialize(numbered.mapInArrow(
        cut, "row long, doc_id long, part int, text string, low int, high int"), "giant-chunks")
    spread = chunks.repartition("row", "part")

    def measure(frames):
        pieces = Pieces(shared.value)
        for frame in frames:
            made = [transfer(pieces, r.text, r.low, r.high, r.part == 0) for r in frame.itertuples()]
            yield pd.DataFrame({
                "row": frame["row"], "part": frame["part"], "entering": [_flat(m[0]) for m in made],
                "leaving": [_flat(m[1]) for m in made], "open": [(m[2] == 0).tobytes() for m in made]})

    matrices = spread.mapInPandas(
        measure, "row long, part int, entering array<int>, leaving array<int>, open binary")

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        made = []
        for r in frame.itertuples():
            entering, leaving = _states(r.entering), _states(r.leaving)
            free = np.frombuffer(r.open, bool).reshape(len(entering), len(leaving))
            made.append((entering, leaving, np.where(free, 0.0, -np.inf)))
        states = fix_states(made)
        return pd.DataFrame({"row": frame["row"].to_numpy(), "part": frame["part"].to_numpy(),
                             "entering": [list(s) for s in states[:-1]], "leaving": [list(s) for s in states[1:]]})

    # A text's matrices are a few hundred bytes a chunk, and a text is at most one row.
    states = materialize(matrices.groupBy("row").applyInPandas(
        scan, "row long, part int, entering array<int>, leaving array<int>"), "giant-states")

    def trace(frames):
        pieces = Pieces(shared.value)
        for frame in frames:
            made = [trace_chunk(pieces, r.text, r.low, r.high, tuple(map(int, r.entering)), tuple(map(int, r.leaving)))
                    for r in frame.itertuples()]
            same = [pieces.decode(ids.tolist()) == r.text[low:high].replace(BLANK, " ")
                    for (ids, low, high), r in zip(made, frame.itertuples())]
            yield pd.DataFrame({"row": frame["row"], "doc_id": frame["doc_id"], "has_id": frame["has_id"],
                                "part": frame["part"], "ids": [ids for ids, _, _ in made], "same": same})

    # Ids may be null, which pandas would turn into doubles.
    plain = chunks.withColumns({"has_id": F.col("doc_id").isNotNull(), "doc_id": F.coalesce("doc_id", F.lit(0))})
    traced = plain.join(states, ["row", "part"]).mapInPandas(
        trace, "row long, doc_id long, has_id boolean, part int, ids array<int>, same boolean")
    ids = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("part", "ids"))), lambda p: p["ids"]))
    joined = traced.groupBy("row", "doc_id", "has_id").agg(ids.alias("ids"), F.bool_and("same").alias("round_trip"))
    return joined.select(F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id"),
                         F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


_CHUNKS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()),
                     ("low", pa.int32()), ("high", pa.int32())])


def _flat(states: list[tuple]) -> list[int]:
    return [x for state in states for x in state]


def _states(flat) -> list[tuple]:
    return [tuple(map(int, flat[i:i + 3])) for i in range(0, len(flat), 3)]


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give a null text."""
    with open(model, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        pieces = Pieces(shared.value)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(ids)[1:] for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")
