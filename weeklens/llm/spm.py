"""SentencePiece encoding and decoding (BPE models) with a max-plus parallel scan over giant documents.

A text gets the dummy prefix and the blank mark; no piece has the mark after another character, so a
text falls into units (marks, then a word) which merges never cross. Ordinary texts are encoded unit
by unit, each unit by the model's merges (best score first, leftmost on ties), remembered per worker.

A text of ``chunk_chars`` code points or more is cut into chunks at fixed places, words or not. Its
encoding is a path through the lattice of pieces: a sequence of pieces is what the merges give exactly
if each pair of neighbours is what the merges give for the two alone (a merge that crossed a border
would show in the pair), so a path weighs the sum of its scores, or minus infinity where neighbours do
not hold. At a chunk's border the state is the piece that ends at or reaches over it. Every chunk,
alone, gives the matrix of best weights from each entry state to each exit state; the matrices are
combined by the (max, +) product, which is associative, the best path fixes one state per border, and
every chunk is traced back by itself between its two states. Where a border or a chunk contains a
start of a unit, all paths meet there and the matrix is the sum of two vectors (what lies between two
meeting points weighs the same on every path and is left out).
"""

from __future__ import annotations

import heapq
import re
import secrets
import sys
import types
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import shuffle_width, stash

MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
BYTE = re.compile(r"<0x([0-9A-F]{2})>")
UNKNOWN_SURFACE = " ⁇ "
#: Words, and pairs, remembered per Python worker (about 200 and 300 bytes each).
WORDS, MEMORY = 200_000, 100_000
#: Rows whose tokens are held at once.
ROWS = 256
NEVER = float("-inf")


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, int]  # ordinary pieces
    scores: dict[str, float]
    byte_ids: tuple[int, ...]  # empty without byte fallback
    unknown: int
    surfaces: tuple[bytes, ...]
    longest: int
    key: str  # names the model in the workers' memories


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a SentencePiece BPE model file, read on the driver."""
    import hashlib

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, surfaces, by_byte = {}, {}, [], {}
    for i in range(sp.vocab_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            by_byte[int(BYTE.fullmatch(piece)[1], 16)] = i
            surfaces.append(bytes([int(BYTE.fullmatch(piece)[1], 16)]))
        elif sp.is_unknown(i):
            surfaces.append(UNKNOWN_SURFACE.encode())
        elif sp.is_control(i):
            surfaces.append(b"")
        else:
            if MARK in piece.lstrip(MARK):
                raise ValueError("a piece has the blank mark inside: texts do not fall into units")
            ids[piece], scores[piece] = i, sp.get_score(i)
            surfaces.append(piece.replace(MARK, " ").encode("utf-8", "surrogatepass"))
    byte_ids = tuple(by_byte[b] for b in range(256)) if len(by_byte) == 256 else ()
    key = hashlib.sha1(repr(sorted(scores.items())).encode("utf-8", "surrogatepass")).hexdigest()
    return Vocabulary(ids, scores, byte_ids, sp.unk_id(), tuple(surfaces), max(map(len, ids)), key)


def merge(unit: str, scores: dict[str, float]) -> list[str]:
    """The model's merges: again and again the best-scored neighbours that form a piece, leftmost on ties."""
    if len(unit) > 48:
        return _merge_long(unit, scores)
    symbols, score = list(unit), scores.get
    found = [score(a + b, NEVER) for a, b in zip(symbols, unit[1:], strict=False)]
    while found and (best := max(found)) != NEVER:
        at = found.index(best)
        both = symbols[at] = symbols[at] + symbols.pop(at + 1)
        del found[at]
        if at:
            found[at - 1] = score(symbols[at - 1] + both, NEVER)
        if at < len(found):
            found[at] = score(both + symbols[at + 1], NEVER)
    return symbols


def _merge_long(unit: str, scores: dict[str, float]) -> list[str]:
    """The same with a heap: for units of any length."""
    n = len(unit)
    symbols: list[str | None] = list(unit)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (s := scores.get(both := symbols[i] + symbols[after[i]])) is not None:
            heapq.heappush(heap, (-s, i, both))

    for i in range(n):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        if symbols[i] is None or after[i] >= n or symbols[i] + symbols[after[i]] != both:
            continue
        j = after[i]
        symbols[i], symbols[j], after[i] = both, None, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [s for s in symbols if s is not None]


class _Memory(dict):
    """Results by key, computed when missing; stops growing at ``most`` entries."""

    def __init__(self, compute, most: int = MEMORY) -> None:
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        out = self.compute(key)
        if len(self) < self.most:
            self[key] = out
        return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.of_unit = _Memory(self._packed)
        self.of_word = _Memory(lambda word: self._packed(MARK + word), WORDS)
        self.holds = _Memory(lambda ab: merge(ab[0] + ab[1], vocabulary.scores) == list(ab))
        self.stands = _Memory(lambda a: merge(a, vocabulary.scores) == [a])

    @staticmethod
    def of(fields: dict) -> Encoder:
        """One encoder per worker process and model, so what it remembers lasts over tasks."""
        kept = sys.modules.setdefault("weeklens_spm_memory", types.ModuleType("weeklens_spm_memory"))
        if fields["key"] not in kept.__dict__:
            kept.__dict__[fields["key"]] = Encoder(Vocabulary(**fields))
        return kept.__dict__[fields["key"]]

    def piece_ids(self, symbols: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for s in symbols:
            if (i := self.v.ids.get(s)) is not None:
                out.append(i)
            elif self.v.byte_ids:
                out += [self.v.byte_ids[b] for b in s.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.v.unknown)
        return tuple(out)

    def _packed(self, unit: str) -> bytes:
        return array("i", self.piece_ids(merge(unit, self.v.scores))).tobytes()

    def units(self, marked: str) -> np.ndarray:
        if marked[:1] == MARK and MARK + MARK not in marked:  # a mark and a word each: remembered with those of other texts
            return np.frombuffer(b"".join(map(self.of_word.__getitem__, marked[1:].split(MARK))), "<i4")
        return np.frombuffer(b"".join(map(self.of_unit.__getitem__, UNIT.findall(marked))), "<i4")

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if text[0] == " " or "  " in text or MARK in text:
            return self.units(mark(text))
        # without runs of blanks every unit is a mark and a word
        return np.frombuffer(b"".join(map(self.of_word.__getitem__, text.split(" "))), "<i4")

    def weight(self, piece: str) -> float:
        return self.v.scores.get(piece, 0.0)  # an unknown character is the only path through itself

    # ------------------------------------------------ the lattice around chunk borders

    def pieces_at(self, s: str, at: int) -> Iterator[str]:
        known = False
        for n in range(1, min(self.v.longest, len(s) - at) + 1):
            p = s[at : at + n]
            if p in self.v.ids and self.stands[p]:
                known |= n == 1
                yield p
        if not known and s[at] not in self.v.ids:
            yield s[at]

    def states(self, s: str, at: int) -> list[tuple[int, str | None]]:
        """States of the border ``at``: (end of the piece, piece), or the one free state where a unit starts."""
        if starts_unit(s, at):
            return [(at, None)]
        return [(i + len(p), p) for i in range(max(0, at - self.v.longest), at) for p in self.pieces_at(s, i) if i + len(p) >= at]

    def _spread(self, s: str, begin: list[tuple[int, str | None]], stop: int) -> dict[int, dict[str | None, np.ndarray]]:
        """Best weights from every state in ``begin`` to every piece that starts before ``stop``: end -> piece -> vector."""
        front: dict[int, dict[str | None, np.ndarray]] = {}
        for i, (end, piece) in enumerate(begin):
            vector = np.full(len(begin), NEVER)
            vector[i] = 0.0
            front.setdefault(end, {})[piece] = vector
        for at in range(min(e for e, _ in begin), stop):
            here = front.pop(at, None) if at < stop else None
            if not here:
                continue
            nexts = list(self.pieces_at(s, at))
            for last, vector in here.items():
                for p in nexts:
                    if last is None or self.holds[last, p]:
                        to, gained = front.setdefault(at + len(p), {}), vector + self.weight(p)
                        to[p] = np.maximum(to[p], gained) if p in to else gained
        return front

    def matrix(self, s: str, lo: int, hi: int) -> np.ndarray:
        """Best weights of the pieces that start in [lo, hi): entry states x exit states, without what is common to all."""
        entries, exits = self.states(s, lo), self.states(s, hi)
        meets = [i for i in (_first_unit(s, lo, hi), _last_unit(s, lo, hi)) if i is not None]
        if not meets:
            return self._exit(self._spread(s, entries, hi), exits, len(entries))
        first, last = meets
        head = self._meet(self._spread(s, entries, first), first, len(entries))
        tail = self._exit(self._spread(s, [(last, None)], hi), exits, 1)[0]
        return head[:, None] + tail[None]

    @staticmethod
    def _meet(front: dict, at: int, n: int) -> np.ndarray:
        out = np.full(n, NEVER)
        for vector in front.get(at, {}).values():
            out = np.maximum(out, vector)
        return out

    def _exit(self, front: dict, exits: list, n: int) -> np.ndarray:
        if exits[0][1] is None:
            return self._meet(front, exits[0][0], n)[:, None]
        return np.stack([front.get(end, {}).get(piece, np.full(n, NEVER)) for end, piece in exits], axis=1)

    def trace(self, s: str, lo: int, hi: int, entry: int, exit_: int) -> np.ndarray:
        """Token ids of the pieces that start in [lo, hi), between an entry and an exit state."""
        begin, end = self.states(s, lo)[entry], self.states(s, hi)[exit_]
        first, last = _first_unit(s, lo, hi), _last_unit(s, lo, hi)
        if first is None:
            return np.array(self.piece_ids(self._path(s, begin, end, hi)), np.int32)
        head = self.piece_ids(self._path(s, begin, (first, None), first))
        tail = self.piece_ids(self._path(s, (last, None), end, hi))
        return np.concatenate((np.array(head, np.int32), self.units(s[first:last]), np.array(tail, np.int32)))

    def _path(self, s: str, begin: tuple, end: tuple, stop: int) -> list[str]:
        """The best path of pieces starting before ``stop`` from one state to another (a None piece: any)."""
        best: dict[int, dict[str | None, tuple[float, tuple | None]]] = {begin[0]: {begin[1]: (0.0, None)}}
        for at in range(begin[0], stop):
            for last, (weight, _) in best.get(at, {}).items():
                for p in self.pieces_at(s, at):
                    if last is None or self.holds[last, p]:
                        to, gained = best.setdefault(at + len(p), {}), weight + self.weight(p)
                        if p not in to or gained > to[p][0]:
                            to[p] = (gained, (at, last))
        ends = best.get(end[0], {})
        piece = end[1] if end[1] is not None else max(ends, key=lambda p: ends[p][0])
        at, out = end[0], []
        while (step := best[at][piece][1]) is not None:
            out.append(piece)
            at, piece = step
        return out[::-1]


def mark(text: str) -> str:
    return MARK + text.replace(" ", MARK)


def starts_unit(s: str, at: int) -> bool:
    """A unit starts at ``at``: a mark after another character. Both ends of a text count."""
    return at in (0, len(s)) or (s[at] == MARK and s[at - 1] != MARK)


def _first_unit(s: str, lo: int, hi: int) -> int | None:
    return next((i for i in range(lo, hi + 1) if starts_unit(s, i)), None)


def _last_unit(s: str, lo: int, hi: int) -> int | None:
    return next((i for i in range(hi, lo - 1, -1) if starts_unit(s, i)), None)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (max, +) product of two transfer matrices."""
    return (a[:, :, None] + b[None]).max(axis=1)


def border_states(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(entry, exit) state of every chunk on the best path: products of the left parts, then backwards."""
    left = [np.zeros((1, 1))]
    for m in matrices:
        left.append(times(left[-1], m))
    out, state = [], int(np.argmax(left[-1][0]))
    for k in range(len(matrices) - 1, -1, -1):
        entry = int(np.argmax(left[k][0] + matrices[k][:, state]))
        out.append((entry, state))
        state = entry
    return out[::-1]


# ---------------------------------------------------------------- on Spark


def _chunks(giants: DataFrame, names: list[str], shared, chunk_chars: int) -> DataFrame:
    """Chunks of giant texts with their transfer matrices, written once."""
    schema = pa.schema([
        *[(n, to_arrow_type(giants.schema[n].dataType)) for n in names], ("text", pa.int64()), ("chunk", pa.int32()),
        ("s", pa.string()), ("lo", pa.int32()), ("hi", pa.int32()), ("matrix", pa.binary()), ("n_in", pa.int32())])
    kinds = ", ".join(f"{n} {giants.schema[n].dataType.simpleString()}" for n in names)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(shared.value)
        margin = encoder.v.longest + 1
        for part in parts:
            for row in range(part.num_rows):
                s, rows, text = mark(part.column("t")[row].as_py()), [], secrets.randbits(62)
                own = {n: part.column(n)[row].as_py() for n in names}  # on the first chunk only
                for k, at in enumerate(range(0, len(s), chunk_chars)):
                    # the margins hold every piece that reaches over a border, and what says if a unit starts there
                    lo, hi = max(0, at - margin), min(len(s), at + chunk_chars + margin)
                    piece, a, b = s[lo:hi], at - lo, min(len(s), at + chunk_chars) - lo
                    m = encoder.matrix(piece, a, b)
                    rows.append((own if k == 0 else {}) | {"text": text, "chunk": k, "s": piece, "lo": a, "hi": b, "matrix": m.tobytes(), "n_in": len(m)})
                    if len(rows) == 64:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    spec = f"{kinds}, text long, chunk int, s string, lo int, hi int, matrix binary, n_in int"
    return stash(giants.mapInArrow(run, spec), "spm-chunks")


def _scan(pdf: pd.DataFrame) -> pd.DataFrame:
    """All matrices of one text, never more than a few numbers per ``chunk_chars`` of one row's text."""
    pdf = pdf.sort_values("chunk")
    matrices = [np.frombuffer(m).reshape(n, -1) for m, n in zip(pdf["matrix"], pdf["n_in"], strict=True)]
    states = border_states(matrices)
    return pd.DataFrame({"text2": pdf["text"], "chunk2": pdf["chunk"], "entry": [a for a, _ in states], "exit": [b for _, b in states]})


def encode(docs: DataFrame, model: str | Vocabulary, id_col: str = "doc_id", text: str = "text",
           chunk_chars: int = 16384, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, ``keep``, token_ids (array of int), as the model's own encoder gives them.

    A null or empty text has no tokens. Characters outside the vocabulary become byte tokens (or the
    unknown token in a model without them). Repeated rows are encoded each. An empty table gives an
    empty result.
    """
    vocabulary = model if isinstance(model, Vocabulary) else load_vocabulary(model)
    shared = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))  # the model's pieces
    cols = [id_col, *keep]
    names = [f"k{i}" for i in range(len(cols))]
    src = docs.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(names, cols, strict=True)],
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    giant = F.char_length("t") >= chunk_chars

    def whole(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(shared.value)
        for part in parts:
            for lo in range(0, part.num_rows, ROWS):
                rows = part.slice(lo, ROWS)
                ids = [encoder.encode(t) for t in rows.column("t").to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), tokens], names=[*names, "token_ids"])

    kinds = ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names)
    short = src.filter(~giant).mapInArrow(whole, f"{kinds}, token_ids array<int>")
    chunks = _chunks(src.filter(giant), names, shared, chunk_chars)
    narrow = chunks.select("text", "chunk", "matrix", "n_in").repartition(shuffle_width(docs.sparkSession), "text")
    states = narrow.groupBy("text").applyInPandas(
        _scan, "text2 long, chunk2 int, entry int, exit int")
    placed = chunks.drop("matrix", "n_in").join(states, (F.col("text") == F.col("text2")) & (F.col("chunk") == F.col("chunk2")))

    def traced(s: pd.Series, lo: pd.Series, hi: pd.Series, entry: pd.Series, exit_: pd.Series) -> pd.Series:
        encoder = Encoder.of(shared.value)
        return pd.Series([encoder.trace(*x) for x in zip(s, lo, hi, entry, exit_, strict=True)], dtype=object)

    ids = F.pandas_udf(traced, "array<int>")("s", "lo", "hi", "entry", "exit")
    parts = placed.select(*names, "text", "chunk", ids.alias("ids"))
    long = parts.groupBy("text").agg(  # the chunks of one text
        *[F.min_by(n, "chunk").alias(n) for n in names], F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("all"))
    long = long.select(*names, F.flatten(F.col("all.ids")).alias("token_ids"))
    return short.unionByName(long).select(*[F.col(k).alias(c) for k, c in zip(names, cols, strict=True)], "token_ids")


def decode(token_ids: Column, model: str | Vocabulary, spark) -> Column:
    """The text of a column of token ids (null: null). Bytes that are no UTF-8 become U+FFFD."""
    vocabulary = model if isinstance(model, Vocabulary) else load_vocabulary(model)
    shared = spark.sparkContext.broadcast(vocabulary.surfaces)

    def run(rows: pd.Series) -> pd.Series:
        surfaces = Surfaces(shared.value)
        return rows.map(lambda ids: None if ids is None else surfaces.text(ids))

    return F.pandas_udf(run, "string")(token_ids)


class Surfaces:
    """The pieces' bytes in one row, so a text is gathered from it at once."""

    #: Tokens gathered at once: bounds the memory that a very long text takes.
    AT_ONCE = 1 << 18

    def __init__(self, surfaces: tuple[bytes, ...]) -> None:
        self.all = np.frombuffer(b"".join(surfaces), np.uint8)
        self.sizes = np.fromiter(map(len, surfaces), np.int64, len(surfaces))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def text(self, ids) -> str:
        ids, parts = np.asarray(ids, np.int64), []
        for lo in range(0, len(ids), self.AT_ONCE):
            part = ids[lo : lo + self.AT_ONCE]
            sizes = self.sizes[part]
            shift = self.starts[part] - (np.cumsum(sizes) - sizes)
            parts.append(self.all[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes())
        return b"".join(parts).removeprefix(b" ").decode("utf-8", "replace")
