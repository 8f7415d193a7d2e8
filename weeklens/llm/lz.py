"""Document fingerprints by Lempel-Ziv phrases.

A text's UTF-8 bytes are parsed LZ78-wise: the shortest prefix that is not yet in the dictionary
becomes a phrase, and the dictionary is what the text itself has shown so far. The set of phrases is
hashed (64 bits, by content) and kept as a one-permutation minimum-hash signature: the hash picks one
of 128 bins, each bin keeps its smallest hash, of which the fingerprint stores one byte (255: empty
bin). The likeness of two fingerprints estimates the Jaccard similarity of their phrase sets, which
is high where one text would help to compress the other.

``edit_likeness`` walks the documents in descending id and compares each with its successor and with
itself after its second half is replaced by the successor's beginning. Documents are range-partitioned
and sorted, so a task streams over neighbours and holds two texts at a time; only the last row of a
partition needs the first of the next one, and these edges (one per partition) are joined afterwards.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import shuffle_width, stash

BINS = 128
EMPTY = 255
#: Base of the phrase hash and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes hashed at once: bounds the memory that a very long text takes.
SPAN = 1 << 20
NOTHING = np.uint64(0xFFFFFFFFFFFFFFFF)


def parse(data: bytes, trie: dict[int, int], node: int) -> tuple[int, list[int]]:
    """Continue an LZ78 parse over ``data``: the open node and the phrases' ends (offsets in data)."""
    get, new, ends, i = trie.get, len(trie) + 1, [], 0
    for b in data:
        i += 1
        k = node << 8 | b
        node = get(k)
        if node is None:
            trie[k] = new
            new += 1
            ends.append(i)
            node = 0
    return node, ends


def _powers(of: int, n: int) -> np.ndarray:
    out = np.full(n, of, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {}


def _hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit content hashes of data[start:end], all within one span."""
    if not _POWERS or len(_POWERS["up"]) <= len(data):
        n = max(SPAN // 16, 2 * len(data)) + 1
        _POWERS.update(up=_powers(BASE, n), down=_powers(INVERSE, n))
    terms = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * _POWERS["up"][: len(data)]
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    h = (prefix[ends] - prefix[starts]) * _POWERS["down"][starts]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def minima(data: bytes, first: int, ends: list[int]) -> np.ndarray:
    """Smallest hash per bin of the phrases that end at ``ends``; the first starts at ``first``."""
    out = np.full(BINS, NOTHING)
    if not ends:
        return out
    stop = np.array(ends, np.int64)
    start = np.concatenate(([first], stop[:-1]))
    lo = 0
    while lo < len(stop):
        base = int(start[lo])
        hi = max(lo + 1, int(np.searchsorted(stop, base + SPAN)))
        h = _hashes(data[base : int(stop[hi - 1])], start[lo:hi] - base, stop[lo:hi] - base)
        np.minimum.at(out, (h >> np.uint64(57)).astype(np.int64), h << np.uint64(7) >> np.uint64(7))
        lo = hi
    return out


def signature(least: np.ndarray) -> bytes:
    return np.where(least == NOTHING, EMPTY, least % np.uint64(EMPTY)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity, corrected for bytes that agree by chance; two empty ones are alike."""
    if a == b:
        return 1.0
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    used = (x != EMPTY) | (y != EMPTY)
    agree = float(((x == y) & used).sum() / used.sum())
    return max(0.0, (agree - 1 / EMPTY) / (1 - 1 / EMPTY))


class Parsed:
    """A text, parsed: its signature, and what an edit of its second half continues from."""

    def __init__(self, text: str) -> None:
        self.text, self.half = text, len(text) // 2
        self.head = text[: len(text) - self.half].encode("utf-8", "surrogatepass")
        tail = text[len(text) - self.half :].encode("utf-8", "surrogatepass")
        trie: dict[int, int] = {}
        self.node, ends = parse(self.head, trie, 0)
        self.open = ends[-1] if ends else 0  # where the phrase that crosses the middle starts
        self.least = minima(self.head, 0, ends)
        self.trie = trie.copy()
        self.signature = self._with(tail, trie)

    def _with(self, tail: bytes, trie: dict[int, int]) -> bytes:
        _, ends = parse(tail, trie, self.node)
        carried = self.head[self.open :]
        more = minima(carried + tail, 0, [len(carried) + e for e in ends])
        return signature(np.minimum(self.least, more))

    def edited(self, following: str) -> tuple[str, bytes]:
        """sha256 of the edited text and its signature; the dictionary is used up."""
        tail = following[: self.half].encode("utf-8", "surrogatepass")
        return hashlib.sha256(self.head + tail).hexdigest(), self._with(tail, self.trie)


def fingerprint(text: str | None) -> str:
    return Parsed(text or "").signature.hex()


def _compare(one: Parsed, following: str, following_signature: bytes) -> tuple:
    sha, edited = one.edited(following)
    return (len(one.text), bytes.fromhex(sha), one.signature, edited,
            likeness(one.signature, edited), likeness(one.signature, following_signature))


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, ``keep``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (likeness to the edited text and to the next document).

    The next document is the one with the next smaller id, after the smallest the largest; equal ids
    follow each other in order of a hash of their text, null ids come last. A null text counts as
    empty; the only document of a table is its own next. An empty table gives an empty result.
    """
    cols = [id_col, *keep]
    names = [f"k{i}" for i in range(len(cols))]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    src = docs.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(names, cols, strict=True)],
                      F.xxhash64(body).alias("h"), body.alias("t"))
    order = [F.col("k0").desc_nulls_last(), F.col("h"), F.col("t")]
    kinds = ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names)
    result = "n_chars long, sha binary, fp binary, edited binary, near_edited double, near_next double"
    id_type = src.schema["k0"].dataType.simpleString()
    spec = f"{kinds}, {result}, part long, head_id {id_type}, head_h long, head_t string, t string"
    schema = pa.schema([
        *[(n, to_arrow_type(src.schema[n].dataType)) for n in names], ("n_chars", pa.int64()), ("sha", pa.binary()),
        ("fp", pa.binary()), ("edited", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("part", pa.int64()), ("head_id", to_arrow_type(src.schema["k0"].dataType)), ("head_h", pa.int64()),
        ("head_t", pa.string()), ("t", pa.string())])
    found = ("n_chars", "sha", "fp", "edited", "near_edited", "near_next")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = held = kept = None
        for part in parts:
            rows = []
            for row in part.to_pylist():
                now = Parsed(row["t"])
                if held is None:
                    head = row
                else:
                    rows.append(kept | dict(zip(found, _compare(held, now.text, now.signature), strict=True)))
                held, kept = now, {k: row[k] for k in names}
            yield pa.RecordBatch.from_pylist(rows, schema)
        if held is not None:  # the last row waits for the first of the next partition
            edge = kept | {"part": secrets.randbits(62), "head_id": head["k0"], "head_h": head["h"], "head_t": head["t"]}
            yield pa.RecordBatch.from_pylist([edge | {"t": held.text}], schema)

    dealt = src.repartitionByRange(shuffle_width(docs.sparkSession), order[0], F.col("h")).sortWithinPartitions(*order)
    done = stash(dealt.mapInArrow(run, spec), "lz")
    inner = done.filter("part is null").select(*names, "n_chars", "sha", "fp", "edited", "near_edited", "near_next")
    edges = done.filter("part is not null")
    # one narrow row per partition: the order of the partitions, then their texts by a join
    turn = Window.orderBy(F.col("head_id").desc_nulls_last(), "head_h", F.md5("head_t"))
    narrow = edges.select("part", F.lead("part").over(turn).alias("after"), F.first("part").over(turn).alias("top"))
    narrow = narrow.select(F.col("part").alias("p2"), F.coalesce("after", "top").alias("follow"))
    heads = edges.select(F.col("part").alias("p3"), F.col("head_t").alias("next_t"))
    pairs = edges.select("part", *names, "t").join(narrow, F.col("part") == F.col("p2")).join(heads, F.col("follow") == F.col("p3"))

    def close(own: pd.Series, following: pd.Series) -> pd.DataFrame:
        rows = [_compare(Parsed(a), b, Parsed(b).signature) for a, b in zip(own, following, strict=True)]
        return pd.DataFrame(rows, columns=["n_chars", "sha", "fp", "edited", "near_edited", "near_next"])

    closing = F.pandas_udf(close, result)
    outer = pairs.withColumn("r", closing("t", "next_t")).select(*names, "r.*")
    both = inner.unionByName(outer)
    return both.select(
        *[F.col(k).alias(c) for k, c in zip(names, cols, strict=True)], "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"), F.lower(F.hex("fp")).alias("fingerprint"),
        F.lower(F.hex("edited")).alias("edited_fingerprint"), "near_edited", "near_next")
