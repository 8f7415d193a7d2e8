"""Ranked lexical search of a document table by a table of items, with bag deduplication.

Terms are the maximal runs of ASCII letters and digits and of all other characters, A-Z lower-cased.
Only the items' vocabulary matters to a score, so every whole document is reduced to its bag: the
(term, tf) pairs of that vocabulary. Documents whose bag and length norm m agree score alike against
every item and form one class: rows are dealt by a hash of (bag, m) and grouped on the hash *and* the
bag's bytes, so a clash of hashes makes two classes, not a wrong one. Each class is scored once
against the items' postings, in 64-bit integers. An item's best documents lie in its best classes
(by score, then by smallest id): any document of a later class has one better document in each
earlier one. So only those classes are expanded, by ascending id, and ranked again.

Bounds. The items are dealt into blocks of about ``max_terms`` distinct terms, ``max_postings``
(term, item) pairs and ``max_items`` items; a block's vocabulary, postings and weights are collected
and broadcast, and every block is one pass over all documents. A task holds one document's terms (cut
into spans), ``CLASSES_AT_ONCE`` rows of scores, and the best classes of each item so far. The classes
that are expanded are at most ``top`` an item. Copies meet only in grouped minima with map-side
combine and in limited windows, so one class may hold any share of all rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, spans, stash

#: Everything in ASCII but letters and digits separates terms; A-Z become a-z.
TERM_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
CLASSES_AT_ONCE = 64
#: Candidates held before a task keeps only the best of each item.
HELD = 1 << 17
LAST = (1 << 63) - 1


def term_counts(data: bytes | None) -> Counter:
    """How often each term stands in a whole text (UTF-8); spans bound the memory of a very long one."""
    out: Counter = Counter()
    for part in spans((data or b"").translate(TERM_BYTES)):
        out.update(part.split())
    return out


def bag_of(counts: Counter, terms: dict[bytes, int]) -> bytes:
    """The sorted (term, tf) pairs of the vocabulary as 32-bit integers: equal bags have equal bytes."""
    found = sorted((terms[t], n) for t, n in counts.items() if t in terms)
    return np.array(found, "<u4").tobytes()


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def item_terms(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """(item, term) once each; rows of equal id are one item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, data in zip(batch.column(0).to_pylist(), _bytes(batch.column(1)), strict=True):
                found = list(term_counts(data))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array(found, pa.binary())], ["item", "term"])

    src = items.select(F.col(f"`{id_col}`").cast("long").alias("item"), F.col(f"`{text}`").alias("t"))
    return src.mapInArrow(run, "item long, term binary").distinct()


def bags(docs: DataFrame, terms, id_col: str, text: str) -> DataFrame:
    """(doc_id, n, bag) of every row: n counts all terms with repeats, the bag holds those of the broadcast vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bag = [], []
            for data in _bytes(batch.column(1)):
                counts = term_counts(data)
                n.append(counts.total())
                bag.append(bag_of(counts, terms.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(bag, pa.binary())], ["doc_id", "n", "bag"])

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    return src.mapInArrow(run, "doc_id long, n long, bag binary")


def _held_by(classes: DataFrame, width: int) -> dict[int, int]:
    """Documents that hold each term: members summed over the classes. At most one row per term of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            for bag, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[np.frombuffer(bag, "<u4")[::2]] += members
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["term", "df"])

    counted = classes.select("bag", "members").mapInArrow(run, "term long, df long")
    return {r["term"]: r["df"] for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The best classes of each item seen so far by one task."""

    def __init__(self, n_items: int, top: int) -> None:
        self.top, self.least_score = top, np.ones(n_items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, scores: np.ndarray, *keys: np.ndarray) -> None:
        """scores: classes x items; keys: smallest id, hash and variant of each class."""
        c, i = np.nonzero(scores >= self.least_score)
        self.parts.append((i, scores[c, i], *(k[c] for k in keys)))
        self.held += len(i)
        if self.held > HELD:
            self.keep()

    def keep(self) -> tuple[np.ndarray, ...]:
        columns = tuple(np.concatenate(x) for x in zip(*self.parts, strict=True))
        item, score, least, *rest = columns
        order = np.lexsort((*rest, least, -score, item))
        starts = np.flatnonzero(np.diff(item[order], prepend=-1))
        place = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
        worst = order[place == self.top - 1]
        self.least_score[item[worst]] = score[worst]
        kept = tuple(x[order[place < self.top]] for x in columns)
        self.parts, self.held = [kept], len(kept[0])
        return kept


def class_scores(found: list[np.ndarray], m: list[int], w: np.ndarray, starts: np.ndarray, postings: np.ndarray, n_items: int) -> np.ndarray:
    """Scores (classes x items) of bags (rows of term, tf) with norms ``m``, exact in 64 bits."""
    sizes = [len(b) for b in found]
    rows = np.concatenate(found).astype(np.int64)
    term, tf = rows[:, 0], rows[:, 1]
    norm = np.repeat(np.array(m, np.int64), sizes)
    adds = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm))
    length = starts[term + 1] - starts[term]
    at = np.repeat(starts[term] - np.cumsum(length) + length, length) + np.arange(length.sum())
    cell = np.repeat(np.repeat(np.arange(len(found)), sizes) * n_items, length) + postings[at]
    out = np.zeros(len(found) * n_items, np.int64)
    np.add.at(out, cell, np.repeat(adds, length))
    return out.reshape(len(found), n_items)


def _best_classes(classes: DataFrame, shared, top: int) -> DataFrame:
    """(item, score, least, h, variant): at least the ``top`` best classes of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, w, starts, postings = shared.value
        best = Best(len(ids), top)
        for batch in batches:
            bag = [np.frombuffer(b, "<u4").reshape(-1, 2) for b in batch.column("bag").to_pylist()]
            m = batch.column("m").to_pylist()
            least = np.array([LAST if x is None else x for x in batch.column("least").to_pylist()], np.int64)
            h, variant = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("h", "variant"))
            for i in range(0, len(bag), CLASSES_AT_ONCE):
                at = slice(i, i + CLASSES_AT_ONCE)
                best.add(class_scores(bag[at], m[at], w, starts, postings, len(ids)), least[at], h[at], variant[at])
        if best.parts:
            item, score, least, h, variant = best.keep()
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in item.tolist()], pa.int64()), pa.array(score), pa.array(least), pa.array(h), pa.array(variant)],
                ["item", "score", "least", "h", "variant"])

    return classes.select("h", "variant", "bag", "m", "least").mapInArrow(run, "item long, score long, least long, h long, variant long")


def _ranked(rows: DataFrame, order: list[Column], top: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, wanted: DataFrame, top: int, id_col: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    pairs = wanted.toArrow()  # bounded by max_terms, max_postings and max_items
    vocabulary = sorted(set(pairs["term"].to_pylist()))
    number = {t: i for i, t in enumerate(vocabulary)}
    ids = sorted(set(pairs["item"].to_pylist()), key=lambda x: (x is None, x or 0))
    position = {x: i for i, x in enumerate(ids)}
    term = np.array([number[t] for t in pairs["term"].to_pylist()], np.int64)
    item = np.array([position[x] for x in pairs["item"].to_pylist()], np.int64)
    order = np.lexsort((item, term))
    starts = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(number)))))

    known = spark.sparkContext.broadcast(number)
    rows = stash(bags(docs, known, id_col, text), "search-bags")
    n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs:
        return spark.createDataFrame([], "item long, rank int, doc_id long, score long")
    m = F.lit(50) + F.expr(f"(50 * n * {n_docs}L) div {n_terms}L")
    rows = rows.filter(F.octet_length("bag") > 0).withColumn("m", m).withColumn("h", F.xxhash64("bag", "m"))
    classes = rows.groupBy("h", "bag", "m").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("members"))
    clash = Window.partitionBy("h").orderBy("bag", "m")  # nearly always one row
    classes = stash(classes.withColumn("variant", F.row_number().over(clash).cast("long")), "search-classes")

    df = _held_by(classes, len(vocabulary))
    w = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    shared = spark.sparkContext.broadcast((ids, w, starts, item[order]))
    best = _best_classes(classes, shared, top)
    chosen = cut(_ranked(best, [F.col("score").desc(), "least", "h", "variant"], top).select("item", "score", "h", "variant"))
    members = rows.join(F.broadcast(chosen.select("h").distinct()), "h", "left_semi").select("h", "bag", "m", "doc_id")  # at most top an item
    place = F.row_number().over(Window.partitionBy("h", "bag", "m").orderBy(F.col("doc_id").asc_nulls_last()))
    members = members.withColumn("place", place).filter(F.col("place") <= top)
    expanded = chosen.join(classes.select("h", "variant", "bag", "m"), ["h", "variant"]).join(members, ["h", "bag", "m"])
    out = _ranked(expanded, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], top)
    return out.select("item", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, top: int = 50, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    max_terms: int = 1 << 19, max_postings: int = 1 << 21, max_items: int = 4096,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents of the highest score above 0, ties by ascending id.

    A null or empty text has no term: such a document is in no result and not counted, such an item has
    no result. Item rows of equal id are one item with the terms of all of them; document rows of equal
    id are documents of their own. A null document id ranks last among equal scores; a null item id is
    an item like any other. Empty tables give an empty result; other columns are ignored.
    """
    wanted = cut(item_terms(items, item_id, text))
    terms, postings, n_items = wanted.agg(
        F.count_distinct("term"), F.count(F.lit(1)), F.count_distinct(F.struct("item"))).first()
    blocks = max(1, -(-terms // max_terms), -(-postings // max_postings), -(-n_items // max_items))
    dealt = wanted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        part = _search_block(docs, dealt.filter(F.col("block") == b).select("item", "term"), top, doc_id, text)
        out = part if out is None else out.unionAll(part)
    return out.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
