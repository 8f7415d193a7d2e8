"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples. A sample of labelled rows is drawn by hash of the id, at most ``max_per_class`` of each
class (the documented bound: everything that is collected or broadcast is limited by it). A term is
a word (a run of letters, lower-cased) or a beginning of 4 to 7 letters of a longer word. Every
example stands in the index with every term it has: nothing is selected by class, count or rank.
Weights are (1 + ln tf) * ln(1 + N / df), normalised to length 1; N and the document frequencies of
the examples' terms are those of all documents.

Index. Examples are grouped into blocks of ``block`` in order of their heaviest term; a term's
posting list is cut by block, and each (term, block) keeps its largest weight. A query takes the sum
of its weights times these maxima as a bound for every block and scores blocks in order of the bound
until none can reach the k-th best cosine found. Terms of more than a ``COMMON`` part of the examples
also stand in a dense table, so that many queries meet them in one matrix product; what comes within
its rounding of the k-th best is scored again in double precision. The neighbours are exactly those
of a full comparison (ties by example id). What is broadcast are the examples' term counts alone,
once for fitting and scoring; a worker builds the lists, maxima and dense table from them.

Score. The k neighbours vote with their cosines as weights, those of either class weighed to the class sizes
of the sample. A logistic curve of the vote and the largest cosine, fitted on the examples themselves
(each judged by the others, never by its own text or copies of it, and weighed to the class sizes of the
whole training fold), turns them into a probability. A text near nothing (an empty one too) has no
votes; it gets the curve's value for that.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold_of, one_thread_a_task, shuffle_width

TERM = re.compile(r"[^\W\d_]+")


#: Lengths of the word beginnings that are terms of their own.
BEGINNINGS = (4, 5, 6, 7)

#: Terms in more than this part of the examples stand in the dense table too, the most frequent MOST_COMMON of them.
COMMON, MOST_COMMON = 1 / 16, 1024

#: Neighbours that vote: picked, with the weight of a vote, by leave-one-out on the training fold.
NEIGHBOURS = 50

#: Queries that meet the dense table at once.
AT_ONCE = 128

#: Bytes of texts whose parts are looked up at once.
LOOKED_UP = 1 << 21

#: Parts of texts whose terms a worker remembers (about 150 bytes each), and up to which length.
REMEMBERED, SHORT = 1 << 18, 64


@dataclass(frozen=True)
class Index:
    """words: the terms by number; idf by term; examples in block order; postings cut by block."""

    words: str
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    texts: np.ndarray  # a 60-bit hash of each example's text
    starts: np.ndarray  # of each (term, block) in the postings
    posting: np.ndarray  # example and weight side by side: 64 bits, read at once
    most: np.ndarray  # largest weight of each (term, block)
    block: int
    column: np.ndarray  # of a common term in the dense table, else -1
    common: np.ndarray  # weights of the common terms by example

    @cached_property
    def terms(self) -> dict[str, int]:
        return _numbered(self.words)

    @cached_property
    def vocabulary(self) -> pa.Array:
        return vocabulary(self.words)

    @property
    def example(self) -> np.ndarray:
        return self.posting.view(np.int32)[::2]

    @property
    def weight(self) -> np.ndarray:
        return self.posting.view(np.float32)[1::2]


@dataclass
class Examples:
    """What is broadcast: the vocabulary (one string), idf, and of each example its id, label, text hash and term counts."""

    words: str
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    texts: np.ndarray
    sizes: np.ndarray  # terms of each example
    term: np.ndarray
    tf: np.ndarray
    block: int
    built: Index | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return vars(self) | {"built": None}

    def index(self) -> Index:
        """Built once in each process."""
        if self.built is None:
            self.built = build_index(self)
        return self.built


@dataclass(frozen=True)
class Model:
    """The broadcast examples and the logistic curve. ``index`` is the index over the examples."""

    shared: Broadcast
    curve: tuple[float, ...]

    @property
    def index(self) -> Index:
        return self.shared.value.index()


def _numbered(words: str) -> dict[str, int]:
    return {t: i for i, t in enumerate(words.split("\n"))} if words else {}


def vocabulary(words: str) -> pa.Array:
    return pc.split_pattern(pa.array([words] if words else [], pa.string()), "\n").flatten()


def word_terms(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


class Counts(dict):
    """Terms of texts by their parts between white space, full stops and commas (no word holds any). Numbers the parts
    it meets; part i has the terms flat[ends[i] : ends[i + 1]].

    Short parts are remembered; all is forgotten between two texts when too many. The vocabulary holds every beginning
    of its words."""

    def __init__(self, terms: dict[str, int]) -> None:
        super().__init__()
        self.terms, self.flat, self.ends = terms, array("i"), array("q", [0])

    def __missing__(self, part: str) -> int:
        for word in TERM.findall(part):
            for n in BEGINNINGS:
                if len(word) <= n:
                    n = 0
                    break
                term = self.terms.get(word[:n] + "*")
                if term is None:  # then no longer beginning is known, nor the word
                    break
                self.flat.append(term)
            else:
                n = 0
            if not n and (term := self.terms.get(word)) is not None:
                self.flat.append(term)
        self.ends.append(len(self.flat))
        out = len(self.ends) - 2
        if len(part) <= SHORT:
            self[part] = out
        return out

    def terms_of(self, parts: list[str] | set[str]) -> np.ndarray:
        """The known terms of all parts, ascending, repeats included."""
        if len(self.ends) > REMEMBERED:
            self.clear()
            self.flat, self.ends = array("i"), array("q", [0])
        number = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
        if not self.flat:
            return np.zeros(0, np.int32)
        ends = np.frombuffer(self.ends, np.int64)
        start = ends[number]
        return np.sort(np.frombuffer(self.flat, np.int32)[_ranges(start, ends[number + 1] - start)])

    def known(self, text: str | None) -> np.ndarray:
        """The distinct known terms of a text, ascending."""
        found = self.terms_of(set(_parts(text)))
        return found[np.flatnonzero(np.diff(found, prepend=-1))]

    def of(self, text: str | None) -> tuple[tuple[np.ndarray, np.ndarray], int]:
        """The distinct known terms of a text, ascending, with how often it holds each, and its number of parts."""
        parts = _parts(text)
        found = self.terms_of(parts)
        at = np.flatnonzero(np.diff(found, prepend=-1))
        return (found[at], np.diff(at, append=len(found))), len(parts)


def _parts(text: str | None) -> list[str]:
    """A text's parts between white space, full stops and commas."""
    return text.lower().replace(".", " ").replace(",", " ").split() if text else []


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places start[i] to start[i] + length[i] - 1 of every i, one after another."""
    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


def _groups(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts in their order, about LOOKED_UP bytes at once."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    edges = np.flatnonzero(np.diff((np.cumsum(size) - size) // LOOKED_UP, prepend=-1, append=np.iinfo(np.int64).max))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield texts.slice(lo, hi - lo).to_pylist()


def _looked_up(texts: list[str | None], vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """The known terms of all distinct parts of the texts; where those of each part begin and how many they are; the edges
    of the texts' parts. The words of all texts together are told apart and looked up once."""
    plain = pa.array([t.lower().replace(".", " ").replace(",", " ") if t else "" for t in texts], pa.large_string())
    parts = pc.ascii_split_whitespace(plain)
    coded = parts.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.string()) if coded.dictionary.nbytes < 1 << 30 else coded.dictionary
    one = pc.and_(pc.string_is_ascii(distinct), pc.ascii_is_alpha(distinct))
    other = pc.invert(one)
    several = [TERM.findall(part) for part in distinct.filter(other).to_pylist()]
    words = pa.concat_arrays([distinct.filter(one), pa.array([w for found in several for w in found], distinct.type)])
    part = np.concatenate((np.flatnonzero(one), np.repeat(np.flatnonzero(other), np.array([len(x) for x in several], np.int64))))
    asked, asker, length = [words], [part], pc.utf8_length(words).to_numpy()
    for n in BEGINNINGS:
        longer = length > n
        asked.append(pc.binary_join_element_wise(pc.utf8_slice_codeunits(words.filter(pa.array(longer)), 0, n), "*", ""))
        asker.append(part[longer])
    asked, asker = pa.concat_arrays(asked).dictionary_encode(), np.concatenate(asker)
    place = pc.fill_null(pc.index_in(vocabulary.cast(words.type), asked.dictionary), -1).to_numpy()  # a small table is asked often
    number = np.full(len(asked.dictionary), -1, np.int32)
    number[place[place >= 0]] = np.flatnonzero(place >= 0)
    term = number[asked.indices.to_numpy()]
    known = np.flatnonzero(term >= 0)
    order = known[np.argsort(asker[known], kind="stable")]
    term = term[order]
    held = np.bincount(asker[order], minlength=len(distinct))
    at, edges = coded.indices.to_numpy(), parts.offsets.to_numpy().tolist()
    return term, (np.cumsum(held) - held)[at], held[at], edges


def counts_of_each(texts: list[str | None], vocabulary: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text the distinct known terms, ascending, with how often it holds each."""
    term, start, held, edges = _looked_up(texts, vocabulary)
    pa.default_memory_pool().release_unused()  # a worker lives on: what the look-up took would stay with it
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        found = np.sort(term[_ranges(start[lo:hi], held[lo:hi])])
        first = np.flatnonzero(np.diff(found, prepend=-1))
        yield found[first], np.diff(first, append=len(found))


def _at_once(counts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    while found := list(islice(counts, AT_ONCE)):
        yield found


def _vector(counts: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t, n = counts
    if not len(t):
        return np.zeros(0, np.int64), np.zeros(0)
    t = t.astype(np.int64)
    w = (1 + np.log(n)) * idf[t]
    return t, w / np.sqrt((w * w).sum())


def build_index(examples: Examples) -> Index:
    """The vectors of the examples (an empty text has no term and is near nothing), by block and by term."""
    n, block, idf = len(examples.ids), examples.block, examples.idf
    blocks, n_terms = max(1, -(-n // block)), len(idf)
    ends = np.cumsum(examples.sizes)
    spans = [slice(lo, hi) for lo, hi in zip((ends - examples.sizes).tolist(), ends.tolist(), strict=True)]
    heaviest, w, held = np.full(n, -1, np.int64), np.empty(len(examples.term), np.float32), np.zeros(n_terms, np.int64)
    for i, own in enumerate(spans):
        if own.start < own.stop:
            t, weight = _vector((examples.term[own], examples.tf[own].astype(np.float64)), idf)
            heaviest[i], w[own] = t[np.argmax(weight)], weight
            held[t] += 1
    placed = np.lexsort((examples.texts, examples.labels, examples.ids, heaviest))
    frequent = np.flatnonzero(held > n * COMMON)
    frequent = np.sort(frequent[np.argsort(-held[frequent], kind="stable")][:MOST_COMMON])
    column = np.full(n_terms, -1, np.int32)
    column[frequent] = np.arange(len(frequent))
    common = np.zeros((n, len(frequent)), np.float32)

    def by_place() -> Iterator[tuple[int, slice, np.ndarray]]:
        for place, i in enumerate(placed.tolist()):  # the terms of an example differ, so do their cells
            yield place, spans[i], examples.term[spans[i]] * np.int64(blocks) + place // block

    starts = np.zeros(n_terms * blocks + 1, np.int64)
    for _, _, cell in by_place():
        starts[cell + 1] += 1
    np.cumsum(starts, out=starts)
    free, most = starts[:-1].copy(), np.zeros(n_terms * blocks, np.float32)
    posting = np.empty(len(w), np.int64)
    example, weight = posting.view(np.int32)[::2], posting.view(np.float32)[1::2]
    for place, own, cell in by_place():
        at = free[cell]
        free[cell] = at + 1
        example[at], weight[at] = place, w[own]
        most[cell] = np.maximum(most[cell], w[own])
        at = column[examples.term[own]]
        common[place, at[at >= 0]] = w[own][at >= 0]
    return Index(examples.words, idf, examples.ids[placed], examples.labels[placed].astype(np.int64), examples.texts[placed],
                 starts, posting, most.reshape(n_terms, blocks), block, column, common)


def _listed(index: Index, t: np.ndarray, q: np.ndarray, b: int, n: int) -> np.ndarray:
    """What the posting lists of the terms ``t`` add to the cosines of the ``n`` examples of block ``b``."""
    cell = t * index.most.shape[1] + b
    start = index.starts[cell]
    length = index.starts[cell + 1] - start
    found = index.posting.take(_ranges(start, length), mode="clip")  # all places exist
    weight = found.view(np.float32)[1::2] * np.repeat(q, length)
    example = found.view(np.int32)[::2]
    return np.bincount(example - b * index.block if b else example, weight, n)


def nearest_of_each(index: Index, texts: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[int] | None = None) -> list[list[tuple[float, int]]]:
    """Of each text the k examples of the largest positive cosine: (cosine, position), ties by example id; none with
    the text hash ``but``."""
    out = []
    for first in range(0, len(texts), AT_ONCE):
        vectors = [_vector(c, index.idf) for c in texts[first : first + AT_ONCE]]
        dense = np.zeros((len(vectors), index.common.shape[1]))
        for i, (t, q) in enumerate(vectors):
            at = index.column[t]
            dense[i, at[at >= 0]] = q[at >= 0]
        near = dense.astype(np.float32) @ index.common.T
        for i, (t, q) in enumerate(vectors):
            out.append(_nearest(index, t, q, dense[i], near[i], k, None if but is None else but[first + i]))
    return out


def _nearest(index: Index, t: np.ndarray, q: np.ndarray, dense: np.ndarray, near: np.ndarray, k: int,
             but: int | None) -> list[tuple[float, int]]:
    if not len(t) or not len(index.ids):
        return []
    bound = q @ index.most[t]
    rare = index.column[t] < 0
    t, q = t[rare], q[rare]
    slack = 1e-4  # far above the rounding of the dense table's product
    found, listed, least = np.zeros(0, np.int64), np.zeros(0), 0.0
    for b in np.argsort(-bound, kind="stable").tolist():
        if bound[b] <= 0 or bound[b] < least - slack:
            break
        at = slice(b * index.block, min((b + 1) * index.block, len(index.ids)))
        part = _listed(index, t, q, b, at.stop - at.start)
        about = part + near[at]
        if but is not None:
            about[index.texts[at] == but] = -1.0
        here = np.flatnonzero(about > (least - slack if least > slack else -0.5))
        if len(here) > k:
            least = max(least, float(np.partition(about[here], -k)[-k]))
            here = here[about[here] >= least - slack]
        found, listed = np.concatenate((found, here + at.start)), np.concatenate((listed, part[here]))
    cosine = np.round(listed + index.common[found].astype(np.float64) @ dense, 9)
    found, cosine = found[cosine > 0], cosine[cosine > 0]
    order = np.lexsort((index.ids[found], -cosine))[:k]
    return [(float(cosine[p]), int(found[p])) for p in order]


def nearest(index: Index, counts: tuple[np.ndarray, np.ndarray], k: int, but: int | None = None) -> list[tuple[float, int]]:
    return nearest_of_each(index, [counts], k, None if but is None else [but])[0]


def features(index: Index, near: list[tuple[float, int]], odds: float) -> tuple[float, ...]:
    """1, the log odds of the distance-weighted votes (0 without neighbours), the largest cosine, and their product.

    ``odds``: clean over toxic examples of the sample, so that a vote counts against what chance would give."""
    toxic = sum(c for c, p in near if index.labels[p])
    clean = sum(c for c, p in near) - toxic
    if not near:
        return 1.0, 0.0, 0.0, 0.0
    little = 0.02 * near[0][0]
    vote = float(np.log((toxic * odds + little) / (clean + little)))
    return 1.0, vote, near[0][0], vote * near[0][0]


def calibrated(curve: tuple[float, ...], x: tuple[float, ...]) -> float:
    z = sum(a * b for a, b in zip(curve, x, strict=True))
    return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def class_odds(labels: np.ndarray) -> float:
    toxic = float((labels == 1).sum())
    return (len(labels) - toxic) / toxic if 0 < toxic < len(labels) else 1.0


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Weighted logistic regression by Newton steps, with a ridge on all but the constant."""
    b, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + np.diag(penalty), x.T @ (weight * (y - p)) - penalty * b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(b.tolist())


def _terms_of(texts: DataFrame) -> DataFrame:
    """The distinct terms of the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = {w for body in batch.column(0).to_pylist() for w in TERM.findall(body.lower())}
            yield pa.RecordBatch.from_arrays([pa.array(sorted({t for w in words for t in word_terms(w)}), pa.string())], ["term"])

    return texts.select("body").mapInArrow(run, "term string").distinct()


def _document_frequencies(docs: DataFrame, text: str, words: Broadcast, width: int) -> tuple[int, np.ndarray]:
    """How many documents there are, and of each term how many hold it: one pass, partial sums by task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df, n = vocabulary(words.value), np.zeros(width, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for texts in _groups(batch.column(0)):
                for term, _ in counts_of_each(texts, known):
                    df[term] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["term", "df"])

    counted = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, "term long, df long")
    found = counted.groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # at most one row a term of the sample
    term, df = found["term"].to_numpy(), found["df"].to_numpy()
    out = np.ones(width)
    out[term[term >= 0]] = df[term >= 0]
    return int(df[term < 0].sum()), out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        max_per_class: int = 2048, block: int = 4096, k: int = NEIGHBOURS) -> Model:
    """Model over a bounded sample of the labelled rows. ``labels`` holds the training fold only.

    Rows with a null id or label teach nothing; an id labelled twice counts as 1 if any label is 1; null,
    empty and wordless texts may be labelled (they are near nothing), and either class may be missing.
    At most ``2 * max_per_class`` ids are broadcast and as many term-count vectors collected.
    """
    spark = docs.sparkSession
    one_thread_a_task(spark)
    told = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("y")).dropna().groupBy("id").agg(
        F.max("y").cast("int").alias("y"))
    per_class = {r["y"]: r["count"] for r in told.groupBy("y").count().collect()}  # two rows
    sample = None
    for y in (0, 1):
        part = told.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_per_class)
        sample = part if sample is None else sample.unionAll(part)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    rows = cut(rows.join(F.broadcast(sample), F.col("doc") == F.col("id")).select("id", "y", "body", F.md5("body").alias("h")))
    text_hash = F.conv(F.substring("h", 1, 15), 16, 10).cast("long")
    spread = rows.select("id", "y", "body", text_hash.alias("h")).repartition(shuffle_width(spark), "id")

    terms = sorted(_terms_of(rows).toArrow()["term"].to_pylist())  # the terms of the sample's texts
    words = spark.sparkContext.broadcast("\n".join(terms))
    n_docs, df = _document_frequencies(docs, text, words, len(terms))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(words.value)
        for batch in batches:
            packed = [np.stack(c).astype("<u4").tobytes() for texts in _groups(batch.column(3)) for c in counts_of_each(texts, known)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], ["id", "y", "h", "v"])

    vectors = spread.select("id", "y", "h", "body").mapInArrow(counted, "id long, y int, h long, v binary").toArrow().sort_by("id")
    pairs = [np.frombuffer(v.as_buffer(), "<u4").reshape(2, -1) for v in vectors["v"]]
    every = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.uint32)
    tf = every[1] if every[1].max(initial=0) > 0xFFFF else every[1].astype(np.uint16)
    y = vectors["y"].to_numpy()
    shared = spark.sparkContext.broadcast(Examples(
        "\n".join(terms), np.log(1 + n_docs / df), vectors["id"].to_numpy(), y.astype(np.int8), vectors["h"].to_numpy(),
        np.array([p.shape[1] for p in pairs], np.int64), every[0].astype(np.int32), tf, block))
    del vectors, pairs, every
    words.destroy()
    if not len(y):
        return Model(shared, (0.0,) * 4)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value.index()
        odds = class_odds(ix.labels)
        for batch in batches:
            found = [c for texts in _groups(batch.column(2)) for c in counts_of_each(texts, ix.vocabulary)]
            x = [features(ix, near, odds) for near in nearest_of_each(ix, found, k, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in x], pa.float64()) for i in (1, 2, 3)]],
                                             ["y", "a", "b", "c"])

    told_by = spread.select("y", "h", "body").mapInArrow(judged, "y int, a double, b double, c double").toArrow()
    y = told_by["y"].to_numpy().astype(float)  # four numbers for each row of the sample
    x = np.column_stack([np.ones(len(y)), *[told_by[c].to_numpy() for c in ("a", "b", "c")]])
    share = {v: per_class.get(v, 0) / max(1, int((y == v).sum())) for v in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    return Model(shared, fit_curve(x, y, weight * len(y) / weight.sum()))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", k: int = NEIGHBOURS,
          evidence: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, ``keep``, score (0 to 1), evidence (ids and cosines of the nearest examples).

    Only the text decides. Null and empty texts and texts without any term are near nothing and have
    no evidence; without any labelled row every score is 1/2. Repeated rows score alike. An empty table gives an empty result.
    """
    cols = [id_col, *keep]
    src = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(cols)], F.col(f"`{text}`").alias("t"))
    shared, curve = model.shared, model.curve

    def votes(texts: pa.Array) -> pa.Array:
        ix, scores, near = shared.value.index(), [], []
        odds = class_odds(ix.labels)
        for group in _groups(texts):
            for found in _at_once(counts_of_each(group, ix.vocabulary)):
                for best in nearest_of_each(ix, found, k):
                    scores.append(calibrated(curve, features(ix, best, odds)))
                    near.append(best[:evidence])
        ends, place = np.cumsum([0, *map(len, near)]), np.array([p for best in near for _, p in best], np.int64)
        one = pa.StructArray.from_arrays([pa.array(ix.ids[place]), pa.array([c for best in near for c, _ in best], pa.float64()),
                                          pa.array(ix.labels[place].astype(np.int32))], ["id", "cosine", "label"])
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), one)],
                                          ["score", "evidence"])

    run = F.arrow_udf(votes, "score double, evidence array<struct<id long, cosine double, label int>>")
    scored = src.withColumn("r", run("t"))
    return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(cols)], "r.score", "r.evidence")


def training_fold(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return labels.filter(fold_of(F.col(f"`{id_col}`")) != 0)
