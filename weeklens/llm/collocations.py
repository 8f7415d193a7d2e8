"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at
spaces and tabs. A stripe is one prefix of a language (no word, one word, two words) with the counts
of its next words. Stripes are built in tasks, a few million words at a time, and merged elementwise:
counts add up, whatever the order. The merged structure answers everything: an element is the
frequency of prefix + word, the elements of the empty prefix are the totals of the one-word prefixes,
those of one-word prefixes the totals of the two-word ones, and the largest element of a two-word
prefix (or of its words as an ending) decides whether a longer phrase subsumes it.

Levels. A phrase cannot be more frequent than its parts, so a level counts only what extends phrases
that reached ``min_count`` on the level before. Tasks know these through a bit table of fixed size
(``FILTER_BITS``): a clash of hashes only lets a rare phrase be counted, it never loses one.

Skew. Counts of one level tell the hot prefixes of the next: those that hold more than 1 / (2 P) of
all words, so at most 2 P a level for P shuffle partitions. Their stripes are sliced by a hash of the
next word, in as many slices as they exceed that share. A slice is a group of its own; element by
element the merge stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, shuffle_width, spans, stash

BREAK = b"\xff"  # no byte of UTF-8
#: A-Z become a-z, the piece breaks become line ends, tabs become spaces.
PIECE_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x0A if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 0x09 else c for c in range(256)
)
#: Bits of the table of frequent phrases (16 MB): the bound of what is broadcast between levels.
FILTER_BITS = 1 << 27
#: Words of one language that a task counts at once (one document more at most).
WORDS_AT_ONCE = 1 << 21


class Numbers(dict):
    """Words -> 1, 2, ... in order of appearance; the break is 0."""

    def __init__(self) -> None:
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        out = self[word] = len(self)
        return out


def word_numbers(data: bytes, numbers: Numbers) -> list[int]:
    """A whole text as word numbers, with a break (0) between pieces and at the end."""
    out: list[int] = []
    spaced = data.translate(PIECE_BYTES).replace(b"\n", b" " + BREAK + b" ")
    for part in spans(spaced):
        out.extend(map(numbers.__getitem__, [w for w in part.split(b" ") if w]))
    out.append(0)
    return out


def mixed(h: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its first words and that of its last (wraps; only selects cells)."""
    return (h * np.uint64(0x9E3779B97F4A7C15)) ^ (lower >> np.uint64(29)) ^ lower


def cell_of(phrase_hash: np.ndarray) -> np.ndarray:
    return (phrase_hash >> np.uint64(37)).astype(np.int64) % FILTER_BITS


class Filter:
    """A bit table: which phrases may have reached the minimum count."""

    def __init__(self, blocks: dict[int, bytes]) -> None:
        self.bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for number, data in blocks.items():
            self.bits[number * 4096 : number * 4096 + 4096] = np.frombuffer(data, np.uint8)

    def has(self, cell: np.ndarray) -> np.ndarray:
        return self.bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1 == 1


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """Seeded by the language; the break has 0."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    out = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
    out[0] = 0
    return out


def count_runs(ids: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of ``width`` word numbers that start at the positions ``at``: (runs x width), counts; sorted."""
    if width == 1:
        run, n = np.unique(ids[at], return_counts=True)
        return run[:, None], n
    code = ids[at] << 32 | ids[at + 1]
    if width == 2:
        code, n = np.unique(code, return_counts=True)
        return np.stack((code >> 32, code & 0xFFFFFFFF), axis=1), n
    pair, inverse = np.unique(code, return_inverse=True)
    code, n = np.unique(inverse.astype(np.int64) << 32 | ids[at + 2], return_counts=True)
    pair = pair[code >> 32]
    return np.stack((pair >> 32, pair & 0xFFFFFFFF, code & 0xFFFFFFFF), axis=1), n


def starts_of(ids: np.ndarray, hashes: np.ndarray, width: int, known: Filter | None) -> np.ndarray:
    """Positions where a run of ``width`` words starts whose parts (one word less) may be frequent."""
    if width == 1:
        return np.flatnonzero(ids > 0)
    inside = ids > 0
    h = hashes[ids]
    if width == 2:
        ok = inside & known.has(cell_of(mixed(np.zeros_like(h), h)))
        return np.flatnonzero(ok[:-1] & ok[1:])
    pair = inside[:-1] & inside[1:]
    pair[pair] = known.has(cell_of(mixed(mixed(np.zeros(pair.sum(), np.uint64), h[:-1][pair]), h[1:][pair])))
    return np.flatnonzero(pair[:-1] & pair[1:])


def stripes(lang: str, ids: np.ndarray, number: Numbers, width: int, known: Filter | None, hot: dict) -> pa.RecordBatch | None:
    """The stripes of one language's words: a row for each prefix (and slice) with its next words and their counts."""
    hashes = word_hashes(lang, list(number))
    at = starts_of(ids, hashes, width, known)
    if not len(at):
        return None
    runs, n = count_runs(ids, at, width)
    if width == 1:  # one prefix, the empty one: sliced in any case
        slices = (hashes[runs[:, 0]] >> np.uint64(8)).astype(np.int64) % 1024
        order = np.argsort(slices, kind="stable")
    else:
        head = runs[:, 0] if width == 2 else runs[:, 0] << 32 | runs[:, 1]
        parts = np.ones(len(runs), np.int64)
        for phrase, k in hot.get(lang, {}).items():
            numbers = [number.get(w, 0) for w in phrase.split(b" ")]
            code = numbers[0] if width == 2 else numbers[0] << 32 | numbers[1]
            parts[np.searchsorted(head, code) : np.searchsorted(head, code, "right")] = k
        slices = (hashes[runs[:, -1]] >> np.uint64(8)).astype(np.int64) % parts
        order = np.lexsort((slices, head))
    runs, n, slices = runs[order], n[order], slices[order]
    changed = np.diff(slices, prepend=-1) != 0
    for column in runs[:, :-1].T:
        changed |= np.diff(column, prepend=-1) != 0
    first = np.flatnonzero(changed)
    offsets = pa.array(np.append(first, len(runs)).astype(np.int32))
    following = pa.array(list(number), pa.binary()).take(pa.array(runs[:, -1]))
    words = list(number)
    prefixes = [b" ".join(words[x] for x in p) for p in runs[first, :-1].tolist()]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(first), pa.string()), pa.array(prefixes, pa.binary()), pa.array(slices[first].astype(np.int32)),
         pa.ListArray.from_arrays(offsets, following), pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int64)))],
        ["lang", "prefix", "slice", "next", "n"])


def level(src: DataFrame, width: int, known, hot: dict) -> DataFrame:
    """(lang, prefix, next, n): merged stripes of phrases of ``width`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if known is None else Filter(known.value)
        held: dict[str, tuple[Numbers, list[np.ndarray], int]] = {}

        def counted(lang: str) -> Iterator[pa.RecordBatch]:
            numbers, parts, _ = held.pop(lang)
            out = stripes(lang, np.concatenate(parts), numbers, width, table, hot)
            if out is not None:
                for i in range(0, out.num_rows, 1 << 16):
                    yield out.slice(i, 1 << 16)

        total = 0
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                numbers, parts, size = held.get(lang) or (Numbers(), [], 0)
                parts.append(np.array(word_numbers(data or b"", numbers), np.int64))
                held[lang] = numbers, parts, size + len(parts[-1])
                total += len(parts[-1])
                if held[lang][2] > WORDS_AT_ONCE:
                    total -= held[lang][2]
                    yield from counted(lang)
                elif total > 2 * WORDS_AT_ONCE or len(held) > 4096:  # many languages
                    total = 0
                    for each in list(held):
                        yield from counted(each)
        for each in list(held):
            yield from counted(each)

    built = src.mapInArrow(run, "lang string, prefix binary, slice int, next array<binary>, n array<long>")
    dealt = built.repartition(shuffle_width(src.sparkSession), "lang", "prefix", "slice")
    elements = dealt.select("lang", "prefix", "slice", F.explode(F.arrays_zip("next", "n")).alias("e"))
    merged = elements.groupBy("lang", "prefix", "slice", F.col("e.next").alias("next")).agg(F.sum("e.n").alias("n"))
    return merged.drop("slice")


def _filter(frequent: DataFrame):
    """The cells of frequent phrases as a broadcast bit table: FILTER_BITS / 8 bytes at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = np.zeros(1, np.uint64)
                for word in word_hashes(lang, [BREAK, *phrase.split(b" ")])[1:]:
                    h = mixed(h, word)
                cells.append(int(cell_of(h)[0]) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64())], ["cell"])

    cells = frequent.select("lang", "phrase").mapInArrow(run, "cell long")
    rows = cells.groupBy(F.bitmap_bucket_number("cell").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect()
    return frequent.sparkSession.sparkContext.broadcast({r["block"] - 1: bytes(r["bits"]) for r in rows})


def _hot(frequent: DataFrame, total: int) -> dict[str, dict[bytes, int]]:
    """Prefixes of the next level that hold more than 1 / (2 P) of all words, with their slices: at most 2 P rows."""
    share = max(1, total // (2 * shuffle_width(frequent.sparkSession)))
    rows = frequent.filter(F.col("n") > share).select("lang", "phrase", F.ceil(F.col("n") / F.lit(share)).alias("slices")).collect()
    out: dict[str, dict[bytes, int]] = {}
    for r in rows:
        out.setdefault(r["lang"], {})[bytes(r["phrase"])] = int(r["slices"])
    return out


def phrase_counts(docs: DataFrame, text: str, lang: str, min_count: int) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) of all word occurrences, and for 1, 2 and 3 words (lang, phrase, prefix, next, n) of the frequent phrases."""
    src = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("t"))
    phrase = F.when(F.octet_length("prefix") == 0, F.col("next")).otherwise(F.concat("prefix", F.lit(b" "), "next"))
    levels: list[DataFrame] = []
    words = stash(level(src, 1, None, {}), "stripes-1")
    totals = words.groupBy("lang").agg(F.sum("n").alias("words"))
    total = totals.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    frequent = words.filter(F.col("n") >= min_count).withColumn("phrase", F.col("next"))
    levels.append(frequent)
    for width in (2, 3):
        merged = level(src, width, _filter(frequent), _hot(frequent, total)).filter(F.col("n") >= min_count)
        frequent = stash(merged.withColumn("phrase", phrase), f"stripes-{width}")
        levels.append(frequent)
    return totals, levels


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 10, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two or three words.

    a, l, r: frequencies of the phrase and of the two parts of its lowest-scoring cut (ties to the
    shortest first part); score = floor(10**6 a a / (l r)), in decimals. Phrases inside a longer one of
    at least half their frequency are dropped. A null text has no words, a null language is ``und``;
    repeated rows count as often as they stand there; other columns are ignored, an empty table gives an empty result.
    """
    totals, (ones, twos, threes) = phrase_counts(docs, text, lang, min_count)
    f1 = ones.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    f2 = twos.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))

    def with_part(rows: DataFrame, parts: DataFrame, part: str, name: str) -> DataFrame:
        named = parts.select(F.col("lang").alias("plang"), F.col("part").alias("ppart"), F.col("f").alias(name))
        return rows.join(named, (F.col("lang") == F.col("plang")) & (F.col(part) == F.col("ppart"))).drop("plang", "ppart")

    pairs = twos.select("lang", "phrase", F.col("prefix").alias("w1"), F.col("next").alias("w2"), F.col("n").alias("a"))
    pairs = with_part(with_part(pairs, f1, "w1", "l"), f1, "w2", "r")
    split = F.position(F.lit(" "), F.col("prefix").cast("string"))
    first = F.substring_index(F.col("prefix").cast("string"), " ", 1).cast("binary")
    second = F.substring_index(F.col("prefix").cast("string"), " ", -1).cast("binary")
    triples = threes.filter(split > 0).select(
        "lang", "phrase", "prefix", F.col("next").alias("w3"), first.alias("w1"), F.concat(second, F.lit(b" "), "next").alias("tail"), F.col("n").alias("a"))
    triples = with_part(with_part(triples, f1, "w1", "l1"), f2, "tail", "r1")
    triples = cut(with_part(with_part(triples, f2, "prefix", "l2"), f1, "w3", "r2"))

    def score(l: str, r: str) -> str:
        a = "cast(a as decimal(16,0))"
        return f"cast((cast(1000000 as decimal(7,0)) * ({a} * {a})) div (cast({l} as decimal(16,0)) * cast({r} as decimal(16,0))) as long)"

    holds = triples.select("lang", F.col("prefix").alias("part"), "a").unionAll(triples.select("lang", F.col("tail").alias("part"), "a"))
    longer = holds.groupBy("lang", "part").agg(F.max("a").alias("longest")).withColumnRenamed("lang", "hlang")
    pairs = pairs.join(longer, (F.col("lang") == F.col("hlang")) & (F.col("phrase") == F.col("part")), "left")
    pairs = pairs.filter(F.col("longest").isNull() | (100 * F.col("longest") < 50 * F.col("a")))
    pairs = pairs.select("lang", "phrase", "a", "l", "r", F.expr(score("l", "r")).alias("score"))
    cuts = triples.select("lang", "phrase", "a", *[F.expr(score(f"l{k}", f"r{k}")).alias(f"s{k}") for k in (1, 2)], "l1", "r1", "l2", "r2")
    one = F.col("s1") <= F.col("s2")
    cuts = cuts.select("lang", "phrase", "a", F.when(one, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                       F.when(one, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = pairs.unionAll(cuts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals.withColumnRenamed("lang", "tlang"), F.col("lang") == F.col("tlang")).select(
        "lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", F.col("words").alias("n"), "score")
