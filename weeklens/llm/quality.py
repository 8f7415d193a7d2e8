"""Quality rules: base counts per text and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams (words and word pairs, A-Z lower-cased, 2 ** ``bits`` cells) are
estimated: the raw corpus from every row, and the trusted target from labelled good rows. The ratio of
a cell is shrunk to 1 by ``smoothing`` counts (the mean of a gamma-Poisson posterior): with e the
target count that the raw corpus leads to expect, ln((c_t + smoothing) / (e + smoothing)). N-grams too
rare for the target to tell anything weigh almost nothing, so texts outside the labelled sample are
not held against it. A text's score is the mean over its n-grams; it is kept if the score is at least
``threshold``, a fixed number that treats every document alike.

The hash space follows the trusted n-grams, not the corpus. The expected counts of all cells sum to the number
of trusted n-grams, however large the corpus is, so with at most ``LOAD`` trusted n-grams to a cell the n-grams
that happen to share a cell add about LOAD counts to both sides of its ratio: they act like that much more
smoothing, which does not grow with the input. ``bits`` is the least number, from MIN_BITS on, that gives this load.

Tasks add up their counts by cell and send them in blocks of ``BLOCK`` cells (positions and counts, packed);
blocks are dealt to tasks and summed as they stream in, so a task holds sums of whole blocks, never a list of
contributions. The model is 4 bytes a cell. The target is taken from at most ``max_trusted`` labelled rows, drawn
by hash of the id (the documented bound of the fitted sample); raw counts cover every document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, cut

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
#: Words hashed at once: bounds the memory that a very long text takes.
WORDS_AT_ONCE = 1 << 18
#: Trusted n-grams to a cell at most, the smallest hash space, and the cells of one block of counts.
LOAD, MIN_BITS, BLOCK = 4, 16, 1 << 16


def ngram_hashes(text: str | None) -> Iterator[np.ndarray]:
    """64-bit hashes of the text's words and word pairs, in pieces."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    for at in range(0, len(words), WORDS_AT_ONCE):
        part = words[at : at + WORDS_AT_ONCE + 1]  # one more: the pair across the edge
        h = np.fromiter(map(crc32, part), np.uint64, len(part))
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
        single = h[:WORDS_AT_ONCE] * np.uint64(0xD6E8FEB86659FD93)
        yield np.concatenate((single, pairs))


def ngram_cells(text: str | None, bits: int) -> Iterator[np.ndarray]:
    """Cells of the text's words and word pairs, in pieces."""
    for hashes in ngram_hashes(text):
        yield (hashes >> np.uint64(64 - bits)).astype(np.int64)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\f\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(SYMBOL.findall(text)), dup, _repeat_words(words)


def _repeat_words(words: list[str], width: int = 5) -> int:
    """Words that lie in a window of ``width`` words which the text holds twice or more."""
    if len(words) <= width:
        return 0
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    hit = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.fromiter((found[w] > 1 for w in windows), bool, len(windows)))
    np.add.at(hit, at, 1)
    np.add.at(hit, at + width, -1)
    return int((np.cumsum(hit)[:-1] > 0).sum())


def ngram_count(text: Column) -> Column:
    """How many n-grams ``ngram_hashes`` gives: every word, and every pair of neighbours."""
    words = F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    return F.greatest(2 * words - 1, F.lit(0))


def bits_for(trusted: int) -> int:
    return max(MIN_BITS, int(np.ceil(np.log2(max(1.0, trusted / LOAD)))))


def count_cells(rows: DataFrame, bits: int) -> DataFrame:
    """rows (t, good) -> (block, raw, trusted): counts of every cell over all rows and over good rows, as packed
    arrays of the block's cells. Blocks without counts are absent."""
    width = min(BLOCK, 1 << bits)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << bits), np.int32)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for block in range((1 << bits) // width):
                raw, trusted = total[:, block * width : (block + 1) * width]
                at = np.flatnonzero(raw)
                if len(at):
                    at = at.astype(np.uint16)
                    row = [[block], [at.tobytes()], [raw[at].tobytes()], [trusted[at].tobytes() if trusted.any() else b""]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(row, (pa.int32(), *[pa.binary()] * 3), strict=True)], ["block", "at", "raw", "trusted"])
            total[:] = 0

        for batch in parts:
            for t, good in zip(batch.column("t").to_pylist(), batch.column("good").to_pylist(), strict=True):
                for cells in ngram_cells(t, bits):
                    np.add.at(total[0], cells, 1)
                    if good:
                        np.add.at(total[1], cells, 1)
                    held += len(cells)
                    if held > 1 << 30:  # before a count can pass 32 bits
                        yield from flush()
                        held = 0
        yield from flush()

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in parts:
            for block, at, raw, trusted in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "raw", "trusted")), strict=True):
                total = sums.setdefault(block, np.zeros((2, width), np.int64))
                cells = np.frombuffer(at, np.uint16)
                total[0, cells] += np.frombuffer(raw, np.int32)
                if trusted:
                    total[1, cells] += np.frombuffer(trusted, np.int32)
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([total[0].tobytes()], pa.binary()), pa.array([total[1].tobytes()], pa.binary())],
                ["block", "raw", "trusted"])

    packed = rows.mapInArrow(count, "block int, at binary, raw binary, trusted binary")
    return packed.repartition("block").mapInArrow(add, "block int, raw binary, trusted binary")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", good: str = "quality",
        bits: int | None = None, smoothing: float = 30.0, max_trusted: int = 32768) -> np.ndarray:
    """The log ratios by cell, 0 where no text has it and everywhere if no row is trusted. Labels with a null id or
    value, or of unknown rows, say nothing. ``bits``: by the trusted n-grams if None."""
    ids = labels.filter(F.col(f"`{good}`") == 1).select(F.col(f"`{id_col}`").alias("id")).dropna().distinct()
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(max_trusted)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text}`").alias("t")).join(
        F.broadcast(ids), F.col("doc") == F.col("id"), "left").select("t", F.col("id").isNotNull().alias("good"))  # no more than max_trusted ids
    if bits is None:
        bits = bits_for(rows.filter("good").select(F.coalesce(F.sum(ngram_count(F.col("t"))), F.lit(0))).first()[0])
    counts = cut(count_cells(rows, bits))
    unpack = F.pandas_udf(lambda c: c.map(lambda x: int(np.frombuffer(x, np.int64).sum())), "long")
    sums = counts.select(unpack("raw").alias("raw"), unpack("trusted").alias("trusted")).agg(F.sum("raw"), F.sum("trusted")).first()
    share = (sums[1] or 0) / max(1, sums[0] or 0)

    def ratios(raw: pd.Series, trusted: pd.Series) -> pd.Series:
        out = []
        for r, t in zip(raw, trusted, strict=True):
            r, t = np.frombuffer(r, np.int64), np.frombuffer(t, np.int64)
            out.append(np.log((t + smoothing) / (r * share + smoothing)).astype(np.float32).tobytes())
        return pd.Series(out)

    told = counts.select("block", F.pandas_udf(ratios, "binary")("raw", "trusted").alias("ratios"))
    out = np.zeros(1 << bits, np.float32)
    width = min(BLOCK, 1 << bits)
    for row in told.toLocalIterator():  # 4 bytes a cell, 2 ** bits cells: bounded by the trusted n-grams
        out[row["block"] * width : (row["block"] + 1) * width] = np.frombuffer(row["ratios"], np.float32)
    return out


def score(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text: str = "text",
          threshold: float = -0.1, min_words: int = 10, max_repeat_pct: int = 20, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, ``keep``, the base counts, base_failed, llr, kept.

    Null and empty texts have no words: they fail the base rules, with llr 0. Repeated rows are
    judged alike. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # 2 ** bits numbers
    bits = int(len(ratios)).bit_length() - 1
    cols = [id_col, *keep]
    src = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(cols)], F.col(f"`{text}`").alias("t"))

    def judge(texts: pd.Series) -> pd.DataFrame:
        out, table = [], shared.value
        for t in texts:
            t = t if isinstance(t, str) else None
            total, n = 0.0, 0
            for cells in ngram_cells(t, bits):
                total, n = total + float(table[cells].sum(dtype=np.float64)), n + len(cells)
            out.append((*base_counts(t), round(total / n, 9) if n else 0.0))
        return pd.DataFrame(out, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr"])

    run = F.pandas_udf(judge, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double")
    r = src.withColumn("r", run("t")).select(*[f"k{i}" for i in range(len(cols))], "r.*")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    return r.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(cols)], "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"), "llr", (~failed & (F.col("llr") >= threshold)).alias("kept"))
