"""Language-model scoring with a hidden Markov model over word classes.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased, and one end token. The
``head`` most frequent training words (and the end) are classes of their own; all other words share
``tail`` classes by hash. A hidden state emits a class, the class emits the word, so
P(word | state) = P(class | state) * (c + 0.5) / (N_class + 0.5 * (V_class + 1)) with the training
count c: the full vocabulary is counted and used, while what is trained by Baum-Welch is bounded
(states x states and states x classes) and fits a broadcast.

1. Each task encodes its texts against vocabularies local to a chunk of about ``chunk_tokens`` tokens
   and writes them once: the codes of every text, and one row per (chunk, word).
2. The rows of a word, at most one per chunk, are summed to its corpus count; the counts go back to
   the chunks, where texts become class sequences, and the base score is summed.
3. Baum-Welch: every task runs the scaled forward-backward recursion over its texts (all texts of a
   batch advance together, one token a step) and sends expected counts, one row per parameter; a
   grouped sum gives the next model.
4. The scaled forward recursion gives the exact likelihood of every sequence.
"""

from __future__ import annotations

import secrets
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

END = b""
#: Class of the end token; head words follow it.
END_CLASS = 0
#: Padded cells (texts x steps) of one forward-backward batch.
CELLS = 1 << 19


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # (states)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (states, classes)


# ---------------------------------------------------------------- encoding


def _pack(codes: np.ndarray) -> bytes:
    """Three byte planes of codes under 2 ** 24: they compress better than whole integers."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(3, -1).astype(np.int64)
    return planes[0] | planes[1] << 8 | planes[2] << 16


def encode(docs: DataFrame, cols: list[str], text: str, training: Column, chunk_tokens: int) -> DataFrame:
    """Texts (kind doc: k0.., train, codes) and chunk vocabularies (kind word: code, w1, w2, n), written once."""
    src = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(cols)],
                      F.coalesce(training, F.lit(False)).alias("train"), F.col(f"`{text}`").alias("t"))
    names = [f"k{i}" for i in range(len(cols))]
    kinds = ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names)
    spec = f"{kinds}, kind string, chunk long, train boolean, codes binary, code int, w1 long, w2 long, n long"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = defaultdict()
        words.default_factory = words.__len__
        held: list[tuple] = []  # (batch, row, train, codes)
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = secrets.randbits(62)
            seen = np.zeros(len(words), np.int64)
            n = np.zeros(len(words), np.int64)
            for *_, train, codes in held:
                np.add.at(seen, codes, 1)
                if train:
                    np.add.at(n, codes, 1)
            by_use = np.argsort(-seen, kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[by_use] = np.arange(len(words))
            both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<i8").reshape(-1, 2)[by_use]
            for lo in range(0, len(held), 4096):
                part = held[lo : lo + 4096]
                rows = {k: [] for k in names}
                for batch, row, *_ in part:
                    for k in names:
                        rows[k].append(batch.column(k)[row].as_py())
                yield pa.RecordBatch.from_pydict({
                    **rows, "kind": ["doc"] * len(part), "chunk": [chunk] * len(part), "train": [t for *_, t, _ in part],
                    "codes": [_pack(rank[c]) for *_, c in part], "code": [None] * len(part), "w1": [None] * len(part),
                    "w2": [None] * len(part), "n": [None] * len(part)}, schema)
            for lo in range(0, len(words), 1 << 17):
                hi = min(len(words), lo + (1 << 17))
                empty = pa.nulls(hi - lo)
                yield pa.RecordBatch.from_arrays([
                    *[empty.cast(schema.field(k).type) for k in names], pa.array(["word"] * (hi - lo)),
                    pa.array(np.full(hi - lo, chunk)), empty.cast(pa.bool_()), empty.cast(pa.binary()),
                    pa.array(np.arange(lo, hi, dtype=np.int32)), pa.array(both[lo:hi, 0]), pa.array(both[lo:hi, 1]),
                    pa.array(n[by_use][lo:hi])], schema=schema)
            words.clear()
            held.clear()

        schema = None
        for batch in parts:
            if schema is None:
                schema = pa.schema([
                    *[batch.schema.field(k) for k in names], ("kind", pa.string()), ("chunk", pa.int64()),
                    ("train", pa.bool_()), ("codes", pa.binary()), ("code", pa.int32()), ("w1", pa.int64()),
                    ("w2", pa.int64()), ("n", pa.int64())])
            ids = batch.select(names)
            trains = batch.column("train").to_pylist()
            for row, t in enumerate(batch.column("t")):
                tokens = (t.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
                tokens.append(END)
                codes = np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))
                held.append((ids, row, trains[row], codes))
                size += len(tokens)
                if size >= chunk_tokens:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return stash(src.mapInArrow(run, spec), "lm-codes", "kind")


# ---------------------------------------------------------------- counts and classes


def word_counts(coded: DataFrame) -> DataFrame:
    """(chunk, code, w1, c, first): the training count of the word over all chunks; first marks one row per word."""
    of_word = Window.partitionBy("w1", "w2")  # at most one row per chunk
    words = coded.filter("kind = 'word'").select("chunk", "code", "w1", "w2", "n")
    return stash(words.select(
        "chunk", "code", "w1", F.sum("n").over(of_word).alias("c"),
        (F.row_number().over(of_word.orderBy("chunk")) == 1).alias("first")), "lm-counts")


def sequences(coded: DataFrame, counts: DataFrame, cols: list[str], head: int, tail: int) -> tuple[DataFrame, int, int]:
    """Texts as class sequences with their base and word scores; N and V of the training tokens."""
    end = int(np.frombuffer(xxhash.xxh3_128_digest(END), "<i8")[0])
    one = counts.filter(F.col("first") & (F.col("c") > 0))
    total, distinct = one.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = [r["w1"] for r in one.filter(F.col("w1") != end).orderBy(F.col("c").desc(), "w1").limit(head).collect()]
    spark = counts.sparkSession
    ranked = spark.createDataFrame([(end, END_CLASS), *[(w, i + 1) for i, w in enumerate(top)]], "hw long, own int")
    shared_tail = (F.pmod(F.col("w1"), F.lit(tail)) + 1 + head).cast("int")
    classed = counts.join(F.broadcast(ranked), F.col("w1") == F.col("hw"), "left").select(  # head + 1 rows
        "chunk", "code", "c", "first", F.coalesce("own", shared_tail).alias("class"))
    sums = classed.filter(F.col("first") & (F.col("c") > 0)).groupBy("class").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # head + tail + 1 rows at most
    room = np.full(head + tail + 1, 0.5)
    for r in sums:
        room[r["class"]] = r["n"] + 0.5 * (r["v"] + 1)
    room[: head + 1] = 0  # a class of one word emits it for sure
    names = [f"k{i}" for i in range(len(cols))]
    texts = coded.filter("kind = 'doc'").select(*names, "chunk", "train", "codes")
    kinds = ", ".join(f"{n} {texts.schema[n].dataType.simpleString()}" for n in names)
    spec = f"{kinds}, train boolean, n_tokens long, n_known long, base_score double, word_score double, classes binary"
    log_base = np.log10(total + 0.5 * (distinct + 1))

    def run(key: tuple, docs: pa.Table, words: pa.Table) -> pa.Table:
        order = np.argsort(words.column("code").to_numpy())
        c = words.column("c").to_numpy()[order]
        cls = words.column("class").to_numpy()[order].astype(np.int64)
        base = np.log10(c + 0.5) - log_base
        space = room[cls]
        word = np.where(space > 0, np.log10(c + 0.5) - np.log10(np.maximum(space, 0.5)), 0.0)
        out = {k: [] for k in ("n_tokens", "n_known", "base_score", "word_score", "classes")}
        for packed in docs.column("codes"):
            codes = _unpack(packed.as_py())
            out["n_tokens"].append(len(codes))
            out["n_known"].append(int((c[codes] > 0).sum()))
            out["base_score"].append(float(base[codes].sum()))
            out["word_score"].append(float(word[codes].sum()))
            out["classes"].append(cls[codes].astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes())
        full = docs.select([*names, "train"])
        for k, kind in (("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
                        ("word_score", pa.float64()), ("classes", pa.binary())):
            full = full.append_column(k, pa.array(out[k], kind))
        return full

    words = classed.select("chunk", "code", "c", "class")
    joined = texts.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(run, spec)
    return stash(joined, "lm-classes"), int(total), int(distinct)


# ---------------------------------------------------------------- the model


def first_model(states: int, classes: int, frequency: np.ndarray, seed: int) -> Model:
    """States start as random tilts of the class frequencies."""
    rng = np.random.default_rng(seed)
    emit = (frequency + 1.0)[None] * np.exp(rng.normal(0, 1, (states, classes)))
    move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(1, keepdims=True))


def _batches(seqs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, padded class matrix by step, texts still running at each step), longest texts first."""
    lengths = np.array([len(s) for s in seqs], np.int64)
    order, at = np.argsort(-lengths, kind="stable"), 0
    while at < len(order):
        longest = int(lengths[order[at]])
        take = order[at : at + max(1, CELLS // longest)]
        at += len(take)
        grid = np.zeros((longest, len(take)), np.int64)
        for j, i in enumerate(take.tolist()):
            grid[: lengths[i], j] = seqs[i]
        running = len(take) - np.searchsorted(lengths[take][::-1], np.arange(longest), side="right")
        yield take, grid, running


def _forward(model: Model, grid: np.ndarray, running: np.ndarray, alpha: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """ln likelihood per text, and the scales by step; fills ``alpha`` (steps, texts, states) if given."""
    by_class = np.ascontiguousarray(model.emit.T)
    steps, n = grid.shape
    log, scales = np.zeros(n), np.ones((steps, n)) if alpha is not None else np.ones((1, n))
    a = model.start[None] * by_class[grid[0]]
    for t in range(steps):
        m = running[t]
        if t:
            a = (a[:m] @ model.move) * by_class[grid[t, :m]]
        s = a.sum(1)
        a /= s[:, None]
        log[:m] += np.log(s)
        if alpha is not None:
            alpha[t, :m], scales[t, :m] = a, s
    return log, scales


def expected_counts(model: Model, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch: expected starts, moves and emissions of whole sequences, and their ln likelihood."""
    states, classes = model.emit.shape
    by_class = np.ascontiguousarray(model.emit.T)
    start, move, emit, total = np.zeros(states), np.zeros((states, states)), np.zeros((states, classes)), 0.0
    for _, grid, running in _batches(seqs):
        steps, n = grid.shape
        alpha = np.zeros((steps, n, states))
        log, scales = _forward(model, grid, running, alpha)
        total += float(log.sum())
        beta = np.ones((n, states))
        for t in range(steps - 1, 0, -1):
            m = running[t]
            b = by_class[grid[t, :m]] * beta[:m] / scales[t, :m, None]
            move += alpha[t - 1, :m].T @ b
            alpha[t, :m] *= beta[:m]
            beta[:m] = b @ model.move.T
        alpha[0] *= beta
        start += alpha[0].sum(0)
        flat, cells = alpha.reshape(-1, states), grid.ravel()  # padding has weight 0
        for k in range(states):
            emit[k] += np.bincount(cells, weights=flat[:, k], minlength=classes)
    return start, move * model.move, emit, total


def _classes_of(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(2, -1).astype(np.int64)
    return planes[0] | planes[1] << 8


def train(texts: DataFrame, states: int, classes: int, rounds: int, seed: int, smoothing: float = 0.1) -> Model:
    """Baum-Welch over all training texts, ``rounds`` times. texts: (train, classes)."""
    spark = texts.sparkSession
    training = texts.filter("train").select("classes")
    cells = states + states * states + states * classes

    def frequencies(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(classes)
        for pdf in parts:
            for packed in pdf["classes"]:
                total += np.bincount(_classes_of(packed), minlength=classes)
        yield pd.DataFrame({"cell": np.arange(classes), "v": total})

    def gathered(fn, size: int) -> np.ndarray:
        out = np.zeros(size)
        rows = training.mapInPandas(fn, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
        for r in rows:  # one row per parameter
            out[r["cell"]] = r["v"]
        return out

    model = first_model(states, classes, gathered(frequencies, classes), seed)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((model.start, model.move, model.emit))  # states * (states + classes + 1) numbers

        def counts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(cells)
            for pdf in parts:
                found = expected_counts(Model(*shared.value), [_classes_of(p) for p in pdf["classes"]])  # noqa: B023
                total += np.concatenate([x.ravel() for x in found[:3]])
            yield pd.DataFrame({"cell": np.arange(cells), "v": total})

        got = gathered(counts, cells) + smoothing
        start, move, emit = np.split(got, [states, states + states * states])
        move, emit = move.reshape(states, states), emit.reshape(states, classes)
        model = Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
        shared.unpersist()
    return model


def log_likelihoods(model: Model, seqs: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(seqs))
    for take, grid, running in _batches(seqs):
        out[take] = _forward(model, grid, running, None)[0]
    return out


def score_texts(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text: str = "text", states: int = 8, head: int = 511,
    tail: int = 512, rounds: int = 4, seed: int = 42, chunk_tokens: int = 4 << 20, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``id_col``, ``keep``, train, n_tokens, n_known, train_tokens, base_score, score.

    Rows where ``training`` holds train the model (null: not); all rows are scored. base_score is the
    add-half unigram log10 probability, score the model's. A null or empty text is the end token
    alone. Repeated rows train and score separately. Without training rows every word is unknown and
    the model is the untrained one. An empty table gives an empty result.
    """
    cols = [id_col, *keep]
    coded = encode(docs, cols, text, training, chunk_tokens)
    texts, total, _ = sequences(coded, word_counts(coded), cols, head, tail)
    model = train(texts, states, head + tail + 1, rounds, seed)
    shared = docs.sparkSession.sparkContext.broadcast((model.start, model.move, model.emit))
    names = [f"k{i}" for i in range(len(cols))]

    def run(packed: pd.Series) -> pd.Series:
        return pd.Series(log_likelihoods(Model(*shared.value), [_classes_of(p) for p in packed]) / np.log(10))

    likelihood = F.pandas_udf(run, "double")
    return texts.select(
        *[F.col(k).alias(c) for k, c in zip(names, cols, strict=True)], "train", "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score",
        (likelihood("classes") + F.col("word_score")).alias("score"))
