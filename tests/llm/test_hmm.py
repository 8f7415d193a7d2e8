import itertools
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF, docs_frame, vocabulary
from weeklens.llm import hmm

from weeklens.llm.queries import QUERIES


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute_base(rows, trains):
    c = Counter(t for (d, x), on in zip(rows, trains) if on for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return n, [(d, len(tokens(x)), sum(c[t] > 0 for t in tokens(x)),
                sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x))) for d, x in rows]


def small_model(seed=0, states=3, classes=5):
    rng = np.random.default_rng(seed)
    a, b, c = rng.random(states), rng.random((states, states)), rng.random((states, classes))
    return hmm.Model(a / a.sum(), b / b.sum(1, keepdims=True), c / c.sum(1, keepdims=True))


def brute_paths(model, seq):
    """Likelihood and expected counts by summing over every state path."""
    k, n = model.emit.shape
    start, move, emit, total = np.zeros(k), np.zeros((k, k)), np.zeros((k, n)), 0.0
    for path in itertools.product(range(k), repeat=len(seq)):
        p = model.start[path[0]] * np.prod([model.emit[s, x] for s, x in zip(path, seq)])
        p *= np.prod([model.move[a, b] for a, b in zip(path, path[1:])])
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:]):
            move[a, b] += p
        for s, x in zip(path, seq):
            emit[s, x] += p
    return start / total, move / total, emit / total, math.log(total)


def test_forward_and_baum_welch_are_exact(monkeypatch):
    model, rng = small_model(), np.random.default_rng(1)
    seqs = [rng.integers(0, 5, n) for n in (1, 2, 6, 4, 4, 1, 7)]
    want = [brute_paths(model, s) for s in seqs]
    for cells in (3, 1 << 19):
        monkeypatch.setattr(hmm, "CELLS", cells)
        assert np.allclose(hmm.log_likelihoods(model, seqs), [w[3] for w in want])
        got = hmm.expected_counts(model, seqs)
        for i in range(3):
            assert np.allclose(got[i], sum(w[i] for w in want))
        assert got[3] == pytest.approx(sum(w[3] for w in want))


def test_training_raises_the_likelihood(spark):
    rng = np.random.default_rng(2)
    seqs = [np.where(rng.random(30) < 0.9, rng.integers(0, 4, 30) + 4 * (i % 2), rng.integers(0, 8, 30)) for i in range(60)]
    packed = [(bool(i % 5), bytearray(s.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes())) for i, s in enumerate(seqs)]
    df = spark.createDataFrame(packed, "train boolean, classes binary")
    held = [s for i, s in enumerate(seqs) if i % 5 == 0]
    likes = [hmm.log_likelihoods(hmm.train(df, 2, 8, rounds, 1), held).sum() for rounds in (0, 3, 8)]
    assert likes[0] < likes[1] < likes[2]


def test_whole_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    n, want = brute_base(rows, [crc32(str(d).encode()) % 5 != 1 for d, _ in rows])
    got = {r["doc_id"]: r for r in QUERIES["op9_hmm"](spark, SF).collect()}
    assert len(got) == len(rows)
    for d, size, known, base in want:
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (size, known, n)
        assert r["held_out"] == (crc32(str(d).encode()) % 5 == 1) and r["base_score"] == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_edge_rows(spark):
    words, rnd = vocabulary(6), random.Random(6)
    rows = [(1, None), (2, ""), (3, "Aa bB"), (4, "aa \t bb É"), (None, "aa"), (5, "twice"), (5, "twice"), (6, "unseen words only"),
            (7, " ".join(rnd.choices(words, k=40_000))), (11, "aa aa")]
    df = docs_frame(spark, rows, extra=True)
    train = F.col("doc_id") != 6
    out = hmm.score_texts(df, train, states=2, head=3, tail=4, rounds=1, chunk_tokens=5, keep=("key", "t")).collect()
    _, want = brute_base(rows, [d is not None and d != 6 for d, _ in rows])
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out), key=str)
    assert got == sorted(((d, a, b, round(c, 6)) for d, a, b, c in want), key=str)
    nobody = hmm.score_texts(df, F.lit(False), states=2, head=3, tail=4, rounds=1).collect()
    assert {r["train_tokens"] for r in nobody} == {0} and {r["base_score"] for r in nobody} == {0.0}
    assert hmm.score_texts(docs_frame(spark, []), train, states=2, head=3, tail=4, rounds=1).collect() == []


def test_probabilities_sum_to_one(spark):
    """Over all texts of one word and the end: every known word, and once an unknown one per class."""
    rows = [(i, w) for i, w in enumerate("a a a b b c d e f g".split())]
    probe = [(100 + i, w) for i, w in enumerate("abcdefg")]
    df = docs_frame(spark, rows + probe)
    out = hmm.score_texts(df, F.col("doc_id") < 100, states=2, head=2, tail=1, rounds=2).filter("doc_id >= 100").collect()
    unseen = hmm.score_texts(docs_frame(spark, [*rows, (200, "zz")]), F.col("doc_id") < 100, states=2, head=2, tail=1, rounds=2)
    total = sum(10 ** r["score"] for r in out) + 10 ** unseen.filter("doc_id = 200").first()["score"]
    assert 0 < total < 1  # the rest belongs to longer texts and to the empty one

