import random
import re
from collections import Counter

import numpy as np

from llm_helpers import SF, docs_frame, vocabulary
from weeklens.llm import quality
from weeklens.llm.queries import QUERIES


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup = [], 0
    for x in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in lines
            lines.append(x)
    w5 = [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(w5)
    hit = {j for i, w in enumerate(w5) if n[w] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def brute_llr(text, ratios, bits):
    cells = np.concatenate([np.zeros(0, int), *quality.ngram_cells(text, bits)])
    return float(ratios[cells].mean()) if len(cells) else 0.0


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_whole_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_quality"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    labels = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["quality"] == 1}
    raw, good = np.zeros(1 << 16, int), np.zeros(1 << 16, int)
    for d, t in docs:
        for cells in quality.ngram_cells(t, 16):
            np.add.at(raw, cells, 1)
            if d in labels:
                np.add.at(good, cells, 1)
    ratios = np.log((good + 30) / (raw * good.sum() / raw.sum() + 30))
    for d, t in docs:
        base = brute_base(t)
        assert tuple(got[d][k] for k in BASE) == base
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        llr = brute_llr(t, ratios, 16)
        assert got[d]["base_failed"] == failed and abs(got[d]["llr"] - llr) < 1e-6
        assert got[d]["kept"] == (not failed and round(llr, 9) >= -0.1)


def test_edge_rows(spark):
    words, rnd = vocabulary(5), random.Random(5)
    rows = [(1, None), (2, ""), (3, "a"), (4, "a b c d e"), (5, "a b c d e a b c d e"), (6, "x\nx\n\n \n \nx"), (7, "# | <a> É\x0bb"),
            (None, "no id here"), (8, "dup"), (8, "dup"), (9, "z " * 60_000), (10, " ".join(rnd.choices(words, k=3000)))]
    df = docs_frame(spark, rows, extra=True)
    labels = spark.createDataFrame([(10, 1), (None, 1), (777, 1), (3, 0), (4, None)], "doc_id long, quality int")
    out = quality.score(df, quality.fit(df, labels, bits=10), keep=("t", "score")).collect()
    assert sorted(((r["doc_id"], *(r[k] for k in BASE)) for r in out), key=str) == sorted(((d, *brute_base(t)) for d, t in rows), key=str)
    empty = docs_frame(spark, [])
    assert quality.score(empty, quality.fit(empty, labels, bits=10)).collect() == []


def test_pieces_of_long_texts_hold_the_same_cells(monkeypatch):
    text = " ".join(random.Random(1).choices(vocabulary(1), k=1000))
    whole = Counter(np.concatenate(list(quality.ngram_cells(text, 12))).tolist())
    monkeypatch.setattr(quality, "WORDS_AT_ONCE", 37)
    assert Counter(np.concatenate(list(quality.ngram_cells(text, 12))).tolist()) == whole


def test_held_out_accuracy(spark):
    """Fitted without the labels of one fold, the ratio tells that fold's good rows from its bad ones."""
    from pyspark.sql import functions as F

    from weeklens.llm.common import fold_of, table

    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    ratios = quality.fit(docs, labels.filter(fold_of(F.col("doc_id")) != 0))
    rows = quality.score(docs, ratios).join(labels.filter(fold_of(F.col("doc_id")) == 0), "doc_id").filter("not base_failed").collect()
    good, bad = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_hash_space_follows_the_trusted_ngrams_not_the_corpus(spark, monkeypatch):
    from pyspark.sql import functions as F

    rnd = random.Random(2)
    rows = [(i, " ".join(f"w{rnd.randrange(1 << 40)}" for _ in range(1000))) for i in range(130)] + [(130, None), (131, ""), (132, "a")]
    df = docs_frame(spark, rows)
    counted = df.select("doc_id", quality.ngram_count(F.col("text")).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in counted} == {d: sum(map(len, quality.ngram_hashes(t))) for d, t in rows}
    monkeypatch.setattr(quality, "MIN_BITS", 8)
    few = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    many = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    assert len(quality.fit(docs_frame(spark, rows[:3]), few)) == len(quality.fit(df, few)) == 512
    assert len(quality.fit(df, many)) * quality.LOAD >= 100 * 1999


def test_scores_equal_a_count_without_hashing(spark):
    """Words and pairs counted as text, the ratio taken from the formula: only shared cells may differ."""
    rnd, words = random.Random(4), vocabulary(4)
    rows = [(i, " ".join(rnd.choices(words[: 200 + 200 * (i % 2)], k=rnd.randint(12, 80)))) for i in range(150)]
    good = {i for i, _ in rows if i % 2 == 0}

    def grams(text):
        w = text.lower().split(" ")
        return [*w, *zip(w, w[1:], strict=False)]

    raw, trusted = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in good:
            trusted.update(grams(t))
    share = sum(trusted.values()) / sum(raw.values())
    labels = spark.createDataFrame([(i, 1) for i in good], "doc_id long, quality int")
    df = docs_frame(spark, rows)
    got = {r["doc_id"]: r["llr"] for r in quality.score(df, quality.fit(df, labels, bits=22)).collect()}
    for i, t in rows:
        want = np.mean([np.log((trusted[g] + 30) / (raw[g] * share + 30)) for g in grams(t)])
        assert abs(got[i] - want) < 1e-3
