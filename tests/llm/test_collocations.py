import random
import re
from collections import Counter

import numpy as np

from llm_helpers import docs_frame, vocabulary
from weeklens.llm import collocations as C


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, min_count, top):
    """rows: (lang, text)."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            total[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    out = {}
    for (lang, *w), a in f.items():
        if len(w) < 2 or a < min_count:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[(lang, *w[:k])], f[(lang, *w[k:])]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        if len(w) == 2 and any(len(p) == 4 and p[0] == lang and b >= min_count and 100 * b >= 50 * a and
                               (list(p[1:3]) == w or list(p[2:4]) == w) for p, b in f.items()):
            continue
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, rank, p.decode(), -a, left, right, total[lang], -s)
            for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def frame(spark, rows):
    df = docs_frame(spark, [(i, t) for i, (_, t) in enumerate(rows)], extra=True)
    langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "i long, l string")
    return df.drop("lang").join(langs, df.doc_id == langs.i).withColumnRenamed("l", "lang").selectExpr("*", "'x' as n", "'y' as phrase", "'z' as next")


def texts(seed, n=200):
    rnd, words = random.Random(seed), vocabulary(5, 12)
    phrases = [" ".join(rnd.choices(words, k=3)) for _ in range(4)]
    out = []
    for i in range(n):
        w = [rnd.choice(phrases if rnd.random() < 0.4 else words) + rnd.choice(["", "", "", ".", ",", "\t", "\n"]) for _ in range(rnd.randint(1, 12))]
        out.append((rnd.choice(["en", "de", None, "und"]), rnd.choice([" ", "  "]).join(w).title()))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]


def test_against_brute_force(spark):
    rows = texts(1)
    for min_count, top in ((3, 40), (10, 2000)):
        got = rows_of(C.collocations(frame(spark, rows), min_count=min_count, top=top))
        assert len(got) > 10 and len(got) == len(set(got)) and set(got) == brute(rows, min_count, top)


def test_small_buffers_and_hot_prefixes_merge_to_the_same(spark, monkeypatch):
    rows = [(lang, (t or "").replace(" ", " the ")) for lang, t in texts(2)]
    monkeypatch.setattr(C, "WORDS_AT_ONCE", 40)
    hot = {}
    real = C._hot
    monkeypatch.setattr(C, "_hot", lambda *a: hot.setdefault(len(hot), real(*a)))
    got = rows_of(C.collocations(frame(spark, rows), min_count=4))
    assert set(got) == brute(rows, 4, 2000)
    assert any(b"the" in words for words in hot[0].values()) and max(k for words in hot[0].values() for k in words.values()) > 1


def test_a_crowded_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(C.Filter, "has", lambda self, cell: np.ones(len(cell), bool))
    rows = texts(3, 60)
    assert set(rows_of(C.collocations(frame(spark, rows), min_count=2))) == brute(rows, 2, 2000)


def test_the_filter_prunes_what_is_rare(spark):
    rows = texts(4)
    df = frame(spark, rows).selectExpr("lang", "text as t").na.fill({"lang": "und"})
    ones = C.level(df, 1, None, {}).withColumn("phrase", C.F.col("next"))
    table = C.Filter(C._filter(ones.filter("n >= 60")).value)
    kept = {(r["lang"], bytes(r["phrase"])): r["n"] >= 60 for r in ones.collect()}
    for (lang, word), frequent in kept.items():
        h = C.mixed(np.zeros(1, np.uint64), C.word_hashes(lang, [C.BREAK, word])[1:])
        assert bool(table.has(C.cell_of(h))[0]) == frequent


def test_edge_rows_and_empty_table(spark):
    rows = [("en", None), ("en", ""), (None, "\t .,!? \n"), ("en", "a b " * 300_000), ("en", "a b " * 300_000), ("fr", "É b\x00c É b\x00c")]
    got = rows_of(C.collocations(frame(spark, rows), min_count=2))
    assert set(got) == brute(rows, 2, 2000)
    assert rows_of(C.collocations(docs_frame(spark, []))) == []
