import random
import re

import pytest

from llm_helpers import SF, docs_frame, vocabulary
from weeklens.llm import mixing
from weeklens.llm.queries import QUERIES


def brute_targets(sizes, weights=(1, 2, 3), cap=3.0):
    """sizes: {source: words}; shares again until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return capped
        level = (total - sum(capped.values())) / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > cap * sizes[s]]
        if not over:
            return capped | {s: w[s] * level for s in free}
        capped |= {s: cap * sizes[s] for s in over}


def check(rows, out, weights=(1, 2, 3)):
    words = {}
    by = {}
    for _, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        words[s] = words.get(s, 0) + n
        by.setdefault(s, []).append(n)
    targets = brute_targets(words, weights)
    assert len(out) == len(rows)
    got = {}
    for r in out:
        s = r["source"]
        assert r["source_size"] == words[s] and r["target"] == pytest.approx(targets[s], rel=1e-9, abs=1e-9)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        got[s] = got.get(s, 0) + r["taken"]
        assert words[s] == 0 or r["copies"] in (int(targets[s] / words[s]), int(targets[s] / words[s]) + 1)
    for s, n in got.items():
        assert abs(n - targets[s]) <= max(by[s]) / 2 + 1e-6


def test_whole_query(spark):
    first = sorted(QUERIES["op5_mixing"](spark, SF).collect())
    assert first == sorted(QUERIES["op5_mixing"](spark, SF).collect())
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    source = {d: s for d, _, s in docs}
    check(docs, [r.asDict() | {"source": source[r["doc_id"]]} for r in first])


@pytest.mark.parametrize("bins", [1, 7, 4096])
def test_edge_rows_and_ranking(spark, bins):
    rnd, words = random.Random(bins), vocabulary(3)
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 60))), rnd.choice(["a", "b", "é", "Z", None])) for i in range(400)]
    rows += [(900, None, "only null"), (901, "", "only null"), (None, "x y z", "a"), (5, "same", "b"), (5, "same", "b"),
             (902, " ".join(rnd.choices(words, k=50_000)), "a"), (903, "w", "")]
    out = mixing.mix(docs_frame(spark, rows, extra=True), rank_bins=bins, keep=("source", "key")).collect()
    check(rows, [r.asDict() for r in out])


def test_bins_do_not_change_the_sample(spark):
    rnd, words = random.Random(5), vocabulary(3)
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 60))), rnd.choice("ab")) for i in range(300)]
    df = docs_frame(spark, rows)
    assert sorted(mixing.mix(df, rank_bins=1).collect()) == sorted(mixing.mix(df, rank_bins=500).collect())


def test_priority_raises_the_odds(spark):
    rows = [(i, "one two three", "a" if i % 2 else "b") for i in range(4000)]
    df = docs_frame(spark, rows).selectExpr("*", "if(doc_id % 4 < 2, 4.0, 1.0) as p")
    out = mixing.mix(df, weights=(1, 2), priority="p", keep=("p",)).filter("doc_id % 2 = 0").collect()
    taken = {p: [r["copies"] - int(r["target"] / r["source_size"]) for r in out if r["p"] == p] for p in (1.0, 4.0)}
    rate = {p: sum(x) / len(x) for p, x in taken.items()}
    assert rate[4.0] > rate[1.0] * 1.1


def brute_scale(docs, left):
    """docs: (priority, size); c with sum of min(1, c * p) * size = left, by halving."""
    lo, hi = 0.0, 1e9
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(1.0, mid * p) * n for p, n in docs) < left else (lo, mid)
    return hi


def test_inclusion_rates_follow_the_inclusion_odds(spark):
    """Each priority's documents are taken as often as their inclusion probability says; certain ones always."""
    rnd = random.Random(8)
    kinds = [1.0, 2.0, 5.0, 400.0, None]
    rows = [(i, " ".join(["w"] * rnd.randint(1, 5)), "a" if i % 4 else "b") for i in range(24_000)]
    df = docs_frame(spark, rows).selectExpr(
        "*", "array(1D, 2D, 5D, if(doc_id % 60 = 3, 400D, 1D), null)[cast(doc_id % 5 as int)] as p")
    out = mixing.mix(df, weights=(1, 1), priority="p", keep=("p", "source")).collect()
    docs, taken, said = {}, {}, {}
    for r in out:
        whole = int(r["target"] / r["source_size"])
        key = (r["source"], r["p"])
        docs.setdefault(r["source"], []).append((r["p"] or 1.0, r["size"]))
        taken.setdefault(key, []).append(r["copies"] - whole)
        said.setdefault(key, set()).add(r["inclusion"])
    for r in {x["source"]: x for x in out}.values():
        c = brute_scale(docs[r["source"]], r["target"] - int(r["target"] / r["source_size"]) * r["source_size"])
        for p in kinds:
            if (r["source"], p) not in taken:
                continue
            f, got = min(1.0, c * (p or 1.0)), taken[r["source"], p]
            assert all(x == pytest.approx(f, rel=1e-6) for x in said[r["source"], p])
            assert abs(sum(got) / len(got) - f) <= 4 * (f * (1 - f) / len(got)) ** 0.5 + 2 / len(got)
            assert f < 1 or all(got)
    assert any(f == 1.0 for fs in said.values() for f in fs)


def test_odd_priorities(spark):
    rows = [(i, "one two", "ab"[i % 2]) for i in range(60)]
    df = docs_frame(spark, rows).selectExpr(
        "*", "array(0D, -1D, double('NaN'), double('inf'), null, 1e300)[cast(doc_id % 6 as int)] as p")
    out = mixing.mix(df, priority="p", keep=("source",)).collect()
    check(rows, [r.asDict() for r in out])


def test_targets_refill_after_caps(spark):
    sizes = {"a": 1000, "b": 1, "c": 1, "d": 50, "e": 0}
    df = spark.createDataFrame(list(sizes.items()), "src string, source_size long")
    got = {r["src"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_empty_table(spark):
    assert mixing.mix(docs_frame(spark, [])).collect() == []
