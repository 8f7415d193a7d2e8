import random
import re

import numpy as np
import pytest

from llm_helpers import SF, docs_frame, vocabulary
from weeklens.llm import jaccard
from weeklens.llm.queries import QUERIES


def shingles(text, width=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, percent=80):
    """[(n_shingles, component)] of rows (id, text)."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(len(s), least.get(find(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def edited(rnd, words, text, rate):
    return " ".join(rnd.choice(words) if rnd.random() < rate else w for w in text.split())


def corpus(seed, n=260):
    rnd, words = random.Random(seed), vocabulary(6)
    passage = " ".join(rnd.choices(words, k=55))
    rows = []
    while len(rows) < n:
        text = " ".join(rnd.choices(words, k=rnd.choice([3, 6, 20, 60, 200])))
        if rnd.random() < 0.5:
            text += " " + passage
        rows.append(text)
        for _ in range(rnd.choice([0, 0, 1, 6])):  # chains of copies near the limit
            text = edited(rnd, words, text, rnd.choice([0, 0.01, 0.03, 0.05]))
            rows.append(text)
    ids = rnd.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


def check(spark, rows, **kw):
    got = [tuple(r) for r in jaccard.jaccard_components(docs_frame(spark, rows, extra=True), **kw).collect()]
    want = [(d, *x) for (d, _), x in zip(rows, brute(rows, kw.get("percent", 80)))]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("percent", [80, 55])
def test_against_brute_force(spark, percent):
    check(spark, corpus(percent), percent=percent)


def test_large_blocks_in_tiles(spark):
    rnd, words = random.Random(8), vocabulary(7)
    base = " ".join(rnd.choices(words, k=90))
    rows = [(i, edited(rnd, words, base, 0.02)) for i in range(150)] + [(1000 + d, t) for d, t in corpus(9, 60)]
    check(spark, rows, tile_tokens=1500)


def test_edge_rows(spark):
    rnd, words = random.Random(2), vocabulary(1)
    long = " ".join(rnd.choice(words) for _ in range(120_000))
    rows = [(5, None), (3, ""), (9, " \t\n"), (7, "One two"), (8, "one TWO"), (None, "one two"), (4, long), (4, long + " end"),
            (None, "lonely text of just six words"), (2, "a a a a a a a"), (1, "a a a a a")]
    check(spark, rows)


def test_empty_table(spark):
    assert jaccard.jaccard_components(docs_frame(spark, [])).collect() == []


def test_whole_query_against_brute_force(spark):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op13_jaccard"](spark, SF).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got == {d: x for (d, _), x in zip(docs, brute(docs))}


@pytest.mark.parametrize("seed", range(6))
def test_traversal_connects_what_all_pairs_connect(seed, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS", 16)
    rnd = np.random.default_rng(seed)
    sets = []
    for _ in range(30):
        base = rnd.integers(0, 1 << 63, int(rnd.integers(1, 60)), dtype=np.uint64)
        for _ in range(int(rnd.integers(1, 6))):
            keep = base[rnd.random(len(base)) < 0.95]
            sets.append(np.unique(np.concatenate((keep, rnd.integers(0, 1 << 63, 2, dtype=np.uint64)))))
    rnd.shuffle(sets)

    def joined(links):
        up = list(range(len(sets)))
        for x, y in links:
            a, b = up[x], up[y]
            up = [min(a, b) if u in (a, b) else u for u in up]
        return up

    pairs = [(i, j) for i in range(len(sets)) for j in range(i)
             if 180 * len(np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]))]
    links = jaccard.tree_links(sets, 80)
    assert joined(links) == joined(pairs) and len(links) < len(sets)
    half = len(sets) // 2
    across = [(i, j) for i, j in pairs if (i < half) != (j < half)]
    assert joined(jaccard.tree_links(sets, 80, half)) == joined(across)


def test_linked_sets_share_the_margin_in_their_prefixes():
    rnd, levels = np.random.default_rng(1), np.random.default_rng(2).integers(0, 9, jaccard.CELLS).astype(np.uint8)
    for _ in range(300):
        base = np.unique(rnd.integers(0, 1 << 63, int(rnd.integers(1, 120)), dtype=np.uint64))
        a = base[rnd.random(len(base)) < 0.93]
        b = np.unique(np.concatenate((base[rnd.random(len(base)) < 0.93], rnd.integers(0, 1 << 63, 1, dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if not len(a) or 180 * both < 80 * (len(a) + len(b)):
            continue
        shared = len(np.intersect1d(jaccard.prefix(a, levels, 80), jaccard.prefix(b, levels, 80)))
        for s in (a, b):
            assert shared >= jaccard.margin(jaccard.least_overlap(len(s), 80), 80)


def test_blocks_hold_members_that_share_enough_tokens_not_chains_of_single_ones(spark):
    """Pairs that share all they need are blocks of their own, though each shares a token with the next pair."""
    import hashlib

    def row(name, hits):
        return hashlib.md5(name.encode()).digest(), 100, b"", hits  # 100 tokens: partners share 4 of the hits at least

    pairs = [row(f"{k} {side}", [10 * k + j for j in range(1, 6)] + [10 * k, 10 * k + 10]) for k in range(40) for side in "ab"]
    group = [row(f"group {i}", [5000 + j for j in range(6)]) for i in range(3 * jaccard.FEW)]  # frequent tokens alone
    lone = [row(f"lone {i}", [5000, 5001, 5002, 9000 + i]) for i in range(5)]  # too few of them
    rows = pairs + group + lone + pairs[:10]
    frame = spark.createDataFrame(rows, "digest binary, n long, tokens binary, hits array<long>")
    placed = jaccard.blocks(frame, 80).collect()
    held = {}
    for r in placed:
        held.setdefault((r["block"], r["weight"]), set()).add(r["node"])
    assert sorted(len(x) for x in held.values()) == [2] * 40 + [3 * jaccard.FEW]
    assert all(weight == 100 * len(nodes) for (_, weight), nodes in held.items())
