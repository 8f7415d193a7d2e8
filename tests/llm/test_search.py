import math
import random
import re
from collections import Counter

from llm_helpers import docs_frame, vocabulary
from weeklens.llm import search


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, top):
    found = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, c in found if c), sum(c.total() for _, c in found)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    df = Counter(t for _, c in found for t in c)
    out = set()
    for item, words in wanted.items():
        scored = []
        for row, (d, c) in enumerate(found):
            if not c:
                continue
            m = 50 + 50 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in words if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, row))
        for rank, (s, _, _, row) in enumerate(sorted(scored)[:top], 1):
            out.add((item, rank, found[row][0], -s))
    return out


def items_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as doc_id", "'y' as score", "'z' as h")


def rows_of(df):
    return [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]


def corpus(seed, n=300):
    rnd, words = random.Random(seed), vocabulary(4, 60)
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 30))).title() for _ in range(n // 3)]
    rows = [(i, rnd.choice(texts)) for i in range(n)]
    rnd.shuffle(rows)
    return rows, [(i, ", ".join(rnd.choices(words, k=6)) + f" only{i}") for i in range(9)]


def test_ranks_scores_and_ties_against_brute_force(spark):
    docs, items = corpus(1)
    got = rows_of(search.search(docs_frame(spark, docs, extra=True), items_frame(spark, items), top=20))
    assert len(got) == len(set(got)) and set(got) == brute(docs, items, 20)


def test_items_in_blocks_give_the_same(spark):
    docs, items = corpus(2, 90)
    got = rows_of(search.search(docs_frame(spark, docs), items_frame(spark, items), top=7, max_terms=20))
    assert set(got) == brute(docs, items, 7)


def test_edge_rows(spark):
    long = "alpha beta " * 150_000 + "gamma"
    docs = [(1, None), (2, ""), (3, " .,\n"), (None, "alpha"), (4, "Alpha"), (4, "alpha"), (5, long), (6, "É2 x_y"), (7, "é2")]
    items = [(1, "ALPHA gamma"), (1, "beta"), (2, None), (3, ""), (None, "É2 y"), (4, "absent")]
    got = rows_of(search.search(docs_frame(spark, docs, extra=True), items_frame(spark, items), top=50))
    assert len(got) == 5 and set(got) == brute(docs, items, 50)


def test_empty_tables(spark):
    some, none = docs_frame(spark, [(1, "a b")]), docs_frame(spark, [])
    assert rows_of(search.search(none, items_frame(spark, [(1, "a")]))) == []
    assert rows_of(search.search(some, items_frame(spark, []))) == []
    assert rows_of(search.search(docs_frame(spark, [(1, None)]), items_frame(spark, [(1, "a")]))) == []


def test_a_clash_of_hashes_makes_two_classes(spark, monkeypatch):
    docs, items = corpus(3, 60)
    real = search.F.xxhash64
    monkeypatch.setattr(search.F, "xxhash64", lambda *c: search.F.pmod(real(*c), search.F.lit(3)).cast("long"))
    got = rows_of(search.search(docs_frame(spark, docs), items_frame(spark, items), top=10))
    assert set(got) == brute(docs, items, 10)


def test_span_cuts_do_not_split_terms():
    text = ("word " * 3 + "x" * 50 + "-yy ").encode() * 2000
    assert search.term_counts(text) == Counter(text.replace(b"-", b" ").split())
