import hashlib
import random

import pytest

from llm_helpers import SF, docs_frame, vocabulary
from weeklens.llm import lz
from weeklens.llm.queries import QUERIES


def phrases(text):
    """LZ78 by slices: the set of shortest new prefixes."""
    data, seen, start = text.encode(), set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in seen:
            seen.add(data[start:end])
            start = end
    return seen


def jaccard(a, b):
    x, y = phrases(a), phrases(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def brute(rows):
    """rows in descending order: (id, n_chars, sha256, edited text, next text)."""
    out = []
    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1] or ""
        t = t or ""
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        out.append((d, t, edited, following))
    return out


def check(want, got, near):
    assert len(got) == len(want)
    for d, t, edited, following in want:
        r = got[d]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == lz.fingerprint(t) and r["edited_fingerprint"] == lz.fingerprint(edited)
        assert r["near_next"] == lz.likeness(bytes.fromhex(lz.fingerprint(t)), bytes.fromhex(lz.fingerprint(following)))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        near.append((r["near_edited"], jaccard(t, edited), r["near_next"], jaccard(t, following)))


def test_whole_query_against_brute_force(spark):
    rows = sorted((tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    got = {r["doc_id"]: r for r in QUERIES["op2_lz"](spark, SF).collect()}
    near = []
    check(brute(rows), got, near)
    error = [abs(a - b) for a, b, *_ in near] + [abs(c - d) for *_, c, d in near]
    assert sum(error) / len(error) < 0.06  # 128 bins: a standard error of at most 0.045
    assert sum(a > c for a, _, c, _ in near) > 0.95 * len(near)


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_small_tables(spark, n):
    rnd, words = random.Random(n), vocabulary(2)
    rows = [(i * 3, rnd.choice([None, "", "é", " ".join(rnd.choices(words, k=rnd.randint(1, 80)))])) for i in range(n)]
    out = lz.edit_likeness(docs_frame(spark, rows, extra=True), keep=("t", "text")).collect()
    check(brute(rows[::-1]), {r["doc_id"]: r for r in out}, [])


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "other"), (None, "x y"), (None, None)]
    out = lz.edit_likeness(docs_frame(spark, rows), keep=("text",)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(rows, key=str)
    assert {r["fingerprint"] for r in out if r["text"] == "a b c"} == {lz.fingerprint("a b c")}


def test_empty_table(spark):
    assert lz.edit_likeness(docs_frame(spark, [])).collect() == []


def test_long_texts_hash_in_spans(monkeypatch):
    rnd = random.Random(1)
    text = " ".join(rnd.choices(vocabulary(4), k=9000))
    whole = lz.fingerprint(text)
    monkeypatch.setattr(lz, "SPAN", 1000)
    assert lz.fingerprint(text) == whole
