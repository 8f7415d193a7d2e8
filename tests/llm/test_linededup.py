import hashlib
import re
from collections import Counter

from llm_helpers import SF, docs_frame
from weeklens.llm import linededup
from weeklens.llm.queries import QUERIES

SPACE = " \t\n\x0b\f\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def brute(rows, min_chars=1, min_docs=10):
    n = Counter()
    for _, t in rows:
        n.update({k for k in map(key, (t or "").split("\n")) if len(k) >= min_chars})
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if n[key(x)] < min_docs or len(key(x)) < min_chars]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_whole_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: (n, x, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, x in brute(rows)}
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in QUERIES["op6_linededup"](spark, SF).collect()}
    assert got == want


def test_edge_rows(spark):
    rows = [(i, f"Shared Line\nown {i}\n\n  shared line\t\nÉ shared") for i in range(12)]
    rows += [(20, None), (21, ""), (22, "\n\n"), (23, "shared line"), (None, "SHARED LINE\nleft"), (24, "é shared"), (24, "é shared")]
    rows += [(30, "\n".join(f"line {i}" for i in range(30_000)) + "\nshared line")]
    for min_chars, min_docs in ((1, 10), (12, 10), (1, 1)):
        out = linededup.drop_common_lines(docs_frame(spark, rows, extra=True), min_chars=min_chars, min_docs=min_docs, keep=("key", "pos"))
        got = sorted(((r["doc_id"], r["kept"], r["n_lines"], r["n_dropped"]) for r in out.collect()), key=str)
        assert got == brute(rows, min_chars, min_docs)


def test_empty_table(spark):
    assert linededup.drop_common_lines(docs_frame(spark, [])).collect() == []


def test_runs_are_compacted_and_known_keys_are_not_added_again(spark):
    runs = linededup.SortedRuns(spark, min_docs=5, fanout=2)
    try:
        for _ in range(4):
            runs.add(spark.createDataFrame([(b"common", 5), (b"rare", 1)], "key binary, n long"))
        assert [len(x) for x in runs.levels] == [0, 0, 1]
        got = {bytes(r["key"]): r["n"] for r in spark.table(runs.tables()[0]).collect()}
        assert got == {b"common": 5, b"rare": 4}  # common was known from the first run on
        assert [bytes(r["key"]) for r in runs.common().collect()] == [b"common"]
    finally:
        runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("weeklens_runs")]
