import re

import corpus_pipeline as P
from llm_helpers import SF, docs_frame
from test_linededup import brute as brute_lines
from test_mixing import brute_targets
from test_simhash import brute_components, brute_fp
from pyspark.sql import functions as F
from weeklens.llm import toxicity
from weeklens.llm.common import row_key

FIVE = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, toxicity.training_fold(
        spark.read.parquet(f"{SF}/labels.parquet")))).collect()}
    clean = P.stash(P.toxicity_filter(spark, docs, SF), "test")
    assert clean.columns == FIVE
    rows = {r["doc_id"]: r for r in clean.collect()}
    assert rows == {d: r for d, r in before.items() if scores[d] < 0.5}

    lines = P.stash(P.line_dedup(spark, clean, SF), "test")
    want = {d: t for d, t, *_ in brute_lines([(d, r["text"]) for d, r in rows.items()])}
    rows = {r["doc_id"]: r for r in lines.collect()}
    assert lines.columns == FIVE and {d: r["text"] for d, r in rows.items()} == want
    assert all(r["n_chars"] == len(r["text"]) and r["source"] == before[d]["source"] for d, r in rows.items())

    unique = P.stash(P.near_dedup(spark, lines, SF), "test")
    fps = [(d, brute_fp(r["text"], 4)) for d, r in rows.items()]
    heads = {c for c in brute_components(fps, 4)}
    rows = {r["doc_id"]: r for r in unique.collect()}
    assert unique.columns == FIVE and set(rows) == heads and unique.count() == len(heads)

    mixed = P.stash(P.mix_sources(spark, unique, SF), "test")
    sizes, taken = {}, {}
    for r in rows.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    copies = mixed.groupBy(*FIVE).count().collect()
    assert mixed.columns == FIVE and all(1 <= r["count"] <= 3 and rows[r["doc_id"]]["text"] == r["text"] for r in copies)
    for r in copies:
        taken[r["source"]] = taken.get(r["source"], 0) + r["count"] * len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    longest = max(len(r["text"].split()) for r in rows.values())
    for s, target in brute_targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= longest / 2 + 1

    coded = P.encode(spark, mixed, SF)
    assert coded.count() == mixed.count() and coded.filter("n_tokens <> size(token_ids)").count() == 0


def test_edge_rows_pass_every_stage(spark):
    rows = [(1, None), (2, ""), (None, "no id but text of a few words"), (3, "a b c d e f", None), (3, "a b c d e f", None), (4, "x\n\ny")]
    docs = docs_frame(spark, rows, extra=True)
    labels = SF
    for name, stage in P.STAGES[:-1]:
        docs = P.stash(stage(spark, docs, labels), "test")
        assert docs.columns == FIVE, name
    assert P.STAGES[-1][1](spark, docs, labels).count() == docs.count()


def test_empty_table_passes_every_stage(spark):
    docs = docs_frame(spark, [])
    for _, stage in P.STAGES:
        docs = P.stash(stage(spark, docs, SF), "test")
    assert docs.collect() == []


def test_row_keys_tell_nulls_and_columns_apart(spark):
    rows = [("5", None), (None, "5"), ("5", ""), ("", "5"), (None, None), ("1:", "a"), ("1", ":a"), ("-", None), (None, "-")]
    df = spark.createDataFrame(rows, "a string, b string").select(row_key(F.col("a"), F.col("b")).alias("k"))
    assert df.distinct().count() == len(rows)


def test_equal_texts_of_different_sources_keep_their_sources(spark):
    """Rows equal in id and text: dedup keeps one whole row, the same in every run; mixing takes each source's own words."""
    rows = [(1, "a b c d e f", "s1"), (1, "a b c d e f", "s2"), (2, "other words that stand alone here", "s3")]
    df = docs_frame(spark, rows)
    kept = {tuple(r) for r in P.near_dedup(spark, df, SF).collect()}
    assert len(kept) == 2 and kept == {tuple(r) for r in P.near_dedup(spark, docs_frame(spark, rows[::-1]).repartition(3), SF).collect()}
    taken = {}
    for r in P.mix_sources(spark, df, SF).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    targets = brute_targets({"s1": 6, "s2": 6, "s3": 6})
    assert all(abs(taken.get(s, 0) - t) <= 3 for s, t in targets.items())
