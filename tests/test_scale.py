"""Exact selection and ranks beyond what one bracket or one range holds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import make_frames
from weeklens.operators import queries as Q
from weeklens.operators import scale


def plan_of(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_a_million_values_stay_in_small_brackets(spark):
    df = spark.range(1_000_000).select((F.col("id") % 3).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 1024.0).alias("v"))
    wanted = {"a": ("v", 0.25), "b": ("v", 0.5), "c": ("v", 0.999)}
    got = {r.g: r for r in scale.group_quantiles(df, wanted, ["g"], count="n").collect()}
    pdf = df.toPandas()
    for g, part in pdf.groupby("g"):
        assert [got[g].a, got[g].b, got[g].c, got[g].n] == pytest.approx([*np.quantile(part["v"], [0.25, 0.5, 0.999]), len(part)], rel=1e-12)


def test_large_groups_are_bracketed_again(spark, monkeypatch):
    monkeypatch.setattr(scale, "INSIDE", 20)
    rounds = []
    real = scale._refined
    monkeypatch.setattr(scale, "_refined", lambda *a: rounds.append(1) or real(*a))
    rnd = random.Random(5)
    rows = [("a", rnd.choice([rnd.gauss(0, 1), rnd.gauss(0, 1), 0.25])) for _ in range(60_000)] + [("b", float(i % 7)) for i in range(500)]
    rows += [("c", None), ("d", 1.0), ("d", 2.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {f"q{i}": ("v", s) for i, s in enumerate([0.0, 0.01, 0.25, 0.5, 0.61, 0.75, 0.999, 1.0])}
    got = {r.g: r for r in scale.group_quantiles(df, wanted, ["g"]).collect()}
    assert rounds and set(got) == {"a", "b", "d"}
    for g, r in got.items():
        want = np.quantile([v for k, v in rows if k == g and v is not None], [s for _, s in wanted.values()])
        assert [r[n] for n in wanted] == pytest.approx(list(want), rel=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 50])
def test_small_groups(spark, n):
    values = [random.Random(n).uniform(-5, 5) for _ in range(n)]
    wanted = {f"q{i}": ("v", i / 20) for i in range(21)}
    row = scale.group_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), wanted).first()
    assert list(row) == pytest.approx(list(np.quantile(values, [s for _, s in wanted.values()])))


def test_ranks_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(scale, "RANGE_ROWS", 500)
    rnd = random.Random(1)
    rows = [(i, rnd.choice([7.0, float(rnd.randint(0, 3000)), None]), float(i % 10)) for i in range(9000)]
    df = spark.createDataFrame(rows, "i long, v double, w double")
    ranked = scale.value_ranks(df, ["v"])
    sizes = ranked.count()
    assert sizes > 3 * scale.RANGE_ROWS
    parts = spark.createDataFrame([(float(v),) for v in range(3000)], "v double").repartitionByRange(6, "v")
    assert max(r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()) <= 3 * scale.RANGE_ROWS
    out = {r.i: r for r in scale.average_percent_ranks(df, {"v": "pv", "w": "pw"}).collect()}
    assert len(out) == len(rows)
    for col, pct in ((1, "pv"), (2, "pw")):
        known = sorted(r[col] for r in rows if r[col] is not None)
        low, high = np.searchsorted(known, known, "left"), np.searchsorted(known, known, "right")
        want = {v: (a + (b - a + 1) / 2) / len(known) for v, a, b in zip(known, low, high)}
        assert all(out[r[0]][pct] == (None if r[col] is None else pytest.approx(want[r[col]])) for r in rows)


def zones(values):
    rows = []
    for i, (a, b) in enumerate(values):
        rows.append({"ZONE": f"Z{i:03d}", "METRIC": "Lead Penetration", "weeks": [a]})
        rows.append({"ZONE": f"Z{i:03d}", "METRIC": "Perfect Orders", "weeks": [b]})
    return rows


def test_high_low_outliers_are_listed_and_counted(spark):
    fr = make_frames(spark, zones([(0.1 * i, 1 - 0.1 * i) for i in range(8)] + [(2.0, 0.5), (9.0, 0.4), (None, 0.1), (3.0, None)]))
    out = Q.high_low_outliers(fr, "Lead Penetration", "Perfect Orders")
    assert {(r.ZONE, r.value_a, r.n_outliers) for r in out.collect()} == {("Z008", 2.0, 2), ("Z009", 9.0, 2)}
    assert {r.ZONE for r in Q.high_low(fr, "Lead Penetration", "Perfect Orders").collect()} == {"Z006", "Z007"}
    assert Q.high_low_outliers(fr, "Perfect Orders", "Lead Penetration").collect() == []


def test_plans_shuffle_little(spark):
    fr = make_frames(spark, zones([(0.01 * i, 1 - 0.01 * i) for i in range(60)]))
    assert plan_of(Q.compare_groups(fr, "Perfect Orders", "city", agg="median")).count("Exchange ") <= 4  # one of them a broadcast
    assert plan_of(Q.high_low(fr, "Lead Penetration", "Perfect Orders")).count("Exchange ") <= 6
