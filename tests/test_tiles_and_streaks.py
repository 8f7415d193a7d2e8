"""Correlations by tiles, streaks over long histories, and the audit of mismatched sheets."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import make_frames
from weeklens.operators import detectors as D
from weeklens.operators import pairs, prep, streaks

N_METRICS, N_ZONES = 500, 60


def test_five_hundred_metrics_equal_pandas_and_the_plan_does_not_grow(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(N_ZONES, 12))
    data = base @ rng.normal(size=(12, N_METRICS)) * 0.3 + rng.normal(size=(N_ZONES, N_METRICS)) * 0.2 + 1e3
    data[rng.random(data.shape) < 0.2] = np.nan
    data[:, 7] = 42.0  # constant: no correlation
    data[:, 8] = np.where(np.arange(N_ZONES) < 1, 5.0, np.nan)  # a single zone
    wide = pd.DataFrame(data, columns=[f"m{i:04d}" for i in range(N_METRICS)])
    long = wide.assign(z=range(N_ZONES)).melt("z", var_name="METRIC", value_name="v").dropna()
    cells = spark.createDataFrame(long)
    metrics = cells.groupBy("METRIC").agg(F.avg("v").alias("mean"))
    out = pairs.pairwise_correlations(cells, metrics, ["z"])
    got = {(r.metric_a, r.metric_b): r for r in out.collect()}
    want, seen = wide.corr().to_numpy(), wide.notna().to_numpy().astype(int)
    common = seen.T @ seen
    names = list(wide.columns)
    expected = {(names[i], names[j]) for i in range(N_METRICS) for j in range(i + 1, N_METRICS) if common[i, j] > 0}
    assert set(got) == expected
    for (a, b), r in got.items():
        i, j = names.index(a), names.index(b)
        assert r.n == common[i, j]
        if np.isnan(want[i, j]) or 7 in (i, j):
            assert r.r is None
        else:
            assert r.r == pytest.approx(want[i, j], abs=1e-9)
    few = pairs.pairwise_correlations(cells, metrics.filter("METRIC < 'm0005'"), ["z"])
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert size(out) <= size(few)


def test_correlations_of_clean_metrics_only(spark):
    rows = []
    for i in range(12):
        for m, v in (("a", i / 20), ("b", -i / 20), ("few", i / 20 if i < 10 else None), ("c", 0.5)):
            rows.append({"ZONE": f"z{i}", "METRIC": m, "weeks": [v]})
    rows += [{"ZONE": "z0", "METRIC": "a", "weeks": [-1.0]}]  # a repeated key: the larger value counts
    got = D.correlations(make_frames(spark, rows)).collect()
    assert [(r.metric_a, r.metric_b, r.direction, r.position) for r in got] == [("a", "b", "negativa", 1)]
    assert got[0].correlation == pytest.approx(-1.0)
    clean = {r.metric: (r.n_values, r.is_clean) for r in D.corr_clean_metrics(make_frames(spark, rows)).collect()}
    assert clean["a"] == (12, True) and clean["few"] == (10, False)
    assert D.correlations(make_frames(spark, [])).collect() == []


def replay(history, hib):
    """{period: value} -> longest run, and the values of the last run, period by period."""
    run = best = 0
    start = end = None
    before = None
    for t in sorted(history):
        v = history[t]
        p = history.get(t - 1)
        worse = before == t - 1 and p is not None and v is not None and p != 0 and (v < p if hib else v > p)
        if worse:
            if not run:
                start = p
            run, end = run + 1, v
            best = max(best, run)
        else:
            run = 0
        before = t
    return len(history), best, start, end


@pytest.mark.parametrize("chunk", [1, 2, 7, 1024])
def test_long_histories_with_gaps_equal_a_replay(spark, chunk):
    rnd = random.Random(chunk)
    histories = {}
    for k in range(40):
        values = [rnd.choice([None, 0.0, *range(1, 9)]) if k % 2 else rnd.randint(1, 9) for _ in range(rnd.randint(1, 60))]
        histories[k] = {t - 20: v for t, v in enumerate(values) if rnd.random() > 0.1 or t == 0}
    histories[100] = {t: 10_000.0 - t for t in range(3000) if t != 1500}  # runs far longer than a chunk
    histories[101] = {}
    if chunk >= 1024:
        walk = 1000.0
        histories[102] = {}
        for t in range(10_000):
            walk = max(1.0, walk + rnd.choice([-2, -1, -1, 1]))
            if rnd.random() > 0.02:
                histories[102][t] = walk
    rows = [(k, t, None if v is None else float(v), k % 3 != 0) for k, h in histories.items() for t, v in h.items()]
    rows += [(None, 1, 5.0, None), (None, 2, 4.0, None), (1, None, 3.0, True)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "s long, chunk long, n double, hib boolean")  # names that clash with inner ones
    out = streaks.long_streaks(df, ["s"], "chunk", "n", "hib", chunk=chunk).collect()
    got = {r.s: (r.n_periods, r.consecutive, r.run_start, r.run_end) for r in out}
    assert got == {k: replay(h, k % 3 != 0) for k, h in histories.items() if h} | {None: (2, 1, 5.0, 4.0)}
    assert len(out) == len(got)
    assert streaks.long_streaks(df.limit(0), ["s"], "chunk", "n").collect() == []


def test_nine_weeks_equal_the_fold_over_the_wide_row(spark):
    rnd = random.Random(9)
    rows = [{"ZONE": f"z{i}", "METRIC": "m", "weeks": [rnd.choice([None, 0, 1, 2, 3, 4, 5]) for _ in range(9)]} for i in range(300)]
    fact = make_frames(spark, rows).fact.withColumn("hib", F.lit(True))
    wide = {r.ZONE: (r.consecutive, r.run_start, r.run_end) for r in streaks.with_streaks(fact, "hib").collect()}
    long = streaks.long_streaks(prep.melt_long(fact.drop("hib")), ["ZONE"], "week_index", chunk=4)
    assert {r.ZONE: (r.consecutive, r.run_start, r.run_end) for r in long.collect()} == wide


def test_sheet_mismatch_finds_planted_zones(spark):
    ids = "COUNTRY string, CITY string, ZONE string, METRIC string"
    m = spark.createDataFrame([("CO", "B", "both", "x"), ("CO", "B", "both", "y"), ("CO", "B", "metrics only", "x"),
                               ("CO", None, "null city", "x")], ids)
    o = spark.createDataFrame([("CO", "B", "both", "Orders"), ("MX", "C", "orders only", "Orders"),
                               ("MX", "C", "orders only", "Orders"), ("CO", None, "null city", "Orders")], ids)
    got = {(r.ZONE, r.missing_in) for r in prep.sheet_mismatch(m, o).collect()}
    assert got == {("metrics only", "orders"), ("orders only", "metrics")}
    assert {tuple(r) for r in prep.sheet_audit(m, o).collect()} == {("CO", 2, 1, 0), ("MX", 0, 0, 1)}
    assert prep.sheet_mismatch(m.limit(0), o.limit(0)).collect() == []
