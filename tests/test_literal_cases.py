"""Cases with values worked out by hand from the original semantics."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import make_frames
from weeklens.operators import detectors as D
from weeklens.operators import prep
from weeklens.operators import queries as Q
from weeklens.operators import streaks as S
from weeklens.operators import text as X

LP, PO = "Lead Penetration", "Perfect Orders"
NEW = "Brand New Metric"


def orders(zone, start, end):
    return {"ZONE": zone, "METRIC": "Orders", "weeks": [None, None, None, start, start, start, start, start, end]}


def test_growth_explanation_keeps_zones_without_metrics(spark):
    fr = make_frames(spark, [orders("A", 100, 200), orders("B", 100, 150),
                             {"ZONE": "A", "METRIC": PO, "weeks": [0.5] * 8 + [0.6]}])
    rows = {r.zone: r for r in Q.growth_explain(fr).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"].metric == PO and rows["A"].improvement == pytest.approx(0.2)
    assert rows["B"].metric is None and rows["B"].value_start is None and rows["B"].growth_pct == pytest.approx(0.5)


def test_metrics_that_only_the_data_has(spark):
    rows = [{"ZONE": f"Z{i:02d}", "METRIC": m, "weeks": [9, 8, 7, 6, 5, 4, 3, 2, i / 20]} for i in range(12) for m in (PO, NEW)]
    fr = make_frames(spark, rows)
    assert {(r.metric_a, r.metric_b) for r in D.correlations(fr).collect()} == {(NEW, PO)}
    assert {r.metric for r in D.corr_clean_metrics(fr).collect()} >= {NEW, PO}
    assert Q.metric_pivot(fr).first()[NEW] is not None
    assert NEW in S.deterioration_matrix(fr).columns and S.deterioration_matrix(fr).first()[NEW] > 0


def test_an_unknown_week_skips_the_outlier_rule(spark):
    fr = make_frames(spark, [{"ZONE": "A", "METRIC": LP, "weeks": [5.0]}, {"ZONE": "B", "METRIC": LP, "weeks": [1.0]}])
    r = Q.compare_groups(fr, LP, week="L12W").first()
    assert (r.value, r.outliers_excluded, r.week) == (3.0, False, "L0W")
    r = Q.compare_groups(fr, LP).first()
    assert (r.value, r.outliers_excluded) == (1.0, True)


def test_gap_compares_exact_values(spark):
    fr = make_frames(spark, [{"ZONE": "A", "METRIC": PO, "ZONE_TYPE": "Wealthy", "weeks": [1e-7]},
                             {"ZONE": "B", "METRIC": PO, "ZONE_TYPE": "Non Wealthy", "weeks": [4e-7]}])
    r = Q.gap(fr, PO).first()
    assert r.leader == "Non Wealthy" and r.gap == pytest.approx(3e-7)


def test_histogram_counts_values_outside_apart(spark):
    values = [-3.0, 0.0, 0.01, 0.99, 1.0, 7.0, None]
    fr = make_frames(spark, [{"ZONE": f"Z{i}", "METRIC": PO, "weeks": [v]} for i, v in enumerate(values)])
    got = {r.bin: (r.n, r.bin_lo, r.bin_hi) for r in Q.metric_histogram(fr, PO).collect()}
    assert {b: n for b, (n, *_) in got.items()} == {-1: 1, 0: 2, 49: 2, 50: 1}
    assert got[-1][1] is None and got[50][2] is None


def test_growth_from_zero_is_infinite(spark):
    fr = make_frames(spark, [{"ZONE": z, "METRIC": PO, "weeks": w} for z, w in
                             (("up", [0, 2]), ("down", [0, -2]), ("none", [0, 0]), ("half", [-2, -1]), ("null", [None, 1]))])
    got = {r.ZONE: r.wow_change for r in Q.pct_change_table(fr).collect()}
    assert got == {"up": math.inf, "down": -math.inf, "half": 0.5}


def test_white_space_and_numbers(spark):
    df = spark.createDataFrame([("\xa0CO　\x1c", "1.5d"), (" a b ", " 1.5 "), ("x", "0x1p3"), ("y", "-1e3"), ("z", "1.5f"),
                                ("u", "nan"), ("v", "Infinity"), ("w", ".5")], "COUNTRY string, L0W string")
    rows = prep.clean_numeric(prep.clean_trim(df, ["COUNTRY"])).collect()
    assert [r.COUNTRY for r in rows[:2]] == ["CO", "a b"]
    assert [r.L0W for r in rows] == [None, 1.5, None, -1000.0, None, None, math.inf, 0.5]


def test_benchmark_positions_do_not_collide(spark):
    rows = [{"ZONE": f"Z{i:03d}", "METRIC": m, "weeks": [0.5 + (i % 7 == 0) * 0.4 + i * 1e-4]} for i in range(60) for m in (PO, LP)]
    fr = make_frames(spark, rows)
    got = D.benchmarking_all(fr, [PO, LP], z_threshold=0.1, top_n=2000, list_pos=True).orderBy("list_pos").collect()
    assert [r.list_pos for r in got] == list(range(1, len(got) + 1))
    assert [r.metric for r in got] == sorted((r.metric for r in got), key=[PO, LP].index)


def test_bounded_results_are_ordered(spark):
    fr = make_frames(spark, [{"ZONE": f"Z{i}", "COUNTRY": c, "METRIC": PO, "weeks": [v]}
                             for i, (c, v) in enumerate((("A", 0.1), ("B", 0.9), ("C", 0.5), ("C", 0.5)))])
    assert [r.group for r in Q.compare_groups(fr, PO, "country").collect()] == ["B", "C", "A"]
    assert Q.zones_per_country(fr).first().COUNTRY == "C"
    r = Q.zone_summary(fr).first()
    assert (r.countries, r.zone_types, r.prioritizations) == ("A|B|C", "Wealthy", "Prioritized")


def messages(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, q string")


def test_places_decide_the_intent_of_metric_pairs(spark):
    mw = make_frames(spark, [{"ZONE": "Chapinero", "METRIC": PO, "weeks": [1]}]).metrics_wide
    msgs = messages(spark, [(1, 1, "user", "gross profit in chapinero last 4 weeks")])
    assert X.metric_pair_tag(msgs, mw).first().intent == X.intent_tag(msgs, mw).first().intent == "trend"


def test_only_the_users_turns_feed_the_context(spark):
    mw = make_frames(spark, [{"ZONE": "Chapinero", "METRIC": PO, "weeks": [1]}]).metrics_wide
    msgs = messages(spark, [(1, 1, "user", "perfect orders in colombia"), (1, 2, "assistant", "turbo adoption in mexico is high"),
                            (1, 3, "user", "y ahora por zona en ese pais")])
    got = {r.turn: r for r in X.context_carry(msgs, mw).collect()}
    assert set(got) == {1, 3} and got[3].metric == PO
    assert got[3].country in (None, "CO")


def test_cells_without_values_stay_null(spark):
    fr = make_frames(spark, [{"ZONE": "A", "METRIC": PO, "weeks": [0.5, None, 0.4]}, orders("B", None, None)])
    long = {(r.ZONE, r.week_label): r.has_value for r in fr.long().filter(F.col("week_label").isin("L1W", "L0W", "L2W")).collect()}
    assert long["A", "L1W"] is False and long["A", "L0W"] is True and long["B", "L0W"] is False


def test_exact_quantiles_and_ranks_on_skewed_values(spark):
    import random

    import numpy as np

    from weeklens.operators.scale import average_percent_ranks, group_quantiles

    rnd = random.Random(3)
    rows = [("hot", 1.0) for _ in range(1900)] + [("hot", rnd.random()) for _ in range(100)] + [("one", 2.5), ("null", None)]
    rows += [("wide", rnd.choice([-1, 1]) * 10 ** rnd.uniform(-6, 8)) for _ in range(500)]  # counts like order volumes
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in group_quantiles(df, {"a": ("v", 0.25), "b": ("v", 0.5), "c": ("v", 0.999)}, ["g"]).collect()}
    assert set(got) == {"hot", "one", "wide"}
    for g, r in got.items():
        values = [v for k, v in rows if k == g]
        assert [r.a, r.b, r.c] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.999])), rel=1e-12)
    whole = [v for _, v in rows if v is not None]
    assert group_quantiles(df, {"q": ("v", 0.4)}).first().q == pytest.approx(np.quantile(whole, 0.4), rel=1e-12)
    ranked = average_percent_ranks(df, {"v": "pct"}).collect()
    assert len(ranked) == len(rows)
    for r in ranked[::97]:
        want = None if r.v is None else (sum(x < r.v for x in whole) + (sum(x == r.v for x in whole) + 1) / 2) / len(whole)
        assert r.pct == (want if want is None else pytest.approx(want))
