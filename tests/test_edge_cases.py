"""Literal tiny tables for the edge cases of the original semantics (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from conftest import make_frames
from weeklens.operators import detectors as D
from weeklens.operators import queries as Q
from weeklens.operators import streaks as S
from weeklens.operators.filters import Filters

LP, PO, GP, MD = "Lead Penetration", "Perfect Orders", "Gross Profit UE", "Restaurants Markdowns / GMV"


def _streak(spark, metric, weeks):
    fr = make_frames(spark, [{"ZONE": "Z", "METRIC": metric, "weeks": weeks}])
    rows = S.deterioration(fr, min_weeks=1).collect()
    return rows[0] if rows else None


def test_longest_run_with_last_run_values(spark):
    r = _streak(spark, PO, [10, 9, 8, 7, 9, 8, 8, 8, 8])
    assert r.consecutive_deterioration_weeks == 3
    assert r.total_pct_change == pytest.approx((8 - 9) / 9)


def test_null_inside_run_resets(spark):
    assert _streak(spark, PO, [5, 4, None, 3, 2, 1, 1, 1, 1]).consecutive_deterioration_weeks == 2


def test_zero_previous_resets_lower_is_better(spark):
    assert _streak(spark, MD, [0, 1, 2, 3, 3, 3, 3, 3, 3]).consecutive_deterioration_weeks == 2


def test_streak_matches_plain_loop(spark):
    import random

    rnd = random.Random(7)
    series = []
    for i in range(200):
        w = [rnd.choice([None, 0, 1, 2, 3, 4]) for _ in range(9)]
        series.append({"ZONE": f"Z{i}", "METRIC": rnd.choice([PO, MD]), "weeks": w})
    fr = make_frames(spark, series)
    got = {r.ZONE: r.consecutive_deterioration_weeks for r in S.deterioration(fr, min_weeks=1).collect()}
    for s in series:
        hib = s["METRIC"] != MD
        cons = best = 0
        w = s["weeks"]
        for i in range(1, 9):
            p, c = w[i - 1], w[i]
            if p is None or c is None or p == 0:
                cons = 0
                continue
            if (c < p) if hib else (c > p):
                cons += 1
                best = max(best, cons)
            else:
                cons = 0
        assert got.get(s["ZONE"], 0) == best, s


def test_lead_value_exactly_at_limit(spark):
    rows = [{"ZONE": f"Z{i}", "METRIC": LP, "weeks": [v]} for i, v in enumerate([2.0, 1.5, 0.5])]
    rows += [{"ZONE": f"Z{i}", "METRIC": PO, "weeks": [0.1]} for i in range(3)]
    fr = make_frames(spark, rows)
    top = [r.value for r in Q.top_zones(fr, LP, top_k=5).collect()]
    assert 2.0 not in top and len(top) == 2
    cg = Q.compare_groups(fr, LP, "ZONE_TYPE").collect()
    assert cg[0].n_zones == 3  # 2.0 is kept by the <= rule
    hl = Q.high_low(fr, LP, PO, percentile_high=0.0, percentile_low=1.0).collect()
    assert all(r.value_a < 2.0 for r in hl) and len(hl) == 2


def test_ties_at_rank_k_ordered_by_ids(spark):
    rows = [{"ZONE": z, "CITY": c, "METRIC": PO, "weeks": [0.5]} for z, c in [("B", "X"), ("A", "Y"), ("C", "X")]]
    fr = make_frames(spark, rows)
    got = [(r.CITY, r.ZONE) for r in Q.top_zones(fr, PO, top_k=2).orderBy("rank").collect()]
    assert got == [("X", "B"), ("X", "C")]


def test_peer_group_of_two_has_no_benchmark(spark):
    rows = [{"ZONE": "A", "METRIC": PO, "weeks": [0.1]}, {"ZONE": "B", "METRIC": PO, "weeks": [0.9]}]
    assert D.benchmarking(make_frames(spark, rows), PO).count() == 0


def test_benchmark_peer_outlier(spark):
    rows = [{"ZONE": f"Z{i}", "METRIC": PO, "weeks": [0.5]} for i in range(9)]
    rows.append({"ZONE": "LOW", "METRIC": PO, "weeks": [0.1]})
    out = D.benchmarking(make_frames(spark, rows), PO).collect()
    assert [r.zone for r in out] == ["LOW"] and out[0].performance == "underperformer"


def test_constant_metric_has_no_correlation(spark):
    rows = []
    for i in range(15):
        rows.append({"ZONE": f"Z{i}", "METRIC": PO, "weeks": [0.5]})
        rows.append({"ZONE": f"Z{i}", "METRIC": "Turbo Adoption", "weeks": [i / 20]})
        rows.append({"ZONE": f"Z{i}", "METRIC": "Pro Adoption (Last Week Status)", "weeks": [i / 30]})
    out = D.correlations(make_frames(spark, rows)).collect()
    assert len(out) == 1 and out[0].correlation == pytest.approx(1.0)
    assert {out[0].metric_a, out[0].metric_b} == {"Turbo Adoption", "Pro Adoption (Last Week Status)"}


def test_growth_from_zero_dropped(spark):
    rows = [{"ZONE": "A", "METRIC": "Orders", "weeks": [0, 0, 0, 0, 0, 0, 0, 0, 100]},
            {"ZONE": "B", "METRIC": "Orders", "weeks": [0, 0, 0, 60, 0, 0, 0, 0, 90]}]
    out = Q.fastest_growing(make_frames(spark, rows), 5, top_k=5, min_base=0).collect()
    assert [r.ZONE for r in out] == ["B"] and out[0].growth_pct == pytest.approx(0.5)


def test_near_zero_base_capped(spark):
    rows = [{"ZONE": "A", "METRIC": PO, "weeks": [0.0001, 0.05]}]
    out = D.anomalies(make_frames(spark, rows)).collect()
    assert out[0].pct_change == 5.0 and out[0].category == "Mejora"


def test_currency_delta_threshold(spark):
    rows = [{"ZONE": "A", "METRIC": GP, "weeks": [-0.5, 0.9]}, {"ZONE": "B", "METRIC": GP, "weeks": [-0.5, 1.1]}]
    out = D.anomalies(make_frames(spark, rows)).collect()
    assert [r.zone for r in out] == ["B"] and out[0].pct_change == pytest.approx(1.6 / 110)


def test_reserved_profit_slots(spark):
    rows = [{"ZONE": f"R{i}", "METRIC": PO, "weeks": [0.5, 0.1]} for i in range(30)]
    rows += [{"ZONE": f"G{i}", "METRIC": GP, "weeks": [0.0, 3.0 + i]} for i in range(5)]
    out = D.anomalies(make_frames(spark, rows)).collect()
    assert len(out) == 20 and sum(r.metric == GP for r in out) == 3


def test_trend_points_and_wow(spark):
    rows = [{"ZONE": "Chapinero", "METRIC": GP, "weeks": [1, 2, 3, 4, 5, 6, 7, 8, 4]},
            {"ZONE": "Other", "METRIC": GP, "weeks": [9] * 9}]
    fr = make_frames(spark, rows)
    t = Q.trend(fr, GP, Filters(zone="chapinero")).orderBy("week_index").collect()
    assert [r.week_label for r in t][0] == "L8W" and t[-1].week_label == "L0W" and len(t) == 9
    assert t[-1].wow_change == pytest.approx(-0.5)


def test_data_quality_and_range_text(spark):
    rows = [{"ZONE": "A", "METRIC": LP, "weeks": [4.5]}, {"ZONE": "B", "METRIC": PO, "weeks": [0.9]}]
    out = D.data_quality(make_frames(spark, rows)).collect()
    assert len(out) == 1 and out[0].expected_range == "[0, 2.0]" and out[0].severity == "alta"


def test_opportunity_selection(spark):
    rows = []
    for i in range(8):
        rows.append({"ZONE": f"Z{i}", "METRIC": LP, "weeks": [0.1 * (i + 1)]})
        rows.append({"ZONE": f"Z{i}", "METRIC": PO, "weeks": [0.9 - 0.1 * i]})
        rows.append({"ZONE": f"Z{i}", "METRIC": "Orders", "weeks": [0, 0, 0, 0, 100, 0, 0, 0, 150]})
    out = D.opportunities(make_frames(spark, rows)).orderBy("position").collect()
    assert [r.zone for r in out] == ["Z6", "Z7"]  # equal growth: ties broken by ids
