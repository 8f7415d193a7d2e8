"""Property checks on the sf0.01 test tables, in the style of the original test suite."""

import os

import pytest
from pyspark.sql import functions as F

from weeklens.catalog import TESTDATA_CATALOG as CAT
from weeklens.frames import testdata_frames as load_frames
from weeklens.operators import prep
from weeklens.operators import queries as Q
from weeklens.operators import streaks as S
from weeklens.operators import text as X
from weeklens.operators.filters import Filters

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def fr(spark):
    return load_frames(spark, SF)


def test_top_zones_sorted_bounded_and_outliers_removed(fr):
    rows = Q.top_zones(fr, CAT.lead, top_k=10).orderBy("rank").collect()
    vals = [r.value for r in rows]
    assert 0 < len(rows) <= 10 and vals == sorted(vals, reverse=True)
    assert max(vals) < CAT.outlier_limit() and [r.rank for r in rows] == list(range(1, len(rows) + 1))
    assert Q.outlier_split(fr).filter("is_outlier").count() > 0  # the limit actually removed something


def test_top_zones_orders_and_country_filter(fr):
    assert Q.top_zones(fr, "Orders").count() > 0
    rows = Q.top_zones(fr, CAT.quality, filters=Filters(country="africa"), top_k=10).collect()
    assert rows and all(r.COUNTRY == "AFRICA" for r in rows)


def test_compare_groups(fr):
    g = {r.group for r in Q.compare_groups(fr, CAT.quality, "ZONE_TYPE").collect()}
    assert g == {"Wealthy", "Non Wealthy"}
    assert Q.compare_groups(fr, CAT.lead, "country").count() > 1
    assert Q.compare_groups(fr, CAT.quality, "country", filters=Filters(zone_type="Wealthy")).count() > 0


def test_trend_points(fr):
    rows = Q.trend(fr, CAT.quality, Filters(zone="supplier#000000001")).orderBy("week_index").collect()
    assert 0 < len(rows) <= 9 and rows[-1].week_label == "L0W"
    assert [r.week_index for r in rows] == sorted(r.week_index for r in rows)


def test_high_low_thresholds(fr):
    rows = Q.high_low(fr, CAT.lead, CAT.quality).collect()
    assert rows
    assert all(r.value_a >= r.threshold_a * 0.99 and r.value_b <= r.threshold_b for r in rows)
    assert rows[0].threshold_a < CAT.outlier_limit()
    assert all(0 < r.percentile_a <= 1 and 0 < r.percentile_b <= 1 for r in rows)


def test_fastest_growing_sorted(fr):
    vals = [r.growth_pct for r in Q.fastest_growing(fr, 5, top_k=5, min_base=50).collect()]
    assert vals == sorted(vals, reverse=True) and len(vals) <= 5


def test_deterioration_min_weeks(fr):
    rows = S.deterioration(fr, 3).collect()
    assert rows and all(r.consecutive_deterioration_weeks >= 3 for r in rows)


def test_data_integrity(fr):
    checks = {r.rule: r.violations for r in prep.expect_checks(
        fr.metrics_wide, fr.orders_wide, ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
        ["Wealthy", "Non Wealthy"]).collect()}
    assert set(checks.values()) == {0}
    assert prep.key_uniqueness(fr.fact).count() == 0


def test_location_repair_and_filter_policy(spark, fr):
    req = spark.createDataFrame(
        [(0, 0, "trend", None, "SUPPLIER#000000001", None, None, "Non Wealthy", None, None, "Non Wealthy", None),
         (0, 1, "comparison", "ZONE_TYPE", None, None, "AMERICA", "Non Wealthy", None, None, "Non Wealthy", None)],
        "conv_id long, turn long, intent string, group_by string, city string, zone string, country string,"
        " zone_type string, prioritization string, sb_country string, sb_zone_type string,"
        " sb_prioritization string")
    fixed = {r.turn: r for r in X.repair_location(req, fr.metrics_wide).collect()}
    place = fr.metrics_wide.filter("ZONE = 'Supplier#000000001'").first()
    assert (fixed[0].zone, fixed[0].city, fixed[0].country) == (place.ZONE, place.CITY, place.COUNTRY)
    assert fixed[0].city_to_zone and fixed[0].unique_zone
    pol = {r.turn: r for r in X.filter_policy(req.withColumn("zone", F.when(F.col("turn") == 0, "x"))).collect()}
    assert pol[0].eff_zone_type is None and pol[1].eff_zone_type is None and pol[1].n_warnings == 2


def test_high_low_approx_close_to_exact(fr):
    exact = Q.high_low(fr, CAT.lead, CAT.quality).first()
    approx = Q.high_low(fr, CAT.lead, CAT.quality, approx=True).first()
    assert approx is not None and abs(approx.threshold_a - exact.threshold_a) < 0.1


def test_invariants(fr):
    from weeklens.operators import detectors as D

    # outlier sets are disjoint from the ranking
    ranked = {r.ZONE for r in Q.top_zones(fr, CAT.lead, top_k=1000).collect()}
    outliers = {r.ZONE for r in Q.outlier_split(fr).filter("is_outlier").collect()}
    assert ranked and outliers and not (ranked & outliers)
    # group counts add up to the rows that were grouped
    n = sum(r.n_zones for r in Q.compare_groups(fr, CAT.quality, "country").collect())
    assert n == fr.wide(CAT.quality).filter(F.col("L0W").isNotNull()).count()
    # correlations are bounded, anomaly lists capped at 2 x top_n
    assert all(abs(r.correlation) <= 1 for r in D.correlations(fr, top_n=50, min_abs_r=0.0).collect())
    assert D.anomalies(fr).count() <= 20
