"""Registered queries: one callable per operator key, with the parameters used on the test tables.

Every callable takes (spark, sf_dir) and returns a lazy DataFrame over the whole
test tables. Parameters follow the original defaults. The operators return exact
values; what is rounded for comparison between engines is rounded here.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import TESTDATA_CATALOG as CAT
from ..frames import FACT_COLUMNS, Frames, testdata_frames
from ..operators import detectors as D
from ..operators import prep
from ..operators import queries as Q
from ..operators import report as R
from ..operators import streaks as S
from ..operators.filters import Filters, apply_filters, week_range
from ..functions import fmt as FM
from ..functions.scalar import out_of_range, pct_change_abs
from ..operators import text as X
from ..session import scratch_path
from ..sources import requests as RQ
from ..sources import sinks, tables, testdata

LEAD, QUAL, PROFIT, VOL = CAT.lead, CAT.quality, CAT.profit, CAT.volume_metric
TREND_ZONE = "supplier#000000001"
MIN_BASE = 50
COUNTRIES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
ZONE_TYPES = ["Wealthy", "Non Wealthy"]


def _fr(spark: SparkSession, sf: str):
    return testdata_frames(spark, sf, CAT)


def _raw_m(spark, sf, cells=None):
    return testdata.raw_metrics(spark, sf, cells)


def _raw_o(spark, sf, cells=None):
    return testdata.raw_orders(spark, sf, cells)


def _orders_enriched(spark, sf):
    cells = testdata.order_cells(spark, sf)  # one plan instance: both sheets read the same exchange
    return prep.orders_enriched(prep.clean_orders(_raw_o(spark, sf, cells)),
                                prep.zone_dim(prep.clean_metrics(_raw_m(spark, sf, cells))))


def _materialized(spark, sf):
    """The fact table as it was written and read back."""
    return _fr(spark, sf).fact.select(*FACT_COLUMNS)


def _exported(spark, sf):
    """The top zones written as CSV into the shared folder and read back."""
    top = QUERIES["top_zones"](spark, sf)
    path = _scratch(spark, "export")
    sinks.export_csv(top, path)
    return sinks.read_csv(spark, path, top.schema).fillna("")  # CSV keeps no difference of empty and missing text


def _filter_rows(f: Filters, exact: bool = False, metric: str = QUAL):
    def run(spark, sf):
        df = apply_filters(_fr(spark, sf).wide(metric), f, exact_zone=exact)
        return df.select("COUNTRY", "CITY", "ZONE", "ZONE_TYPE", "ZONE_PRIORITIZATION", "L0W")
    return run


def _week_range(spark, sf):
    df = week_range(_fr(spark, sf).long(QUAL), "L5W", "L1W")
    return df.select("COUNTRY", "CITY", "ZONE", "week_label", "week_index", "value")


def _range_predicate(spark, sf):
    fr = _fr(spark, sf)
    df = fr.fact.join(F.broadcast(fr.mdim), "METRIC", "left")
    return df.select("COUNTRY", "CITY", "ZONE", "METRIC", F.col("L0W").alias("value"),
                     out_of_range(F.col("L0W"), F.col("range_lo"), F.col("range_hi"), F.col("hi_strict"))
                     .alias("out_of_range"))


def _scratch(spark, name):
    return scratch_path(spark, f"weeklens-{name}/{uuid.uuid4().hex}")


def _sheet(raw):
    """A1/A2: the raw sheet as a CSV file, read back with its header."""
    def run(spark, sf):
        df = raw(spark, sf)
        path = _scratch(spark, "sheet")
        sinks.export_csv(df, path)
        return prep.strip_header(tables.load_sheet(spark, path, df.schema, "csv"))
    return run


def _metric_dictionary(spark, sf):
    """A3: the dictionary read from a JSON file, with the rows that each metric has in the fact table."""
    fr = _fr(spark, sf)
    path = _scratch(spark, "dictionary")
    tables.write_metric_dictionary(spark, CAT, path)
    attrs, aliases = tables.load_metric_dictionary(spark, path)
    live = Frames(spark, fr.fact, tables.load_catalog(spark, path, CAT)).mdim.select("METRIC", "hi_strict", "min_abs_change")
    listed = aliases.groupBy("METRIC").agg(
        F.count(F.lit(1)).alias("n_aliases"), F.sort_array(F.collect_list(F.struct("alias_pos", "alias"))).alias("a"))
    seen = fr.fact.groupBy("METRIC").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
    # dictionary tables: one row per catalogued metric
    out = seen.join(F.broadcast(attrs), "METRIC", "left").join(F.broadcast(listed), "METRIC", "left").join(
        F.broadcast(live), "METRIC", "left")
    return out.select(
        "METRIC", "n_rows", "higher_is_better", "unit", "range_lo", "range_hi", "hi_strict", "min_abs_change", "category",
        "n_aliases", F.array_join("a.alias", "|").alias("aliases"))


def _formats(kind: str):
    def run(spark, sf):
        fr = _fr(spark, sf)
        df = fr.fact.join(F.broadcast(fr.mdim.select("METRIC", "unit")), "METRIC", "left")
        unit = F.coalesce(F.col("unit"), F.lit("ratio"))
        if kind == "value":
            v, text = F.col("L0W"), FM.format_value(F.col("L0W"), unit)
        elif kind == "decimal":
            v, text = F.col("L0W"), FM.format_value_decimal(F.col("L0W"), unit)
        else:
            v = pct_change_abs(F.col("L1W"), F.col("L0W"))
            text = FM.format_change(v)
        return df.select("COUNTRY", "CITY", "ZONE", "METRIC", v.alias("value"), text.alias("text"))
    return run


def _cards(spark, sf):
    fr = _fr(spark, sf)
    return R.insight_card(R.insights_table(fr, min_orders_base=MIN_BASE), [CAT.profit])


def _sheet_audit(spark, sf):
    cells = testdata.order_cells(spark, sf)
    return prep.sheet_audit(prep.clean_metrics(_raw_m(spark, sf, cells)), prep.clean_orders(_raw_o(spark, sf, cells)))


def _long_streaks(spark, sf):
    runs = S.long_streaks(testdata.weekly_units(spark, sf), ["ZONE"])
    return runs.filter(F.col("consecutive") >= 3)


def _expect(spark, sf):
    fr = _fr(spark, sf)
    return prep.expect_checks(fr.metrics_wide, fr.orders_wide, COUNTRIES, ZONE_TYPES)


EXACT: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # --- sources, cleaning, reshape (A*)
    "load_metrics": _sheet(_raw_m),
    "load_orders": _sheet(_raw_o),
    "metric_dictionary": _metric_dictionary,
    "clean_dedup": lambda s, sf: prep.clean_dedup(_raw_m(s, sf)),
    "clean_trim": lambda s, sf: prep.clean_trim(prep.clean_dedup(_raw_m(s, sf)), prep.METRIC_DIMS),
    "clean_numeric": lambda s, sf: prep.clean_metrics(_raw_m(s, sf)),
    "melt_long": lambda s, sf: prep.melt_long(prep.clean_metrics(_raw_m(s, sf))),
    "zone_dim": lambda s, sf: prep.zone_dim(prep.clean_metrics(_raw_m(s, sf))),
    "orders_enriched": _orders_enriched,
    "materialize": _materialized,
    "export_csv": _exported,
    "key_uniqueness": lambda s, sf: prep.key_uniqueness(_fr(s, sf).fact),
    "expect_checks": _expect,
    "sheet_audit": _sheet_audit,
    # --- filters (B*)
    "filter_country": _filter_rows(Filters(country="america")),
    "filter_city": _filter_rows(Filters(city="nation_3")),
    "filter_zone_contains": _filter_rows(Filters(zone="00007")),
    "filter_zone_exact": _filter_rows(Filters(zone=TREND_ZONE), exact=True),
    "filter_zone_type": _filter_rows(Filters(zone_type="wealthy")),
    "filter_priority": _filter_rows(Filters(prioritization="HIGH PRIORITY")),
    "filter_week_range": _week_range,
    "outlier_split": lambda s, sf: Q.outlier_split(_fr(s, sf)),
    "range_predicate": _range_predicate,
    # --- queries (Q*, E*, F12, F13)
    "top_zones": lambda s, sf: Q.top_zones(_fr(s, sf), LEAD, "L0W", None, 10, "desc"),
    "compare_groups": lambda s, sf: Q.compare_groups(_fr(s, sf), QUAL, "ZONE_TYPE"),
    "aggregate_metric": lambda s, sf: Q.aggregate_metric(_fr(s, sf), LEAD),
    "agg_median": lambda s, sf: Q.compare_groups(_fr(s, sf), PROFIT, "city", agg="median"),
    "agg_sum": lambda s, sf: Q.compare_groups(_fr(s, sf), VOL, "prioritization", agg="sum"),
    "trend_all": lambda s, sf: Q.trend(_fr(s, sf), QUAL),
    "trend_zone": lambda s, sf: Q.trend(_fr(s, sf), QUAL, Filters(zone=TREND_ZONE)),
    "trend_from_wide": lambda s, sf: Q.trend_from_wide(_fr(s, sf), PROFIT, Filters(zone=TREND_ZONE)),
    "high_low": lambda s, sf: Q.high_low(_fr(s, sf), LEAD, QUAL),
    "high_low_outliers": lambda s, sf: Q.high_low_outliers(_fr(s, sf), LEAD, QUAL),
    "fastest_growing": lambda s, sf: Q.fastest_growing(_fr(s, sf), 5, None, 5, MIN_BASE),
    "growth_explain": lambda s, sf: Q.growth_explain(_fr(s, sf), 5, None, 5, MIN_BASE),
    "pct_change_abs": lambda s, sf: Q.pct_change_table(_fr(s, sf)),
    "deterioration": lambda s, sf: S.deterioration(_fr(s, sf), 3),
    "long_streaks": _long_streaks,
    "deterioration_matrix": lambda s, sf: S.deterioration_matrix(_fr(s, sf), 3, 20),
    "zone_summary": lambda s, sf: Q.zone_summary(_fr(s, sf)),
    "zones_per_country": lambda s, sf: Q.zones_per_country(_fr(s, sf)),
    "metric_histogram": lambda s, sf: Q.metric_histogram(_fr(s, sf), QUAL),
    "metric_pivot": lambda s, sf: Q.metric_pivot(_fr(s, sf)),
    "gap": lambda s, sf: Q.gap(_fr(s, sf), QUAL, "ZONE_TYPE"),
    "trend_summary": lambda s, sf: Q.trend_summary(_fr(s, sf), QUAL, Filters(zone=TREND_ZONE)),
    # --- detectors (D*)
    "anomalies": lambda s, sf: D.anomalies(_fr(s, sf)),
    "trends_insight": lambda s, sf: D.trends_insight(_fr(s, sf)),
    "benchmarking": lambda s, sf: D.benchmarking_all(_fr(s, sf)),
    "correlations": lambda s, sf: D.correlations(_fr(s, sf)),
    "corr_clean_metrics": lambda s, sf: D.corr_clean_metrics(_fr(s, sf)),
    "opportunities": lambda s, sf: D.opportunities(_fr(s, sf), min_orders_base=MIN_BASE),
    "data_quality": lambda s, sf: D.data_quality(_fr(s, sf)),
    "all_insights": lambda s, sf: R.all_insights(_fr(s, sf), min_orders_base=MIN_BASE),
    "insight_counts": lambda s, sf: R.insight_counts(R.insights_table(_fr(s, sf), min_orders_base=MIN_BASE)),
    "diversified_top5": lambda s, sf: R.diversified_top5(R.insights_table(_fr(s, sf), min_orders_base=MIN_BASE)),
    "report_sections": lambda s, sf: R.report_sections(R.insights_table(_fr(s, sf), min_orders_base=MIN_BASE)),
    "insight_card": _cards,
    # --- display formats
    "format_value": _formats("value"),
    "format_value_decimal": _formats("decimal"),
    "format_change": _formats("change"),
    # --- text jobs over the conversations table (X*)
    "resolve_labels": lambda s, sf: X.resolve_labels(RQ.labels(s, sf)),
    "resolve_country": lambda s, sf: X.resolve_country(RQ.attribute_labels(s, sf)),
    "resolve_zone_type": lambda s, sf: X.resolve_zone_type(RQ.attribute_labels(s, sf)),
    "resolve_priority": lambda s, sf: X.resolve_priority(RQ.attribute_labels(s, sf)),
    "week_scope": lambda s, sf: X.week_scope(RQ.messages(s, sf)),
    "concept_tag": lambda s, sf: X.concept_tag(RQ.messages(s, sf)),
    "intent_tag": lambda s, sf: X.intent_tag(RQ.messages(s, sf), _fr(s, sf).metrics_wide),
    "extract_params": lambda s, sf: X.extract_params(RQ.messages(s, sf), _fr(s, sf).metrics_wide),
    "gazetteer_tag": lambda s, sf: X.gazetteer_tag(RQ.messages(s, sf), _fr(s, sf).metrics_wide),
    "context_carry": lambda s, sf: X.context_carry(RQ.messages(s, sf), _fr(s, sf).metrics_wide),
    "zone_catalog": lambda s, sf: X.zone_catalog(_fr(s, sf).metrics_wide),
    "repair_location": lambda s, sf: X.repair_location(RQ.requests(s, sf), _fr(s, sf).metrics_wide),
    "filter_policy": lambda s, sf: X.filter_policy(RQ.requests(s, sf)),
    "trivial_filter_flag": lambda s, sf: X.trivial_filter_flag(RQ.requests(s, sf)),
    "metric_tag": lambda s, sf: X.metric_tag(RQ.messages(s, sf)),
    "metric_pair_tag": lambda s, sf: X.metric_pair_tag(RQ.messages(s, sf), _fr(s, sf).metrics_wide),
    "normalize_requests": lambda s, sf: X.normalize_requests(RQ.requests(s, sf)),
}

# Means and interpolated quantiles of 6-decimal values fall on 6-decimal ties; they are compared with more digits.
DIGITS = {"threshold_a": 9, "threshold_b": 9, "peer_perfect_threshold": 9, "peer_lead_threshold": 9, "group_mean": 10}
KEY_DIGITS = {"agg_median": 9, "compare_groups": 10, "aggregate_metric": 10, "trend_all": 10, "trend_zone": 10}


def _rounded(key: str, run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with its floating columns rounded, so that two engines can be compared."""
    def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        digits = {c: DIGITS.get(c, KEY_DIGITS.get(key, 6)) for c, kind in df.dtypes if kind == "double"}
        return df.withColumns({c: F.round(F.col(f"`{c}`"), d) for c, d in digits.items()}) if digits else df
    return rounded


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _rounded(k, f) for k, f in EXACT.items()}

__all__ = ["QUERIES", "FACT_COLUMNS"]
