"""Automatic insight detectors.

Every detector is one lazy DataFrame. Per-row logic is column arithmetic
joined to the catalogue-sized ``metric_dim`` (broadcast, bounded by the
catalogue). Peer statistics are grouped aggregates joined back on the peer key
(partial aggregation map-side; AQE picks broadcast or skew-split join at
runtime) rather than windows, so a hot peer group never lands in one task.
Bounded outputs (top-n) use ``orderBy().limit()`` (distributed top-k); the
small windows that number the final rows only ever see those few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import IDS
from ..frames import Frames
from ..functions.scalar import clamp, out_of_range, peer_key, approx_quantile, robust_pct_change
from .pairs import pairwise_correlations
from .scale import group_quantiles
from .streaks import trend_rows

LOWER_IDS = {"ZONE": "zone", "COUNTRY": "country", "CITY": "city",
             "ZONE_TYPE": "zone_type", "ZONE_PRIORITIZATION": "zone_prioritization", "METRIC": "metric"}


def _attrs(fr: Frames, df: DataFrame) -> DataFrame:
    """Left-join metric attributes with defaults for uncatalogued metrics."""
    lo_d, hi_d = fr.catalog.unknown_range
    d = F.broadcast(fr.mdim)  # catalogue-sized
    return df.join(d, "METRIC", "left").withColumns(
        {
            "higher_is_better": F.coalesce("higher_is_better", F.lit(True)),
            "unit": F.coalesce("unit", F.lit("ratio")),
            "range_lo": F.coalesce("range_lo", F.lit(float(lo_d))),
            "range_hi": F.coalesce("range_hi", F.lit(float(hi_d))),
            "hi_strict": F.coalesce("hi_strict", F.lit(False)),
            "min_abs_change": F.coalesce("min_abs_change", F.lit(0.0)),
        }
    )


def _oor(c: Column) -> Column:
    return out_of_range(c, F.col("range_lo"), F.col("range_hi"), F.col("hi_strict"))


def _number(df: DataFrame, order: list[Column]) -> DataFrame:
    """Position 1..n of an already limited (small) result."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def _lower_ids(cols: list[str]) -> list[Column]:
    return [F.col(c).alias(LOWER_IDS[c]) for c in cols]


# ---------------------------------------------------------------- D1 anomalies
def anomalies(
    fr: Frames,
    threshold: float = 0.10,
    from_week: str = "L1W",
    to_week: str = "L0W",
    top_n: int = 10,
    reserved: int = 3,
) -> DataFrame:
    """Week-over-week jumps, deteriorations first, with slots reserved for the profit metric."""
    df = _attrs(fr, fr.fact)
    v_from, v_to = F.col(from_week), F.col(to_week)
    df = df.filter(~_oor(v_from) & ~_oor(v_to))
    pct = robust_pct_change(v_from, v_to, F.col("min_abs_change"), F.col("unit"),
                            F.col("abs_delta_min"), F.col("abs_delta_scale"))
    is_abs = F.col("abs_delta_scale").isNotNull()
    eff = F.when(is_abs, F.col("abs_delta_min") / F.col("abs_delta_scale")).otherwise(F.lit(threshold))
    df = df.withColumn("_pct", pct).filter(F.col("_pct").isNotNull() & (F.abs("_pct") >= eff))
    df = df.withColumn("_pct", clamp(F.col("_pct")))
    det = F.when(F.col("higher_is_better"), F.col("_pct") < 0).otherwise(F.col("_pct") > 0)
    df = df.withColumns({"_det": det, "_abs": F.abs("_pct"), "_gp": is_abs})
    order = [F.col("_det").desc(), F.col("_abs").desc(), *[F.col(c).asc() for c in [*IDS, "METRIC"]]]
    cap = top_n * 2
    others = df.filter(~F.col("_gp")).orderBy(*order).limit(cap)
    gp = df.filter(F.col("_gp")).orderBy(*order).limit(reserved)
    # Both lists are already limited (<= cap + reserved rows), so these
    # windows only number a handful of rows
    both = others.unionByName(gp).withColumns({
        "_n_gp": F.count_if(F.col("_gp")).over(Window.partitionBy(F.lit(1))),
        "_pos": F.row_number().over(Window.partitionBy("_gp").orderBy(*order)),
    })
    kept = both.filter(F.col("_gp") | (F.col("_pos") <= F.lit(cap) - F.col("_n_gp")))
    final = _number(kept, order).filter(F.col("position") <= cap)
    return final.select(
        F.lit("anomaly").alias("type"),
        F.when(F.col("_det"), "Deterioro").otherwise("Mejora").alias("category"),
        *_lower_ids(["ZONE", "COUNTRY", "CITY", "ZONE_TYPE", "ZONE_PRIORITIZATION", "METRIC"]),
        F.col(from_week).alias("value_from"),
        F.col(to_week).alias("value_to"),
        F.col("_pct").alias("pct_change"),
        F.when(F.col("_abs") > 0.20, "alta").otherwise("media").alias("severity"),
        "position",
    )


# ---------------------------------------------------------------- D2 trends
def trends_insight(fr: Frames, min_weeks: int = 3, top_n: int = 10) -> DataFrame:
    """Sustained deterioration (longest run), current value in range, longest first."""
    df = trend_rows(fr, min_weeks)
    order = [F.col("consecutive").desc(), *[F.col(c).asc() for c in [*IDS, "METRIC"]]]
    top = df.orderBy(*order).limit(top_n)
    total = (F.col("run_end") - F.col("run_start")) / F.abs(F.col("run_start"))
    return _number(top, order).select(
        F.lit("consistent_deterioration").alias("type"),
        F.lit("Tendencia Preocupante").alias("category"),
        *_lower_ids(["ZONE", "COUNTRY", "CITY", "ZONE_TYPE", "ZONE_PRIORITIZATION", "METRIC"]),
        F.col("consecutive").alias("consecutive_weeks"),
        total.alias("total_pct_change"),
        F.col("L0W").alias("current_value"),
        F.when(F.col("consecutive") >= 5, "alta").otherwise("media").alias("severity"),
        "position",
    )


# ---------------------------------------------------------------- D3 benchmarking
def benchmark_rows(fr: Frames, metrics: list[str], week: str = "L0W") -> DataFrame:
    """Peer z-scores per (METRIC, COUNTRY, ZONE_TYPE) for one or more metrics.

    One partial aggregation for all requested metrics, joined back on the peer
    key; AQE broadcasts the (small) statistics at runtime."""
    df = _attrs(fr, fr.fact.filter(F.col("METRIC").isin(*metrics)))
    df = df.filter(F.col(week).isNotNull() & ~_oor(F.col(week))).withColumn("_v", F.col(week))
    peers = df.groupBy("METRIC", "COUNTRY", "ZONE_TYPE").agg(
        F.avg("_v").alias("group_mean"),
        F.stddev_samp("_v").alias("group_std"),
        F.count("_v").alias("group_count"),
    )
    # NULL peer keys never match: such rows have no peer statistics, as in the original
    df = df.join(peers, ["METRIC", "COUNTRY", "ZONE_TYPE"], "inner")
    return df.withColumn("z_score", (F.col("_v") - F.col("group_mean")) / (F.col("group_std") + 1e-9))


def _benchmark_top(rows: DataFrame, metrics: list[str], z_threshold: float, top_n: int) -> DataFrame:
    """The top_n rows of each metric in one pass: a window group limit keeps top_n rows per metric and
    task before the shuffle, so a metric with very many rows is never ranked whole."""
    df = rows.filter((F.abs("z_score") >= z_threshold) & (F.col("group_count") >= 3))
    w = Window.partitionBy("METRIC").orderBy(F.abs("z_score").desc(), *[F.col(c).asc() for c in IDS])
    top = df.withColumn("position", F.row_number().over(w).cast("bigint")).filter(F.col("position") <= top_n)
    metric_pos = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("METRIC"))
    under = (F.col("z_score") < 0) & F.col("higher_is_better") | (F.col("z_score") > 0) & ~F.col("higher_is_better")
    return top.select(
        F.lit("benchmarking").alias("type"),
        F.lit("Benchmarking").alias("category"),
        *_lower_ids(["ZONE", "COUNTRY", "CITY", "ZONE_TYPE", "ZONE_PRIORITIZATION", "METRIC"]),
        F.col("_v").alias("current_value"),
        "group_mean",
        "z_score",
        F.when(under, "underperformer").otherwise("outperformer").alias("performance"),
        F.when(F.abs("z_score") >= 2.0, "alta").otherwise("media").alias("severity"),
        "position",
        metric_pos.alias("_metric_pos"),
    )


def benchmarking(fr: Frames, metric: str | None = None, week: str = "L0W",
                 z_threshold: float = 1.5, top_n: int = 10) -> DataFrame:
    """D3: zones whose value is >= z_threshold peer standard deviations away (peers of >= 3)."""
    metric = metric or fr.catalog.quality
    return _benchmark_top(benchmark_rows(fr, [metric], week), [metric], z_threshold, top_n).drop("_metric_pos")


def benchmark_metrics(fr: Frames) -> list[str]:
    return [fr.catalog.quality, fr.catalog.lead, fr.catalog.profit]


def benchmarking_all(fr: Frames, metrics: list[str] | None = None, week: str = "L0W",
                     z_threshold: float = 1.5, top_n: int = 5, list_pos: bool = False) -> DataFrame:
    """S3: top-n benchmarks for each of several metrics: one peer aggregation and one top-n pass for all."""
    metrics = metrics or benchmark_metrics(fr)
    out = _benchmark_top(benchmark_rows(fr, metrics, week), metrics, z_threshold, top_n)
    if list_pos:  # numbers at most top_n rows of each metric
        out = out.withColumn("list_pos", F.row_number().over(Window.orderBy("_metric_pos", "position")).cast("bigint"))
    return out.drop("_metric_pos")


# ---------------------------------------------------------------- D4 correlations
def _metric_cells(fr: Frames, week: str) -> DataFrame:
    """One value per zone and metric. Dealt by zone once: the metrics' statistics and the zones' rows both start here."""
    rows = fr.metrics_wide.select(*IDS, "METRIC", F.col(week).alias("v")).repartition(*IDS)
    return rows.groupBy(*IDS, "METRIC").agg(F.max("v").alias("v"))


def _metric_cleanliness(fr: Frames, cells: DataFrame) -> DataFrame:
    """Per metric its non-null zones, their share inside the range (inclusive) and their mean."""
    known = _attrs(fr, cells)
    inside = (F.col("v") >= F.col("range_lo")) & (F.col("v") <= F.col("range_hi"))
    stats = known.groupBy("METRIC").agg(
        F.count("v").alias("n_values"), F.avg(inside.cast("double")).alias("share_in_range"), F.avg("v").alias("mean"))
    clean = (F.col("n_values") > 10) & F.coalesce(F.col("share_in_range") > 0.9, F.lit(False))
    return stats.withColumn("is_clean", clean)


def corr_clean_metrics(fr: Frames, week: str = "L0W") -> DataFrame:
    """Metrics with > 10 non-null zones and > 90 % of values inside the range; catalogued metrics without rows too."""
    stats = _metric_cleanliness(fr, _metric_cells(fr, week))
    listed = fr.mdim.filter(F.col("METRIC") != fr.volume).select("METRIC")
    return stats.join(listed, "METRIC", "full").select(
        F.col("METRIC").alias("metric"), F.coalesce("n_values", F.lit(0)).cast("bigint").alias("n_values"),
        "share_in_range", F.coalesce("is_clean", F.lit(False)).alias("is_clean"))


def correlations(fr: Frames, week: str = "L0W", top_n: int = 5, min_abs_r: float = 0.5) -> DataFrame:
    """Strongest Pearson correlations between clean metrics (|r| >= 0.5)."""
    cells = _metric_cells(fr, week)
    clean = _metric_cleanliness(fr, cells).filter("is_clean")
    pairs = pairwise_correlations(cells, clean, IDS)
    pairs = pairs.filter(F.col("r").isNotNull() & (F.abs("r") >= min_abs_r))
    order = [F.abs("r").desc(), F.col("metric_a"), F.col("metric_b")]
    top = pairs.orderBy(*order).limit(top_n)
    positive = F.col("r") > 0
    return _number(top, order).select(
        F.lit("correlation").alias("type"),
        F.lit("Correlación").alias("category"),
        "metric_a", "metric_b",
        F.col("r").alias("correlation"),
        F.when(positive, "positiva").otherwise("negativa").alias("direction"),
        F.when(F.abs("r") >= 0.7, "alta").otherwise("media").alias("severity"),
        F.concat(F.lit("Zonas con alto "), F.col("metric_a"), F.lit(" tienden a tener "),
                 F.when(positive, "también alto").otherwise("bajo"), F.lit(" "), F.col("metric_b"))
        .alias("interpretation"),
        "position",
    )


# ---------------------------------------------------------------- D5 opportunities
def opportunity_rows(fr: Frames, week: str = "L0W", n_weeks_growth: int = 4,
                     min_orders_base: float = 50, approx: bool = False) -> DataFrame:
    """Lead x quality rows with order growth and peer percentiles (before selection)."""
    cat = fr.catalog
    lead_spec, qual_spec = cat.by_role("lead"), cat.by_role("quality")
    lead = fr.wide(cat.lead).select(*IDS, F.col(week).alias("lead_pen"), "ZONE_TYPE", "ZONE_PRIORITIZATION")
    qual = fr.wide(cat.quality).select(*IDS, F.col(week).alias("perfect_orders"))
    merged = lead.join(qual, IDS, "inner").filter(F.col("lead_pen").isNotNull() & F.col("perfect_orders").isNotNull())
    merged = merged.filter(
        ~out_of_range(F.col("lead_pen"), F.lit(float(lead_spec.lo)), F.lit(float(lead_spec.hi)), F.lit(lead_spec.hi_strict))
        & ~out_of_range(F.col("perfect_orders"), F.lit(float(qual_spec.lo)), F.lit(float(qual_spec.hi)),
                        F.lit(qual_spec.hi_strict))
    )
    start = f"L{n_weeks_growth}W"
    growth = fr.orders_wide.filter(F.col(start).isNotNull() & F.col("L0W").isNotNull())
    growth = growth.filter((F.col(start) >= min_orders_base) & (F.col(start) > 0)).select(
        *IDS,
        ((F.col("L0W") - F.col(start)) / F.abs(F.col(start))).alias("order_growth"),
        F.col(start).alias("orders_base"),
    )
    merged = merged.join(growth, IDS, "left").withColumn("peer_key", peer_key(F.col("COUNTRY"), F.col("ZONE_TYPE")))
    wanted = {"lead_peer_p75": ("lead_pen", 0.75), "perf_peer_p40": ("perfect_orders", 0.40)}
    if approx:
        peers = merged.groupBy("peer_key").agg(*[approx_quantile(c, p).alias(n) for n, (c, p) in wanted.items()])
    else:
        peers = group_quantiles(merged, wanted, ["peer_key"])
    return merged.join(peers, "peer_key", "inner")


def opportunities(fr: Frames, week: str = "L0W", n_weeks_growth: int = 4, min_orders_base: float = 50,
                  top_n: int = 8, approx: bool = False) -> DataFrame:
    """High lead vs peers, low quality vs peers, growing orders."""
    df = opportunity_rows(fr, week, n_weeks_growth, min_orders_base, approx)
    df = df.filter((F.col("lead_pen") >= F.col("lead_peer_p75")) & (F.col("perfect_orders") < F.col("perf_peer_p40")))
    df = df.filter(F.col("order_growth") > 0)
    order = [F.col("order_growth").desc(), *[F.col(c).asc() for c in IDS]]
    top = df.orderBy(*order).limit(top_n)
    return _number(top, order).select(
        F.lit("opportunity").alias("type"),
        F.lit("Oportunidad").alias("category"),
        *_lower_ids(["ZONE", "COUNTRY", "CITY", "ZONE_TYPE", "ZONE_PRIORITIZATION"]),
        F.col("lead_pen").alias("lead_penetration"),
        "perfect_orders",
        F.col("perf_peer_p40").alias("peer_perfect_threshold"),
        F.col("lead_peer_p75").alias("peer_lead_threshold"),
        "order_growth",
        F.col("orders_base"),
        F.lit("media").alias("severity"),
        "position",
    )


# ---------------------------------------------------------------- D6 data quality
def data_quality(fr: Frames, week: str = "L0W", top_n: int = 20) -> DataFrame:
    """Metric values outside the expected range (metrics table only)."""
    df = _attrs(fr, fr.metrics_wide).filter(F.col(week).isNotNull() & _oor(F.col(week)))
    order = [F.col("METRIC"), *[F.col(c) for c in IDS]]
    top = df.orderBy(*order).limit(top_n)
    v = F.col(week)
    return _number(top, order).select(
        F.lit("data_quality").alias("type"),
        F.lit("Calidad de Datos").alias("category"),
        *_lower_ids(["ZONE", "COUNTRY", "CITY", "METRIC"]),
        F.col(week).alias("value"),
        F.coalesce(F.col("range_text"), F.lit("[-1000000000.0, 1000000000.0]")).alias("expected_range"),
        F.when((v > F.col("range_hi") * 2) | (v < F.col("range_lo") * 2), "alta").otherwise("media").alias("severity"),
        "position",
    )
