"""The analytical query catalogue (Q1-Q8 and the E/F helpers around them).

Each function takes ``Frames`` and parameters and returns a lazy DataFrame.
Scalars the original returned next to a table (thresholds, flags) become
columns. Ties are broken by (COUNTRY, CITY, ZONE, METRIC) so limits are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import IDS, WEEK_LABELS
from ..frames import Frames
from ..functions.scalar import floored_pct_change, improvement, pct_change_abs, approx_quantile
from .filters import WEEK_INDEX, Filters, apply_filters, week_or_default
from .scale import average_percent_ranks, cut, group_quantiles

GROUP_COLUMNS = {
    "zone_type": "ZONE_TYPE",
    "ZONE_TYPE": "ZONE_TYPE",
    "country": "COUNTRY",
    "city": "CITY",
    "prioritization": "ZONE_PRIORITIZATION",
    "ZONE_PRIORITIZATION": "ZONE_PRIORITIZATION",
}


def group_column(group_by: str | None) -> str:
    """E5: group alias -> column; other text is upper-cased."""
    if not group_by:
        return "COUNTRY"
    return GROUP_COLUMNS.get(group_by, group_by.upper())


def _order(value: Column, ascending: bool) -> list[Column]:
    return [value.asc() if ascending else value.desc(), *[F.col(c).asc() for c in IDS]]


# --------------------------------------------------------------------- Q1 / B10
def top_zones(
    fr: Frames,
    metric: str,
    week: str = "L0W",
    filters: Filters | None = None,
    top_k: int = 5,
    sort: str = "desc",
) -> DataFrame:
    """Q1: top-k zones by a metric at one week; the lead metric's outliers are left out."""
    df = apply_filters(fr.wide(metric), filters)
    week = week_or_default(df, week)
    df = df.select(*IDS, F.col(week).alias("value")).filter(F.col("value").isNotNull())
    if metric == fr.catalog.lead:
        df = df.filter(F.col("value") < fr.catalog.outlier_limit())
    ordering = _order(F.col("value"), sort == "asc")
    top = df.orderBy(*ordering).limit(top_k)
    return top.select(
        *IDS,
        "value",
        F.row_number().over(Window.orderBy(*ordering)).cast("bigint").alias("rank"),
        F.lit(metric).alias("metric"),
        F.lit(week).alias("week"),
        F.lit("").alias("data_quality_note"),
    )


def outlier_split(fr: Frames, week: str = "L0W", filters: Filters | None = None) -> DataFrame:
    """Lead-metric rows with an ``is_outlier`` flag (value >= the outlier limit)."""
    lead = fr.catalog.lead
    df = apply_filters(fr.wide(lead), filters)
    week = week_or_default(df, week)
    return df.filter(F.col(week).isNotNull()).select(
        *IDS,
        F.col(week).alias("value"),
        (F.col(week) >= fr.catalog.outlier_limit()).alias("is_outlier"),
    )


# ------------------------------------------------------------------ Q2 / Q4 / E
def compare_groups(
    fr: Frames,
    metric: str,
    group_by: str = "ZONE_TYPE",
    week: str = "L0W",
    filters: Filters | None = None,
    agg: str = "mean",
) -> DataFrame:
    """Q2: one value per group at one week; n_zones counts rows; lead metric keeps <= limit."""
    gcol = group_column(group_by)
    base = fr.wide(metric)
    known = week in base.columns  # the outlier rule is skipped for an unknown week, which falls back to L0W
    week = week_or_default(base, week)
    df = base
    if metric == fr.catalog.lead and known:
        limit = fr.catalog.outlier_limit()
        # Anything removed by the <= limit rule (NULLs count as removed)
        excluded = base.select(F.count_if(~F.coalesce(F.col(week) <= limit, F.lit(False))) > 0).scalar()
        df = df.filter(F.col(week) <= limit)
    else:
        excluded = F.lit(False)
    df = apply_filters(df, filters)
    df = df.filter(F.col(week).isNotNull() & F.col(gcol).isNotNull())
    df = df.select(F.col(gcol).alias("group"), F.col(week).alias("value"))
    if agg == "median":
        grouped = group_quantiles(df, {"median": ("value", 0.5)}, ["group"], count="n_zones").withColumnRenamed("median", "value")
    else:
        fn = F.sum if agg == "sum" else F.avg
        grouped = df.groupBy("group").agg(fn("value").alias("value"), F.count(F.lit(1)).cast("bigint").alias("n_zones"))
    return grouped.select(
        "group", "value", "n_zones",
        F.lit(metric).alias("metric"),
        F.lit(week).alias("week"),
        excluded.alias("outliers_excluded"),
    ).orderBy(F.col("value").desc(), "group")


def aggregate_metric(fr: Frames, metric: str, group_by: str = "country", week: str = "L0W",
                     filters: Filters | None = None, agg: str = "mean") -> DataFrame:
    """compare_groups with a country default."""
    return compare_groups(fr, metric, group_by, week, filters, agg)


def gap(fr: Frames, metric: str, group_by: str = "ZONE_TYPE", week: str = "L0W",
        filters: Filters | None = None) -> DataFrame:
    """gap between the two groups of a comparison (first minus second by value desc).

    Returns one row only when exactly two groups exist; ``gap_pp`` is the gap in
    percentage points for ratio metrics.
    """
    groups = compare_groups(fr, metric, group_by, week, filters)
    spec = fr.catalog.get(metric)
    ratio = spec is not None and spec.unit == "ratio"
    top = F.max_by(F.struct("value", "group"), F.struct("value", F.col("group")))
    bottom = F.min_by(F.struct("value", "group"), F.struct("value", F.col("group")))
    out = groups.agg(F.count(F.lit(1)).alias("n_groups"), top.alias("g0"), bottom.alias("g1"))
    diff = F.col("g0.value") - F.col("g1.value")
    return out.filter(F.col("n_groups") == 2).select(
        F.col("g0.group").alias("group_a"),
        F.col("g1.group").alias("group_b"),
        F.col("g0.value").alias("value_a"),
        F.col("g1.value").alias("value_b"),
        diff.alias("gap"),
        (F.abs(diff) * 100).alias("gap_pp") if ratio else F.lit(None).cast("double").alias("gap_pp"),
        F.when(diff > 0, F.col("g0.group")).otherwise(F.col("g1.group")).alias("leader"),
        F.lit(metric).alias("metric"),
    )


# ------------------------------------------------------------------ Q3 trends
def _with_wow(df: DataFrame, partition: list[str]) -> DataFrame:
    """Change against the previous present week, signed denominator."""
    w = Window.partitionBy(*partition).orderBy("week_index") if partition else Window.orderBy("week_index")
    prev = F.lag("value").over(w)
    return df.withColumn("wow_change", (F.try_divide(F.col("value") - prev, prev)))


def trend(
    fr: Frames,
    metric: str,
    filters: Filters | None = None,
    start_week: str = "L8W",
    end_week: str = "L0W",
) -> DataFrame:
    """Q3: mean per week over matching zones (E6); per ZONE when a zone is named.

    The per-week means are averages of the week columns (NULLs ignored), so the
    rows are never expanded 9x into the long form; only the <= 9 results per
    group are unpivoted.
    """
    by_zone = bool(filters and filters.zone)
    df = apply_filters(fr.wide(metric), filters, exact_zone=by_zone)
    lo, hi = WEEK_INDEX.get(start_week, 0), WEEK_INDEX.get(end_week, 8)
    weeks = [w for w in WEEK_LABELS if w in df.columns and lo <= WEEK_INDEX[w] <= hi]
    keys = ["ZONE"] if by_zone else []
    means = df.groupBy(*keys).agg(*[F.avg(w).alias(w) for w in weeks])
    long = means.unpivot(keys, weeks, "week_label", "value").filter(F.col("value").isNotNull())
    index = F.lit(-1)
    for w in weeks:
        index = F.when(F.col("week_label") == w, F.lit(WEEK_INDEX[w])).otherwise(index)
    long = long.withColumn("week_index", index)
    out_keys = ["week_label", "week_index"] + keys
    # at most 9 rows per named zone (or 9 rows overall), so the window is tiny
    out = _with_wow(long, keys)
    return out.select(*out_keys, "value", "wow_change", F.lit(metric).alias("metric"))


def trend_from_wide(
    fr: Frames,
    metric: str,
    filters: Filters | None = None,
    start_week: str = "L8W",
    end_week: str = "L0W",
) -> DataFrame:
    """The trend read straight from wide rows (duplicates averaged first)."""
    by_zone = bool(filters and filters.zone)
    df = apply_filters(fr.wide(metric), filters, exact_zone=by_zone)
    weeks = [w for w in WEEK_LABELS if w in df.columns]
    dedup = df.groupBy(*IDS, "METRIC").agg(*[F.avg(w).alias(w) for w in weeks])
    lo, hi = WEEK_INDEX.get(start_week, 0), WEEK_INDEX.get(end_week, 8)
    if by_zone:
        first = dedup.orderBy(*IDS, "METRIC").limit(1)
        long = first.unpivot([*IDS, "METRIC"], weeks, "week_label", "value")
        keys = [*IDS]
        long = long.select(*IDS, "week_label", "value")
    else:
        long = dedup.unpivot([*IDS, "METRIC"], weeks, "week_label", "value")
        keys = []
    long = long.withColumn("week_index", 8 - F.regexp_extract("week_label", r"L(\d+)W", 1).cast("int"))
    long = long.filter(F.col("week_index").between(lo, hi) & F.col("value").isNotNull())
    series = long.groupBy(*keys, "week_label", "week_index").agg(F.avg("value").alias("value"))
    out = _with_wow(series, [])
    return out.select(*keys, "week_label", "week_index", "value", "wow_change",
                      F.lit(metric).alias("metric"))


def trend_summary(
    fr: Frames, metric: str, filters: Filters | None = None, start_week: str = "L8W", end_week: str = "L0W"
) -> DataFrame:
    """first, last, mean, last WoW and total change of a trend series."""
    series = trend(fr, metric, filters, start_week, end_week)
    first = F.min_by("value", "week_index")
    last = F.max_by("value", "week_index")
    total = F.when(first != 0, (last - first) / F.abs(first)).otherwise(F.lit(0.0))
    return series.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_points"),
        first.alias("first_value"),
        last.alias("last_value"),
        F.avg("value").alias("mean_value"),
        F.max_by("wow_change", "week_index").alias("last_wow"),
        total.alias("total_change"),
    ).filter(F.col("n_points") > 0).withColumns(
        {
            "direction": F.when(F.col("total_change") > 0, "mejoró").otherwise("empeoró"),
            "metric": F.lit(metric),
        }
    )


# ------------------------------------------------------------------ Q5 high/low
def _high_low_pairs(fr: Frames, metric_a: str, metric_b: str, week: str, filters: Filters | None) -> DataFrame:
    """The zones that have both metrics in the week."""
    a = apply_filters(fr.wide(metric_a), filters)
    b = apply_filters(fr.wide(metric_b), filters)
    week = week_or_default(a, week)
    a = a.select(*IDS, F.col(week).alias("value_a"), "ZONE_TYPE", "ZONE_PRIORITIZATION")
    b = b.select(*IDS, F.col(week).alias("value_b"))
    return a.join(b, IDS, "inner").filter(F.col("value_a").isNotNull() & F.col("value_b").isNotNull())


def high_low_outliers(fr: Frames, metric_a: str, metric_b: str, week: str = "L0W", filters: Filters | None = None) -> DataFrame:
    """Q5: the zones that high/low leaves out because metric_a (the lead metric) is at its limit or above, and how many
    they are; no rows for other metrics."""
    merged = _high_low_pairs(fr, metric_a, metric_b, week, filters)
    limit = fr.catalog.outlier_limit() if metric_a == fr.catalog.lead else None
    out = merged.filter(F.col("value_a") >= limit) if limit is not None else merged.filter(F.lit(False))
    return out.withColumn("n_outliers", out.select(F.count(F.lit(1))).scalar())


def high_low(
    fr: Frames,
    metric_a: str,
    metric_b: str,
    direction_a: str = "high",
    direction_b: str = "low",
    week: str = "L0W",
    filters: Filters | None = None,
    percentile_high: float = 0.75,
    percentile_low: float = 0.25,
    approx: bool = False,
) -> DataFrame:
    """Q5: zones where metric_a is high (or low) and metric_b low (or high), by global quantiles."""
    merged = _high_low_pairs(fr, metric_a, metric_b, week, filters)
    if metric_a == fr.catalog.lead:
        merged = merged.filter(F.col("value_a") < fr.catalog.outlier_limit())
    merged = cut(merged)  # read by the thresholds and by the selection
    # Exact linear-interpolated quantiles, all four in one scalar subquery (no join)
    wanted = {"a_high": ("value_a", percentile_high), "b_low": ("value_b", percentile_low),
              "a_low": ("value_a", 1 - percentile_high), "b_high": ("value_b", 1 - percentile_low)}
    found = (merged.select(*[approx_quantile(c, p).alias(n) for n, (c, p) in wanted.items()]) if approx
             else group_quantiles(merged, wanted))
    th = found.select(F.struct(*wanted)).scalar()
    mask_a = F.col("value_a") >= th["a_high"] if direction_a == "high" else F.col("value_a") <= th["a_low"]
    mask_b = F.col("value_b") <= th["b_low"] if direction_b == "low" else F.col("value_b") >= th["b_high"]
    result = merged.filter(mask_a & mask_b).select(
        *IDS, "ZONE_TYPE", "ZONE_PRIORITIZATION", "value_a", "value_b",
        th["a_high"].alias("threshold_a"), th["b_low"].alias("threshold_b"),
    )
    result = average_percent_ranks(result, {"value_a": "percentile_a", "value_b": "percentile_b"})
    return result.select(
        *IDS, "ZONE_TYPE", "ZONE_PRIORITIZATION",
        "value_a",
        "value_b",
        "percentile_a",
        "percentile_b",
        "threshold_a",
        "threshold_b",
        F.lit(metric_a).alias("metric_a"),
        F.lit(metric_b).alias("metric_b"),
        F.lit("").alias("data_quality_note"),
    )


# ------------------------------------------------------------------ Q6 growth
def _growth_base(fr: Frames, n_weeks: int, filters: Filters | None, min_base: float) -> DataFrame:
    start, end = f"L{n_weeks}W", "L0W"
    df = apply_filters(fr.orders_wide, filters)
    df = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    df = df.filter((F.col(start) >= min_base) & (F.col(start) > 0))  # B12
    return df.select(
        *IDS,
        ((F.col(end) - F.col(start)) / F.abs(F.col(start))).alias("growth_pct"),
        F.col(start).alias("orders_start"),
        F.col(end).alias("orders_end"),
        (F.col(end) - F.col(start)).alias("orders_abs_growth"),
    )


def fastest_growing(
    fr: Frames, n_weeks: int = 5, filters: Filters | None = None, top_k: int = 5, min_base: float = 50
) -> DataFrame:
    """Q6: top-k zones by order growth over n weeks (base >= min_base)."""
    base = _growth_base(fr, n_weeks, filters, min_base)
    top = base.orderBy(F.col("growth_pct").desc(), *IDS).limit(top_k)
    return top.select(*IDS, "growth_pct", "orders_start", "orders_end",
                      "orders_abs_growth")


def growth_explain(
    fr: Frames, n_weeks: int = 5, filters: Filters | None = None, top_k: int = 5, min_base: float = 50,
    per_zone: int = 3,
) -> DataFrame:
    """Q6 explanations: the best metric improvements of each top-growth zone.

    Metric rows are matched on (ZONE, COUNTRY) only, as in the original.
    """
    start = f"L{n_weeks}W"
    top = _growth_base(fr, n_weeks, filters, min_base).orderBy(F.col("growth_pct").desc(), *IDS).limit(top_k)
    top = top.select(F.col("ZONE").alias("t_zone"), F.col("COUNTRY").alias("t_country"),
                     F.col("CITY").alias("t_city"), "growth_pct", "orders_start", "orders_end")
    mw = fr.metrics_wide.select("ZONE", "COUNTRY", "METRIC", F.col(start).alias("value_start"),
                                F.col("L0W").alias("value_end"))
    mw = mw.filter(F.col("value_start").isNotNull() & F.col("value_end").isNotNull())
    # top holds at most top_k rows; the metric dimension is catalogue-sized
    # a top zone without metric rows keeps one row with a NULL metric
    found = mw.join(F.broadcast(top.select("t_zone", "t_country").distinct()),
                    (mw.ZONE == F.col("t_zone")) & (mw.COUNTRY == F.col("t_country")), "left_semi")
    joined = top.join(found, (found.ZONE == top.t_zone) & (found.COUNTRY == top.t_country), "left").join(
        F.broadcast(fr.mdim.select("METRIC", "higher_is_better")), "METRIC", "left"
    )
    pct = floored_pct_change(F.col("value_start"), F.col("value_end"))
    joined = joined.withColumn("pct_change", pct).withColumn(
        "improvement", improvement(F.col("pct_change"), F.coalesce("higher_is_better", F.lit(True)))
    )
    w = Window.partitionBy("t_zone", "t_country", "t_city").orderBy(F.col("improvement").desc(), "METRIC")
    ranked = joined.withColumn("improvement_rank", F.row_number().over(w).cast("bigint"))
    return ranked.filter(F.col("improvement_rank") <= per_zone).select(
        F.col("t_zone").alias("zone"), F.col("t_country").alias("country"), F.col("t_city").alias("city"),
        "growth_pct", "orders_start", "orders_end",
        F.col("METRIC").alias("metric"), "value_start",
        "value_end", "pct_change",
        "improvement", "improvement_rank",
    )


# ------------------------------------------------------------------ Q7
def pct_change_table(
    fr: Frames, metric: str | None = None, from_week: str = "L1W", to_week: str = "L0W",
    filters: Filters | None = None,
) -> DataFrame:
    """Q7/F1: (to - from) / |from| per row; a zero base gives +-inf, 0/0 and missing values are dropped."""
    df = fr.fact if not metric else fr.wide(metric)
    df = apply_filters(df, filters)
    return df.select(
        *IDS, "METRIC", "ZONE_TYPE", "ZONE_PRIORITIZATION",
        (pct_change_abs(F.col(from_week), F.col(to_week))).alias("wow_change"),
        F.col(from_week).alias(from_week),
        F.col(to_week).alias(to_week),
    ).filter(F.col("wow_change").isNotNull())


# ------------------------------------------------------------------ E9-E13
def zone_summary(fr: Frames) -> DataFrame:
    """Distinct zones, countries and metrics, and the sorted value lists of the small dimensions (metrics table)."""
    return fr.metrics_wide.agg(
        F.count_distinct("ZONE").cast("bigint").alias("n_zones"),
        F.count_distinct("COUNTRY").cast("bigint").alias("n_countries"),
        F.count_distinct("METRIC").cast("bigint").alias("n_metrics"),
        F.count_distinct("CITY").cast("bigint").alias("n_cities"),
        F.array_join(F.array_sort(F.collect_set("COUNTRY")), "|").alias("countries"),
        F.array_join(F.array_sort(F.collect_set("ZONE_TYPE")), "|").alias("zone_types"),
        F.array_join(F.array_sort(F.collect_set("ZONE_PRIORITIZATION")), "|").alias("prioritizations"),
    )


def zones_per_country(fr: Frames) -> DataFrame:
    """Distinct ZONE per country, most zones first."""
    counts = fr.metrics_wide.groupBy("COUNTRY").agg(F.count_distinct("ZONE").cast("bigint").alias("n_zones"))
    return counts.orderBy(F.col("n_zones").desc(), "COUNTRY")


def metric_histogram(fr: Frames, metric: str, week: str = "L0W", bins: int = 50,
                     lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Fixed-width histogram of a metric per ZONE_TYPE (bounds default to the metric range).

    Values below the first or above the last bin are counted apart, in bins -1 and ``bins``, which are
    open on that side; the last bin includes its upper bound.
    """
    spec = fr.catalog.get(metric)
    lo = spec.lo if lo is None and spec else (lo if lo is not None else 0.0)
    hi = spec.hi if hi is None and spec else (hi if hi is not None else 1.0)
    df = fr.wide(metric).filter(F.col(week).isNotNull())
    width = (hi - lo) / bins
    inside = F.least(F.greatest(F.floor((F.col(week) - lo) / width), F.lit(0)), F.lit(bins - 1))
    b = F.when(F.col(week) < lo, -1).when(F.col(week) > hi, bins).otherwise(inside).cast("bigint")
    return df.groupBy("ZONE_TYPE", b.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        "ZONE_TYPE", "bin",
        F.when(F.col("bin") >= 0, F.lit(lo) + F.col("bin") * width).alias("bin_lo"),
        F.when(F.col("bin") < bins, F.lit(lo) + (F.col("bin") + 1) * width).alias("bin_hi"),
        "n",
    )


def metric_pivot(fr: Frames, week: str = "L0W", metrics: list[str] | None = None) -> DataFrame:
    """Zone x metric matrix at one week (largest value per cell), all-null rows dropped."""
    metrics = metrics or fr.metric_names()
    pv = fr.metrics_wide.groupBy(*IDS).agg(
        *[F.max(F.when(F.col("METRIC") == m, F.col(week))).alias(m) for m in metrics]
    )
    return pv.filter(F.coalesce(*[F.col(f"`{m}`") for m in metrics]).isNotNull())
