"""Runs of consecutive deteriorating weeks (W7), shared by Q8 and D2.

The nine weekly values already sit in one wide row, so the run is a fold
(``aggregate`` higher-order function) over the eight (previous, current) week
pairs: a narrow projection with no shuffle and no window, whatever the data
size or skew.

Step rules: a step with a NULL side or a zero previous value resets the run;
a deteriorating step (lower when higher is better, higher otherwise) extends
it; anything else, equality included, resets it. The result is the longest
run, while start/end values belong to the *last* run that occurred.

Histories of any length (``long_streaks``) are kept as one row per period: chunks of periods are summed up
on their own, and the summaries combine associatively, so no task ever holds a whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import IDS, WEEK_LABELS
from ..frames import Frames
from ..functions.scalar import out_of_range
from .filters import Filters, apply_filters


def with_streaks(wide: DataFrame, hib_col: str = "higher_is_better") -> DataFrame:
    """Add ``consecutive`` (longest run), ``run_start``, ``run_end`` to wide rows."""
    weeks = F.array(*[F.col(w) for w in WEEK_LABELS])
    pairs = F.arrays_zip(F.slice(weeks, 1, 8).alias("p"), F.slice(weeks, 2, 8).alias("c"))
    hib = F.coalesce(F.col(hib_col), F.lit(True))
    init = F.struct(
        F.lit(0).alias("cons"), F.lit(0).alias("best"),
        F.lit(None).cast("double").alias("start"), F.lit(None).cast("double").alias("end"),
    )

    def step(acc, x):
        p, c = x["p"], x["c"]
        broken = p.isNull() | c.isNull() | (p == 0)
        worse = F.when(hib, c < p).otherwise(c > p)
        extend = ~broken & worse
        cons = F.when(extend, acc["cons"] + 1).otherwise(F.lit(0))
        return F.struct(
            cons.alias("cons"),
            F.greatest(acc["best"], cons).alias("best"),
            F.when(extend & (acc["cons"] == 0), p).otherwise(acc["start"]).alias("start"),
            F.when(extend, c).otherwise(acc["end"]).alias("end"),
        )

    folded = F.aggregate(pairs, init, step)
    return wide.withColumn("_run", folded).withColumns(
        {
            "consecutive": F.col("_run.best").cast("bigint"),
            "run_start": F.col("_run.start"),
            "run_end": F.col("_run.end"),
        }
    ).drop("_run")


#: Periods to a chunk of a long history.
CHUNK = 1024


def _one_period(x: Column) -> Column:
    """Summary of a single period: no step, so every run is empty."""
    none, zero = F.lit(None), F.lit(0).cast("bigint")
    return F.struct(
        x["period"].alias("first"), x["value"].alias("first_v"), x["period"].alias("last"), x["value"].alias("last_v"),
        F.lit(True).alias("full"), zero.alias("prefix"), zero.alias("suffix"), zero.alias("best"),
        none.cast("bigint").alias("run_first"), none.cast("double").alias("start"), none.cast("double").alias("end"))


def _combine(a: Column, b: Column, hib: Column) -> Column:
    """Summary of two neighbouring stretches of periods, ``a`` before ``b``; associative.

    A summary holds its first and last period and value, whether all its steps deteriorate (``full``), the
    runs at its beginning and end, the longest run, and where its last run began, with that run's values."""
    p, c = a["last_v"], b["first_v"]
    step = (b["first"] == a["last"] + 1) & (p != 0) & F.when(hib, c < p).otherwise(c > p)
    ext = F.coalesce(step, F.lit(False))
    zero = F.lit(0).cast("bigint")
    across = F.when(ext, a["suffix"] + 1 + b["prefix"]).otherwise(zero)
    # b's own last run stands unless it is the continuation of a's
    own = b["run_first"].isNotNull() & ~(ext & (b["run_first"] == b["first"]))
    opened = a["suffix"] > 0

    def last(of_b: Column, of_step: Column, of_a: Column) -> Column:
        return F.when(own, of_b).when(ext, of_step).otherwise(of_a)

    return F.struct(
        a["first"].alias("first"), a["first_v"].alias("first_v"), b["last"].alias("last"), b["last_v"].alias("last_v"),
        (a["full"] & ext & b["full"]).alias("full"),
        F.when(a["full"] & ext, a["prefix"] + 1 + b["prefix"]).otherwise(a["prefix"]).alias("prefix"),
        F.when(b["full"] & ext, a["suffix"] + 1 + b["suffix"]).otherwise(b["suffix"]).alias("suffix"),
        F.greatest(a["best"], b["best"], across).alias("best"),
        last(b["run_first"], F.when(opened, a["run_first"]).otherwise(a["last"]), a["run_first"]).alias("run_first"),
        last(b["start"], F.when(opened, a["start"]).otherwise(p), a["start"]).alias("start"),
        last(b["end"], F.coalesce(b["end"], c), a["end"]).alias("end"))


def _fold(parts: Column, hib: Column) -> Column:
    """Ordered summaries (at least one) combined from the left."""
    return F.aggregate(F.slice(parts, 2, F.size(parts)), F.element_at(parts, 1), lambda a, b: _combine(a, b, hib))


def long_streaks(long: DataFrame, keys: list[str], period: str = "period", value: str = "value",
                 higher_is_better: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """W7 over histories of any length: ``keys``, n_periods, consecutive (longest run), run_start, run_end.

    ``long`` has one row per key and period (an integer, one more for each next period); a period without a row
    or value breaks a run, as does a zero before the step; a repeated period breaks it too. Rows without a
    period say nothing. ``higher_is_better`` is a boolean column that is constant for a key (null or absent:
    true). Null keys are keys of their own; an empty table gives an empty result.

    Two exchanges: by (key, chunk of periods), each group at most ``chunk`` periods, then one summary per chunk
    by key."""
    hib = F.coalesce(F.col(f"`{higher_is_better}`"), F.lit(True)) if higher_is_better else F.lit(True)
    names = [f"k{i}" for i in range(len(keys))]
    rows = long.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)], hib.alias("hib"),
                       F.col(f"`{period}`").cast("bigint").alias("period"), F.col(f"`{value}`").cast("double").alias("value"))
    rows = rows.filter(F.col("period").isNotNull()).withColumn("chunk", F.floor(F.col("period") / chunk))
    chunks = rows.groupBy(*names, "hib", "chunk").agg(F.array_sort(F.collect_list(F.struct("period", "value"))).alias("x"))
    chunks = chunks.select(*names, "hib", F.size("x").cast("bigint").alias("n"),
                           _fold(F.transform("x", _one_period), F.col("hib")).alias("s"))
    whole = chunks.groupBy(*names, "hib").agg(
        F.sum("n").alias("n_periods"),
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("s.first"), F.col("s")))), lambda x: x["s"]).alias("parts"))
    out = whole.select(*names, "n_periods", _fold(F.col("parts"), F.col("hib")).alias("s"))
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "n_periods",
                      F.col("s.best").alias("consecutive"), F.col("s.start").alias("run_start"), F.col("s.end").alias("run_end"))


def _with_attrs(fr: Frames, df: DataFrame) -> DataFrame:
    # catalogue-sized dimension: a proven bound, broadcast is safe
    return df.join(F.broadcast(fr.mdim), "METRIC", "left")


def deterioration(fr: Frames, min_weeks: int = 3, filters: Filters | None = None) -> DataFrame:
    """Q8: zone-metrics with a run of at least ``min_weeks`` deteriorating weeks."""
    df = _with_attrs(fr, apply_filters(fr.metrics_wide, filters))
    df = with_streaks(df).filter(F.col("consecutive") >= min_weeks)
    total = F.try_divide(F.col("run_end") - F.col("run_start"), F.abs(F.col("run_start")))
    return df.select(
        *IDS, "METRIC", "ZONE_TYPE", "ZONE_PRIORITIZATION",
        F.col("consecutive").alias("consecutive_deterioration_weeks"),
        total.alias("total_pct_change"),
        F.col("L0W").alias("L0W_value"),
    )


def deterioration_matrix(fr: Frames, min_weeks: int = 3, top_n: int = 20) -> DataFrame:
    """ZONE x METRIC matrix of run lengths (mean, missing -> 0), top zones by row max."""
    det = deterioration(fr, min_weeks)
    metrics = fr.metric_names()
    pv = det.groupBy("ZONE").agg(
        *[F.coalesce(F.avg(F.when(F.col("METRIC") == m, F.col("consecutive_deterioration_weeks"))), F.lit(0.0))
          .alias(m) for m in metrics]
    )
    largest = F.greatest(*[F.col(f"`{m}`") for m in metrics]) if len(metrics) > 1 else F.col(f"`{metrics[0]}`")
    pv = pv.withColumn("max_weeks", largest)
    return pv.orderBy(F.col("max_weeks").desc(), "ZONE").limit(top_n)


def trend_rows(fr: Frames, min_weeks: int = 3) -> DataFrame:
    """D2 rows before ranking: runs >= min_weeks whose current value is in range."""
    df = _with_attrs(fr, fr.metrics_wide)
    lo = F.coalesce(F.col("range_lo"), F.lit(fr.catalog.unknown_range[0]))
    hi = F.coalesce(F.col("range_hi"), F.lit(fr.catalog.unknown_range[1]))
    strict = F.coalesce(F.col("hi_strict"), F.lit(False))
    df = df.filter(~out_of_range(F.col("L0W"), lo, hi, strict))
    df = with_streaks(df).filter((F.col("consecutive") >= min_weeks) & F.col("run_start").isNotNull())
    return df
