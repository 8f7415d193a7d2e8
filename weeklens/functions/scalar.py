"""Column expressions shared by queries and detectors.

Everything is a native expression: ANSI-safe division (``try_divide`` or a
guarded ``when``), no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def approx_quantile(c: str, p: float, accuracy: int = 10000) -> Column:
    """The sketch-based estimate of a quantile (exact ones: ``operators.scale.group_quantiles``)."""
    return F.percentile_approx(c, p, accuracy)


def pct_change_abs(v_from: Column, v_to: Column) -> Column:
    """(to - from) / |from|; a zero base gives +-inf, 0/0 NULL."""
    up = F.when(v_to > 0, F.lit(float("inf"))).when(v_to < 0, F.lit(float("-inf")))
    return F.when(v_from == 0, up).otherwise(F.try_divide(v_to - v_from, F.abs(v_from)))


def floored_pct_change(v_from: Column, v_to: Column, floor: float = 1e-3) -> Column:
    """(end - start) / max(|start|, floor)."""
    return (v_to - v_from) / F.greatest(F.abs(v_from), F.lit(floor))


def improvement(pct: Column, higher_is_better: Column) -> Column:
    """a change signed so that positive means better."""
    return F.when(higher_is_better, pct).otherwise(-pct)


def clamp(c: Column, lo: float = -5.0, hi: float = 5.0) -> Column:
    """F5."""
    return F.greatest(F.least(c, F.lit(hi)), F.lit(lo))


def out_of_range(value: Column, lo: Column, hi: Column, hi_strict: Column) -> Column:
    """Value outside [lo, hi] (or [lo, hi) when strict); NULL value -> false."""
    inside = (value >= lo) & F.when(hi_strict, value < hi).otherwise(value <= hi)
    return F.coalesce(~inside, F.lit(False))


def robust_pct_change(
    v_from: Column,
    v_to: Column,
    min_abs: Column,
    unit: Column,
    abs_delta_min: Column,
    abs_delta_scale: Column,
) -> Column:
    """dual-guard change. NULL when undefined or below the metric's minimum move.

    Metrics with an absolute-delta path (``abs_delta_scale`` set) give
    sign * |delta| / scale once |delta| >= abs_delta_min; others divide by
    max(|from|, 1.0 for counts else 0.001).
    """
    delta = v_to - v_from
    adelta = F.abs(delta)
    floor = F.when(unit == "count", F.lit(1.0)).otherwise(F.lit(0.001))
    standard = delta / F.greatest(F.abs(v_from), floor)
    absolute = F.when(
        adelta >= abs_delta_min, F.when(delta > 0, F.lit(1.0)).otherwise(F.lit(-1.0)) * adelta / abs_delta_scale
    )
    return F.when(
        v_from.isNotNull() & v_to.isNotNull() & (adelta >= min_abs),
        F.when(abs_delta_scale.isNotNull(), absolute).otherwise(standard),
    )


def peer_key(country: Column, zone_type: Column) -> Column:
    """COUNTRY + '_' + coalesce(ZONE_TYPE, 'unknown')."""
    return F.concat(country, F.lit("_"), F.coalesce(zone_type, F.lit("unknown")))
