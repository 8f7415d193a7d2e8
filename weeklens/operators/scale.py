"""Distributed building blocks for order-dependent computations.

A window without ``partitionBy``, or an aggregate that keeps every value of a group, moves a whole
group into one task. The helpers here select and rank exactly without either.

Selection (``group_quantiles``). A sketch of each group brackets the wanted position between two of its
values; one more pass counts the rows below, on and above the bracket and keeps only what lies strictly
inside, about ``6 / ACCURACY`` of the group (a value frequent enough to fill a bracket is an end of it,
and ends are only counted). Groups too large for that are bracketed again, inside the bracket, until
a bracket holds about ``INSIDE`` values. Nothing but these brackets and counts is shuffled. The sketch
only chooses the bracket: a position outside of it raises an error, it never gives a wrong value.

Ranking (``average_percent_ranks``). Values are counted with map-side combine, the distinct ones are
range-partitioned by boundaries sampled from the data into as many ranges of ``RANGE_ROWS`` as they
need, the ranges' counts give every range its offset, and only inside a range are values put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ACCURACY = 10_000
#: Values that an open bracket may hold, and steps by which a refinement divides it.
INSIDE, STEPS = 1 << 16, 64
#: Distinct values that are put in order in one task.
RANGE_ROWS = 1 << 18


def cut(df: DataFrame) -> DataFrame:
    """Materialize once, as a reliable checkpoint: what follows reads it instead of planning the input again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _with_bounds(src: DataFrame, bounds: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """``src`` with the columns ``names`` of its group's row (a scalar subquery where there is one group)."""
    if keys:
        return src.join(bounds.select(*keys, *names), keys)
    row = bounds.select(F.struct(*names)).scalar()
    return src.withColumns({n: row[n] for n in names})


def _refined(src: DataFrame, bounds: DataFrame, wanted: dict[str, tuple[str, float]], keys: list[str]) -> DataFrame:
    """Brackets inside the brackets: a grid over the values strictly inside, and the steps around the wanted position."""
    lo, hi = [f"_{n}_lo" for n in wanted], [f"_{n}_hi" for n in wanted]
    rows = _with_bounds(src, bounds, keys, [*lo, *hi])
    grid = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    parts = []
    for n in wanted:
        v, a, b = F.col(f"_{n}"), F.col(f"_{n}_lo"), F.col(f"_{n}_hi")
        inside = F.when((v > a) & (v < b), v)
        parts += [F.percentile_approx(inside, grid, F.lit(ACCURACY)).alias(f"_{n}_grid"), F.count_if(v <= a).alias(f"_{n}_upto"),
                  F.count(inside).alias(f"_{n}_in"), F.count(v).alias(f"_{n}_n"), F.min(a).alias(f"_{n}_a"), F.min(b).alias(f"_{n}_z")]
    out = rows.groupBy(*keys).agg(*parts)
    cells = []
    for n, (_, share) in wanted.items():
        at = F.floor(F.lit(float(share)) * (F.col(f"_{n}_n") - 1)) - F.col(f"_{n}_upto")  # among the values inside
        step = F.floor(F.try_divide(at, F.col(f"_{n}_in")) * STEPS).cast("int")
        open_ = (F.col(f"_{n}_in") > 0) & (at >= -1) & (at <= F.col(f"_{n}_in"))
        low = F.when(open_ & (step >= 2), F.get(f"_{n}_grid", step - 2)).otherwise(F.col(f"_{n}_a"))
        high = F.when(open_ & (step <= STEPS - 3), F.get(f"_{n}_grid", step + 3)).otherwise(F.col(f"_{n}_z"))
        cells += [low.alias(f"_{n}_lo"), high.alias(f"_{n}_hi"), (F.col(f"_{n}_in")).alias(f"_{n}_in")]
    return out.select(*keys, *cells)


def _at(position: Column, n: str) -> Column:
    """The value at a 0-based position of the group, from the counts around its bracket."""
    below, on_lo, on_hi = F.col(f"_{n}_below"), F.col(f"_{n}_on_lo"), F.col(f"_{n}_on_hi")
    inside, first = F.col(f"_{n}_inside"), F.col(f"_{n}_below") + F.col(f"_{n}_on_lo")
    last = first + F.size(inside)
    return (
        F.when(position == below - 1, F.col(f"_{n}_prev"))
        .when((position >= below) & (position < below + on_lo), F.col(f"_{n}_lo"))
        .when((position >= first) & (position < last), F.get(inside, (position - first).cast("int")))
        .when((position >= last) & (position < last + on_hi), F.col(f"_{n}_hi"))
        .when(position == last + on_hi, F.col(f"_{n}_next"))
        .when(F.col(f"_{n}_n") > 0, F.raise_error(F.lit("a quantile lies outside of its bracket")).cast("double"))
    )


def group_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]], keys: list[str] | None = None, count: str | None = None) -> DataFrame:
    """One row per group (one in all without ``keys``): exact, linearly interpolated quantiles.

    ``wanted``: output name -> (column, share). Null values are ignored; groups with a null key, or without
    any value, have no row. ``count``: name of a column with the rows of the group.
    One action reads the size of the largest group, which decides how often brackets are refined.
    """
    keys = keys or []
    src = df.select(*keys, *[F.col(c).cast("double").alias(f"_{n}") for n, (c, _) in wanted.items()])
    largest = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    near, parts = 2 / ACCURACY, []
    for n, (_, share) in wanted.items():
        ends = [float(max(0.0, share - near)), float(min(1.0, share + near))]
        parts.append(F.percentile_approx(f"_{n}", ends, ACCURACY).alias(f"_{n}_ends"))
    bounds = src.groupBy(*keys).agg(*parts)
    bounds = bounds.select(*keys, *[F.get(f"_{n}_ends", i).alias(f"_{n}_{end}") for n in wanted for i, end in ((0, "lo"), (1, "hi"))])
    inside = 6 * largest / ACCURACY
    while inside > INSIDE:
        bounds = cut(_refined(src, bounds, wanted, keys))
        inside = 6 * inside / STEPS
    rows = _with_bounds(src, bounds, keys, [f"_{n}_{end}" for n in wanted for end in ("lo", "hi")])
    parts = [F.count(F.lit(1)).alias("_rows")]
    for n in wanted:
        v, lo, hi = F.col(f"_{n}"), F.col(f"_{n}_lo"), F.col(f"_{n}_hi")
        parts += [
            F.count(v).alias(f"_{n}_n"), F.count_if(v < lo).alias(f"_{n}_below"), F.count_if(v == lo).alias(f"_{n}_on_lo"),
            F.count_if((v == hi) & (hi > lo)).alias(f"_{n}_on_hi"), F.max(F.when(v < lo, v)).alias(f"_{n}_prev"),
            F.min(F.when(v > hi, v)).alias(f"_{n}_next"), F.min(lo).alias(f"_{n}_lo"), F.min(hi).alias(f"_{n}_hi"),
            F.sort_array(F.collect_list(F.when((v > lo) & (v < hi), v))).alias(f"_{n}_inside"),
        ]
    found, out = rows.groupBy(*keys).agg(*parts), []
    if keys:
        found = found.filter(F.greatest(F.lit(0), *[F.col(f"_{n}_n") for n in wanted]) > 0)
    for n, (_, share) in wanted.items():
        p = F.lit(float(share)) * (F.col(f"_{n}_n") - 1)
        low, high = _at(F.floor(p), n), _at(F.ceil(p), n)
        out.append(F.when(F.floor(p) == F.ceil(p), low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high).alias(n))
    return found.select(*keys, *out, *([F.col("_rows").alias(count)] if count else []))


def value_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """(_col, _v, _n, _below, _total): every distinct non-null value of ``columns`` with its number of rows, the rows
    below it, and all rows of the column."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in columns]))
    long = df.select(cells.alias("_x")).select("_x._col", "_x._v").filter("_v is not null")
    counts = cut(long.groupBy("_col", "_v").agg(F.count(F.lit(1)).alias("_n")))
    ranges = max(1, -(-counts.count() // RANGE_ROWS))
    if ranges > 1:  # written once: the ranges' numbers must not change between the counts and the ranks
        counts = cut(counts.repartitionByRange(ranges, "_col", "_v").withColumn("_range", F.spark_partition_id()))
    else:
        counts = counts.withColumn("_range", F.lit(0))
    sizes = counts.groupBy("_col", "_range").agg(F.sum("_n").alias("_rows"))  # a row per range, one more per column
    before = Window.partitionBy("_col").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("_col")
    offsets = sizes.select("_col", "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
                           F.sum("_rows").over(every).alias("_total"))
    inside = Window.partitionBy("_col", "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return ranked.join(offsets, ["_col", "_range"]).select("_col", "_v", "_n", (F.col("_offset") + F.col("_inside")).alias("_below"), "_total")


def average_percent_ranks(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add for every column -> output the average-method percent rank of its non-null values:
    (values below + (equal values + 1) / 2) / values."""
    df = cut(df)
    ranks = cut(value_ranks(df, sorted(columns)))
    share = (F.col("_below") + (F.col("_n") + 1) / 2.0) / F.col("_total")
    for column, out in columns.items():
        own = ranks.filter(F.col("_col") == column).select(F.col("_v").alias(f"_{out}_v"), share.alias(out))
        df = df.join(own, F.col(column) == F.col(f"_{out}_v"), "left").drop(f"_{out}_v")
    return df
