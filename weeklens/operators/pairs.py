"""Pairwise-complete correlations of any number of metrics, by tiles.

The values of one zone are one row of (metric number, centred value) lists. Metrics are numbered and cut
into tiles of ``TILE``; a zone's row is repeated once for each pair of tiles that it has values in, and each
task sorts its rows by tile pair (locally, spilling), so it holds the sums of one tile pair at a time: six
matrix products of at most TILE x TILE numbers. Tasks send one row of sums per metric pair to a grouped sum.
The plan is the same for five metrics and for five thousand, and no zone's metrics are paired row by row.

Values are centred by their metric's mean before they are multiplied. Where the values of a pair's zones
differ by less than about a millionth of their distance from that mean, the pair counts as constant and has
no correlation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Metrics to a tile.
TILE = 128
#: Variance over mean square below which a pair's values count as constant.
CONSTANT = 1e-12

SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
SUMS_SCHEMA = "i int, j int, " + ", ".join(f"{c} double" for c in SUMS)


def _dense(pos: pa.ListArray, x: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of (position in the tile, value) lists -> values and presence, both rows x TILE."""
    lengths = pos.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(pos)), lengths)
    col = pos.flatten().to_numpy()
    values, present = np.zeros((len(pos), TILE)), np.zeros((len(pos), TILE))
    values[row, col] = x.flatten().to_numpy()
    present[row, col] = 1.0
    return values, present


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, a_pos, a_x, b_pos, b_x), sorted by (a, b) -> the sums of every metric pair of each tile pair."""
    at, sums = None, None

    def flush() -> Iterator[pa.RecordBatch]:
        a, b = at
        found = sums[0] > 0
        if a == b:
            found &= np.triu(np.ones((TILE, TILE), bool), 1)
        i, j = np.nonzero(found)
        if len(i):
            columns = [pa.array((i + a * TILE).astype(np.int32)), pa.array((j + b * TILE).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(s[i, j]) for s in sums], ["i", "j", *SUMS])

    for batch in batches:
        a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
        starts = np.flatnonzero((np.diff(a, prepend=-1) != 0) | (np.diff(b, prepend=-1) != 0))
        for lo, hi in zip(starts, [*starts[1:], len(a)], strict=True):
            here = (int(a[lo]), int(b[lo]))
            if here != at:
                if at is not None:
                    yield from flush()
                at, sums = here, [np.zeros((TILE, TILE)) for _ in SUMS]
            part = batch.slice(lo, hi - lo)
            x, mx = _dense(part.column("a_pos"), part.column("a_x"))
            y, my = _dense(part.column("b_pos"), part.column("b_x"))
            for total, left, right in zip(sums, (mx, x, mx, x * x, mx, x), (my, my, y, my, y * y, y), strict=True):
                total += left.T @ right
    if at is not None:
        yield from flush()


def pairwise_correlations(cells: DataFrame, metrics: DataFrame, row_keys: list[str]) -> DataFrame:
    """(metric_a, metric_b, n, r) for every pair a < b with a common row; r is null for fewer than two rows
    or where one side is constant.

    ``cells``: ``row_keys``, METRIC, v (at most one value of a metric in a row, nulls are skipped).
    ``metrics``: METRIC and its ``mean``, one row per metric to compare; others are left out. Null row keys
    are keys of their own.
    """
    # one row per metric: numbering them in one task and broadcasting them is bounded by the metric names
    numbered = metrics.select("METRIC", "mean", (F.row_number().over(Window.orderBy("METRIC")) - 1).alias("pos"))
    known = cells.filter(F.col("v").isNotNull()).join(F.broadcast(numbered), "METRIC")
    rows = known.groupBy(*row_keys).agg(F.collect_list(F.struct("pos", (F.col("v") - F.col("mean")).alias("x"))).alias("c"))
    tile = lambda c: F.floor(c["pos"] / TILE).cast("int")
    rows = rows.select("c", F.array_sort(F.array_distinct(F.transform("c", tile))).alias("tiles"))
    rows = rows.select("c", "tiles", F.explode("tiles").alias("a"))
    rows = rows.select("c", "a", F.explode(F.filter("tiles", lambda t: t >= F.col("a"))).alias("b"))

    def side(t: str) -> list:
        mine = F.filter("c", lambda c: tile(c) == F.col(t))
        return [F.transform(mine, lambda c: (c["pos"] % TILE).cast("int")).alias(f"{t}_pos"), F.transform(mine, lambda c: c["x"]).alias(f"{t}_x")]

    tiled = rows.select("a", "b", *side("a"), *side("b")).sortWithinPartitions("a", "b")
    sums = tiled.mapInArrow(_pair_sums, SUMS_SCHEMA).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in SUMS])
    n = F.col("n")
    vx, vy = n * F.col("sxx") - F.col("sx") ** 2, n * F.col("syy") - F.col("sy") ** 2
    varies = (n > 1) & (vx > n * F.col("sxx") * CONSTANT) & (vy > n * F.col("syy") * CONSTANT)
    r = (n * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.sqrt(vx) * F.sqrt(vy))
    r = F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    name = lambda pos, out: F.broadcast(numbered.select(F.col("pos").alias(pos), F.col("METRIC").alias(out)))
    return sums.join(name("i", "metric_a"), "i").join(name("j", "metric_b"), "j").select(
        "metric_a", "metric_b", n.cast("bigint").alias("n"), r.alias("r"))
