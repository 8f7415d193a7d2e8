"""Raw weekly tables derived from the TPC-H-like test tables (FIXTURES.md §2).

A zone is a supplier: COUNTRY = region, CITY = nation, ZONE = supplier name, so the
zones and the fact table grow with the tables. Every order line belongs to the zone
that ships it; its ship date gives one of nine equal periods between the oldest and
the newest line. Per (zone, period) cell we count lines, finished, large and returned
lines, units and cents, and derive five ratio metrics plus the line count.

Scale plan: lineitem is read once, column-pruned, and aggregated by (supplier,
period) with map-side combine before it meets the supplier dimension; nation and
region are fixed 25/5-row dimensions (broadcast); the supplier join is left to AQE.
The oldest and newest dates are scalar subqueries, not joins. Rounding is done with
integer arithmetic (half-up) so every engine produces identical doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LARGE_LINE_PRICE = 80000
TICKET_CENTER = 50000
TICKET_SCALE = 2000
UNIT_SCALE_X2 = 11  # units per line are counted in steps of 5.5
WEEKS = 9


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ratio6(num: Column, den: Column) -> Column:
    """round(num/den, 6) half-up, computed on integers; NULL when den is 0."""
    num_d = num.cast("double")
    den_d = den.cast("double")
    return F.when(den > 0, F.floor((num_d * 2e6 + den_d) / (den_d * 2.0)) / 1e6)


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (zone, period) with the integer counts behind every metric."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    newest = lines.select(F.max("l_shipdate")).scalar()
    days = lines.select(F.datediff(F.max("l_shipdate"), F.min("l_shipdate")) + 1).scalar()
    period = F.ceil(days / WEEKS)
    ago = F.floor(F.datediff(newest, F.col("l_shipdate")) / period).cast("int")
    by_zone = lines.groupBy("l_suppkey", ago.alias("weeks_ago")).agg(
        F.count(F.lit(1)).alias("n_ord"),
        F.count_if(F.col("l_linestatus") == "F").alias("n_fin"),
        F.count_if(F.col("l_extendedprice") >= LARGE_LINE_PRICE).alias("n_large"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
        F.sum(F.round("l_quantity").cast("bigint")).alias("units"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
    )
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )
    return (
        by_zone.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("r_name").alias("COUNTRY"),
            F.col("n_name").alias("CITY"),
            F.col("s_name").alias("ZONE"),
            F.when(F.col("s_suppkey") % 5 < 2, "Wealthy").otherwise("Non Wealthy").alias("ZONE_TYPE"),
            F.when(F.col("n_nationkey") % 3 == 0, "High Priority")
            .when(F.col("n_nationkey") % 3 == 1, "Prioritized")
            .otherwise("Not Prioritized")
            .alias("ZONE_PRIORITIZATION"),
            "weeks_ago", "n_ord", "n_fin", "n_large", "n_ret", "units", "cents",
        )
    )


def _cell_metrics(cells: DataFrame) -> DataFrame:
    n = F.col("n_ord")
    offset = F.col("cents") - F.lit(TICKET_CENTER * 100) * n
    metrics = {
        "Finished": _ratio6(F.col("n_fin"), n),
        "Returned": _ratio6(F.col("n_ret"), n),
        "LargeOrders": _ratio6(F.col("n_large"), n),
        "UnitsPerLine": _ratio6(F.col("units") * 2, n * UNIT_SCALE_X2),
        "TicketDelta": _ratio6(offset, n * (TICKET_SCALE * 100)),
    }
    stacked = F.explode(
        F.array(*[F.struct(F.lit(k).alias("METRIC"), v.alias("value")) for k, v in metrics.items()])
    )
    return cells.select(
        "COUNTRY", "CITY", "ZONE", "ZONE_TYPE", "ZONE_PRIORITIZATION", "weeks_ago", stacked.alias("m"),
    ).select("*", "m.METRIC", "m.value").drop("m")


def _to_wide(long: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("weeks_ago") == i, F.col("value"))).alias(f"L{i}W{suffix}") for i in range(8, -1, -1)]
    )


def raw_metrics(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    """Raw metrics sheet: ids, zone attributes, METRIC, L8W_ROLL .. L0W_ROLL."""
    cells = cells if cells is not None else order_cells(spark, sf_dir)
    long = _cell_metrics(cells)
    return _to_wide(long, ["COUNTRY", "CITY", "ZONE", "ZONE_TYPE", "ZONE_PRIORITIZATION", "METRIC"], "_ROLL")


def raw_orders(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    """Raw orders sheet: ids, METRIC='Orders', L8W .. L0W (all zones)."""
    cells = cells if cells is not None else order_cells(spark, sf_dir)
    long = cells.select(
        "COUNTRY", "CITY", "ZONE", F.lit("Orders").alias("METRIC"), "weeks_ago",
        F.col("n_ord").cast("double").alias("value"),
    )
    return _to_wide(long, ["COUNTRY", "CITY", "ZONE", "METRIC"], "")


def weekly_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units per zone and calendar week over the whole history: ZONE, period (weeks since 1970), value."""
    lines = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_shipdate")
    week = F.floor(F.unix_date(F.col("l_shipdate").cast("date")) / 7)
    units = lines.groupBy("l_suppkey", week.alias("period")).agg(
        F.sum(F.round("l_quantity").cast("bigint")).cast("double").alias("value"))
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return units.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_name").alias("ZONE"), "period", "value")


# ---------------------------------------------------------------------------
# The same derivation as DuckDB SQL: prefix of every oracle query. Defines
# mw (metrics_wide), ow (orders_wide), zd (zone dim), owe (orders enriched),
# ml / ol (long forms).
# ---------------------------------------------------------------------------
def _sql_ratio6(num: str, den: str) -> str:
    return (
        f"CASE WHEN {den} > 0 THEN floor((CAST({num} AS DOUBLE) * 2e6 + CAST({den} AS DOUBLE))"
        f" / (CAST({den} AS DOUBLE) * 2.0)) / 1e6 END"
    )


def _sql_weeks(expr_value: str, suffix: str) -> str:
    return ",\n    ".join(
        f"max(CASE WHEN weeks_ago = {i} THEN {expr_value} END) AS L{i}W{suffix}" for i in range(8, -1, -1)
    )


def fixture_sql() -> str:
    metric_exprs = {
        "Finished": _sql_ratio6("n_fin", "n_ord"),
        "Returned": _sql_ratio6("n_ret", "n_ord"),
        "LargeOrders": _sql_ratio6("n_large", "n_ord"),
        "UnitsPerLine": _sql_ratio6("units * 2", f"(n_ord * {UNIT_SCALE_X2})"),
        "TicketDelta": _sql_ratio6(f"(cents - {TICKET_CENTER * 100} * n_ord)", f"(n_ord * {TICKET_SCALE * 100})"),
    }
    unions = "\n  UNION ALL ".join(
        f"SELECT COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, weeks_ago, '{k}' AS METRIC,"
        f" {v} AS value FROM fx_cells"
        for k, v in metric_exprs.items()
    )
    trim = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    mw_cols = ", ".join(trim.format(c=c) + f" AS {c}" for c in
                        ["COUNTRY", "CITY", "ZONE", "ZONE_TYPE", "ZONE_PRIORITIZATION", "METRIC"])
    ow_cols = ", ".join(trim.format(c=c) + f" AS {c}" for c in ["COUNTRY", "CITY", "ZONE", "METRIC"])
    mw_weeks = ", ".join(f"TRY_CAST(L{i}W_ROLL AS DOUBLE) AS L{i}W" for i in range(8, -1, -1))
    ow_weeks = ", ".join(f"TRY_CAST(L{i}W AS DOUBLE) AS L{i}W" for i in range(8, -1, -1))
    long_m = "\n  UNION ALL ".join(
        f"SELECT COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, METRIC, 'L{i}W' AS week_label,"
        f" L{i}W AS value, {8 - i} AS week_index, {i} AS weeks_ago FROM mw"
        for i in range(8, -1, -1)
    )
    long_o = "\n  UNION ALL ".join(
        f"SELECT COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, METRIC, 'L{i}W' AS week_label,"
        f" L{i}W AS value, {8 - i} AS week_index, {i} AS weeks_ago FROM owe"
        for i in range(8, -1, -1)
    )
    return f"""WITH
fx_span AS (
  SELECT CAST(max(l_shipdate) AS DATE) AS newest,
    CAST(ceil((date_diff('day', CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE)) + 1) / {WEEKS}.0) AS BIGINT)
      AS period
  FROM lineitem),
fx_counts AS (
  SELECT l_suppkey, CAST(date_diff('day', CAST(l_shipdate AS DATE), newest) // period AS INTEGER) AS weeks_ago,
    count(*) AS n_ord,
    count_if(l_linestatus = 'F') AS n_fin,
    count_if(l_extendedprice >= {LARGE_LINE_PRICE}) AS n_large,
    count_if(l_returnflag = 'R') AS n_ret,
    sum(CAST(round(l_quantity) AS BIGINT)) AS units,
    sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents
  FROM lineitem CROSS JOIN fx_span GROUP BY ALL),
fx_cells AS (
  SELECT r_name AS COUNTRY, n_name AS CITY, s_name AS ZONE,
    CASE WHEN s_suppkey % 5 < 2 THEN 'Wealthy' ELSE 'Non Wealthy' END AS ZONE_TYPE,
    CASE n_nationkey % 3 WHEN 0 THEN 'High Priority' WHEN 1 THEN 'Prioritized' ELSE 'Not Prioritized' END
      AS ZONE_PRIORITIZATION,
    weeks_ago, n_ord, n_fin, n_large, n_ret, units, cents
  FROM fx_counts
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
fx_mlong AS (
  {unions}),
fx_mraw AS (
  SELECT COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, METRIC,
    {_sql_weeks('value', '_ROLL')}
  FROM fx_mlong GROUP BY COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, METRIC),
fx_oraw AS (
  SELECT COUNTRY, CITY, ZONE, 'Orders' AS METRIC,
    {_sql_weeks('CAST(n_ord AS DOUBLE)', '')}
  FROM fx_cells GROUP BY COUNTRY, CITY, ZONE),
mw AS (SELECT {mw_cols}, {mw_weeks} FROM (SELECT DISTINCT * FROM fx_mraw)),
ow AS (SELECT {ow_cols}, {ow_weeks} FROM (SELECT DISTINCT * FROM fx_oraw)),
zd AS (SELECT DISTINCT COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION FROM mw),
owe AS (SELECT ow.COUNTRY, ow.CITY, ow.ZONE, zd.ZONE_TYPE, zd.ZONE_PRIORITIZATION, ow.METRIC,
          {', '.join(f'ow.L{i}W' for i in range(8, -1, -1))}
        FROM ow LEFT JOIN zd ON ow.COUNTRY = zd.COUNTRY AND ow.CITY = zd.CITY AND ow.ZONE = zd.ZONE),
ml AS (
  {long_m}),
ol AS (
  {long_o})
"""
