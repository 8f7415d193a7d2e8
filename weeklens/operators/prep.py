"""Cleaning, reshaping and enrichment of the weekly tables.

All steps are narrow projections except ``dropDuplicates`` (one shuffle on the
full row) and the zone-dimension join. The zone dimension is one row per zone;
the orders table is joined to it with a plain equi-join so AQE chooses
broadcast or shuffle from runtime sizes (zone counts are not bounded a priori).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import IDS, WEEK_LABELS, ZONE_ATTRS

METRIC_DIMS = ["COUNTRY", "CITY", "ZONE", "ZONE_TYPE", "ZONE_PRIORITIZATION", "METRIC"]
ORDER_DIMS = ["COUNTRY", "CITY", "ZONE", "METRIC"]


# Every character that counts as white space at the ends of a text
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: what counts as a number in a sheet cell
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"


def strip_header(df: DataFrame) -> DataFrame:
    """A1/A2: strip blanks around column names (as read from a sheet header)."""
    return df.toDF(*[c.strip() for c in df.columns])


def clean_dedup(df: DataFrame) -> DataFrame:
    """A4: drop fully identical rows, before any trimming."""
    return df.dropDuplicates()


def strip_all(c: Column) -> Column:
    """Strip every kind of leading/trailing whitespace, Unicode's too (F.trim only strips blanks)."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_trim(df: DataFrame, dims: list[str]) -> DataFrame:
    """A5: dimensions as text with whitespace stripped."""
    return df.withColumns({d: strip_all(F.col(d).cast("string")) for d in dims if d in df.columns})


def clean_rename(df: DataFrame) -> DataFrame:
    """L{i}W_ROLL -> L{i}W."""
    mapping = {f"L{i}W_ROLL": f"L{i}W" for i in range(9) if f"L{i}W_ROLL" in df.columns}
    return df.withColumnsRenamed(mapping) if mapping else df


def clean_numeric(df: DataFrame) -> DataFrame:
    """Week columns to double; anything unparsable (or NaN) becomes NULL."""
    out = {}
    for w in WEEK_LABELS:
        if w in df.columns:
            text = strip_all(F.col(w).cast("string"))
            out[w] = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return df.withColumns(out)


def clean_metrics(raw: DataFrame) -> DataFrame:
    return clean_numeric(clean_rename(clean_trim(clean_dedup(strip_header(raw)), METRIC_DIMS)))


def clean_orders(raw: DataFrame) -> DataFrame:
    return clean_numeric(clean_rename(clean_trim(clean_dedup(strip_header(raw)), ORDER_DIMS)))


def week_columns(df: DataFrame) -> list[str]:
    return [w for w in WEEK_LABELS if w in df.columns]


def melt_long(wide: DataFrame) -> DataFrame:
    """Wide -> long over present weeks; nulls kept; week_index/weeks_ago/has_value."""
    weeks = week_columns(wide)
    ids = [c for c in wide.columns if c not in weeks]
    long = wide.unpivot(ids, weeks, "week_label", "value")
    # labels are the known week columns: map them directly (L8W -> 0 ... L0W -> 8)
    index = F.lit(-1)
    ago = F.lit(None).cast("int")
    for w in weeks:
        i = int(w[1:-1])
        index = F.when(F.col("week_label") == w, F.lit(8 - i)).otherwise(index)
        ago = F.when(F.col("week_label") == w, F.lit(i)).otherwise(ago)
    return long.withColumns(
        {"week_index": index, "weeks_ago": ago, "has_value": F.col("value").isNotNull()}
    )


def zone_dim(metrics_wide: DataFrame) -> DataFrame:
    """Distinct zone attributes."""
    return metrics_wide.select(*IDS, *ZONE_ATTRS).distinct()


def orders_enriched(orders_wide: DataFrame, zones: DataFrame) -> DataFrame:
    """Orders left-joined to the zone attributes (fans out on conflicting attributes)."""
    return orders_wide.join(zones, IDS, "left").select(*IDS, *ZONE_ATTRS, "METRIC", *week_columns(orders_wide))


def key_uniqueness(wide: DataFrame) -> DataFrame:
    """(ids, METRIC) keys that do not occur exactly once."""
    return (
        wide.groupBy(*IDS, "METRIC")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") != 1)
    )


def _sheet_sides(metrics_wide: DataFrame, orders_wide: DataFrame) -> DataFrame:
    """Distinct zones with a flag for each sheet that has them: both sheets' ids tagged and grouped once (partial
    aggregation, one exchange) instead of two anti joins. Null ids compare as equal."""
    tagged = metrics_wide.select(*IDS, F.lit(True).alias("m"), F.lit(False).alias("o")).unionByName(
        orders_wide.select(*IDS, F.lit(False).alias("m"), F.lit(True).alias("o")))
    return tagged.groupBy(*IDS).agg(F.bool_or("m").alias("m"), F.bool_or("o").alias("o"))


def sheet_mismatch(metrics_wide: DataFrame, orders_wide: DataFrame) -> DataFrame:
    """Zones that only one of the sheets has: ids and ``missing_in`` ('orders' or 'metrics'). Repeated rows count
    once; two empty sheets give an empty result."""
    sides = _sheet_sides(metrics_wide, orders_wide)
    return sides.filter(F.col("m") != F.col("o")).select(
        *IDS, F.when(F.col("m"), "orders").otherwise("metrics").alias("missing_in"))


def sheet_audit(metrics_wide: DataFrame, orders_wide: DataFrame) -> DataFrame:
    """Per country: zones in both sheets, without orders, without metrics."""
    m, o = F.col("m"), F.col("o")
    return _sheet_sides(metrics_wide, orders_wide).groupBy("COUNTRY").agg(
        F.count_if(m & o).alias("n_both"), F.count_if(m & ~o).alias("n_without_orders"),
        F.count_if(~m & o).alias("n_without_metrics"))


def expect_checks(
    metrics_wide: DataFrame,
    orders_wide: DataFrame,
    countries: list[str],
    zone_types: list[str],
) -> DataFrame:
    """Data rules as (rule, violations) rows, each a count_if in one pass per table."""
    m = metrics_wide.agg(
        F.count_if(~F.col("COUNTRY").isin(*countries) | F.col("COUNTRY").isNull()).alias("country_domain"),
        F.count_if(~F.col("ZONE_TYPE").isin(*zone_types) | F.col("ZONE_TYPE").isNull()).alias("zone_type_domain"),
        F.when(F.count("L0W") > 0, F.lit(0)).otherwise(F.lit(1)).alias("metrics_have_l0w"),
    )
    o = orders_wide.agg(
        F.count_if(F.col("L0W") < 0).alias("orders_nonneg_l0w"),
        F.count_if(F.col("L1W") < 0).alias("orders_nonneg_l1w"),
    )
    w = melt_long(metrics_wide.select("METRIC", *week_columns(metrics_wide))).agg(
        F.count_if(~F.col("week_index").between(0, 8)).alias("week_index_range")
    )
    rules = m.unionByName(o, allowMissingColumns=True).unionByName(w, allowMissingColumns=True)
    names = ["country_domain", "zone_type_domain", "metrics_have_l0w", "orders_nonneg_l0w",
             "orders_nonneg_l1w", "week_index_range"]
    stacked = rules.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).cast("bigint").alias("v")) for n in names]))
        .alias("r")
    ).select("r.rule", "r.v")
    return stacked.groupBy("rule").agg(F.sum("v").cast("bigint").alias("violations"))
