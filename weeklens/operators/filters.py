"""Zone filters.

Filters ignore case. On a materialized fact table they compare the case-folded key columns with
plain equalities, which Catalyst pushes to the parquet scan; on other tables they fold the column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Case-folded copies of the filter columns that a materialized fact table carries.
KEYS = {
    "COUNTRY_KEY": ("COUNTRY", F.upper),
    "CITY_KEY": ("CITY", F.lower),
    "ZONE_KEY": ("ZONE", F.lower),
    "ZONE_TYPE_KEY": ("ZONE_TYPE", F.lower),
    "ZONE_PRIORITIZATION_KEY": ("ZONE_PRIORITIZATION", F.lower),
}

WEEK_INDEX = {f"L{i}W": 8 - i for i in range(9)}


@dataclass(frozen=True)
class Filters:
    country: str | None = None
    city: str | None = None
    zone: str | None = None
    zone_type: str | None = None
    prioritization: str | None = None


def _key(df: DataFrame, column: str) -> Column:
    name, fold = f"{column}_KEY", KEYS[f"{column}_KEY"][1]
    return F.col(name) if name in df.columns else fold(F.col(column))


def apply_filters(df: DataFrame, f: Filters | None, exact_zone: bool = False) -> DataFrame:
    """Case-insensitive filters; ZONE is a literal substring match unless ``exact_zone``."""
    if f is None:
        return df
    cond = F.lit(True)
    if f.country:
        cond = cond & (_key(df, "COUNTRY") == f.country.upper())  # B1
    if f.city:
        cond = cond & (_key(df, "CITY") == f.city.lower())  # B2
    if f.zone:
        if exact_zone:
            cond = cond & (_key(df, "ZONE") == f.zone.lower())  # B4
        else:
            cond = cond & _key(df, "ZONE").contains(f.zone.lower())  # B3
    if f.zone_type and "ZONE_TYPE" in df.columns:
        cond = cond & (_key(df, "ZONE_TYPE") == f.zone_type.lower())  # B5
    if f.prioritization and "ZONE_PRIORITIZATION" in df.columns:
        cond = cond & (_key(df, "ZONE_PRIORITIZATION") == f.prioritization.lower())  # B6
    return df.filter(cond)


def week_or_default(df: DataFrame, week: str) -> str:
    return week if week in df.columns else "L0W"


def week_range(df: DataFrame, start_week: str = "L8W", end_week: str = "L0W") -> DataFrame:
    """Long rows with start_idx <= week_index <= end_idx (unknown labels -> 0 / 8)."""
    lo = WEEK_INDEX.get(start_week, 0)
    hi = WEEK_INDEX.get(end_week, 8)
    return df.filter(F.col("week_index").between(lo, hi))
