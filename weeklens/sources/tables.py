"""Readers for user-supplied weekly sheets and the metric dictionary (A1-A3).

Sheets are read with an explicit schema (no inference); week columns are read
as text so that anything unparsable becomes NULL in ``clean_numeric`` instead
of failing the scan. Excel itself is not read: export the sheets to parquet or
CSV first.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import WEEK_LABELS, Catalog, MetricSpec

METRICS_SHEET = T.StructType(
    [T.StructField(c, T.StringType()) for c in
     ["COUNTRY", "CITY", "ZONE", "ZONE_TYPE", "ZONE_PRIORITIZATION", "METRIC"]]
    + [T.StructField(f"{w}_ROLL", T.StringType()) for w in WEEK_LABELS]
)
ORDERS_SHEET = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["COUNTRY", "CITY", "ZONE", "METRIC"]]
    + [T.StructField(w, T.StringType()) for w in WEEK_LABELS]
)

DICTIONARY_SCHEMA = T.StructType([
    T.StructField("metrics", T.MapType(T.StringType(), T.StructType([
        T.StructField("description", T.StringType()),
        T.StructField("higher_is_better", T.BooleanType()),
        T.StructField("aliases", T.ArrayType(T.StringType())),
        T.StructField("category", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("expected_range", T.ArrayType(T.DoubleType())),
        T.StructField("anomaly_abs_min", T.DoubleType()),
        T.StructField("note", T.StringType()),
    ]))),
    T.StructField("zone_types", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("zone_prioritization", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("countries", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])


def load_sheet(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A1/A2: read a weekly sheet (parquet, or CSV with a header) with the given schema."""
    if fmt == "csv":
        return spark.read.option("header", True).schema(schema).csv(path)
    return spark.read.schema(schema).parquet(path)


def write_metric_dictionary(spark: SparkSession, catalog: Catalog, path: str) -> None:
    """A catalogue as a nested dictionary JSON file, in the form that ``load_metric_dictionary`` reads."""
    metrics = {m.name: {
        "higher_is_better": m.higher_is_better, "aliases": list(m.aliases), "category": m.category, "unit": m.unit,
        "expected_range": [float(m.lo), float(m.hi)], "anomaly_abs_min": float(m.min_abs_change),
    } for m in catalog.metrics}
    groups = {"zone_types": catalog.zone_types, "zone_prioritization": catalog.prioritizations, "countries": catalog.countries}
    whole = {"metrics": metrics, **{k: {name: list(al) for name, al in g} for k, g in groups.items()}}
    spark.createDataFrame([(json.dumps(whole, ensure_ascii=False),)], "value string").coalesce(1).write.text(path)


def load_catalog(spark: SparkSession, path: str, limits: Catalog) -> Catalog:
    """A catalogue from a dictionary JSON: names, directions, units, categories and aliases come from the
    file; detector limits and roles of the metrics that ``limits`` knows are kept, new metrics get the
    file's expected range. The file is one small document, read to the driver."""
    d = spark.read.schema(DICTIONARY_SCHEMA).option("multiLine", True).json(path).first()
    specs = []
    for name, m in (d.metrics or {}).items():
        lo, hi = (m.expected_range or list(limits.unknown_range))[:2]
        spec = limits.get(name) or MetricSpec(name, True, "ratio", lo, hi, min_abs_change=m.anomaly_abs_min or 0.0)
        better = m.higher_is_better if m.higher_is_better is not None else True
        specs.append(replace(spec, higher_is_better=better, unit=m.unit or "ratio", category=m.category or "",
                             aliases=tuple(m.aliases or ())))

    def groups(found) -> tuple:
        return tuple((k, tuple(v or ())) for k, v in (found or {}).items())

    return replace(limits, metrics=tuple(specs), zone_types=groups(d.zone_types),
                   prioritizations=groups(d.zone_prioritization), countries=groups(d.countries))


def load_metric_dictionary(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A3: nested dictionary JSON -> (metric attributes, exploded aliases)."""
    d = spark.read.schema(DICTIONARY_SCHEMA).option("multiLine", True).json(path)
    m = d.select(F.posexplode(F.map_entries("metrics")).alias("metric_pos", "e"))
    attrs = m.select(
        F.col("e.key").alias("METRIC"), "metric_pos",
        F.coalesce(F.col("e.value.higher_is_better"), F.lit(True)).alias("higher_is_better"),
        F.col("e.value.unit").alias("unit"), F.col("e.value.category").alias("category"),
        F.element_at("e.value.expected_range", 1).alias("range_lo"),
        F.element_at("e.value.expected_range", 2).alias("range_hi"),
        F.col("e.value.anomaly_abs_min").alias("anomaly_abs_min"),
    )
    aliases = m.select(F.col("e.key").alias("METRIC"), "metric_pos",
                       F.posexplode("e.value.aliases").alias("alias_pos", "alias"))
    return attrs, aliases
