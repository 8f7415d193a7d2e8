"""Sinks: CSV export (A15) and the partitioned parquet materialization."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..frames import materialize  # noqa: F401  (A13: parquet partitioned by METRIC)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Result table to CSV with a header and no index column.

    Results are written by the executors in parallel (one file per partition);
    ``single_file`` is only meant for small, already-limited report tables.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark, path: str, schema) -> DataFrame:
    """Read an exported table back with an explicit schema (no inference)."""
    return spark.read.option("header", True).schema(schema).csv(path)
