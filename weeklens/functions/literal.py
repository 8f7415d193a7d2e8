"""Small fixed tables as JVM-side literal relations.

``createDataFrame`` on a Python list is an RDD of pickled rows: every scan needs Python workers, and literals
put into the plan one by one are analysed again with every step that follows. Catalogue-sized tables (metric
dimension, alias dictionaries) go as one Arrow batch, which Spark keeps as a local relation of known size.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], schema)
    columns = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(zip(*rows, strict=True), schema.fields, strict=True)]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)
