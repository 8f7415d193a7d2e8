"""Line de-duplication with levelled sorted runs of line hashes.

A line's key is the line stripped of ASCII white space at both ends with A-Z lower-cased; its hash
is the 128-bit MD5. Documents arrive in batches. The keys of a batch are counted (documents, not
occurrences), merge-anti-joined against the keys that a sorted run already knows to be common, and
the rest becomes a new run of level 0: a table bucketed and sorted by hash, so later merges read it
without another shuffle. ``fanout`` runs of one level are compacted into one of the next, summing
their counts, so few runs exist at any time. After the last batch the runs are summed once and the
keys found in ``min_docs`` documents or more lose all their lines in every document.

Nothing but hashes and counts is gathered; the lines to drop come back as positions by row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, cut, row_key, shuffle_width


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _hashes(lines: Column, min_chars: int) -> Column:
    """MD5 of each line's key; null for keys that are too short to count."""
    def one(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(key.cast("binary"))))
    return F.transform(lines, one)


class SortedRuns:
    """Runs of (key, n) in managed tables, bucketed and sorted by key; ``close`` drops them."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[str]] = [[]]
        self.name, self.made = f"weeklens_runs_{uuid.uuid4().hex}", 0
        self.buckets = shuffle_width(spark)

    def _write(self, rows: DataFrame) -> str:
        self.made += 1
        name = f"{self.name}_{self.made}"
        (rows.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
         .format("parquet").saveAsTable(name))
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """batch: (key, n), one row per key."""
        for name in self.tables():
            known = self.spark.table(name).filter(F.col("n") >= self.min_docs).select("key")
            batch = batch.join(known, "key", "left_anti")
        self.levels[0].append(self._write(batch))
        for i, level in enumerate(self.levels):
            if len(level) < self.fanout:
                break
            merged = self._write(self._sum(level))
            self._drop(level)
            self.levels[i] = []
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(merged)

    def _sum(self, names: list[str]) -> DataFrame:
        """Merge runs by their sorted keys. A merge join, not a union with a grouped sum: Spark 4.1 takes a
        union of bucketed scans for partitioned by key when it is not, and the sum then loses counts."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).withColumnRenamed("n", "n2")
            total = F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))
            rows = rows.join(other, "key", "full").select("key", total.alias("n"))
        return rows

    def common(self) -> DataFrame:
        return self._sum(self.tables()).filter(F.col("n") >= self.min_docs).select("key")

    def close(self) -> None:
        self._drop(self.tables())


def common_lines(docs: DataFrame, text: str, min_chars: int, min_docs: int, batches: int, fanout: int) -> DataFrame:
    """(key): hashes of the line keys found in ``min_docs`` rows or more, checkpointed."""
    spark = docs.sparkSession
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    batch = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]), F.lit(batches))
    keys = F.array_distinct(_hashes(F.split(t, "\n", -1), min_chars))
    counted = (
        docs.select(batch.cast("int").alias("batch"), F.explode(keys).alias("key"))
        .filter("key is not null")
        .groupBy("batch", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    runs = SortedRuns(spark, min_docs, fanout)
    arrivals = f"{runs.name}_in"
    try:
        counted.write.partitionBy("batch").format("parquet").saveAsTable(arrivals)
        for b in range(batches):
            runs.add(spark.table(arrivals).filter(F.col("batch") == b).select("key", "n"))
        return cut(runs.common())
    finally:
        runs.close()
        spark.sql(f"DROP TABLE IF EXISTS {arrivals}")


def drop_common_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 1, min_docs: int = 10,
    batches: int = 6, fanout: int = 3, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``id_col``, ``keep``, kept (text), n_lines, n_dropped.

    Lines end at ``\\n`` only; a null or empty text is one empty line. Keys shorter than
    ``min_chars`` code points are never dropped. A document is a row: repeated rows count each, and a
    line repeated inside one document counts once. Where all lines go, kept is the empty text. An
    empty table gives an empty result.
    """
    cols = [id_col, *keep]
    common = common_lines(docs, text, min_chars, min_docs, batches, fanout)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = row_key(F.col(f"`{id_col}`"), t)
    lines = F.split(t, "\n", -1)
    at = docs.select(row.alias("row"), F.posexplode(_hashes(lines, min_chars)).alias("pos", "key"))
    drops = (
        at.filter("key is not null").join(common, "key").groupBy("row")
        .agg(F.collect_set(F.col("pos") + 1).alias("drops"))  # no more than the document has lines
        .withColumnRenamed("row", "row2")
    )
    whole = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(cols)], row.alias("row"), lines.alias("lines"))
    joined = whole.join(drops, F.col("row") == F.col("row2"), "left")
    left = F.array_except(F.sequence(F.lit(1), F.size("lines")), F.col("drops"))
    kept = F.when(F.col("drops").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(left, lambda i: F.element_at(F.col("lines"), i)), "\n"))
    return joined.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(cols)], kept.alias("kept"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"))
