"""Shared helpers: table readers, checkpoints in the shared folder, row keys, ASCII text rules."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

#: The six ASCII white-space characters; bytes.split() without arguments splits on the same set.
SPACE = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialize ``df`` once, as a reliable checkpoint in the folder of spark.checkpoint.dir."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stash(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: for tables with large binaries."""
    path = scratch_path(df.sparkSession, f"weeklens-{name}/{uuid.uuid4().hex}")
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_thread_a_task(spark: SparkSession) -> None:
    """From now on matrix products in Python workers take one thread: a task has one core, and idle BLAS threads spin."""
    spark.sparkContext.environment["OPENBLAS_NUM_THREADS"] = "1"


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings take the fast built-in, others translate()."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def row_key(*columns: Column) -> Column:
    """128-bit key of a row by content: rows of equal columns share it, a null differs from every text."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.md5(F.concat(*[part(c) for c in columns]).cast("binary")))


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32(doc_id as text) mod ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def spans(data: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes, cut at spaces (a part ends before one): bounds the memory of a long text."""
    at = 0
    while len(data) - at > size:
        end = data.find(b" ", at + size)
        if end < 0:
            break
        yield data[at:end]
        at = end
    yield data[at:]
