"""Landed tables: good and rejected rows side by side in one pass, safe to write again.

A load writes the partitions of its own batch (or source file) and nothing else, with dynamic partition
overwrite: a repeated batch replaces itself, other batches stay. ``reject_reason`` tells rejects apart, so
input is read once and nothing is cached.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import checked_broadcast


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_batch(df: DataFrame, path: str, load_batch: int, *by: str) -> None:
    write_partitions(df.withColumn("load_batch", F.lit(load_batch).cast("bigint")), path, "load_batch", *by)


def read_landed(spark: SparkSession, path: str, schema: T.StructType, *parts: str) -> DataFrame:
    """The table, or what lies in the folders ``parts`` of it, with its declared types; an empty one before the first load."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(*(parts or (path,)))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_batch(spark: SparkSession, path: str, schema: T.StructType, load_batch: int) -> DataFrame:
    """Rows of one batch; only its folder is listed and read."""
    return read_landed(spark, path, schema, f"{path}/load_batch={load_batch}").where(F.col("load_batch") == load_batch)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, load_batches: list[int]) -> DataFrame:
    """Rows of several batches that are there; only their folders are listed and read."""
    return read_landed(spark, path, schema, *(f"{path}/load_batch={n}" for n in load_batches))


def next_batch(spark: SparkSession, target: str, count: int = 1) -> int:
    """A batch number never given before, whichever route asks, the first of ``count``; they are spent even if the batch fails.
    One writer a table."""
    schema = T.StructType([T.StructField("load_batch", T.LongType())])
    number = (read_landed(spark, f"{target}/numbers", schema).agg(F.max("load_batch")).first()[0] or 0) + 1
    spark.createDataFrame([(number + count - 1,)], schema).coalesce(1).write.mode("append").parquet(f"{target}/numbers")
    return number


# Most numbers that a run of batches claims at a time.
_CLAIMED = 256


def batch_numbers(spark: SparkSession, target: str, count: int = 1) -> Iterator[int]:
    """Numbers of ``next_batch`` for a run of batches: ``count``, then twice as many at a time, so that the table of numbers is
    not read for every batch. Those left over are spent."""
    while True:
        first = next_batch(spark, target, count)
        yield from range(first, first + count)
        count = max(count, min(2 * count, _CLAIMED))


def stream_id(spark: SparkSession, target: str) -> str:
    """The identity that a stream keeps in its checkpoint; a stream whose checkpoint was lost has another one."""
    return spark.read.schema("id string").json(f"{target}/_checkpoint/metadata").first().id


def committed(df: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of the batches named in ``marks``, which are written last: a batch that broke off does not count."""
    return df.join(checked_broadcast(marks.select("load_batch").distinct()), "load_batch", "left_semi").select(*df.columns)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Even out file sizes per partition value before a write: AQE splits the large and merges the small."""
    return df.hint("rebalance", *by)


def write_source_files(df: DataFrame, path: str) -> None:
    """Replace everything stored for the source files in ``df``; folders are named by a hash of the file name."""
    write_partitions(df.withColumn("file_key", F.hex(F.xxhash64("source_file"))), path, "file_key")
