"""Which loads and versions of a table count: a log beside the data, written last.

An entry is one small file of the log, so it is there as a whole or not at all. Data without an entry, of a driver that was
lost half way, is not read; its number is not given again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .landing import read_landed

_ENTRY = T.StructType([T.StructField("number", T.LongType()), T.StructField("rows", T.LongType())])


def log_of(path: str) -> str:
    return f"{path.rstrip('/')}_log"


def commit(spark: SparkSession, path: str, number: int, rows: int) -> None:
    """Enter that data number ``number`` of the table at ``path`` is whole."""
    spark.createDataFrame([(number, rows)], _ENTRY).coalesce(1).write.mode("append").parquet(log_of(path))


def commits(spark: SparkSession, path: str) -> DataFrame:
    return read_landed(spark, log_of(path), _ENTRY)


def last_commit(spark: SparkSession, path: str) -> int:
    """The latest number that counts; 0 before the first."""
    return commits(spark, path).agg(F.max("number")).first()[0] or 0


def next_number(spark: SparkSession, path: str, column: str) -> int:
    """A number above those that count and those that data without an entry have."""
    schema = T.StructType([T.StructField(column, T.LongType())])
    written = read_landed(spark, path, schema).agg(F.max(column)).first()[0] or 0
    return max(written, last_commit(spark, path)) + 1
