"""Small keyed tables kept as versions: an upsert reads version n and adds version n + 1 as a new partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .commits import commit, last_commit, next_number
from .landing import read_landed


def _versioned(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("version", T.LongType())])


def current_version(spark: SparkSession, path: str) -> int:
    """The newest version that is whole; 0 before the first."""
    return last_commit(spark, path)


def read_version(spark: SparkSession, path: str, schema: T.StructType, version: int) -> DataFrame:
    """Rows of one version; others are pruned by partition."""
    table = read_landed(spark, path, _versioned(schema))
    return table.where(F.col("version") == version).select(*schema.fieldNames())


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the newest version that is whole."""
    return read_version(spark, path, schema, current_version(spark, path))


def write_next(df: DataFrame, path: str, schema: T.StructType) -> int:
    """Add ``df`` as the next version. The version read from is not touched, so a failed write loses nothing: what it leaves
    has no entry in the log and is never read."""
    spark = df.sparkSession
    version = next_number(spark, path, "version")
    df.withColumn("version", F.lit(version).cast("bigint")).write.mode("append").partitionBy("version").parquet(path)
    commit(spark, path, version, read_version(spark, path, schema, version).count())
    return version
