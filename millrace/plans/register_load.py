"""Register load: XML files or ZIP archives -> flat rows, replaced per source file.

A load adds one partition of rows and one of the list of its files, and its entry in the log last: it counts as a whole or not
at all. The rows of a file are those of the latest load that lists it, so a file without any replaces its old rows as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.register import (
    REGISTER_COLUMNS, flatten_register, header_rejects, project_register, register_events, split_heads,
)
from ..schemas import REGISTER_FLAT
from ..session import checked_broadcast, passing_stages, stage
from ..sinks.commits import commit, commits, next_number
from ..sinks.landing import read_landed
from ..sources.archives import list_members
from ..sources.listing import snapshot
from ..sources.register import is_register_file, read_archived_register_chunks, read_register_chunks

STORED = T.StructType([
    *REGISTER_FLAT.fields,
    *(T.StructField(name, T.StringType()) for name in ("source_file", "reject_reason", "raw")),
    T.StructField("load", T.LongType()),
])
FILES = T.StructType([
    T.StructField("source_file", T.StringType()),
    *(T.StructField(name, T.LongType()) for name in ("records", "rejects", "load")),
])
# Loads named one by one in the partition filter.
_LISTED = 1000


def parse(chunks: DataFrame) -> DataFrame:
    """Read and parse the text once and keep the narrow result, its headers apart. It is as long as the register: zstd makes it
    half as large as Spark's usual codec."""
    return stage(split_heads(project_register(register_events(chunks))), "register", "is_head", compression="zstd")


def _listed_files(spark: SparkSession, source: str, archived: bool) -> DataFrame:
    """Every register file of the source, those of no bytes included."""
    if archived:
        members = list_members(spark, source).where(is_register_file(F.col("member")))
        return members.select(F.concat_ws("/", "archive", "member").alias("source_file"))
    return snapshot(spark, source).where(is_register_file(F.col("path"))).select(F.col("path").alias("source_file"))


def load_register(spark: SparkSession, source: str, target: str, archived: bool = False) -> int:
    """Load every register file below ``source``; what was stored for the same files before is replaced. A file without
    records is a reject row. Returns the number of the load; what was staged for it is deleted."""
    rows_path = f"{target}/rows"
    with passing_stages(spark):
        listed = _listed_files(spark, source, archived)
        projected = parse((read_archived_register_chunks if archived else read_register_chunks)(spark, source))
        flat = flatten_register(projected).unionByName(header_rejects(projected), allowMissingColumns=True)
        load = next_number(spark, rows_path, "load")
        flat.write.parquet(f"{rows_path}/load={load}")
        stored = read_landed(spark, rows_path, STORED).where(F.col("load") == load)
        bad = F.col("reject_reason").isNotNull()
        counts = stored.groupBy("source_file").agg(F.count_if(~bad).alias("records"), F.count_if(bad).alias("rejects"))
        files = stage(listed.join(counts, "source_file", "full_outer").select(
            "source_file", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("records", "rejects"))
        ), "files")
        empty = files.where("records = 0 AND rejects = 0").select("source_file").withColumn("reject_reason", F.lit("no records"))
        empty.unionByName(stored.limit(0), allowMissingColumns=True).drop("load").write.mode("append").parquet(f"{rows_path}/load={load}")
        files.write.parquet(f"{target}/files/load={load}")
        commit(spark, rows_path, load, files.agg(F.sum("records")).first()[0] or 0)
    return load


def register_files(spark: SparkSession, target: str) -> DataFrame:
    """Files of all loads that count, with the numbers of their good and rejected rows."""
    done = commits(spark, f"{target}/rows").select(F.col("number").alias("load"))
    return read_landed(spark, f"{target}/files", FILES).join(checked_broadcast(done), "load", "left_semi")


def _stored(spark: SparkSession, target: str) -> DataFrame:
    """Rows of the latest load of every file; loads that have none of these are not opened."""
    files = register_files(spark, target)
    latest = files.groupBy("source_file").agg(F.max("load").alias("load"))
    live = [row.load for row in latest.select("load").distinct().limit(_LISTED + 1).collect()]
    rows = read_landed(spark, f"{target}/rows", STORED)
    if len(live) > _LISTED:
        rows = rows.join(checked_broadcast(latest.select("load").distinct()), "load", "left_semi")
    else:
        rows = rows.where(F.col("load").isin(live))
        files = files.where(F.col("load").isin(live))
    older = stage(files.select("source_file", "load").join(latest, ["source_file", "load"], "left_anti"), "older")
    return rows if older.isEmpty() else rows.join(checked_broadcast(older), ["source_file", "load"], "left_anti")


def read_register(spark: SparkSession, target: str) -> DataFrame:
    return _stored(spark, target).where(F.col("reject_reason").isNull()).select(*REGISTER_COLUMNS)


def read_register_rejects(spark: SparkSession, target: str) -> DataFrame:
    return _stored(spark, target).where(F.col("reject_reason").isNotNull()).select("source_file", "reject_reason", "raw")
