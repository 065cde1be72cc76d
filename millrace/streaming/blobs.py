"""Incremental flattening of the raw page table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.pages import latest_blobs, superseded_copies
from ..operators.records import clean_index_lines
from ..operators.upsert import unprocessed
from ..schemas import INDEX_RECORDS, RAW_PAGES
from ..session import checked_broadcast, stage
from ..sinks.landing import committed, next_batch, read_batch, read_landed, stream_id, write_batch, write_partitions
from ..sources.blobs import decode_blobs, is_parquet_blob, parquet_blobs
from ..sources.pages import ANY_AGE

CLEANED = T.StructType([
    *INDEX_RECORDS.fields,
    T.StructField("mime_detected", T.StringType()),
    T.StructField("uploaded_at", T.TimestampNTZType()),
    T.StructField("reject_reason", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("load_batch", T.LongType()),
])

LOADS = T.StructType([
    T.StructField("raw_id", T.LongType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("uploaded_at", T.TimestampNTZType()),
    T.StructField("records", T.LongType()),
    T.StructField("rejects", T.LongType()),
    T.StructField("route", T.StringType()),
    T.StructField("load_batch", T.LongType()),
])


def open_copies(files: DataFrame, done: DataFrame) -> DataFrame:
    """Copies of pages (id, file_name, uploaded_at) not in ``done``; found once, on narrow columns."""
    copies = files.where(is_parquet_blob(F.col("file_name"))).select("id", "file_name", "uploaded_at").distinct()
    return stage(unprocessed(copies, done), "open")


def flatten_copies(files: DataFrame, copies: DataFrame, target: str, route: str) -> int:
    """Decode and clean the latest of the staged ``copies`` of each page as a new batch of records; then list all copies
    with their counts, which marks them as done. Returns the batch number."""
    spark = files.sparkSession
    load_batch = next_batch(spark, target)
    wanted = latest_blobs(copies).select(F.col("id").alias("id_"), F.col("file_name").alias("name_"), F.col("uploaded_at").alias("at_"))
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("id", "id_"), ("file_name", "name_"), ("uploaded_at", "at_"))]
    blobs = parquet_blobs(files).join(checked_broadcast(wanted), same, "left_semi")
    write_batch(clean_index_lines(decode_blobs(blobs)), f"{target}/records", load_batch)
    stored = read_batch(spark, f"{target}/records", CLEANED, load_batch)
    key = {"raw_id": "id", "source_file": "file_name", "uploaded_at": "uploaded_at"}
    counts = stored.groupBy(*(F.col(c).alias(f"{c}_") for c in key)).agg(
        F.count_if(F.col("reject_reason").isNull()).alias("records"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejects"),
    )
    # An empty blob and a superseded copy have no rows to count but are done all the same.
    listed = copies.select(*(F.col(b).alias(a) for a, b in key.items()))
    done = listed.join(counts, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in key], "left").select(
        *key,
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("rejects", F.lit(0)).alias("rejects"),
        F.lit(route).alias("route"),
        F.lit(load_batch).cast("bigint").alias("load_batch"),
    )
    write_partitions(done, f"{target}/loads", "load_batch")
    return load_batch


def flatten_blobs(spark: SparkSession, raw_pages: str, target: str, max_files: int | None = None) -> StreamingQuery:
    """Flatten every raw page file not flattened before, ``max_files`` table files per batch, then stop.

    Copies that the batch route or a stream with a lost checkpoint has done are left out; of its own batches, a repeated
    one does nothing more once it is listed.
    """
    reader = spark.readStream.schema(RAW_PAGES).option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def flatten(batch: DataFrame, batch_id: int) -> None:
        own = stream_id(batch.sparkSession, target)
        done = loads(batch.sparkSession, target)
        if done.where(F.col("route") == f"{own}/{batch_id}").isEmpty():
            copies = open_copies(batch, done.where(~F.col("route").startswith(f"{own}/")))
            if not copies.isEmpty():
                flatten_copies(batch, copies, target, f"{own}/{batch_id}")

    return (
        reader.parquet(raw_pages)
        .writeStream.foreachBatch(flatten)
        .option("checkpointLocation", f"{target}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def cleaned(spark: SparkSession, target: str) -> DataFrame:
    """Records of every copy that was flattened, and rejects."""
    return committed(read_landed(spark, f"{target}/records", CLEANED), loads(spark, target))


def latest_cleaned(spark: SparkSession, target: str) -> DataFrame:
    """The same of the latest copy of each page."""
    done = loads(spark, target).select(F.col("raw_id").alias("id"), F.col("source_file").alias("file_name"), "uploaded_at")
    same = {"raw_id": "old_id", "source_file": "old_file_name", "uploaded_at": "old_uploaded_at"}
    older = checked_broadcast(superseded_copies(done))
    return cleaned(spark, target).join(older, [F.col(a).eqNullSafe(F.col(b)) for a, b in same.items()], "left_anti")


def loads(spark: SparkSession, target: str) -> DataFrame:
    return read_landed(spark, f"{target}/loads", LOADS)
