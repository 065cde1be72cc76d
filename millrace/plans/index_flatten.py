"""Index flatten: landed pages or raw blobs -> cleaned records, every page exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.pages import latest_pages
from ..operators.records import clean_index_lines
from ..session import checked_broadcast, stage
from ..sinks.landing import read_landed, write_partitions
from ..sources.blobs import oldest_blobs, read_raw_pages
from ..streaming.blobs import CLEANED, flatten_copies, loads, open_copies
from ..streaming.pages import LANDED, landed_pages, ledger

# Open batches named one by one in the partition filter; more are joined.
_LISTED = 1000

PAGE_RECORDS = T.StructType([
    *(f for f in CLEANED.fields if f.name not in ("load_batch", "uploaded_at")),
    *(f for f in LANDED.fields if f.name in ("segment", "page", "source_path", "landed_at", "part", "load_batch")),
])


def flatten_pages(spark: SparkSession, target: str) -> bool:
    """Clean the landed batches that were not cleaned yet; False when there are none.

    A batch is cleaned into the partition of the same number, from its own folder only: no join, no shuffle,
    and a repeated run replaces what it had written.
    """
    done = read_landed(spark, f"{target}/flattened", T.StructType([T.StructField("load_batch", T.LongType())]))
    batches = ledger(spark, target).select("load_batch").distinct().join(done, "load_batch", "left_anti")
    lines = landed_pages(spark, target)
    first = sorted(row.load_batch for row in batches.limit(_LISTED + 1).collect())
    if len(first) <= _LISTED:
        lines = lines.where(F.col("load_batch").isin(first))
    else:
        batches = stage(batches, "batches")
        lines = lines.join(checked_broadcast(batches), "load_batch", "left_semi")
    if first:
        write_partitions(clean_index_lines(lines), f"{target}/records", "load_batch", "segment")
        marks = spark.createDataFrame([(b,) for b in first], "load_batch long") if len(first) <= _LISTED else batches
        marks.write.mode("append").parquet(f"{target}/flattened")
    return bool(first)


def page_records(spark: SparkSession, target: str) -> DataFrame:
    """Cleaned records of the latest copy of every page."""
    return latest_pages(read_landed(spark, f"{target}/records", PAGE_RECORDS), ledger(spark, target))


def flatten_blobs_once(spark: SparkSession, raw_pages: str, target: str, limit: int | None = None) -> int | None:
    """Flatten the copies of pages not done yet by any route (all, or the ``limit`` oldest) as one batch; None when there
    are none."""
    files = read_raw_pages(spark, raw_pages)
    copies = open_copies(files, loads(spark, target))
    if limit:
        copies = stage(oldest_blobs(copies, limit), "oldest")
    return None if copies.isEmpty() else flatten_copies(files, copies, target, "batch")
