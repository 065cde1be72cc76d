"""Index pull: catalog -> pages -> bookmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import segment_name
from ..operators.pages import bookmarks_from_ledger
from ..operators.upsert import catalog_rejects, lookup_bookmarks, upsert_bookmarks, upsert_catalog
from ..schemas import BOOKMARKS
from ..sinks.landing import write_partitions
from ..sinks.versions import read_current, write_next
from ..sources.catalog import endpoints, read_catalog
from ..streaming.pages import land_changed, land_pages, ledger

CATALOG = T.StructType([
    *(T.StructField(name, T.StringType()) for name in ("id", "name", "timegate", "cdx_api")),
    *(T.StructField(name, T.TimestampNTZType()) for name in ("crawl_start", "crawl_end", "created_at")),
])


def load_catalog(spark: SparkSession, source: str, target: str, now: Column) -> int:
    """Upsert the catalog files into the catalog table; entries without an id are kept aside. Returns the version."""
    incoming = read_catalog(spark, source)
    current = read_current(spark, f"{target}/catalog", CATALOG)
    version = write_next(upsert_catalog(current, incoming, now), f"{target}/catalog", CATALOG)
    refused = catalog_rejects(incoming).drop("ord").withColumn("version", F.lit(version).cast("bigint"))
    write_partitions(refused, f"{target}/catalog_rejects", "version")
    return version


def update_bookmarks(spark: SparkSession, target: str, now: Column) -> int:
    """Move the bookmark of every crawl to its last landed page."""
    current = read_current(spark, f"{target}/bookmarks", BOOKMARKS)
    moved = upsert_bookmarks(current, bookmarks_from_ledger(ledger(spark, target), current), now)
    return write_next(moved, f"{target}/bookmarks", BOOKMARKS)


def start_pages(spark: SparkSession, target: str) -> DataFrame:
    """Where a fetcher should go on: every crawl endpoint with its bookmark."""
    catalog = read_current(spark, f"{target}/catalog", CATALOG)
    crawls = endpoints(catalog).withColumn("cc_index", segment_name(F.col("cdx_api")))
    return lookup_bookmarks(crawls, read_current(spark, f"{target}/bookmarks", BOOKMARKS))


def pull(
    spark: SparkSession, catalog: str, landing: str, target: str, now: Column, max_files: int | None = None
) -> None:
    load_catalog(spark, catalog, target, now)
    land_pages(spark, landing, target, max_files).awaitTermination()
    land_changed(spark, landing, target)
    update_bookmarks(spark, target, now)
