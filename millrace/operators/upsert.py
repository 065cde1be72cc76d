"""Upserts by key, bookmark lookup and the "not yet done" test.

Parquet tables have no MERGE: an upsert is a full outer join on the key, stored as a new table version
(see ``sinks.versions``). Incoming rows are first reduced to one per key with map-side partial aggregation,
so that a hot key does not travel; after that both sides have unique keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BOOKMARKS, CATALOG_COLUMNS
from ..session import fits_broadcast

_ENTRY = ["name", "timegate", "cdx_api", "crawl_start", "crawl_end"]


def reduce_catalog(incoming: DataFrame) -> DataFrame:
    """One row per id: for each column the last non-NULL value in order of ``ord``. Refused entries do not count."""
    good = F.col("id").isNotNull()
    if "reject_reason" in incoming.columns:
        good = good & F.col("reject_reason").isNull()
    return incoming.where(good).groupBy("id").agg(
        *(F.max_by(name, F.when(F.col(name).isNotNull(), F.col("ord"))).alias(name) for name in _ENTRY)
    )


def upsert_catalog(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Insert or update by id; an incoming NULL keeps the stored value, ``created_at`` is set on insert only."""
    new, old = reduce_catalog(incoming).alias("new"), current.alias("old")
    merged = old.join(new, F.col("old.id") == F.col("new.id"), "full_outer")
    return merged.select(
        F.coalesce("old.id", "new.id").alias("id"),
        *(F.coalesce(f"new.{name}", f"old.{name}").alias(name) for name in _ENTRY),
        F.when(F.col("old.id").isNull(), now.cast("timestamp_ntz")).otherwise(F.col("old.created_at")).alias("created_at"),
    ).select(*CATALOG_COLUMNS)


def catalog_rejects(incoming: DataFrame) -> DataFrame:
    """Entries without the required id or with a date that is none, and the reason."""
    if "reject_reason" not in incoming.columns:
        incoming = incoming.withColumn("reject_reason", F.when(F.col("id").isNull(), "id is null"))
    return incoming.where(F.col("reject_reason").isNotNull())


def upsert_bookmarks(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Advance bookmarks by crawl: never below zero, never backwards; ``last_updated`` moves with the value."""
    newest = incoming.groupBy("cc_index").agg(F.max("bookmark").alias("bookmark"))
    old, new = current.alias("old"), newest.alias("new")
    stamp = now.cast("timestamp_ntz")
    moved = F.greatest("old.bookmark", "new.bookmark", F.lit(0).cast("bigint"))
    value = F.when(F.col("new.cc_index").isNull(), F.col("old.bookmark")).otherwise(moved)
    changed = F.col("old.cc_index").isNull() | ~value.eqNullSafe(F.col("old.bookmark"))
    return old.join(new, F.col("old.cc_index") == F.col("new.cc_index"), "full_outer").select(
        F.coalesce("old.cc_index", "new.cc_index").alias("cc_index"),
        value.alias("bookmark"),
        F.when(F.col("old.cc_index").isNull(), stamp).otherwise(F.col("old.created_at")).alias("created_at"),
        F.when(changed, stamp).otherwise(F.col("old.last_updated")).alias("last_updated"),
    ).select(*BOOKMARKS.fieldNames())


def lookup_bookmarks(segments: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """Start page of every crawl in ``segments`` (cc_index): 0 when there is no row or no value."""
    known = bookmarks.select("cc_index", F.col("bookmark").alias("found"))
    return segments.join(known, "cc_index", "left").select(
        "cc_index", F.coalesce("found", F.lit(0).cast("bigint")).alias("bookmark")
    )


def unprocessed(files: DataFrame, done: DataFrame, keys: dict[str, str] | None = None) -> DataFrame:
    """Files whose key is not in ``done``. ``keys`` maps columns of ``files`` to columns of ``done``; a page that was
    fetched again bears its id again, so upload times are compared as well where ``done`` has them (null equals null).

    ``files`` may carry file contents. When the list of done keys is too large to broadcast, the open keys are
    found on the key column alone, so that contents are shuffled only if the open list is too large as well.
    """
    if keys is None:
        keys = {"id": "raw_id"} | {c: c for c in ("uploaded_at",) if c in done.columns}
    known = done.select(*(F.col(b).alias(f"{a}_") for a, b in keys.items())).distinct()
    same = [F.col(a).eqNullSafe(F.col(f"{a}_")) for a in keys]
    if fits_broadcast(known):
        return files.join(F.broadcast(known), same, "left_anti")
    left = files.select(*keys).distinct().join(known, same, "left_anti").toDF(*(f"{a}_" for a in keys))
    if fits_broadcast(left):
        return files.join(F.broadcast(left), same, "left_semi")
    return files.join(known, same, "left_anti")
