"""Page identity: latest copies, counts and bookmarks from the ledger of landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import BROADCAST_ROWS, fits_broadcast


_COPY = ["file_name", "uploaded_at", "id"]


def superseded_copies(raw_pages: DataFrame) -> DataFrame:
    """Copies (old_file_name, old_uploaded_at, old_id) of pages that have a later one."""
    tops = raw_pages.groupBy("file_name").agg(F.max(F.struct("uploaded_at", "id")).alias("top"))
    tops = tops.select(F.col("file_name").alias("page_name"), "top")
    # Every copy of a page may bear the page's id: a copy is told by its name, time and id together.
    return (
        raw_pages.select(*(F.col(c).alias(f"old_{c}") for c in _COPY))
        .join(tops, F.col("old_file_name").eqNullSafe(F.col("page_name")))
        .where(~F.struct(F.col("old_uploaded_at").alias("uploaded_at"), F.col("old_id").alias("id")).eqNullSafe(F.col("top")))
        .drop("page_name", "top")
        .distinct()
    )


def latest_blobs(raw_pages: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Latest copy of every stored page by (uploaded_at, id), with all its blobs.

    An aggregate with map-side partials finds the winners on narrow columns, so a page with very many copies
    is no hot group. Superseded ids are broadcast when they are few, so that file contents are not shuffled.
    """
    older = superseded_copies(raw_pages)
    same = [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in _COPY]
    older = F.broadcast(older) if fits_broadcast(older, max_rows) else older
    return raw_pages.join(older, same, "left_anti")


def page_ledger(lines: DataFrame) -> DataFrame:
    """One row per landed file: page, batch, when it landed, how many good and rejected lines."""
    bad = F.col("reject_reason").isNotNull()
    return lines.groupBy("raw_id", "segment", "page", "source_file", "source_path", "load_batch").agg(
        F.max("landed_at").alias("landed_at"),
        F.count_if(~bad).alias("records"),
        F.count_if(bad).alias("rejects"),
    )


def _copies(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Winning and superseded (load_batch, source_path) keys; a page is landed anew when it was fetched twice."""
    version = F.struct("load_batch", "landed_at", "source_path")
    unnamed = F.col("segment").isNull() | F.col("page").isNull()
    alone = F.when(unnamed, F.col("source_path")).alias("alone")  # a file that names no page is a page of its own
    winners = (
        ledger.groupBy("segment", "page", alone).agg(F.max(version).alias("top")).select("top.load_batch", "top.source_path")
    )
    keys = ledger.select("load_batch", "source_path")
    return winners, keys.join(winners, ["load_batch", "source_path"], "left_anti")


def latest_pages(lines: DataFrame, ledger: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Lines of the latest copy of every page.

    Few pages are fetched twice: normally the short list of superseded files is broadcast and the lines are
    not shuffled. A longer list falls back to a join, whose skewed partitions AQE splits.
    """
    _, superseded = _copies(ledger)
    if fits_broadcast(superseded, max_rows):
        return lines.join(F.broadcast(superseded), ["load_batch", "source_path"], "left_anti")
    return lines.join(superseded, ["load_batch", "source_path"], "left_anti")


def latest_ledger(ledger: DataFrame) -> DataFrame:
    winners, _ = _copies(ledger)
    return ledger.join(winners, ["load_batch", "source_path"], "left_semi")


def bookmarks_from_ledger(ledger: DataFrame, bookmarks: DataFrame | None = None) -> DataFrame:
    """Last page with records of every crawl, up to the first page that has not landed: a fetcher that goes on from there
    leaves no gap. The run starts behind the stored bookmark of a crawl, or at page 0; a crawl whose next page has not landed
    has no row. A page without records ends a crawl and is not one."""
    landed = (
        ledger.where(F.col("segment").isNotNull() & F.col("page").isNotNull())
        .groupBy(F.col("segment").alias("cc_index"), "page")
        .agg(F.max("records").alias("records"))
    )
    if bookmarks is None:
        landed = landed.withColumn("done", F.lit(-1).cast("long"))
    else:
        stored = bookmarks.select("cc_index", F.col("bookmark").alias("stored"))
        landed = landed.join(stored, "cc_index", "left").withColumn("done", F.coalesce("stored", F.lit(-1).cast("long")))
    in_order = Window.partitionBy("cc_index").orderBy("page")
    return (
        landed.where("page > done")
        .withColumn("nth", F.row_number().over(in_order))
        .where("page = done + nth AND records > 0")
        .groupBy("cc_index")
        .agg(F.max("page").alias("bookmark"))
    )
