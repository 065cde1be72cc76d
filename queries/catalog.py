"""Crawl catalog and bookmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import segment_name
from millrace.operators.upsert import catalog_rejects, lookup_bookmarks, upsert_bookmarks, upsert_catalog
from millrace.sources.catalog import endpoints, read_catalog

from . import fixtures as fx

ENTRIES_PER_FILE = 128
NOW, BEFORE = "2025-06-01 00:00:00", "2024-01-01 00:00:00"


def _write_arrays(entries: DataFrame, path: str) -> None:
    """JSON arrays of at most a few hundred entries each, one per file, in order of ``place``."""
    names = [c for c in entries.columns if c not in ("n", "place")]
    item = F.struct("place", F.struct(*(F.col(f"`{c}`") for c in names)).alias("entry"))
    arrays = entries.groupBy(F.floor(F.col("n") / ENTRIES_PER_FILE).alias("batch")).agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(item)), lambda e: e["entry"])).alias("value")
    )
    arrays.repartition("batch").write.partitionBy("batch").text(path)


def _first(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("c_custkey")
    at = F.expr("cast(timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_custkey) as string)")
    return fx.table(spark, folder, "customer").select(
        n.alias("n"), n.alias("place"),
        F.format_string("CC-MAIN-%d", n).alias("id"),
        F.when(n % 7 != 0, F.col("c_name")).alias("name"),
        F.format_string("https://i.example.org/CC-MAIN-%d/", n).alias("timegate"),
        F.when(n % 4 != 0, F.concat(F.format_string("https://i.example.org/CC-MAIN-%d-index", n), F.repeat(F.lit("/"), (n % 3).cast("int")))).alias("cdx-api"),
        F.concat(F.replace(at, F.lit(" "), F.lit("T")), F.when(n % 2 == 0, "Z").otherwise("")).alias("from"),
        F.when(n % 5 != 0, at).alias("to"),
    )


def _second(spark: SparkSession, folder: str) -> DataFrame:
    """Renamed entries, entries that come twice, new entries and entries without an id."""
    n = F.col("c_custkey")
    customers = fx.table(spark, folder, "customer")
    none = F.lit(None).cast("string")
    renamed = customers.where(n % 2 == 0).select(
        n.alias("n"), (n * 2).alias("place"), F.format_string("CC-MAIN-%d", n).alias("id"),
        F.when(n % 10 != 0, F.format_string("again %d", n)).alias("name"), none.alias("timegate"),
        none.alias("cdx-api"), none.alias("from"), none.alias("to"),
    )
    twice = customers.where(n % 6 == 0).select(
        n.alias("n"), (n * 2 + 1).alias("place"), F.format_string("CC-MAIN-%d", n).alias("id"),
        F.when(n % 4 == 0, F.format_string("third %d", n)).alias("name"), none.alias("timegate"),
        F.format_string("https://new.example.org/%d-index", n).alias("cdx-api"), none.alias("from"), none.alias("to"),
    )
    new = customers.where(n % 9 == 0).select(
        n.alias("n"), (n * 2 + 1).alias("place"), F.when(n % 27 != 0, F.format_string("CC-NEW-%d", n)).alias("id"),
        F.col("c_name").alias("name"), none.alias("timegate"), none.alias("cdx-api"), none.alias("from"), none.alias("to"),
    )
    undated = customers.where(n % 11 == 3).select(
        n.alias("n"), (n * 2 + 1).alias("place"), F.format_string("CC-UNDATED-%d", n).alias("id"), F.col("c_name").alias("name"),
        none.alias("timegate"), none.alias("cdx-api"), F.when(n % 2 == 0, "soon").otherwise("2025-01-01").alias("from"),
        F.when(n % 2 == 1, "2025-02-30T00:00:00").alias("to"),
    )
    return renamed.unionByName(twice).unionByName(new).unionByName(undated)


def _catalog(spark, folder):
    path = fx.once(spark, folder, "catalog", lambda p: _write_arrays(_first(spark, folder), p))
    return read_catalog(spark, path)


def _update(spark, folder):
    path = fx.once(spark, folder, "catalog_update", lambda p: _write_arrays(_second(spark, folder), p))
    return read_catalog(spark, path)


def _stored(spark, folder):
    return _catalog(spark, folder).drop("ord", "reject_reason").withColumn("created_at", F.lit(BEFORE).cast("timestamp_ntz"))


def _text(df: DataFrame, *stamps: str) -> DataFrame:
    return df.withColumns({s: F.col(s).cast("string") for s in stamps})


def catalog_load(spark, folder):
    return _text(_catalog(spark, folder).drop("ord", "reject_reason"), "crawl_start", "crawl_end")


def catalog_endpoints(spark, folder):
    return endpoints(_catalog(spark, folder))


def segment_name_query(spark, folder):
    return endpoints(_catalog(spark, folder)).select("cdx_api", segment_name(F.col("cdx_api")).alias("segment"))


def catalog_upsert(spark, folder):
    merged = upsert_catalog(_stored(spark, folder), _update(spark, folder), F.lit(NOW))
    return _text(merged, "crawl_start", "crawl_end", "created_at")


def catalog_rejects_query(spark, folder):
    return catalog_rejects(_update(spark, folder)).select("name", "reject_reason")


def _bookmarks(spark, folder):
    n = F.col("c_custkey")
    stamp = F.lit(BEFORE).cast("timestamp_ntz")
    return fx.table(spark, folder, "customer").where(n % 5 != 4).select(
        F.format_string("CC-MAIN-%d", n).alias("cc_index"), F.when(n % 3 != 0, n % 50).alias("bookmark"),
        stamp.alias("created_at"), stamp.alias("last_updated"),
    )


def bookmark_lookup(spark, folder):
    crawls = _catalog(spark, folder).select(F.col("id").alias("cc_index"))
    return lookup_bookmarks(crawls, _bookmarks(spark, folder))


def bookmark_upsert(spark, folder):
    orders = fx.table(spark, folder, "orders").select(
        F.format_string("CC-MAIN-%d", "o_custkey").alias("cc_index"), (F.col("o_orderkey") % 60 - 1).alias("bookmark")
    )
    floor = fx.table(spark, folder, "supplier").select(
        F.format_string("CC-SUP-%d", "s_suppkey").alias("cc_index"), F.lit(-1).cast("bigint").alias("bookmark")
    )
    merged = upsert_bookmarks(_bookmarks(spark, folder), orders.unionByName(floor), F.lit(NOW))
    return _text(merged, "created_at", "last_updated")


QUERIES = {
    "catalog_load": catalog_load,
    "catalog_endpoints": catalog_endpoints,
    "segment_name": segment_name_query,
    "catalog_upsert": catalog_upsert,
    "catalog_rejects": catalog_rejects_query,
    "bookmark_lookup": bookmark_lookup,
    "bookmark_upsert": bookmark_upsert,
}

_CATALOG_SQL = """
cat AS (
  SELECT c_custkey AS n, 'CC-MAIN-' || c_custkey AS id, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name,
         'https://i.example.org/CC-MAIN-' || c_custkey || '/' AS timegate,
         CASE WHEN c_custkey % 4 <> 0
              THEN 'https://i.example.org/CC-MAIN-' || c_custkey || '-index' || repeat('/', c_custkey % 3) END AS cdx_api,
         strftime(TIMESTAMP '2025-01-01' + to_seconds(c_custkey), '%Y-%m-%d %H:%M:%S') AS crawl_start,
         CASE WHEN c_custkey % 5 <> 0
              THEN strftime(TIMESTAMP '2025-01-01' + to_seconds(c_custkey), '%Y-%m-%d %H:%M:%S') END AS crawl_end
  FROM customer
)"""

_BOOKMARK_SQL = f"""
bm AS (
  SELECT 'CC-MAIN-' || c_custkey AS cc_index, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 50 END AS bookmark,
         '{BEFORE}' AS created_at, '{BEFORE}' AS last_updated
  FROM customer WHERE c_custkey % 5 <> 4
)"""

ORACLE = {
    "catalog_load": f"WITH {_CATALOG_SQL} SELECT id, name, timegate, cdx_api, crawl_start, crawl_end FROM cat",
    "catalog_endpoints": f"WITH {_CATALOG_SQL} SELECT cdx_api FROM cat WHERE cdx_api IS NOT NULL",
    "segment_name": f"WITH {_CATALOG_SQL} SELECT cdx_api, 'CC-MAIN-' || n AS segment FROM cat WHERE cdx_api IS NOT NULL",
    "catalog_upsert": f"""WITH {_CATALOG_SQL}
        SELECT id,
               CASE WHEN n % 6 = 0 AND n % 4 = 0 THEN 'third ' || n
                    WHEN n % 2 = 0 AND n % 10 <> 0 THEN 'again ' || n ELSE name END AS name,
               timegate, CASE WHEN n % 6 = 0 THEN 'https://new.example.org/' || n || '-index' ELSE cdx_api END AS cdx_api,
               crawl_start, crawl_end, '{BEFORE}' AS created_at
        FROM cat
        UNION ALL
        SELECT 'CC-NEW-' || c_custkey, c_name, NULL, NULL, NULL, NULL, '{NOW}'
        FROM customer WHERE c_custkey % 9 = 0 AND c_custkey % 27 <> 0""",
    "catalog_rejects": """SELECT c_name AS name, 'id is null' AS reject_reason FROM customer WHERE c_custkey % 27 = 0
        UNION ALL
        SELECT c_name, CASE WHEN c_custkey % 2 = 0 THEN 'from' ELSE 'to' END || ' is no date'
        FROM customer WHERE c_custkey % 11 = 3""",
    "bookmark_lookup": f"""WITH {_CATALOG_SQL}, {_BOOKMARK_SQL}
        SELECT cat.id AS cc_index, coalesce(bm.bookmark, 0) AS bookmark FROM cat LEFT JOIN bm ON bm.cc_index = cat.id""",
    "bookmark_upsert": f"""WITH {_BOOKMARK_SQL},
        inc AS (
          SELECT cc_index, max(bookmark) AS bookmark FROM (
            SELECT 'CC-MAIN-' || o_custkey AS cc_index, o_orderkey % 60 - 1 AS bookmark FROM orders
            UNION ALL SELECT 'CC-SUP-' || s_suppkey, -1 FROM supplier) GROUP BY cc_index),
        merged AS (
          SELECT coalesce(bm.cc_index, inc.cc_index) AS cc_index, bm.cc_index IS NULL AS is_new, bm.bookmark AS old_value,
                 CASE WHEN inc.cc_index IS NULL THEN bm.bookmark
                      ELSE greatest(coalesce(bm.bookmark, 0), inc.bookmark, 0) END AS bookmark
          FROM bm FULL JOIN inc ON bm.cc_index = inc.cc_index)
        SELECT cc_index, CAST(bookmark AS BIGINT) AS bookmark, CASE WHEN is_new THEN '{NOW}' ELSE '{BEFORE}' END AS created_at,
               CASE WHEN is_new OR bookmark IS DISTINCT FROM old_value THEN '{NOW}' ELSE '{BEFORE}' END AS last_updated
        FROM merged""",
}
