"""Index pages: scan, clean, land, pack, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import (
    crawl_timestamp, empty_to_null, is_unusable_number, page_file_name, to_bigint, url_domain, url_path,
)
from millrace.operators.append import append_all
from millrace.operators.counts import load_counts, page_sizes, target_count
from millrace.operators.pages import bookmarks_from_ledger, latest_blobs, latest_pages
from millrace.operators.records import (
    broken_constraints, clean_index_lines, conform, good, in_scope, index_flat, index_records, rejects, repeated_keys,
    with_lineage,
)
from millrace.operators.upsert import unprocessed
from millrace.plans.index_flatten import flatten_blobs_once, flatten_pages, page_records
from millrace.plans.register_load import load_register, read_register_rejects
from millrace.schemas import PAGE_KEYS
from millrace.session import scratch_path, small_files, stage
from millrace.sinks.blobs import pack_blobs
from millrace.sources.blobs import decode_blobs, oldest_blobs, parquet_blobs, read_raw_pages
from millrace.sources.pages import read_index_pages
from millrace.streaming import blobs as blob_stream
from millrace.streaming import pages as page_stream

from . import fixtures as fx


_RAW_SQL = 'urlkey, "timestamp", url, mime, mime_detected, status, digest, length, "offset", filename'
_ID_SQL = "page * 100 + CAST(right(segment, 2) AS BIGINT)"
_STAMP_SQL = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_RECORD_SQL = (
    f"{_ID_SQL} AS raw_id, source_file, urlkey, {_STAMP_SQL.format('crawl_timestamp')}, status, url, filename, length, "
    "mime, file_offset, digest"
)
NOW = "2025-06-01 00:00:00"


def _keys() -> list[F.Column]:
    return [F.col(f"`{key}`").alias(key.replace("-", "_")) for key in PAGE_KEYS]


def _serial() -> F.Column:
    """Serial id of a page as a relational table would give it."""
    return F.col("page") * 100 + F.substring("segment", -2, 2).cast("bigint")


def _readable(df: DataFrame, *stamps: str) -> DataFrame:
    return df.withColumns({s: F.col(s).cast("string") for s in stamps})


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return read_index_pages(spark, fx.index_pages(spark, folder)).withColumn("raw_id", _serial())


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_index_lines(_lines(spark, folder))


# --- scan, project, filter -------------------------------------------------------------------------------------


def index_page_scan(spark, folder):
    return read_index_pages(spark, fx.index_pages(spark, folder)).select("segment", "page", *_keys())


def conform_schema(spark, folder):
    status = F.when(F.col("k") % 5 == 1, F.lit(404.0)).when(F.col("k") % 5 == 0, F.lit(float("nan"))).otherwise(F.lit(200.0))
    loose = fx.index_lines(spark, folder).drop("digest").withColumn("status", status)
    return conform(loose, ["urlkey", "timestamp", "status", "url", "filename", "length", "mime", "offset", "digest"])


def lineage_columns(spark, folder):
    lines = with_lineage(
        fx.index_lines(spark, folder), F.col("page") * 100, page_file_name(F.col("segment"), F.col("page"))
    )
    return lines.select("raw_id", "source_file", "url", "filename")


def index_records_query(spark, folder):
    return _readable(index_records(_cleaned(spark, folder)), "crawl_timestamp")


def index_flat_query(spark, folder):
    return _readable(index_flat(_cleaned(spark, folder), F.lit(NOW)), "timestamp", "inserted_at").withColumns(
        {"status": F.col("status").cast("bigint"), "length": F.col("length").cast("bigint")}
    )


def domain_status(spark, folder):
    """Flagship: captures and bytes per domain and status over the analytics view."""
    flat = index_flat(_cleaned(spark, folder), F.lit(NOW))
    return flat.groupBy("domain", F.col("status").cast("bigint").alias("status")).agg(
        F.count("*").alias("captures"), F.sum(F.col("length").cast("bigint")).alias("bytes")
    )


def constraint_rejects(spark, folder):
    """Rows that break a constraint, and record places that a stored load (every seventh record, some twice) has as well."""
    cleaned = stage(_cleaned(spark, folder), "cleaned")  # four branches read it: the pages are parsed once
    stored = cleaned.where("file_offset % 7000 = 0")
    stored = append_all(stored, stored.where("file_offset % 35000 = 0"))
    repeated = repeated_keys(good(cleaned), ["filename", "file_offset"], good(stored)).select(
        F.col("filename").alias("source_file"), "file_offset", F.lit("key is repeated").alias("reject_reason"), "n"
    )
    broken = broken_constraints(cleaned).select("source_file", "file_offset", "reject_reason", F.lit(1).cast("long").alias("n"))
    return broken.unionByName(repeated)


def index_scope_filter(spark, folder):
    lines = read_index_pages(spark, fx.index_pages(spark, folder))
    return lines.where(in_scope(to_bigint(F.col("status")), F.col("urlkey"), F.col("url"))).select("url", "urlkey", "status")


def _faulty(spark: SparkSession, folder: str) -> DataFrame:
    """Landed lines of the faulty pages."""

    def build(target: str) -> None:
        page_stream.land_batch(read_index_pages(spark, fx.faulty_pages(spark, folder)), target, 0)

    return page_stream.landed_pages(spark, fx.once(spark, folder, "faulty_landed", build))


def json_rejects(spark, folder):
    return rejects(_faulty(spark, folder)).groupBy("source_file", "reject_reason").agg(
        F.count("*").alias("n"), F.max(F.length("raw")).cast("bigint").alias("raw_length")
    )


def packed_page_scan(spark, folder):
    """Gzipped pages, some damaged: the good ones load."""
    lines = read_index_pages(spark, fx.packed_pages(spark, folder))
    return good(lines).select("segment", "page", *_keys())


def file_rejects(spark, folder):
    """Unreadable blobs, gzipped pages and register files beside rows whose numbers cannot be kept."""
    blobs = rejects(clean_index_lines(decode_blobs(parquet_blobs(_raw_pages(spark, folder)))))
    rows = rejects(clean_index_lines(_faulty(spark, folder))).where("raw is null")
    pages = rejects(clean_index_lines(read_index_pages(spark, fx.packed_pages(spark, folder))))
    target = scratch_path(spark, "spoiled_register_table")
    load_register(spark, fx.spoiled_register(spark, folder), target)
    files = read_register_rejects(spark, target).withColumn("source_file", F.substring_index("source_file", "/", -1))
    return append_all(blobs, rows, pages, files).groupBy("source_file", "reject_reason").agg(F.count("*").alias("n"))


# --- scalar functions ------------------------------------------------------------------------------------------


def _scalar(spark: SparkSession, folder: str, **columns: F.Column) -> DataFrame:
    return fx.index_lines(spark, folder).select("k", *(value.alias(name) for name, value in columns.items()))


def page_file_name_query(spark, folder):
    return _scalar(spark, folder, file_name=page_file_name(F.col("segment"), F.col("page")))


def crawl_timestamp_query(spark, folder):
    return _scalar(spark, folder, crawl_timestamp=crawl_timestamp(F.col("timestamp")).cast("string"))


def numeric_coerce(spark, folder):
    halved = F.concat(F.col("length"), F.when(F.col("k") % 3 == 0, ".5").otherwise(".0"))
    numbers = {name: to_bigint(F.col(key)) for name, key in (("status", "status"), ("length", "length"), ("file_offset", "offset"))}
    return _scalar(spark, folder, **numbers, unusable=is_unusable_number(halved))


def empty_to_null_query(spark, folder):
    return _scalar(spark, folder, urlkey=empty_to_null(F.col("urlkey")), mime=empty_to_null(F.col("mime")))


def url_domain_query(spark, folder):
    return _scalar(spark, folder, domain=url_domain(F.col("url")))


def url_path_query(spark, folder):
    return _scalar(spark, folder, path=url_path(F.col("url")))


# --- raw page table --------------------------------------------------------------------------------------------


def _raw_pages_path(spark: SparkSession, folder: str) -> str:
    """Raw page table: gzipped and plain blobs, other files, unreadable blobs, some without upload time."""
    page, segment = F.col("page"), F.col("segment")

    def build(path: str) -> None:
        name = F.concat(
            segment, F.lit("-"), page.cast("string"),
            F.when(page % 7 == 3, ".json").when(page % 2 == 0, ".parquet.gz").otherwise(".PARQUET"),
        )
        packed = pack_blobs(_lines(spark, folder), name, F.lit("2025-01-01 00:00:00"))
        at = F.floor(F.col("id") / 100)
        packed.withColumns({
            "file_data": F.when(at % 7 == 5, F.encode(F.lit("no parquet here"), "UTF-8")).otherwise(F.col("file_data")),
            "uploaded_at": F.when(
                at % 11 != 10,
                F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, cast(id % 1000 as int), 0)"),
            ),
        }).repartition(6, "id").write.parquet(path)

    return fx.once(spark, folder, "raw_pages", build)


def _raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    return read_raw_pages(spark, _raw_pages_path(spark, folder))


_BLOB_SQL = fx.INDEX_SQL + f""",
blob AS (
  SELECT DISTINCT {_ID_SQL} AS id, page, segment,
         segment || '-' || page || CASE WHEN page % 7 = 3 THEN '.json' WHEN page % 2 = 0 THEN '.parquet.gz' ELSE '.PARQUET' END
           AS file_name,
         CASE WHEN page % 11 = 10 THEN NULL ELSE TIMESTAMP '2025-01-01' + to_minutes(({_ID_SQL}) % 1000) END AS uploaded_at
  FROM idx
)"""


def raw_blob_scan(spark, folder):
    return parquet_blobs(_raw_pages(spark, folder)).select("id", "file_name", (F.length("file_data") > 0).alias("filled"))


def blob_decode(spark, folder):
    decoded = decode_blobs(parquet_blobs(_raw_pages(spark, folder)))
    return good(decoded).select("raw_id", "source_file", *_keys())


def blob_pack_roundtrip(spark, folder):
    path = scratch_path(spark, "packed")
    name = page_file_name(F.col("segment"), F.col("page"))
    pack_blobs(_lines(spark, folder), name, F.lit(NOW)).write.parquet(path)
    return good(decode_blobs(read_raw_pages(spark, path))).select("raw_id", "source_file", *_keys())


def oldest_blobs_query(spark, folder):
    return _readable(oldest_blobs(_raw_pages(spark, folder), 10).select("id", "file_name", "uploaded_at"), "uploaded_at")


def unprocessed_files(spark, folder):
    blobs = _raw_pages(spark, folder)
    done = blobs.where(F.floor(F.col("id") / 100) % 3 == 0).select(F.col("id").alias("raw_id"))
    return unprocessed(blobs, done).select("id", "file_name")


def latest_page(spark, folder):
    blobs = _raw_pages(spark, folder).select("id", "file_name", "uploaded_at")
    again = blobs.where("id % 3 = 0").withColumns({
        "id": F.col("id") + 1_000_000, "uploaded_at": F.expr("uploaded_at + interval 1 day")
    })
    return _readable(latest_blobs(append_all(blobs, again)), "uploaded_at")


def page_sizes_query(spark, folder):
    sizes = page_sizes(_raw_pages(spark, folder).withColumn("file_size", F.length("file_data").cast("bigint")))
    return sizes.select("file_name", (F.col("bytes") == F.col("file_size")).alias("agree"), (F.col("bytes") > 0).alias("filled"))


# --- landing, counting, incremental loads ----------------------------------------------------------------------


def _landed(spark: SparkSession, folder: str) -> str:
    def build(target: str) -> None:
        page_stream.land_pages(spark, fx.index_pages(spark, folder), target).awaitTermination()

    return fx.once(spark, folder, "landed", build)


def _flattened(spark: SparkSession, folder: str) -> str:
    target = _landed(spark, folder)
    flatten_pages(spark, target)
    return target


def page_land(spark, folder):
    target = scratch_path(spark, "page_land")
    lines = read_index_pages(spark, fx.index_pages(spark, folder))
    page_stream.land_batch(lines, target, 0)
    page_stream.land_batch(lines, target, 0)  # landing a batch again replaces it
    return page_stream.landed_pages(spark, target).groupBy("segment", "page").agg(F.count("*").alias("n"))


def records_append(spark, folder):
    target = _flattened(spark, folder)
    flatten_pages(spark, target)  # nothing is left to do
    records = good(page_records(spark, target)).withColumn("raw_id", _serial())
    return _readable(index_records(records), "crawl_timestamp")


def target_count_query(spark, folder):
    return target_count(page_records(spark, _flattened(spark, folder)))


def load_counts_query(spark, folder):
    return load_counts(good(page_records(spark, _flattened(spark, folder))))


def stream_counts(spark, folder):
    return page_stream.running_counts(spark, _landed(spark, folder))


def bookmark_from_pages(spark, folder):
    """Page 0 of one crawl is missing; another crawl goes on behind a stored bookmark, with its first pages gone."""
    segment, page = F.col("segment"), F.col("page")
    gone = (segment.endswith("-13") & (page == 0)) | (segment.endswith("-21") & (page <= 1))
    stored = spark.createDataFrame([("CC-MAIN-2025-21", 1)], "cc_index string, bookmark long")
    return bookmarks_from_ledger(page_stream.ledger(spark, _landed(spark, folder)).where(~gone), stored)


def incremental_pages(spark, folder):
    """Two deliveries and a run without any; every line is landed once."""
    source, target = scratch_path(spark, "deliveries"), scratch_path(spark, "incremental")
    lines = fx.clustered_index_lines(spark, folder)
    for run, delivery in enumerate((lines.where("page % 2 = 0"), lines.where("page % 2 = 1"), None)):
        if delivery is not None:
            fx._write_pages(delivery, source, False, run)
        page_stream.land_pages(spark, source, target, max_files=16).awaitTermination()
    return page_stream.landed_pages(spark, target).select("segment", "page", *_keys())


def page_dedup(spark, folder):
    """All pages, then every third again with other content: the later copy counts."""
    source, target = scratch_path(spark, "refetch"), scratch_path(spark, "dedup")
    lines = fx.clustered_index_lines(spark, folder)
    fx._write_pages(lines, source, False, 1)
    page_stream.land_pages(spark, source, target).awaitTermination()
    fx._write_pages(lines.where("page % 3 = 0").withColumn("mime", F.lit("second/copy")), source, False, 2)
    page_stream.land_pages(spark, source, target).awaitTermination()
    latest = latest_pages(page_stream.landed_pages(spark, target), page_stream.ledger(spark, target))
    return latest.groupBy("segment", "page", "mime").agg(F.count("*").alias("n"))


def incremental_flatten(spark, folder):
    """Raw page table flattened two table files at a time; a second run adds nothing."""
    target = scratch_path(spark, "flattened")
    for _ in range(2):
        blob_stream.flatten_blobs(spark, _raw_pages_path(spark, folder), target, max_files=2).awaitTermination()
    return _readable(index_records(blob_stream.cleaned(spark, target)), "crawl_timestamp")


def batch_flatten(spark, folder):
    """The same by batch jobs: the ten oldest first, then the rest, then nothing."""
    target, source = scratch_path(spark, "batches"), _raw_pages_path(spark, folder)
    for limit in (10, None, None):
        flatten_blobs_once(spark, source, target, limit)
    return blob_stream.loads(spark, target).select("raw_id", "source_file", "records", "rejects")


def blob_refetch(spark, folder):
    """All pages packed and flattened, then every third again with a third of its lines: ids are the library's own."""
    raw, target = scratch_path(spark, "raw"), scratch_path(spark, "refetched")
    lines = read_index_pages(spark, fx.index_pages(spark, folder))
    for later, some in enumerate((lines, lines.where("page % 3 = 0 AND try_cast(offset AS bigint) % 3 = 0"))):
        stamp = F.lit(f"2025-01-0{later + 1} 00:00:00")
        with small_files(spark):
            pack_blobs(some, page_file_name(F.col("segment"), F.col("page")), stamp).write.mode("append").parquet(raw)
        flatten_blobs_once(spark, raw, target)
    return good(blob_stream.latest_cleaned(spark, target)).groupBy("source_file").agg(
        F.count("*").alias("n"), F.sum("file_offset").cast("bigint").alias("offsets")
    )


def append_union(spark, folder):
    """Two loads of all lines, the second without one column; duplicates stay."""
    lines = fx.index_lines(spark, folder).select("segment", "url", "mime")
    return append_all(lines, lines.drop("mime")).groupBy("segment", "mime").agg(
        F.count("*").alias("n"), F.countDistinct("url").alias("urls")
    )


QUERIES = {
    "domain_status": domain_status,
    "index_page_scan": index_page_scan,
    "packed_page_scan": packed_page_scan,
    "conform_schema": conform_schema,
    "lineage_columns": lineage_columns,
    "index_records": index_records_query,
    "index_flat": index_flat_query,
    "constraint_rejects": constraint_rejects,
    "index_scope_filter": index_scope_filter,
    "json_rejects": json_rejects,
    "file_rejects": file_rejects,
    "page_file_name": page_file_name_query,
    "crawl_timestamp": crawl_timestamp_query,
    "numeric_coerce": numeric_coerce,
    "empty_to_null": empty_to_null_query,
    "url_domain": url_domain_query,
    "url_path": url_path_query,
    "raw_blob_scan": raw_blob_scan,
    "blob_decode": blob_decode,
    "blob_pack_roundtrip": blob_pack_roundtrip,
    "oldest_blobs": oldest_blobs_query,
    "unprocessed_files": unprocessed_files,
    "latest_page": latest_page,
    "page_sizes": page_sizes_query,
    "page_land": page_land,
    "records_append": records_append,
    "target_count": target_count_query,
    "load_counts": load_counts_query,
    "stream_counts": stream_counts,
    "bookmark_from_pages": bookmark_from_pages,
    "incremental_pages": incremental_pages,
    "page_dedup": page_dedup,
    "blob_refetch": blob_refetch,
    "incremental_flatten": incremental_flatten,
    "batch_flatten": batch_flatten,
    "append_union": append_union,
}

_FLAT_SQL = fx.CLEAN_SQL + """,
flat AS (
  SELECT urlkey, url, crawl_timestamp, try_cast(status AS SMALLINT) AS status, mime, mime_detected, digest,
         try_cast(length AS INTEGER) AS length, file_offset, filename,
         nullif(regexp_extract(url, 'https?://([^/]+)/', 1), '') AS "domain",
         nullif(regexp_extract(url, '(?s)https?://[^/]+(/.*)', 1), '') AS path
  FROM clean
  WHERE urlkey IS NOT NULL AND url IS NOT NULL AND crawl_timestamp IS NOT NULL AND length(digest) <= 32
)"""

_GOOD_BLOB = "page % 7 NOT IN (3, 5)"
_BLOB_NAME_SQL = "segment || '-' || page || CASE WHEN page % 2 = 0 THEN '.parquet.gz' ELSE '.PARQUET' END"

ORACLE = {
    "domain_status": f"""WITH {_FLAT_SQL}
        SELECT "domain", CAST(status AS BIGINT) AS status, count(*) AS captures, CAST(sum(length) AS BIGINT) AS bytes
        FROM flat GROUP BY ALL""",
    "index_page_scan": f"WITH {fx.INDEX_SQL} SELECT segment, page, {_RAW_SQL} FROM idx",
    "packed_page_scan": f"WITH {fx.INDEX_SQL} SELECT segment, page, {_RAW_SQL} FROM idx WHERE page % 5 <> 2",
    "conform_schema": f"""WITH {fx.INDEX_SQL}
        SELECT urlkey, "timestamp", CASE k % 5 WHEN 1 THEN '404.0' WHEN 0 THEN NULL ELSE '200.0' END AS status, url,
               filename, length, mime, "offset", CAST(NULL AS VARCHAR) AS digest FROM idx""",
    "lineage_columns": f"""WITH {fx.INDEX_SQL}
        SELECT page * 100 AS raw_id, segment || '-' || page || '.parquet.gz' AS source_file, url, filename FROM idx""",
    "index_records": f"WITH {fx.CLEAN_SQL} SELECT {_RECORD_SQL} FROM clean",
    "index_flat": f"""WITH {_FLAT_SQL}
        SELECT urlkey, url, strftime(crawl_timestamp, '%Y-%m-%d %H:%M:%S') AS "timestamp",
               CAST(status AS BIGINT) AS status, mime, mime_detected, digest, CAST(length AS BIGINT) AS length,
               file_offset, filename, "domain", path, '{NOW}' AS inserted_at FROM flat""",
    "constraint_rejects": f"""WITH {fx.CLEAN_SQL}
        SELECT *, CAST(1 AS BIGINT) AS n FROM (
          SELECT source_file, file_offset,
                 CASE WHEN urlkey IS NULL THEN 'urlkey is null' WHEN url IS NULL THEN 'url is null'
                      WHEN crawl_timestamp IS NULL THEN 'timestamp is null'
                      WHEN length(digest) > 32 THEN 'digest is too long' END AS reject_reason
          FROM clean) WHERE reject_reason IS NOT NULL
        UNION ALL
        SELECT filename, file_offset, 'key is repeated', CASE WHEN k % 35 = 0 THEN 3 ELSE 2 END FROM clean WHERE k % 7 = 0""",
    "index_scope_filter": f"""WITH {fx.INDEX_SQL}
        SELECT url, urlkey, status FROM idx
        WHERE try_cast(trim(status) AS DOUBLE) = 200
          AND (starts_with(urlkey, 'au,') OR regexp_matches(url, '(?i)^https?://([^/@]*@)?[^/:]*\\.au(:[0-9]+)?([/?#]|$)'))""",
    "json_rejects": f"""WITH {fx.INDEX_SQL}
        SELECT segment || '-' || page || '.parquet.gz' AS source_file, 'malformed json' AS reject_reason, count(*) AS n,
               CAST(40 AS BIGINT) AS raw_length
        FROM idx WHERE k % 101 = 7 GROUP BY ALL""",
    "file_rejects": f"""WITH {_BLOB_SQL}, {fx.ENTITY_SQL}
        SELECT file_name AS source_file,
               'unreadable blob: ' || CASE WHEN page % 2 = 0 THEN 'BadGzipFile' ELSE 'ArrowInvalid' END AS reject_reason,
               CAST(1 AS BIGINT) AS n
        FROM blob WHERE page % 7 = 5
        UNION ALL
        SELECT segment || '-' || page || '.parquet.gz', 'length is no integer', count(*)
        FROM idx WHERE k % 103 = 5 AND k % 101 <> 7 GROUP BY ALL
        UNION ALL
        SELECT DISTINCT segment || '-' || page || '.parquet.gz', 'unreadable file: EOFError', 1 FROM idx WHERE page % 5 = 2
        UNION ALL
        SELECT DISTINCT 'register-' || grp || '.xml.gz', 'unreadable file: EOFError', 1 FROM ent WHERE grp % 3 = 1""",
    "page_file_name": f"WITH {fx.INDEX_SQL} SELECT k, segment || '-' || page || '.parquet.gz' AS file_name FROM idx",
    "crawl_timestamp": f"WITH {fx.CLEAN_SQL} SELECT k, {_STAMP_SQL.format('crawl_timestamp')} FROM clean",
    "numeric_coerce": f"""WITH {fx.CLEAN_SQL}
        SELECT k, status, length, file_offset, coalesce(length IS NOT NULL AND k % 3 = 0, false) AS unusable FROM clean""",
    "empty_to_null": f"WITH {fx.CLEAN_SQL} SELECT k, urlkey, mime FROM clean",
    "url_domain": f"""WITH {fx.INDEX_SQL}
        SELECT k, nullif(regexp_extract(url, 'https?://([^/]+)/', 1), '') AS "domain" FROM idx""",
    "url_path": f"""WITH {fx.INDEX_SQL}
        SELECT k, nullif(regexp_extract(url, '(?s)https?://[^/]+(/.*)', 1), '') AS path FROM idx""",
    "raw_blob_scan": f"WITH {_BLOB_SQL} SELECT id, file_name, true AS filled FROM blob WHERE page % 7 <> 3",
    "blob_decode": f"""WITH {fx.INDEX_SQL}
        SELECT {_ID_SQL} AS raw_id, {_BLOB_NAME_SQL} AS source_file, {_RAW_SQL} FROM idx WHERE {_GOOD_BLOB}""",
    "blob_pack_roundtrip": f"""WITH {fx.INDEX_SQL}
        SELECT {_ID_SQL} AS raw_id, segment || '-' || page || '.parquet.gz' AS source_file, {_RAW_SQL} FROM idx""",
    "oldest_blobs": f"""WITH {_BLOB_SQL}
        SELECT id, file_name, {_STAMP_SQL.format('uploaded_at')} FROM (
          SELECT * FROM blob WHERE page % 7 <> 3 ORDER BY uploaded_at NULLS LAST, id LIMIT 10)""",
    "unprocessed_files": f"WITH {_BLOB_SQL} SELECT id, file_name FROM blob WHERE page % 3 <> 0",
    "latest_page": f"""WITH {_BLOB_SQL},
        copies AS (SELECT id, file_name, uploaded_at FROM blob
                   UNION ALL SELECT id + 1000000, file_name, uploaded_at + INTERVAL 1 DAY FROM blob WHERE id % 3 = 0)
        SELECT id, file_name, {_STAMP_SQL.format('uploaded_at')} FROM copies
        QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY copies.uploaded_at DESC NULLS LAST, id DESC) = 1""",
    "page_sizes": f"""WITH {_BLOB_SQL}
        SELECT file_name, true AS agree, true AS filled FROM blob UNION ALL SELECT NULL, true, true""",
    "page_land": f"WITH {fx.INDEX_SQL} SELECT segment, page, count(*) AS n FROM idx GROUP BY ALL",
    "records_append": f"WITH {fx.CLEAN_SQL} SELECT {_RECORD_SQL} FROM clean",
    "target_count": f"WITH {fx.INDEX_SQL} SELECT count(*) AS n FROM idx",
    "load_counts": f"""WITH {fx.CLEAN_SQL}
        SELECT source_file, count(*) AS n FROM clean GROUP BY ROLLUP (source_file)""",
    "stream_counts": f"""WITH {fx.CLEAN_SQL}
        SELECT source_file, count(*) AS records, CAST(0 AS BIGINT) AS rejects FROM clean GROUP BY source_file""",
    "bookmark_from_pages": f"""WITH {fx.INDEX_SQL}
        SELECT segment AS cc_index, max(page) AS bookmark FROM idx WHERE segment NOT LIKE '%-13' GROUP BY segment
        HAVING segment NOT LIKE '%-21' OR max(page) > 1""",
    "incremental_pages": f"WITH {fx.INDEX_SQL} SELECT segment, page, {_RAW_SQL} FROM idx",
    "page_dedup": f"""WITH {fx.INDEX_SQL}
        SELECT segment, page, CASE WHEN page % 3 = 0 THEN 'second/copy' ELSE mime END AS mime, count(*) AS n
        FROM idx GROUP BY ALL""",
    "blob_refetch": f"""WITH {fx.CLEAN_SQL}
        SELECT source_file, count(*) AS n, CAST(sum(file_offset) AS BIGINT) AS offsets
        FROM (SELECT *, count_if(page % 3 = 0 AND file_offset % 3 = 0) OVER (PARTITION BY source_file) AS again FROM clean)
        WHERE again = 0 OR file_offset % 3 = 0 GROUP BY source_file""",
    "incremental_flatten": f"""WITH {fx.CLEAN_SQL}
        SELECT {_RECORD_SQL.replace('source_file', _BLOB_NAME_SQL + ' AS source_file')} FROM clean WHERE {_GOOD_BLOB}""",
    "batch_flatten": f"""WITH {_BLOB_SQL}
        SELECT id AS raw_id, file_name AS source_file,
               CASE WHEN blob.page % 7 = 5 THEN 0 ELSE count(*) END AS records,
               CAST(CASE WHEN blob.page % 7 = 5 THEN 1 ELSE 0 END AS BIGINT) AS rejects
        FROM blob JOIN idx USING (segment, page) WHERE blob.page % 7 <> 3 GROUP BY id, file_name, blob.page""",
    "append_union": f"""WITH {fx.INDEX_SQL},
        both_loads AS (SELECT segment, url, mime FROM idx UNION ALL SELECT segment, url, NULL FROM idx)
        SELECT segment, mime, count(*) AS n, count(DISTINCT url) AS urls FROM both_loads GROUP BY ALL""",
}
