"""Business register: discovery, scan, flatten, reject, load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import extract_time, iso_date, safe_text, typed_date
from millrace.operators.register import REGISTER_COLUMNS, attach_headers, flatten_register, header_spans, register_events
from millrace.plans.register_load import load_register, parse, read_register, read_register_rejects
from millrace.schemas import REGISTER_FLAT
from millrace.session import scratch_path, stage
from millrace.sinks.export import read_csv, write_csv
from millrace.sources.archives import list_members
from millrace.sources.register import (
    discover_register_files, read_archived_register_chunks, read_register_chunks,
)

from . import fixtures as fx

_COLUMNS_SQL = ", ".join(REGISTER_COLUMNS)
_parsed: dict[tuple, DataFrame] = {}


def _group(path: str = "source_file") -> F.Column:
    return F.regexp_extract(path, "register-([0-9]+)[.]", 1).cast("bigint").alias("grp")


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return read_register_chunks(spark, fx.register_files(spark, folder))


def _projected(spark: SparkSession, folder: str, files: Callable[[SparkSession, str], str] = fx.register_files) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, files.__name__)
    if key not in _parsed:
        _parsed[key] = parse(read_register_chunks(spark, files(spark, folder)))
    return _parsed[key]


def xml_discover(spark, folder):
    """Files with every ending side by side, some in sub-folders: texts and archives are no register files."""

    def build(path: str) -> None:
        text = fx.register_text(spark, folder)
        fx._write_register(text, f"{path}/plain", ".xml", ".XML", ".txt")
        fx._write_register(text, f"{path}/packed/deep", ".XML.gz", ".GZ", ".zip")

    files = discover_register_files(spark, fx.once(spark, folder, "discover", build))
    return files.select(
        F.regexp_extract("path", "(plain|packed)/", 1).alias("kind"), _group("path"), (F.col("length") > 0).alias("filled")
    )


def register_scan(spark, folder):
    """Records of usual files, of some in another encoding and of some with loosely written end tags."""
    chunks = read_register_chunks(spark, fx.odd_register(spark, folder))
    events = register_events(chunks).where(F.col("xml").isNotNull())
    return events.select(
        _group(), F.regexp_extract("xml", r"<ABN[^>]*>\s*([0-9]+)\s*</ABN>", 1).alias("abn"),
        F.regexp_extract("xml", "<Note>([^<]*)</Note>", 1).alias("note"),
    )


def register_header(spark, folder):
    return header_spans(_projected(spark, folder)).select(_group(), "file_sequence_number", "record_count", "extract_time")


def register_flatten(spark, folder):
    """The whole way: scan, split, parse, project, join headers."""
    return flatten_register(parse(_chunks(spark, folder))).select(*REGISTER_COLUMNS)


def register_header_join(spark, folder):
    """Header join without broadcast, as for a very long list of headers."""
    projected = _projected(spark, folder)
    records = projected.where("is_record").select("source_file", "block", "seq", "pos", "abn")
    joined = attach_headers(records, header_spans(projected), broadcast=False)
    return joined.select("abn", "file_sequence_number", "record_count", "extract_time")


def register_deep_name(spark, folder):
    return _projected(spark, folder).where("is_record").select(
        "abn", "mainentity_name_type", "mainentity_name_text", "businessaddress_state", "businessaddress_postcode"
    )


def other_entities(spark, folder):
    return _projected(spark, folder).where("is_record").select("abn", "other_entities")


def xml_rejects(spark, folder):
    chunks = read_register_chunks(spark, fx.faulty_register(spark, folder))
    flat = flatten_register(parse(chunks)).where(F.col("reject_reason").isNotNull())
    return flat.select(_group(), F.regexp_extract("raw", r"<ABN[^>]*>\s*([0-9]+)\s*</ABN>", 1).alias("key"), "reject_reason")


def register_append(spark, folder):
    """Gzipped files loaded twice: the second load replaces the first file by file."""
    target = scratch_path(spark, "register_table")
    for _ in range(2):
        load_register(spark, fx.register_gz(spark, folder), target)
    return read_register(spark, target)


def zip_expand(spark, folder):
    """Register members of every archive with their records."""
    chunks = read_archived_register_chunks(spark, fx.register_zips(spark, folder))
    records = register_events(chunks).where(F.col("xml").isNotNull())
    parts = F.regexp_extract("source_file", r"archive-([0-9]+)\.zip/data/(part[0-9]+\.XML)$", 1).cast("bigint")
    member = F.regexp_extract("source_file", r"/([^/]+)$", 1)
    return records.groupBy(parts.alias("archive"), member.alias("member")).agg(
        F.count("*").alias("records"), F.countDistinct("seq").alias("places")
    )


def zip_members(spark, folder):
    members = list_members(spark, fx.register_zips(spark, folder))
    return members.select(F.regexp_extract("archive", r"archive-([0-9]+)\.zip$", 1).cast("bigint").alias("archive"), "member")


def register_from_zip(spark, folder):
    """Archives loaded end to end."""
    target = scratch_path(spark, "register_zip_table")
    load_register(spark, fx.register_zips(spark, folder), target, archived=True)
    return read_register(spark, target)


def csv_export(spark, folder):
    """Flat register of gzipped files written as gzipped CSV and read back: empty text and NULL stay apart."""
    path = scratch_path(spark, "csv")
    write_csv(flatten_register(_projected(spark, folder, fx.register_gz)).select(*REGISTER_COLUMNS), path, "gzip")
    return read_csv(spark, path, REGISTER_FLAT)


def _padded(key: F.Column, text: F.Column) -> F.Column:
    return F.when(key % 9 == 0, " \t 　").otherwise(F.concat(F.lit("\t  "), text, F.lit("  \n")))


def safe_text_query(spark, folder):
    docs = fx.table(spark, folder, "documents")
    text = safe_text(_padded(F.col("doc_id"), F.col("text")))
    return docs.select("doc_id", F.length(text).cast("bigint").alias("chars"), F.md5(text).alias("digest"))


def iso_date_query(spark, folder):
    key = F.col("o_orderkey")
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    raw = (
        F.when(key % 8 == 0, F.replace(day, F.lit("-"), F.lit("")))
        .when(key % 8 == 1, F.concat(F.lit(" "), day, F.lit("T10:20:30\t")))
        .when(key % 8 == 2, "20259999").when(key % 8 == 3, "2025-02-30").when(key % 8 == 4, "2025-1-3")
        .when(key % 8 == 5, "").when(key % 8 == 6, F.col("o_orderpriority")).otherwise(day)
    )
    found = iso_date(raw)
    return fx.table(spark, folder, "orders").select(
        key.alias("k"), found.alias("iso_date"), typed_date(found).cast("string").alias("typed_date")
    )


def extract_time_query(spark, folder):
    key = F.col("o_orderkey")
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    raw = (
        F.when(key % 7 == 0, F.concat(day, F.lit(" 10:00"))).when(key % 7 == 1, F.concat(day, F.lit("T10:00:00Z")))
        .when(key % 7 == 2, F.concat(day, F.lit("T10:00:00.5+0530"))).when(key % 7 == 3, F.col("o_orderpriority"))
        .when(key % 7 == 4, "").when(key % 7 == 5, "2025-02-30").otherwise(day)
    )
    return fx.table(spark, folder, "orders").select(key.alias("k"), extract_time(raw).alias("extract_time"))


def header_rejects(spark, folder):
    """Headers whose numbers are none, from files made of suppliers."""
    key = F.col("s_suppkey")
    number = F.when(key % 3 == 0, F.concat(F.lit("x"), key.cast("string"))).when(key % 3 == 1, "").otherwise(key.cast("string"))
    chunks = fx.table(spark, folder, "supplier").select(
        F.concat(F.lit("supplier-"), key.cast("string")).alias("source_file"),
        F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("seq"),
        F.concat(
            F.lit("<Transfer><TransferInfo><FileSequenceNumber>"), number,
            F.lit("</FileSequenceNumber></TransferInfo><ABR><ABN>"), key.cast("string"), F.lit("</ABN>"),
        ).alias("value"),
    )
    target = scratch_path(spark, "header_rejects")
    projected = parse(chunks)
    from millrace.operators.register import header_rejects as refused

    return stage(refused(projected), "refused").select("source_file", "reject_reason", "raw")


QUERIES = {
    "xml_discover": xml_discover,
    "register_scan": register_scan,
    "register_header": register_header,
    "register_flatten": register_flatten,
    "register_header_join": register_header_join,
    "register_deep_name": register_deep_name,
    "other_entities": other_entities,
    "xml_rejects": xml_rejects,
    "header_rejects": header_rejects,
    "register_append": register_append,
    "zip_expand": zip_expand,
    "zip_members": zip_members,
    "register_from_zip": register_from_zip,
    "csv_export": csv_export,
    "safe_text": safe_text_query,
    "iso_date": iso_date_query,
    "extract_time": extract_time_query,
}

_PAD = "' ' || chr(9) || chr(10) || chr(160) || chr(8195) || chr(12288)"

ORACLE = {
    "xml_discover": f"""WITH {fx.ENTITY_SQL}
        SELECT DISTINCT kind, grp, true AS filled FROM (SELECT grp FROM ent), (VALUES ('plain'), ('packed')) AS kinds(kind)
        WHERE grp % 3 <> 2""",
    "register_scan": f"WITH {fx.REGISTER_SQL} SELECT grp, abn, 'Café Ñ ' || k AS note FROM reg",
    "register_header": f"""WITH {fx.ENTITY_SQL},
        files AS (SELECT DISTINCT grp FROM ent)
        SELECT grp, grp + 1 AS file_sequence_number, CASE WHEN grp % 3 = 1 THEN NULL ELSE CAST(4096 AS BIGINT) END AS record_count,
               CASE WHEN grp % 2 = 1 THEN '2025-01-01T10:00:00' ELSE '2025-01-01T10:00:00+00:00' END AS extract_time
        FROM files WHERE grp % 5 <> 4
        UNION ALL
        SELECT grp, CASE WHEN grp % 5 <> 4 THEN grp + 1 END, CASE WHEN grp % 5 <> 4 AND grp % 3 <> 1 THEN CAST(4096 AS BIGINT) END,
               '2025-02-02T00:00:00.250000' FROM files WHERE grp % 4 = 2""",
    "register_flatten": f"WITH {fx.REGISTER_SQL} SELECT {_COLUMNS_SQL} FROM reg",
    "register_header_join": f"WITH {fx.REGISTER_SQL} SELECT abn, file_sequence_number, record_count, extract_time FROM reg",
    "register_deep_name": f"""WITH {fx.REGISTER_SQL}
        SELECT abn, mainentity_name_type, mainentity_name_text, businessaddress_state, businessaddress_postcode FROM reg""",
    "other_entities": f"WITH {fx.REGISTER_SQL} SELECT abn, other_entities FROM reg",
    "xml_rejects": f"""WITH {fx.REGISTER_SQL}
        SELECT grp, abn AS key, 'malformed xml' AS reject_reason FROM reg WHERE k % 97 = 5
        UNION ALL SELECT DISTINCT grp, '99' || grp, 'malformed xml' FROM reg WHERE grp % 4 = 1""",
    "header_rejects": """SELECT 'supplier-' || s_suppkey AS source_file, 'FileSequenceNumber is no integer' AS reject_reason,
        'x' || s_suppkey AS raw FROM supplier WHERE s_suppkey % 3 = 0""",
    "register_append": f"WITH {fx.REGISTER_SQL} SELECT {_COLUMNS_SQL} FROM reg",
    "zip_expand": f"""WITH {fx.ENTITY_SQL}
        SELECT grp // 3 AS archive, 'part' || grp || '.XML' AS member, count(*) AS records, count(*) AS places
        FROM ent GROUP BY grp""",
    "zip_members": f"""WITH {fx.ENTITY_SQL}
        SELECT DISTINCT grp // 3 AS archive, 'data/part' || grp || ending AS member
        FROM ent, (VALUES ('.XML'), ('.txt')) AS kinds(ending)""",
    "register_from_zip": f"WITH {fx.REGISTER_SQL} SELECT {_COLUMNS_SQL} FROM reg",
    "csv_export": f"WITH {fx.REGISTER_SQL} SELECT {_COLUMNS_SQL} FROM reg",
    "safe_text": f"""WITH t AS (
          SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE nullif(trim(text, {_PAD}), '') END AS s FROM documents)
        SELECT doc_id, CAST(length(s) AS BIGINT) AS chars, md5(s) AS digest FROM t""",
    "iso_date": """WITH t AS (
          SELECT o_orderkey AS k,
                 CASE o_orderkey % 8 WHEN 2 THEN '2025-99-99' WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL
                      WHEN 6 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso_date FROM orders)
        SELECT k, iso_date, CAST(try_cast(iso_date AS DATE) AS VARCHAR) AS typed_date FROM t""",
    "extract_time": """
        SELECT o_orderkey AS k,
               CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT10:00:00')
                    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT10:00:00+00:00')
                    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT10:00:00.500000+05:30')
                    WHEN 3 THEN o_orderpriority WHEN 4 THEN NULL WHEN 5 THEN '2025-02-30'
                    ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00') END AS extract_time
        FROM orders""",
}
