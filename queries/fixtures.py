"""Inputs in the raw formats, made by Spark from the driver tables, with the same rows in SQL for the oracle.

Every row of the named tables goes in. Awkward values are placed by key so that both sides know them.
Files go to the shared folder, once per session and table folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path

_built: dict[tuple, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def once(spark: SparkSession, folder: str, name: str, build: Callable[[str], None]) -> str:
    """Path of a fixture, built at first use."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _built:
        path = scratch_path(spark, name)
        build(path)
        _built[key] = path
    return _built[key]


def _runs(batches, key: str):
    """Stretches of rows with the same ``key``, in the order the rows come in: (value, batch of them)."""
    import numpy as np

    for batch in batches:
        codes = batch.column(key).dictionary_encode()
        at = codes.indices.to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
        for start, end in zip(cuts, cuts[1:]):
            if start < end:
                yield codes.dictionary[int(at[start])].as_py(), batch.slice(start, end - start)


def _file_writer(root: str):
    """Task body: rows clustered by file and in order -> the files, one held at a time."""

    def store(name, encoding, spoiled, lines):
        import gzip

        from pyarrow import fs

        text = "\n".join(lines).encode(encoding)
        if name.lower().endswith(".gz"):
            text = gzip.compress(text, mtime=0)
        if spoiled:
            text = text[:-5]
        opened, folder = fs.FileSystem.from_uri(root)
        with opened.open_output_stream(f"{folder}/{name}", compression=None) as stream:
            stream.write(text)

    def write(batches):
        import pyarrow as pa

        current, lines = None, []
        for name, rows in _runs(batches, "file"):
            given = (name, rows.column("encoding")[0].as_py(), rows.column("spoiled")[0].as_py())
            if lines and current != given:
                store(*current, lines)
                lines = []
            current = given
            lines += rows.column("value").to_pylist()
        if lines:
            store(*current, lines)
        yield pa.RecordBatch.from_arrays([pa.array([len(lines)], pa.int64())], ["n"])

    return write


def make_folder(path: str) -> str:
    """Create a folder of the shared file system; gives its URI."""
    from pyarrow import fs

    uri = path if "://" in path else f"file://{path}"
    store, folder = fs.FileSystem.from_uri(uri)
    store.create_dir(folder, recursive=True)
    return uri


# Rows of the source tables that one task makes files of.
ROWS_PER_TASK = 65_536


def clustered(rows: DataFrame, count: int, by: Column, *order: str) -> DataFrame:
    """``rows``, some ``count``, with those of the same ``by`` in one task and in order: the number of tasks grows with the
    rows, and texts are made of the narrow rows after the shuffle."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-count // ROWS_PER_TASK))
    return rows.repartition(n, by).sortWithinPartitions(*order)


def write_files(lines: DataFrame, path: str) -> None:
    """One file per value of ``file``, of its lines (value) as they come: ``lines`` are ``clustered``. Files have a fixed number
    of lines. Optional columns say in which encoding a file is written and whether its end is cut off."""
    given = {"encoding": F.lit("utf-8"), "spoiled": F.lit(False)}
    lines = lines.withColumns({c: v for c, v in given.items() if c not in lines.columns})
    lines.select("file", "value", *given).mapInArrow(_file_writer(make_folder(path)), "n long").count()


# --- index lines -----------------------------------------------------------------------------------------------

LINES_PER_PAGE = 512

# Raw index lines: keys k (even: pages, odd: events), segment, page and the text values of a line.
INDEX_SQL = """
src AS (
  SELECT page_id * 2 AS k, url,
         array_to_string(list_reverse(string_split(regexp_extract(url, '^https?://([^/]+)', 1), '.')), ',')
           || ')/' || page_id AS surt,
         octet_length(encode(html)) AS size
  FROM pages
  UNION ALL
  SELECT event_id * 2 + 1,
         CASE WHEN event_id % 13 = 0 THEN 'https://h' || user_id || '.example.au'
              WHEN event_id % 17 = 0 THEN 'http://u@h' || user_id || '.example.org:80/x?q=1#f'
              WHEN event_id % 19 = 0 THEN 'ftp://h' || user_id || '.example.au/' || event_id
              WHEN event_id % 23 = 0 THEN 'HTTPS://H' || user_id || '.example.com/p'
              WHEN event_id % 29 = 0 THEN 'see https://b' || user_id || '.org/z'
              ELSE 'https://h' || user_id || '.example.au/' || event_type || '/' || event_id END,
         'au,example,h' || user_id || ')/' || event_type || '/' || event_id,
         event_id + 1
  FROM events
),
keyed AS (
  SELECT k, url, surt, size, (k // 512) // 3 AS page,
         'CC-MAIN-2025-' || lpad(CAST(5 + 8 * ((k // 512) % 3) AS VARCHAR), 2, '0') AS segment,
         strftime(TIMESTAMP '2025-01-01' + to_seconds(k), '%Y%m%d%H%M%S') AS ts
  FROM src
),
idx AS (
  SELECT k, segment, page,
         CASE WHEN k % 53 = 0 THEN NULL WHEN k % 59 = 0 THEN '' ELSE surt END AS urlkey,
         CASE k % 12 WHEN 0 THEN '20250231000000' WHEN 1 THEN '' WHEN 2 THEN '2025-03-04T05:06:07Z' WHEN 3 THEN NULL
                     WHEN 4 THEN ' ' || ts || ' ' WHEN 5 THEN ts || '1234' WHEN 6 THEN '01/02/2025'
                     WHEN 7 THEN '20250101' ELSE ts END AS "timestamp",
         url,
         CASE WHEN k % 4 = 0 THEN '' ELSE 'text/html' END AS mime,
         CASE WHEN k % 5 = 0 THEN NULL ELSE 'application/xhtml+xml' END AS mime_detected,
         CASE k % 5 WHEN 0 THEN '-' WHEN 1 THEN '404' WHEN 2 THEN ' 200 ' WHEN 3 THEN '2e2' ELSE '200' END AS status,
         CASE WHEN k % 61 = 0 THEN upper(md5(url)) || 'XYZ' ELSE upper(md5(url)) END AS digest,
         CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(size AS VARCHAR) END AS length,
         CAST(k * 1000 AS VARCHAR) AS "offset",
         'crawl-data/' || segment || '/warc/' || lpad(CAST(page AS VARCHAR), 5, '0') || '.warc.gz' AS filename
  FROM keyed
)"""

# What cleaning makes of them.
CLEAN_SQL = INDEX_SQL + """,
clean AS (
  SELECT k, segment, page, segment || '-' || page || '.parquet.gz' AS source_file,
         nullif(urlkey, '') AS urlkey,
         CASE WHEN regexp_full_match(trim("timestamp"), '[0-9]{14,}')
                THEN try_strptime(substr(trim("timestamp"), 1, 14), '%Y%m%d%H%M%S')
              WHEN regexp_full_match("timestamp", '[0-9]{8}') THEN try_strptime("timestamp", '%Y%m%d')
              WHEN contains("timestamp", '/') THEN try_strptime("timestamp", '%m/%d/%Y')
              ELSE try_strptime("timestamp", '%Y-%m-%dT%H:%M:%SZ') END AS crawl_timestamp,
         CAST(try_cast(trim(status) AS DOUBLE) AS BIGINT) AS status,
         url, filename, try_cast(length AS BIGINT) AS length, nullif(mime, '') AS mime, mime_detected,
         try_cast("offset" AS BIGINT) AS file_offset, digest
  FROM idx
)"""


def index_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw index lines of ``INDEX_SQL``."""
    return _index_lines(_index_rows(spark, folder))


def clustered_index_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same, those of a page in one task and in order."""
    rows = _index_rows(spark, folder)
    return _index_lines(clustered(rows, rows.count(), F.floor(F.col("k") / LINES_PER_PAGE), "k"))


def _index_rows(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        (F.col("page_id") * 2).alias("k"),
        "url",
        F.concat(
            F.array_join(F.reverse(F.split(F.regexp_extract("url", "^https?://([^/]+)", 1), "[.]")), ","),
            F.lit(")/"),
            F.col("page_id").cast("string"),
        ).alias("surt"),
        F.octet_length("html").cast("bigint").alias("size"),
    )
    host = F.concat(F.lit("h"), F.col("user_id").cast("string"))
    key = F.col("event_id")
    events = table(spark, folder, "events").select(
        (key * 2 + 1).alias("k"),
        F.when(key % 13 == 0, F.format_string("https://%s.example.au", host))
        .when(key % 17 == 0, F.format_string("http://u@%s.example.org:80/x?q=1#f", host))
        .when(key % 19 == 0, F.format_string("ftp://%s.example.au/%d", host, key))
        .when(key % 23 == 0, F.format_string("HTTPS://H%d.example.com/p", "user_id"))
        .when(key % 29 == 0, F.format_string("see https://b%d.org/z", "user_id"))
        .otherwise(F.format_string("https://%s.example.au/%s/%d", host, "event_type", key))
        .alias("url"),
        F.format_string("au,example,%s)/%s/%d", host, "event_type", key).alias("surt"),
        (key + 1).alias("size"),
    )
    return pages.unionByName(events)


def _index_lines(rows: DataFrame) -> DataFrame:
    k = F.col("k")
    group = F.floor(k / LINES_PER_PAGE)
    stamp = F.translate(F.expr("cast(timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, k) as string)"), "-: ", "")
    keyed = rows.select(
        "*",
        F.floor(group / 3).alias("page"),
        F.concat(F.lit("CC-MAIN-2025-"), F.lpad((group % 3 * 8 + 5).cast("string"), 2, "0")).alias("segment"),
        stamp.alias("ts"),
    )
    twelve, five = k % 12, k % 5
    return keyed.select(
        "k", "segment", "page",
        F.when(k % 53 == 0, None).when(k % 59 == 0, "").otherwise(F.col("surt")).alias("urlkey"),
        F.when(twelve == 0, "20250231000000").when(twelve == 1, "").when(twelve == 2, "2025-03-04T05:06:07Z")
        .when(twelve == 3, None).when(twelve == 4, F.concat(F.lit(" "), "ts", F.lit(" ")))
        .when(twelve == 5, F.concat("ts", F.lit("1234"))).when(twelve == 6, "01/02/2025")
        .when(twelve == 7, "20250101").otherwise(F.col("ts")).alias("timestamp"),
        "url",
        F.when(k % 4 == 0, "").otherwise("text/html").alias("mime"),
        F.when(five == 0, None).otherwise("application/xhtml+xml").alias("mime-detected"),
        F.when(five == 0, "-").when(five == 1, "404").when(five == 2, " 200 ").when(five == 3, "2e2")
        .otherwise("200").alias("status"),
        F.concat(F.upper(F.md5("url")), F.when(k % 61 == 0, "XYZ").otherwise("")).alias("digest"),
        F.when(k % 7 == 0, None).otherwise(F.col("size").cast("string")).alias("length"),
        (k * 1000).cast("string").alias("offset"),
        F.format_string("crawl-data/%s/warc/%s.warc.gz", "segment", F.lpad(F.col("page").cast("string"), 5, "0")).alias("filename"),
    )


def _write_pages(lines: DataFrame, path: str, faulty: bool, run: int = 1) -> None:
    """JSON lines, one file per (segment, page), of clustered lines; an extra key, blank lines and, if wanted, faults by key."""
    k = F.col("k")
    names = [c for c in lines.columns if c not in ("k", "segment", "page")]
    values = [F.col(f"`{c}`") for c in names]
    if faulty:
        values = [F.when(k % 103 == 5, "1.5").otherwise(v).alias(c) if c == "length" else v for v, c in zip(values, names)]
    text = F.to_json(F.struct(*values, F.when(k % 11 == 0, "noindex").alias("robots")))
    if faulty:
        text = F.when(k % 101 == 7, F.substring(text, 1, 40)).otherwise(text)
    text = F.when(k % 50 == 0, F.concat(F.lit("\n"), text)).otherwise(text)
    name = F.format_string("%s-%d.jsonl", "segment", "page")
    write_files(lines.select(name.alias("file"), text.alias("value")), f"{path}/run={run}")


def packed_pages(spark: SparkSession, folder: str) -> str:
    """Gzipped pages; of every fifth the end is missing."""

    def build(path: str) -> None:
        lines = clustered_index_lines(spark, folder)
        names = [c for c in lines.columns if c not in ("k", "segment", "page")]
        name = F.format_string("%s-%d.jsonl.gz", "segment", "page")
        text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in names)))
        rows = lines.select(name.alias("file"), text.alias("value"), (F.col("page") % 5 == 2).alias("spoiled"))
        write_files(rows, path)

    return once(spark, folder, "packed_pages", build)


def index_pages(spark: SparkSession, folder: str) -> str:
    return once(spark, folder, "pages", lambda p: _write_pages(clustered_index_lines(spark, folder), p, False))


def faulty_pages(spark: SparkSession, folder: str) -> str:
    return once(spark, folder, "faulty_pages", lambda p: _write_pages(clustered_index_lines(spark, folder), p, True))


# --- register documents ----------------------------------------------------------------------------------------

RECORDS_PER_FILE = 4096

# Entities: customers (even keys) and orders (odd keys); one register file per 4,096 keys.
ENTITY_SQL = """
ent AS (
  SELECT k, name, kind, region, k // 4096 AS grp FROM (
    SELECT c_custkey * 2 AS k, c_name AS name, c_mktsegment AS kind, c_nationkey AS region FROM customer
    UNION ALL
    SELECT o_orderkey * 2 + 1, 'Order ' || o_orderkey || ' & <' || o_orderpriority || '>', o_orderstatus,
           CAST(o_custkey % 8 AS INTEGER)
    FROM orders)
)"""

REGISTER_SQL = ENTITY_SQL + """,
reg AS (
  SELECT k, grp,
    CASE WHEN grp % 5 = 4 THEN NULL ELSE grp + 1 END AS file_sequence_number,
    CASE WHEN grp % 5 = 4 OR grp % 3 = 1 THEN NULL ELSE CAST(4096 AS BIGINT) END AS record_count,
    CASE WHEN grp % 4 = 2 AND k % 4096 >= 2048 THEN '2025-02-02T00:00:00.250000' WHEN grp % 5 = 4 THEN NULL
         WHEN grp % 2 = 1 THEN '2025-01-01T10:00:00' ELSE '2025-01-01T10:00:00+00:00' END AS extract_time,
    '2025-01-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') AS record_last_updated_date,
    CASE WHEN k % 7 = 0 THEN NULL WHEN k % 3 = 0 THEN '' ELSE ' N ' END AS replaced,
    lpad(CAST(k AS VARCHAR), 11, '0') AS abn,
    CASE WHEN k % 5 = 0 THEN 'CAN' ELSE 'ACT' END AS abn_status,
    CASE WHEN k % 31 = 0 THEN '2025-99-99' WHEN k % 37 = 0 THEN NULL WHEN k % 41 = 0 THEN '2020-02-03'
         ELSE '2000-07-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') END AS abn_status_from_date,
    CASE WHEN k % 3 = 0 THEN 'IND' ELSE 'PUB' END AS entity_type_ind,
    kind AS entity_type_text,
    CASE WHEN k % 3 = 0 OR k % 4 = 1 THEN NULL ELSE 'MN' END AS mainentity_name_type,
    CASE WHEN k % 3 = 0 THEN NULL ELSE name END AS mainentity_name_text,
    CASE WHEN k % 3 = 0 OR k % 10 = 1 THEN NULL ELSE 'S' || region END AS businessaddress_state,
    CASE WHEN k % 3 = 0 OR k % 10 = 1 THEN NULL ELSE lpad(CAST(k % 10000 AS VARCHAR), 4, '0') END AS businessaddress_postcode,
    CASE WHEN k % 6 = 0 THEN NULL ELSE lpad(CAST(k AS VARCHAR), 9, '0') END AS asicnumber,
    CASE WHEN k % 6 = 0 THEN NULL ELSE 'undetermined' END AS asicnumber_type,
    CASE WHEN k % 4 = 0 THEN NULL ELSE 'ACT' END AS gst_status,
    CASE WHEN k % 4 = 0 THEN NULL ELSE '2000-07-01' END AS gst_status_from_date,
    CASE WHEN k % 29 = 0 THEN NULL ELSE
      'TRD:' || name || ' t1' || CASE WHEN k % 4 >= 1 THEN '; ' || name || ' t2' ELSE '' END
      || CASE WHEN k % 4 = 3 THEN '; BN:' || name || ' t4' ELSE '' END END AS other_entities
  FROM ent
)"""


def entities(spark: SparkSession, folder: str) -> DataFrame:
    """Entities of ``ENTITY_SQL``."""
    customers = table(spark, folder, "customer").select(
        (F.col("c_custkey") * 2).alias("k"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("kind"), F.col("c_nationkey").alias("region"),
    )
    orders = table(spark, folder, "orders").select(
        (F.col("o_orderkey") * 2 + 1).alias("k"),
        F.format_string("Order %d & <%s>", "o_orderkey", "o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("kind"), (F.col("o_custkey") % 8).cast("int").alias("region"),
    )
    return customers.unionByName(orders).withColumn("grp", F.floor(F.col("k") / RECORDS_PER_FILE))


def record_xml() -> F.Column:
    """One register record as XML over several lines, text padded, some names nested or repeated."""
    k, name = F.col("k"), F.replace(F.replace(F.replace("name", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    day = F.lpad((k % 28 + 1).cast("string"), 2, "0")

    def number(width: int, value=k):
        return F.lpad(value.cast("string"), width, "0")

    def maybe(missing, *parts):
        return F.when(missing, "").otherwise(F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)))

    def label(kind, suffix):
        return F.concat(
            F.lit("<NonIndividualName"), F.lit(f' type="{kind}"' if kind else ""), F.lit("><NonIndividualNameText>"),
            name, F.lit(suffix), F.lit("</NonIndividualNameText></NonIndividualName>"),
        )

    main_name = F.concat(
        F.lit("<NonIndividualName"), F.when(k % 4 == 1, "").otherwise(' type="MN"'),
        F.lit(">\n<NonIndividualNameText>\t "), name, F.lit("  </NonIndividualNameText>\n</NonIndividualName>"),
    )
    nested = k % 499 == 43
    return F.concat(
        F.lit('<ABR recordLastUpdatedDate="2025'), F.when(k % 2 == 0, "-01-").otherwise("01"), day, F.lit('"'),
        F.when(k % 7 == 0, "").when(k % 3 == 0, ' replaced=""').otherwise(' replaced=" N "'), F.lit(">\n <ABN status=\""),
        F.when(k % 5 == 0, "CAN").otherwise("ACT"), F.lit('"'),
        F.when(k % 31 == 0, ' ABNStatusFromDate="20259999"').when(k % 37 == 0, "")
        .when(k % 41 == 0, ' ABNStatusFromDate=" 2020-02-03 "')
        .otherwise(F.concat(F.lit(' ABNStatusFromDate="200007'), day, F.lit('"'))),
        F.lit("> "), number(11), F.lit("\n</ABN>"), F.when(k % 47 == 0, "<ABN status=\"OLD\">1</ABN>").otherwise(""),
        F.lit("<EntityType><EntityTypeInd>"), F.when(k % 3 == 0, "IND").otherwise("PUB"),
        F.lit("</EntityTypeInd><EntityTypeText> "), "kind", F.lit(" </EntityTypeText></EntityType>\n"),
        maybe(
            k % 3 == 0, "<MainEntity>", F.when(nested, "<Group>").otherwise(""), main_name,
            F.when(nested, "</Group><NonIndividualName type=\"LATE\"/>").otherwise(""),
            maybe(
                k % 10 == 1, "<BusinessAddress><AddressDetails><State>S", F.col("region").cast("string"),
                "</State><Postcode>", number(4, k % 10000), "</Postcode></AddressDetails></BusinessAddress>",
            ),
            "</MainEntity>\n",
        ),
        maybe(k % 6 == 0, '<ASICNumber ASICNumberType="undetermined">', number(9), "</ASICNumber>"),
        maybe(k % 4 == 0, '<GST status="ACT" GSTStatusFromDate="20000701" />'),
        F.when(k % 29 == 0, "<OtherEntity/>").otherwise(F.concat(
            F.lit("<OtherEntity>"), F.when(k % 503 == 53, "<Deep>").otherwise(""), label("TRD", " t1"),
            F.when(k % 503 == 53, "</Deep>").otherwise(""), F.lit("</OtherEntity>"),
            maybe(k % 4 < 1, "<OtherEntity>", label("", " t2"), "</OtherEntity>"),
            maybe(k % 4 < 2, '<OtherEntity><NonIndividualName type="TRD"><NonIndividualNameText>  </NonIndividualNameText></NonIndividualName></OtherEntity>'),
            maybe(k % 4 < 3, "<OtherEntity>", label("BN", " t4"), "</OtherEntity>"),
        )),
        F.lit("</ABR>"),
    )


def register_text(spark: SparkSession, folder: str, faulty: bool = False) -> DataFrame:
    """Lines (grp, ord, value) of the register files: head, records, some with a second header half way, end. The files of an
    archive are in one task, and their lines in order."""
    ents, grp, role = entities(spark, folder), F.col("grp"), F.col("role")
    first = (grp * RECORDS_PER_FILE).cast("double")
    files = ents.select("grp").distinct().withColumn("role", F.explode(F.array(*map(F.lit, ("head", "second", "end")))))
    place = F.when(role == "head", first - 1).when(role == "second", first + 2047.5).otherwise(first + RECORDS_PER_FILE)
    marks = files.where((role != "second") | (grp % 4 == 2)).withColumn("ord", place)
    records = ents.withColumns({"role": F.lit("record"), "ord": F.col("k").cast("double")})
    rows = clustered(
        records.unionByName(marks, allowMissingColumns=True), ents.count(), F.floor(grp / FILES_PER_ARCHIVE), "grp", "ord"
    )
    record = record_xml()
    if faulty:
        record = F.when(F.col("k") % 97 == 5, F.replace(record, F.lit("</EntityType>"), F.lit(""))).otherwise(record)
    header = F.when(grp % 5 == 4, "").otherwise(F.concat(
        F.lit("<TransferInfo><FileSequenceNumber> "), (grp + 1).cast("string"), F.lit(" </FileSequenceNumber><RecordCount>"),
        F.when(grp % 3 == 1, " ").otherwise(str(RECORDS_PER_FILE)), F.lit("</RecordCount><Sender>x</Sender><ExtractTime>"),
        F.when(grp % 2 == 1, "2025-01-01 10:00").otherwise("2025-01-01T10:00:00Z"), F.lit("</ExtractTime></TransferInfo>"),
    ))
    head = F.concat(F.lit('<?xml version="1.0"?>\n<Transfer>'), header)
    second = F.lit("<TransferInfo><ExtractTime>2025-02-02T00:00:00.25</ExtractTime></TransferInfo>")
    last = F.lit("</Transfer>")
    if faulty:  # the file breaks off between two elements of a record
        last = F.when(grp % 4 == 1, F.format_string("<ABR><ABN> 99%d </ABN>", "grp")).otherwise(last)
    value = F.when(role == "record", record).when(role == "head", head).when(role == "second", second).otherwise(last)
    return rows.select("grp", "ord", value.alias("value"))


def _write_register(text: DataFrame, path: str, *endings: str) -> None:
    """Files named by group, with each of the endings in turn."""
    ending = F.element_at(F.array(*map(F.lit, endings)), (F.col("grp") % len(endings) + 1).cast("int"))
    write_files(text.withColumn("file", F.concat(F.lit("register-"), F.col("grp").cast("string"), ending)), path)


def register_files(spark: SparkSession, folder: str) -> str:
    return once(spark, folder, "register", lambda p: _write_register(register_text(spark, folder), p, ".xml", ".XML"))


def register_gz(spark: SparkSession, folder: str) -> str:
    """Gzipped files (any .gz is a register file)."""
    return once(spark, folder, "register_gz", lambda p: _write_register(register_text(spark, folder), p, ".xml.gz", ".GZ"))


def odd_register(spark: SparkSession, folder: str) -> str:
    """Files in another encoding (grp % 4 = 1), with loosely written end tags (2), others as usual; each record has a note."""

    def build(path: str) -> None:
        kind, value = F.col("grp") % 4, F.col("value")
        note = F.concat(F.lit("<Note>Café Ñ "), F.col("ord").cast("long").cast("string"), F.lit("</Note></ABR"))
        value = F.replace(value, F.lit('version="1.0"?'), F.when(kind == 1, 'version="1.0" encoding="ISO-8859-1"?').otherwise('version="1.0"?'))
        value = F.replace(value, F.lit("</ABR"), note)
        value = F.when(kind == 2, F.replace(value, F.lit("</ABR>"), F.lit("</ABR\n >"))).otherwise(value)
        text = register_text(spark, folder).withColumns({
            "value": value, "encoding": F.when(kind == 1, "iso-8859-1").otherwise("utf-8"),
        })
        _write_register(text, path, ".xml", ".XML")

    return once(spark, folder, "odd_register", build)


def spoiled_register(spark: SparkSession, folder: str) -> str:
    """Gzipped files; of every third the end is missing."""
    return once(spark, folder, "spoiled_register", lambda p: _write_register(
        register_text(spark, folder).withColumn("spoiled", F.col("grp") % 3 == 1), p, ".xml.gz"))


def faulty_register(spark: SparkSession, folder: str) -> str:
    return once(spark, folder, "faulty_register", lambda p: _write_register(register_text(spark, folder, True), p, ".xml"))


FILES_PER_ARCHIVE = 3


def _zip_writer(path: str):
    """Task body: lines of register files in order -> archives, one held at a time."""

    def members(batches):
        grp, lines = None, []
        for found, rows in _runs(batches, "grp"):
            if lines and grp != found:
                yield grp, lines
                lines = []
            grp = found
            lines += rows.column("value").to_pylist()
        if lines:
            yield grp, lines

    def write(batches):
        import io
        import itertools
        import zipfile

        import pyarrow as pa
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(path)
        n = 0
        for archive, found in itertools.groupby(members(batches), lambda member: member[0] // FILES_PER_ARCHIVE):
            held, n = io.BytesIO(), n + 1
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as out:
                for grp, lines in found:
                    out.writestr(f"data/part{grp}.XML", "\n".join(lines))
                    out.writestr(f"data/part{grp}.txt", "not a register file")
            with store.open_output_stream(f"{folder}/archive-{archive}.zip", compression=None) as stream:
                stream.write(held.getvalue())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return write


def register_zips(spark: SparkSession, folder: str) -> str:
    """ZIP archives of three register files each."""

    def build(path: str) -> None:
        text = register_text(spark, folder).select("grp", "value")
        text.mapInArrow(_zip_writer(make_folder(path)), "n long").count()

    return once(spark, folder, "register_zips", build)
