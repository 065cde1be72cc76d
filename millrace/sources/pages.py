"""Index pages: JSON lines, one file per (segment, page)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import page_file_name, page_raw_id
from ..schemas import CORRUPT, PAGE_KEYS, PAGE_LINE
from .streams import BINARY_FILE, PACKED_FILES, list_files, listed, read_files
from .streams import lines as lines_of

# Where segment and page number stand, in folder names or in the file name.
_IN_FOLDERS = r"/segment=([^/]+)/page=([0-9]+)/[^/]+$"
_IN_NAME = r"^(.+)-([0-9]+)\.[A-Za-z.]+$"

# Fixed value: names that do not end in .gz, in any case of letters.
_NOT_PACKED = "{*[!zZ],*[!gG][zZ],*[!.][gG][zZ]}"

# Restored and back-filled files have old time stamps: none is too old to be landed.
ANY_AGE = "36500d"


def _with_identity(lines: DataFrame) -> DataFrame:
    path = F.col("source_path")
    name = F.substring_index(path, "/", -1)
    by_folder = path.contains("/segment=")

    def found(k: int) -> F.Column:
        return F.when(by_folder, F.regexp_extract(path, _IN_FOLDERS, k)).otherwise(F.regexp_extract(name, _IN_NAME, k))

    lines = lines.withColumns({"segment": F.nullif(found(1), F.lit("")), "page": found(2).try_cast("bigint")})
    unnamed = F.col("segment").isNull() | F.col("page").isNull()
    return lines.select(
        page_raw_id(F.col("segment"), F.col("page")).alias("raw_id"),
        "segment",
        "page",
        F.when(unnamed, path).otherwise(page_file_name(F.col("segment"), F.col("page"))).alias("source_file"),
        "source_path",
        "landed_at",
        "part",
        *(F.col(f"`{key}`") for key in PAGE_KEYS),
        F.coalesce("unreadable", F.when(unnamed, "no page identity").when(F.col(CORRUPT).isNotNull(), "malformed json"))
        .alias("reject_reason"),
        F.col(CORRUPT).alias("raw"),
    )


def _plain(lines: DataFrame) -> DataFrame:
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_block_start").alias("part"),
        F.lit(None).cast("string").alias("unreadable"),
    )


def _unpacked(files: DataFrame) -> DataFrame:
    """Lines of gzipped pages; a damaged one is a single row that says so."""
    chunks = read_files(files, lines_of)
    line = F.from_json("value", PAGE_LINE, {"columnNameOfCorruptRecord": CORRUPT})
    return chunks.withColumn("line", line).select(
        *(F.col(f"line.`{f}`").alias(f) for f in PAGE_LINE.fieldNames()),
        F.col("source_file").alias("source_path"), "landed_at", F.col("block").alias("part"),
        F.col("reject_reason").alias("unreadable"),
    )


def read_index_pages(spark: SparkSession, path: str) -> DataFrame:
    """All lines below ``path`` with the page they belong to; malformed lines carry a reject reason. Gzipped pages cannot be
    split: each is streamed by one task, and a damaged one is one reject row instead of its lines."""
    reader = spark.read.schema(PAGE_LINE).option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", _NOT_PACKED)
    plain = _plain(reader.option("recursiveFileLookup", True).json(path))
    return _with_identity(plain.unionByName(_unpacked(list_files(spark, path, PACKED_FILES))))


def stream_index_pages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same rows as a stream over newly landed files, ``max_files`` plain and as many packed ones at a time."""

    def reader(names: str):
        found = spark.readStream.option("maxFileAge", ANY_AGE).option("pathGlobFilter", names).option("recursiveFileLookup", True)
        return found.option("maxFilesPerTrigger", max_files) if max_files else found

    plain = reader(_NOT_PACKED).schema(PAGE_LINE).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    packed = reader(PACKED_FILES).format("binaryFile").schema(BINARY_FILE).load(path)
    return _with_identity(_plain(plain).unionByName(_unpacked(listed(packed, spark, path))))
