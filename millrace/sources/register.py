"""Business-register XML, split inside files at the record end tag."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checked_broadcast, stage
from .archives import expand_members, list_members
from .streams import PACKED_FILES, as_utf8, cut, declared_encoding, is_native, list_files, open_input, read_files

RECORD_END = "</ABR>"
# Fixed value: ending of plain register files, in any case of letters.
PLAIN_FILES = "*.[xX][mM][lL]"
# Chunks of one packed file that stay together when it is spread, about 1 MB of text.
TOGETHER = 1_000
# Row number inside a scan task: the low 33 bits of monotonically_increasing_id.
_ROW_BITS = (1 << 33) - 1
_END, _START = re.compile(rb"</ABR\s*>"), re.compile(rb"<ABR[\s/>]")
_OPENED = re.compile(rb"<ABR(?:\s[^>]*)?(?<!/)>")
# Bytes looked at from both ends of a file, and most of all.
_LOOK, _LOOK_MOST = 64 << 10, 16 << 20
# Odd files named one by one in the filter of the scan; more are joined.
_LISTED = 1000


def is_register_file(path: Column) -> Column:
    """File name test, case-insensitive: ``.xml``, ``.xml.gz`` or any ``.gz``."""
    name = F.lower(path)
    return name.endswith(".xml") | name.endswith(".gz")


def discover_register_files(spark: SparkSession, path: str) -> DataFrame:
    """Register files below ``path``, all sub-folders included; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return files.option("pathGlobFilter", f"{{{PLAIN_FILES},{PACKED_FILES}}}").load(path).select(
        F.col("_metadata.file_path").alias("path"), "length"
    )


def spread(chunks: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Distribute stretches of ``TOGETHER`` chunks, whatever file they come from.

    Parsing is far slower than inflating: a large packed file is inflated by one task and parsed by many, and many small files
    are evened out.
    """
    n = parallelism or int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return chunks.repartition(n, "source_file", "block", F.floor(F.col("seq") / TOGETHER))


def _is_odd(path: str) -> bool:
    """Whether a plain file needs the streaming reader: another encoding than UTF-8, record ends written loosely or not within
    reach, or a last record that is not closed. Looks at the file's beginning and end only."""
    with open_input(path) as file:
        size, look = file.size(), _LOOK
        head = file.read_at(min(size, look), 0)
        try:
            if not is_native(declared_encoding(head)):
                return True
        except LookupError:
            return True
        while _START.search(head) and not _END.search(head) and look < min(size, _LOOK_MOST):
            look *= 4
            head = file.read_at(min(size, look), 0)
        first = _END.search(head)
        if first is None:
            return _START.search(head) is not None
        look = _LOOK
        while True:
            tail = file.read_at(min(size, look), max(0, size - look))
            ends = list(_END.finditer(tail))
            if ends or look >= min(size, _LOOK_MOST):
                break
            look *= 4
        if not ends or first[0] != RECORD_END.encode() or ends[-1][0] != RECORD_END.encode():
            return True
        return _OPENED.search(tail, ends[-1].end()) is not None


def _odd_files(spark: SparkSession, path: str) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array([_is_odd(p) for p in batch.column(0).to_pylist()], pa.bool_()))

    files = list_files(spark, path, PLAIN_FILES)
    if "content" in files.columns:  # nothing can be looked at without reading it all: all are taken as they should be
        return files.drop("content").limit(0)
    n = 4 * spark.sparkContext.defaultParallelism
    return stage(files.repartition(n, "path").mapInArrow(run, files.schema), "odd_files")


def record_chunks(found: Iterable[bytes]) -> Iterator[tuple[bytes, bool, bool]]:
    """Text of one file between record end tags, as UTF-8."""
    return cut(as_utf8(found), _END, _START)


def _scan(spark: SparkSession, path: str, odd: DataFrame) -> DataFrame:
    text = spark.read.option("lineSep", RECORD_END).option("recursiveFileLookup", True)
    text = text.option("pathGlobFilter", PLAIN_FILES).text(path)
    names = [row.path for row in odd.limit(_LISTED + 1).collect()]
    if 0 < len(names) <= _LISTED:  # on the path alone: the files are not opened
        text = text.where(~F.col("_metadata.file_path").isin(names))
    # Name and place are taken first: a joined row has no file of its own, and another number.
    chunks = text.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("seq"),
        "value",
        F.lit(True).alias("closed"),
        F.lit(None).cast("string").alias("reject_reason"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )
    if len(names) <= _LISTED:
        return chunks
    left_out = odd.select(F.col("path").alias("odd_path"))
    return chunks.join(checked_broadcast(left_out), F.col("source_file") == F.col("odd_path"), "left_anti")


def read_register_chunks(spark: SparkSession, path: str, parallelism: int | None = None) -> DataFrame:
    """Text between record end tags with its place: (source_file, block, seq, value, closed, reject_reason).

    Plain files are split by size like any text file, so one huge file is read by many tasks; ``closed`` says that the end tag
    was there. Gzipped files, and plain ones in other encodings, with loose end tags or cut off in a record, are streamed by a
    task each and their chunks spread after reading. (block, seq) orders the chunks as in the document. A packed file that is
    damaged, or an encoding nobody knows, is one row with a reject reason.
    """
    odd = _odd_files(spark, path)
    streamed = read_files(list_files(spark, path, PACKED_FILES), record_chunks, parallelism)
    if not odd.isEmpty():
        streamed = streamed.unionByName(read_files(odd, record_chunks, parallelism))
    return _scan(spark, path, odd).unionByName(spread(streamed, parallelism))


def read_archived_register_chunks(spark: SparkSession, path: str, parallelism: int | None = None) -> DataFrame:
    """The same rows straight from ZIP archives; unreadable archives and members have a reject reason."""
    members = list_members(spark, path)
    wanted = members.where(F.col("member").isNull() | is_register_file(F.col("member")))
    return spread(expand_members(wanted, record_chunks, parallelism), parallelism)
