"""Text of files that Spark's own readers cannot split or would end on: inflated, decoded and cut in tasks, piece by piece.

A packed file is read through once before its first row leaves: it counts wholly, or is one reject row. What is held at a
time is one block and the piece being put together, which has a bound; nothing else grows with the file.
"""

from __future__ import annotations

import codecs
import gzip
import io
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1 << 20
# Bytes of the longest piece; a longer one is a reject.
LONGEST = 64 << 20
# An end tag is looked for across this many bytes of two blocks.
_OVERLAP = 256
# Bytes of a piece that is too long which the reject row shows.
_SHOWN = 1000

CHUNK = "source_file string, block long, seq long, value string, closed boolean, reject_reason string, landed_at timestamp"
# What says that packed bytes are not whole. Other errors of a store end the task, which Spark tries again.
BROKEN = (gzip.BadGzipFile, EOFError, zlib.error)

# Schemes of Hadoop file systems and the names the Arrow file systems have for the same stores.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}
_OPENED = {"file", "hdfs", "s3", "gs", "abfs", "abfss", *_SCHEMES}
# Byte order marks, longest first, and the encodings they stand for.
_MARKS = [
    (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF8, "utf-8"),
    (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"),
]
_PROLOG = re.compile(rb"""^\s*<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._:-]+)["']""")
# Encodings whose bytes Spark takes as they are.
_NATIVE = {"utf-8", "ascii"}


def open_store(uri: str):
    """The Arrow file system of a name that Spark gives, and the path in it."""
    from pyarrow import fs

    scheme, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}{mark}{rest}")


def open_input(uri: str):
    """A seekable file of the shared file system, by Spark's name for it."""
    store, path = open_store(uri)
    return store.open_input_file(path)


def scheme_of(spark: SparkSession, path: str) -> str | None:
    """The scheme of a path if tasks can open its store by themselves."""
    default = spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")
    scheme = (path if "://" in path else default).partition(":")[0]
    return scheme if scheme in _OPENED else None


def declared_encoding(head: bytes) -> str:
    """Python's name of the encoding that the first bytes of an XML text declare; LookupError if there is none of that name."""
    for mark, encoding in _MARKS:
        if head.startswith(mark):
            return encoding
    if head.startswith(b"<\0?\0") or head.startswith(b"\0<\0?"):
        return "utf-16-le" if head[0] else "utf-16-be"
    found = _PROLOG.match(head)
    return codecs.lookup(found[1].decode()).name if found else "utf-8"


def is_native(encoding: str) -> bool:
    return encoding in _NATIVE


def blocks(stream, packed: bool) -> Iterator[bytes]:
    text = gzip.GzipFile(fileobj=stream) if packed else stream
    while data := text.read(BLOCK):
        yield data


def as_utf8(found: Iterable[bytes]) -> Iterator[bytes]:
    """The same text as UTF-8, by its byte order mark or XML declaration."""
    decoder = None
    for i, data in enumerate(found):
        if i == 0:
            encoding = declared_encoding(data[:1024])
            if not is_native(encoding):
                decoder = codecs.getincrementaldecoder(encoding)("replace")
        yield decoder.decode(data).encode("utf-8", "replace") if decoder else data
    if decoder and (rest := decoder.decode(b"", True)):
        yield rest.encode("utf-8", "replace")


def _last_start(text: bytes, start: re.Pattern | None) -> int:
    """Where the last start in a text is; 0 without one."""
    return max((m.start() for m in start.finditer(text)), default=0) if start else 0


def cut(
    found: Iterable[bytes], end: re.Pattern, start: re.Pattern | None = None, longest: int = LONGEST
) -> Iterator[tuple[bytes, bool, bool]]:
    """Pieces (text, closed, fits) between ends. What follows the last end is not closed. A piece beyond ``longest`` is cut
    before the last ``start`` in it; without one, its beginning is given as not fitting and the rest is passed over up to the
    next start or end."""
    held, searched, skipping = bytearray(), 0, False

    def bounded(text: bytes):
        at = _last_start(text, start) if len(text) > longest else 0
        if at:
            yield text[:at], False, at <= longest
        yield text[at:], True, len(text) - at <= longest

    for data in found:
        held += data
        taken = 0
        while True:
            if skipping:  # within a piece that is too long: up to where the next one may begin
                marks = [m for m in (end.search(held, taken), start and start.search(held, taken)) if m]
                if not marks:
                    taken = max(taken, len(held) - _OVERLAP)
                    break
                first = min(marks, key=lambda m: m.start())
                taken, skipping = first.end() if first.re is end else first.start(), False
                searched = taken
            mark = end.search(held, max(taken, searched - _OVERLAP))
            if not mark:
                break
            yield from bounded(bytes(held[taken : mark.start()]))
            taken = searched = mark.end()
        del held[:taken]
        if len(held) > longest and not skipping:
            at = _last_start(bytes(held), start)
            if at:
                yield bytes(held[:at]), False, at <= longest
            if len(held) - at > longest:
                yield bytes(held[at : at + _SHOWN]), False, False
                at, skipping = max(at + 1, len(held) - _OVERLAP), True
            del held[:at]
        searched = len(held)
    if held and not skipping:
        yield bytes(held), False, True


def piece_batches(
    name: str, pieces: Iterable[tuple[bytes, bool, bool]], landed_at=None, most: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Rows of ``CHUNK``, a few MB at a time. Values are bytes as they are: Spark says whether they are UTF-8."""
    held, size, seq = [], 0, 0

    def rows():
        n = len(held)
        text = pa.array([p[0] if p[2] else p[0][:_SHOWN] for p in held], pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array([name] * n, pa.string()), pa.array([0] * n, pa.int64()), pa.array(range(seq, seq + n), pa.int64()), text,
            pa.array([p[1] for p in held], pa.bool_()),
            pa.array([None if p[2] else "record too long" for p in held], pa.string()), pa.array([landed_at] * n, _TIME),
        ], schema=_ARROW)

    for piece in pieces:
        held.append(piece)
        size += min(len(piece[0]), LONGEST)
        if size >= most:
            yield rows()
            seq, held, size = seq + len(held), [], 0
    if held:
        yield rows()


def refused(name: str, reason: str, landed_at=None) -> pa.RecordBatch:
    """The one row of a file that cannot be read."""
    values = [[name], [0], [0], [None], [False], [reason], [landed_at]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _ARROW)], schema=_ARROW)


_TIME = pa.timestamp("us", "UTC")
_ARROW = pa.schema([
    ("source_file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("value", pa.binary()), ("closed", pa.bool_()),
    ("reject_reason", pa.string()), ("landed_at", _TIME),
])
RAW_CHUNK = CHUNK.replace("value string", "value binary")


def read_stream(
    name: str, opened: Callable, packed: bool, pieces: Callable[[Iterable[bytes]], Iterable], what: str = "file",
    verify: bool = False, broken: tuple = BROKEN, landed_at=None,
) -> Iterator[pa.RecordBatch]:
    """Rows of one file, or one reject row. ``opened()`` gives the stream; it is read through beforehand where it is packed or
    ``verify`` is set. ``what`` names its kind in a reject reason."""
    try:
        if packed or verify:
            with opened() as stream:
                for _ in blocks(stream, packed):
                    pass
        with opened() as stream:
            yield from piece_batches(name, pieces(blocks(stream, packed)), landed_at)
    except broken as error:
        yield refused(name, f"unreadable {what}: {type(error).__name__}", landed_at)
    except LookupError as error:
        yield refused(name, f"unreadable {what}: {error}", landed_at)


def is_packed(path: str) -> bool:
    return path.lower().endswith(".gz")


# Fixed value: columns of Spark's reader of whole files, which a stream must be told.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
# Fixed value: names of packed files.
PACKED_FILES = "*.[gG][zZ]"


def listed(files: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Path and time of whole files and, in a store that the tasks cannot open by themselves, their bytes."""
    return files.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("landed_at"),
        *([] if scheme_of(spark, path) else ["content"]),
    )


def list_files(spark: SparkSession, path: str, names: str | None = None) -> DataFrame:
    """The files below ``path``, all sub-folders included; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return listed((files.option("pathGlobFilter", names) if names else files).load(path), spark, path)


def read_files(files: DataFrame, pieces: Callable[[Iterable[bytes]], Iterable], parallelism: int | None = None) -> DataFrame:
    """Pieces of the listed files, each streamed by one task, in rows of ``CHUNK``."""

    def run(batches):
        for batch in batches:
            given = batch.column(2) if batch.num_columns > 2 else [None] * batch.num_rows
            for path, landed_at, content in zip(batch.column(0).to_pylist(), batch.column(1), given):
                def opened(path=path, content=content):
                    return open_input(path) if content is None else io.BytesIO(content.as_buffer())

                yield from read_stream(path, opened, is_packed(path), pieces, landed_at=landed_at)

    n = parallelism or 4 * files.sparkSession.sparkContext.defaultParallelism
    found = files.repartition(n, "path").mapInArrow(run, RAW_CHUNK)
    return found.withColumn("value", F.col("value").cast("string"))


LINE_END = re.compile(rb"\n")


def lines(found: Iterable[bytes]) -> Iterator[tuple[bytes, bool, bool]]:
    """Lines of a text, blank ones left out."""
    for text, closed, fits in cut(found, LINE_END):
        if text.strip():
            yield text.removesuffix(b"\r"), closed, fits
