"""Raw page table: every row holds one (gzipped) Parquet file as a binary value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PAGE_KEYS, RAW_PAGES
from ..session import checked_broadcast

DECODED = T.StructType([
    T.StructField("raw_id", T.LongType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("uploaded_at", T.TimestampNTZType()),
    *(T.StructField(key, T.StringType()) for key in PAGE_KEYS),
    T.StructField("reject_reason", T.StringType()),
])


def is_parquet_blob(file_name):
    name = F.lower(file_name)
    return name.like("%.parquet") | name.like("%.parquet.gz")


def _stamp(blobs: DataFrame):
    """Upload time, null where the table has none."""
    given = F.col("uploaded_at") if "uploaded_at" in blobs.columns else F.lit(None)
    return given.cast("timestamp_ntz").alias("uploaded_at")


def read_raw_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_PAGES).parquet(path)


def parquet_blobs(raw_pages: DataFrame) -> DataFrame:
    """Blobs to flatten, by name; the suffix test is pushed to the scan."""
    return raw_pages.where(is_parquet_blob(F.col("file_name"))).select("id", "file_name", "file_data", _stamp(raw_pages))


def oldest_blobs(raw_pages: DataFrame, limit: int | None = 10) -> DataFrame:
    """The ``limit`` oldest copies of pages (NULL times last, id as tie-break), each with all its blobs.

    The order is found on the narrow columns. File contents are read for the winners only: up to a thousand
    keys become an IN list that the scan can skip row groups by; more are broadcast if few by count, else joined.
    """
    limit = 10 if limit is None else limit
    winners = (
        raw_pages.where(is_parquet_blob(F.col("file_name")))
        .select(F.col("id").alias("id_"), F.col("uploaded_at").alias("at_"))
        .distinct()
        .orderBy(F.col("at_").asc_nulls_last(), "id_")
        .limit(limit)
    )
    same = [F.col("id").eqNullSafe(F.col("id_")), F.col("uploaded_at").eqNullSafe(F.col("at_"))]
    if limit <= 1000:
        raw_pages = raw_pages.where(F.col("id").isin([row.id_ for row in winners.collect()]))
    return raw_pages.join(checked_broadcast(winners), same, "left_semi")


def _blob_decoder(keys: list[str]):
    """Task body: a stream of Arrow batches of blobs -> Arrow batches of text columns."""

    def decode(batches):
        import gzip
        import zlib

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        fields = ["raw_id", "source_file", "uploaded_at", *keys, "reject_reason"]
        types = [pa.int64(), pa.string(), pa.timestamp("us")] + [pa.string()] * (len(keys) + 1)
        schema = pa.schema(list(zip(fields, types)))

        def as_text(column):
            if pa.types.is_floating(column.type):
                column = pc.if_else(pc.is_nan(column), pa.scalar(None, column.type), column)
            if pa.types.is_boolean(column.type) or pa.types.is_nested(column.type):
                return pa.array([None if v is None else str(v) for v in column.to_pylist()], pa.string())
            return pc.cast(column, pa.string())

        def rows(mark, count, columns, reason=None):
            arrays = [pa.repeat(pa.scalar(value, kind), count) for value, kind in zip(mark, types)]
            arrays += [columns.get(key, pa.nulls(count, pa.string())) for key in keys]
            arrays.append(pa.repeat(pa.scalar(reason, pa.string()), count))
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for raw_id, name, data, at in zip(*(batch.column(i) for i in range(4))):
                mark, name, data = (raw_id.as_py(), name.as_py(), at.as_py()), name.as_py(), data.as_buffer()
                try:
                    if data is None:
                        raise EOFError("no file data")
                    if name.lower().endswith(".gz"):
                        data = pa.py_buffer(gzip.decompress(data))
                    file = pq.ParquetFile(pa.BufferReader(data))
                    present = [key for key in keys if key in file.schema_arrow.names]
                    # The whole file is read before any row leaves: a file counts wholly or not at all.
                    table = file.read(columns=present)
                    parts = [
                        rows(mark, part.num_rows, {key: as_text(part.column(key)) for key in present})
                        for part in table.to_batches(max_chunksize=16_384)
                    ]
                except (OSError, EOFError, zlib.error, pa.ArrowException) as error:
                    parts = [rows(mark, 1, {}, f"unreadable blob: {type(error).__name__}")]
                yield from parts

    return decode


def decode_blobs(blobs: DataFrame) -> DataFrame:
    """Rows of every blob (id, file_name, file_data) as text columns; an unreadable blob is one reject row."""
    return blobs.select("id", "file_name", "file_data", _stamp(blobs)).mapInArrow(_blob_decoder(PAGE_KEYS), DECODED)
