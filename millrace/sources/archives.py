"""ZIP archives of register files.

A deflated member cannot be split, but members are independent: one row per member is spread over the
cluster and each task streams its member in bounded pieces, so neither an archive nor a member is ever held as one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .streams import BROKEN, RAW_CHUNK, is_packed, open_input, read_stream

MEMBER = "archive string, member string, member_bytes long, reject_reason string"


def _member_lister():
    def listing(frames):
        import zipfile

        import pandas as pd
        from pyarrow import ArrowInvalid

        for frame in frames:
            out = []
            for archive in frame["archive"]:
                try:
                    with open_input(archive) as handle, zipfile.ZipFile(handle) as opened:
                        out += [(archive, m.filename, m.file_size, None) for m in opened.infolist() if not m.is_dir()]
                except (zipfile.BadZipFile, ArrowInvalid):  # too short a file to seek in is none either
                    out.append((archive, None, None, "unreadable archive"))
            rows = pd.DataFrame(out, columns=["archive", "member", "member_bytes", "reject_reason"])
            yield rows.astype({"member_bytes": "Int64"})

    return listing


def list_members(spark: SparkSession, path: str) -> DataFrame:
    """One row per archive member, read from the directories at the archives' ends (contents are not read)."""
    archives = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .where(F.lower(F.col("_metadata.file_path")).endswith(".zip"))
        .select(F.col("_metadata.file_path").alias("archive"))
    )
    return archives.mapInPandas(_member_lister(), MEMBER)


def _member_reader(pieces):
    def read(batches):
        import zipfile
        from contextlib import contextmanager

        import pyarrow as pa

        # RuntimeError: an encrypted member; NotImplementedError: an unknown method of compression
        broken = (*BROKEN, zipfile.BadZipFile, pa.ArrowInvalid, RuntimeError, NotImplementedError)
        for batch in batches:
            for archive, member in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                @contextmanager
                def opened(archive=archive, member=member):
                    with open_input(archive) as handle, zipfile.ZipFile(handle) as found, found.open(member) as stream:
                        yield stream

                yield from read_stream(f"{archive}/{member}", opened, is_packed(member), pieces, "member", True, broken)

    return read


def expand_members(members: DataFrame, pieces, parallelism: int | None = None) -> DataFrame:
    """Contents of the listed members in rows (source_file, block, seq, value, closed, reject_reason), in the order of the
    member; ``pieces`` cuts the blocks of one. A member that cannot be read to its end is one reject row."""
    spark = members.sparkSession
    spread = parallelism or 4 * spark.sparkContext.defaultParallelism
    readable = members.where(F.col("reject_reason").isNull()).select("archive", "member")
    found = readable.repartition(spread, "archive", "member").mapInArrow(_member_reader(pieces), RAW_CHUNK)
    broken = members.where(F.col("reject_reason").isNotNull()).select(
        F.col("archive").alias("source_file"),
        F.lit(0).cast("long").alias("block"),
        F.lit(0).cast("long").alias("seq"),
        F.lit(None).cast("string").alias("value"),
        F.lit(False).alias("closed"),
        "reject_reason",
        F.lit(None).cast("timestamp").alias("landed_at"),
    )
    return found.withColumn("value", F.col("value").cast("string")).unionByName(broken)
