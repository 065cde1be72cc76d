"""Session settings, the shared working folder and size-checked joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a narrow key table that may be broadcast (about 100 bytes a row).
BROADCAST_ROWS = 200_000

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot does not compile methods beyond 8,000 bytes: let Spark split such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tasks write few partition folders each: no sort by partition value for up to this many open files.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Shuffle files go when their query has ended, not when the driver next collects garbage: a job of many rounds would keep
    # those of all its rounds. A result that is run again is computed again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A file stream hands over the paths of its files one by one, and Spark lists them in as many tasks, 10,000 at most.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # A row of a blob table is a whole file, and 10,000 texts are tens of MB: hand few of them to Python at once. A batch is
    # held by the executor and by the worker, each with what it needs to make it.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are written for."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("millrace").config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, "spark.sql.session.timeZone": "UTC", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, named by the cluster in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_stages: ContextVar[str | None] = ContextVar("stages", default=None)


# Bytes that opening a file counts for while many small ones are read.
_OPENING = "1m"


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Loads planned inside read some hundred small files in a task and not thirty, and so write fewer and larger ones."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, _OPENING)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{_stages.get() or f'{shared_dir(spark)}/millrace'}/{uuid.uuid4().hex}/{name}"


@contextmanager
def passing_stages(spark: SparkSession) -> Iterator[str]:
    """Everything staged inside is deleted at the end, in stores that can be reached from here."""
    folder = f"{shared_dir(spark)}/millrace/passing-{uuid.uuid4().hex}"
    token = _stages.set(folder)
    try:
        yield folder
    finally:
        _stages.reset(token)
        _delete(folder)


def _delete(folder: str) -> None:
    from pyarrow import ArrowInvalid, fs

    try:
        store, path = fs.FileSystem.from_uri(folder)
        if store.get_file_info(path).type == fs.FileType.Directory:
            store.delete_dir(path)
    except ArrowInvalid:  # a store that only Spark knows
        pass


def stage(df: DataFrame, name: str, *by: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, in partitions by ``by``, and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*(F.col(f"`{c}`") for c in df.columns))


def drop_staged(df: DataFrame) -> None:
    """Delete a table that ``stage`` wrote without partitions and nothing reads any more."""
    file = next(iter(df.inputFiles()), "")
    if "/millrace/" in file:
        _delete(file.rsplit("/", 1)[0])


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Count a staged or narrow table (distributed, no rows move) and compare."""
    return df.count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when the table is small by count; otherwise leave the join to shuffle (AQE splits skew)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df
