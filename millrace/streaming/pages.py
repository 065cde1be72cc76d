"""Incremental landing of index pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.pages import page_ledger
from ..schemas import PAGE_KEYS
from ..session import checked_broadcast, stage
from ..sinks.landing import (
    batch_numbers, committed, next_batch, read_batch, read_batches, read_landed, stream_id, write_batch, write_partitions,
)
from ..sources.listing import snapshot
from ..sources.pages import read_index_pages, stream_index_pages


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


LANDED = T.StructType([
    T.StructField("raw_id", T.LongType()),
    *_text("segment"),
    T.StructField("page", T.LongType()),
    *_text("source_file", "source_path"),
    T.StructField("landed_at", T.TimestampType()),
    T.StructField("part", T.LongType()),
    *_text(*PAGE_KEYS, "reject_reason", "raw"),
    T.StructField("load_batch", T.LongType()),
])

LEDGER = T.StructType([
    T.StructField("raw_id", T.LongType()),
    *_text("segment"),
    T.StructField("page", T.LongType()),
    *_text("source_file", "source_path"),
    T.StructField("load_batch", T.LongType()),
    T.StructField("landed_at", T.TimestampType()),
    T.StructField("records", T.LongType()),
    T.StructField("rejects", T.LongType()),
    *_text("route"),
])

# Changed files named one by one in the filter of the scan; more are joined.
LISTED = 1000
# Files that one trigger of a stream takes, as whole batches; one batch at least.
TRIGGERED = 1024
# Files that a task reads, from which on they count as small.
_SMALL = 8


def land_batch(
    lines: DataFrame, target: str, load_batch: int, route: str = "batch", files: DataFrame | None = None,
    spark: SparkSession | None = None,
) -> None:
    """Store one batch of lines and its ledger rows. Doing it again replaces the batch. ``files`` names the files that are
    entered even if they have no lines. The ledger is made in session ``spark`` if given: that of a stream does not plan
    adaptively, and would write as many files as the shuffle has partitions."""
    spark = spark or lines.sparkSession
    write_batch(lines, f"{target}/pages", load_batch, "segment")
    entries = page_ledger(read_batch(spark, f"{target}/pages", LANDED, load_batch))
    if files is not None:
        empty = files.join(entries, "source_path", "left_anti").withColumns({
            "load_batch": F.lit(load_batch).cast("bigint"), "records": F.lit(0).cast("bigint"), "rejects": F.lit(0).cast("bigint"),
        })
        entries = entries.unionByName(empty)
    write_partitions(entries.withColumn("route", F.lit(route)), f"{target}/ledger", "load_batch")


def _batches(lines: DataFrame, max_files: int) -> list[list[list[str]]]:
    """Files of one trigger that have lines, oldest first, in batches of at most ``max_files`` plain and as many packed ones, and
    these in runs that have no page in two batches: whatever part of a run has been entered when a driver is lost, the rest can
    be landed later without an older copy of a page coming after a newer one."""
    named = F.col("segment").isNotNull() & F.col("page").isNotNull()
    file = F.struct(
        "landed_at", "source_path", F.lower("source_path").endswith(".gz").alias("packed"),
        F.when(named, F.concat_ws("-", "segment", "page")).otherwise(F.col("source_path")).alias("page"),
    )
    batches, taken = {}, {False: 0, True: 0}
    for found in sorted(lines.agg(F.collect_set(file).alias("files")).first().files):
        batches.setdefault(taken[found.packed] // max_files, []).append(found)
        taken[found.packed] += 1
    runs, pages = [], set()
    for _, files in sorted(batches.items()):
        if not runs or not pages.isdisjoint(f.page for f in files):
            runs.append([])
            pages = set()
        runs[-1].append([f.source_path for f in files])
        pages.update(f.page for f in files)
    return runs


def land_batches(
    lines: DataFrame, target: str, batches: dict[int, list[str]], route: str, spark: SparkSession | None = None
) -> None:
    """Store several batches, given as the files of each number, and their ledger rows: what ``land_batch`` stores of each, but
    in one job for all, as jobs for a few files take longer than their work."""
    numbers = [(path, number) for number, paths in batches.items() for path in paths]
    given = lines.sparkSession.createDataFrame(numbers, "source_path string, load_batch long")
    tasks = lines.rdd.getNumPartitions()
    lines = lines.join(F.broadcast(given), "source_path").select(*LANDED.fieldNames())
    if len(numbers) >= _SMALL * tasks:  # a task reads files of many batches, and would start files of its own for each
        lines = lines.repartition(tasks, "load_batch", "segment", "part")
    write_partitions(lines, f"{target}/pages", "load_batch", "segment")
    landed = read_batches(spark or lines.sparkSession, f"{target}/pages", LANDED, list(batches))
    entries = page_ledger(landed).withColumn("route", F.lit(route))
    writers = min(len(batches), lines.sparkSession.sparkContext.defaultParallelism)
    write_partitions(entries.repartition(writers, "load_batch"), f"{target}/ledger", "load_batch")


def land_changed(spark: SparkSession, landing: str, target: str) -> int | None:
    """Land files anew that were overwritten in place since: their path is in the ledger with another time. The file
    stream knows files by path and passes these over. The folders are listed by tasks; a file that has no bytes any more is
    entered without lines, and so replaces what it had. Returns the batch number, None if there are none."""
    listed = snapshot(spark, landing).select(F.col("path").alias("source_path"), "landed_at")
    version = F.struct("load_batch", "landed_at", "raw_id", "segment", "page", "source_file")
    known = ledger(spark, target).groupBy("source_path").agg(F.max(version).alias("last"))
    changed = stage(
        listed.join(known, "source_path").where(F.col("landed_at") != F.col("last.landed_at"))
        .select("source_path", "landed_at", "last.raw_id", "last.segment", "last.page", "last.source_file"),
        "changed",
    )
    paths = [row.source_path for row in changed.select("source_path").limit(LISTED + 1).collect()]
    if not paths:
        return None
    lines = read_index_pages(spark, landing)
    if len(paths) <= LISTED:  # a filter on paths keeps other files from being opened
        lines = lines.where(F.col("source_path").isin(paths))
    else:
        lines = lines.join(checked_broadcast(changed.select("source_path")), "source_path", "left_semi")
    number = next_batch(spark, target)
    land_batch(lines.select(*(f.name for f in LANDED if f.name != "load_batch")), target, number, "changed", changed)
    return number


def _gathered(batch: DataFrame) -> DataFrame:
    """The rows of a batch in a quarter of the tasks, as long as there are some for every core: a task of the stream reads some
    thirty small files and starts files of its own for every segment, which takes longer than reading those."""
    tasks = batch.rdd.getNumPartitions()
    enough = max(tasks // 4, 4 * batch.sparkSession.sparkContext.defaultParallelism)
    return batch.coalesce(enough) if enough < tasks else batch


def _without(batch: DataFrame, staged: DataFrame | None, *keys: str) -> DataFrame:
    if staged is None:
        return batch
    left_out = batch.sparkSession.read.schema(staged.schema).parquet(*staged.inputFiles())
    return batch.join(checked_broadcast(left_out), list(keys), "left_anti")


def land_pages(spark: SparkSession, landing: str, target: str, max_files: int | None = None) -> StreamingQuery:
    """Land every page file not landed before, ``max_files`` per batch, then stop.

    A batch has its own number, folders and ledger rows. Every trigger of a stream writes its logs and plans its jobs, which
    takes longer than landing a few files: it takes as many whole batches as have some ``TRIGGERED`` files, and lands them by
    the same jobs, the oldest files in the first.

    The checkpoint lies beside the data it describes. The ledger is written last and names the stream's trigger: when this is
    repeated after a failure, files that have been entered are left out. A stream whose checkpoint was lost leaves out what
    another has landed. The ledger is read in the first trigger of a run only: with one writer a table, the run itself makes
    all later entries, and what a batch costs does not grow with those before it.
    """
    run = {}
    several = bool(max_files) and 2 * max_files <= TRIGGERED

    def land(batch: DataFrame, batch_id: int) -> None:
        if not run:
            own, done = stream_id(spark, target), ledger(spark, target)
            others = done.where(~F.col("route").startswith(f"{own}/")).select("source_path", "landed_at").distinct()
            again = done.where(F.col("route") == f"{own}/{batch_id}").select("source_path").distinct()
            others, again = stage(others, "others"), stage(again, "again")
            run.update(own=own, others=None if others.isEmpty() else others, again=None if again.isEmpty() else again)
        if max_files is None:
            batch = _gathered(batch)
        batch = _without(batch, run["others"], "source_path", "landed_at")
        again = run.pop("again", None)  # only the first trigger of a run can be a repeated one
        batch = _without(batch, again, "source_path")
        route = f"{run['own']}/{batch_id}"
        if several:
            runs = _batches(batch, max_files)
            numbers = run.setdefault("numbers", batch_numbers(spark, target, max(1, sum(map(len, runs)))))
            for batches in runs:
                land_batches(batch, target, {next(numbers): files for files in batches}, route, spark)
        elif again is None or not batch.isEmpty():
            land_batch(batch, target, next(run.setdefault("numbers", batch_numbers(spark, target))), route, spark=spark)

    return (
        stream_index_pages(spark, landing, TRIGGERED // max_files * max_files if several else max_files)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{target}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def landed_pages(spark: SparkSession, target: str) -> DataFrame:
    return committed(read_landed(spark, f"{target}/pages", LANDED), ledger(spark, target))


def ledger(spark: SparkSession, target: str) -> DataFrame:
    return read_landed(spark, f"{target}/ledger", LEDGER)


def running_counts(spark: SparkSession, target: str) -> DataFrame:
    """Records and rejects per source file over all batches so far; sums the ledger, needs no state store."""
    return ledger(spark, target).groupBy("source_file").agg(
        F.sum("records").alias("records"), F.sum("rejects").alias("rejects")
    )
