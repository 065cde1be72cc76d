"""Listing of a folder tree by tasks: what lies there now, as a table.

Spark's own readers list on the driver and pass over files of no bytes. Here each task lists some folders; the folders found
are the next round's, so the driver only learns whether there are any.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .streams import open_store, scheme_of

LISTING = "path string, size long, landed_at timestamp"
# Characters that Spark's names of files carry as percent codes.
_CODED = re.compile(r'[ "%<>\\^`{|}#?\[\]]')


def _coded(path: str) -> str:
    return _CODED.sub(lambda c: f"%{ord(c[0]):02X}", path)


def _is_hidden(name: str) -> bool:
    return name.startswith(("_", ".")) or name.endswith("._COPYING_")


def _lister(root: str):
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, top = open_store(root)
        # Spark's names have an authority or none at all.
        named = re.sub("^([a-z0-9]+):///", r"\1:/", root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = store.get_file_info(fs.FileSelector(f"{top.rstrip('/')}/{folder}".rstrip("/"), recursive=False))
                rows = [i for i in found if not _is_hidden(i.base_name)]
                places = [f"{folder}/{i.base_name}".lstrip("/") for i in rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array([i.type == fs.FileType.Directory for i in rows], pa.bool_()), pa.array(places, pa.string()),
                    pa.array([f"{named}/{_coded(p)}" for p in places], pa.string()), pa.array([i.size for i in rows], pa.int64()),
                    pa.array([i.mtime for i in rows], pa.timestamp("us", "UTC")),
                ], ["is_folder", "folder", "path", "size", "landed_at"])

    return run


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` with size and time, empty ones included and hidden ones not, under the names Spark's readers give
    them. The result is staged. A store that tasks cannot list by themselves is listed by Spark, without empty files."""
    scheme = scheme_of(spark, path)
    if scheme is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return stage(files.select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("landed_at"),
        ), "listing")
    root = (path if ":/" in path else f"{scheme}://{_coded(path)}").rstrip("/")
    tasks = 4 * spark.sparkContext.defaultParallelism
    folders, levels = spark.createDataFrame([("",)], "folder string"), []
    while True:
        found = folders.repartition(tasks, "folder").mapInArrow(_lister(root), f"is_folder boolean, folder string, {LISTING}")
        found = stage(found, "listing")
        at = F.date_trunc("millisecond", "landed_at").alias("landed_at")  # as exact as Spark's readers tell it
        levels.append(found.where("NOT is_folder").select("path", "size", at))
        folders = found.where("is_folder").select("folder")
        if folders.isEmpty():
            break
    files = levels[0]
    for level in levels[1:]:
        files = files.unionByName(level)
    return files
