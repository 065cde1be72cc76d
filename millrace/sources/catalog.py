"""Crawl catalog: files holding one JSON array of objects each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CATALOG_ALIASES, CATALOG_ENTRY


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Typed catalog entries in document order; a file that is no JSON fails the job.

    ``ord`` grows in document order inside a file; it orders duplicates of one run and is not to be stored.
    ``reject_reason`` says what an entry lacks: its id, or a ``from`` or ``to`` that is a date.
    """
    raw = (
        spark.read.schema(CATALOG_ENTRY)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("mode", "FAILFAST")
        .json(path)
    )
    dates = {name: F.col(f"`{key}`").try_cast("timestamp_ntz") for key, name in CATALOG_ALIASES.items() if name != "cdx_api"}
    wrong = [
        F.when(F.col(f"`{key}`").isNotNull() & dates[name].isNull(), f"{key} is no date")
        for key, name in CATALOG_ALIASES.items() if name in dates
    ]
    return raw.select(
        "id", "name", "timegate", F.col("`cdx-api`").alias("cdx_api"),
        *(value.alias(name) for name, value in dates.items()),
        F.struct(
            F.col("_metadata.file_modification_time").alias("written"),
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"),
        F.coalesce(F.when(F.col("id").isNull(), "id is null"), *wrong).alias("reject_reason"),
    )


def endpoints(catalog: DataFrame) -> DataFrame:
    """Index endpoints of all crawls that have one."""
    return catalog.select("cdx_api").where(F.col("cdx_api").isNotNull())
