"""Row and byte counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def target_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("n"))


def load_counts(records: DataFrame) -> DataFrame:
    """Rows per source file, and the total in the row whose source_file is NULL."""
    return records.rollup("source_file").agg(F.count("*").alias("n"))


def page_sizes(raw_pages: DataFrame) -> DataFrame:
    """Bytes per stored page, and the total in the row whose file_name is NULL."""
    return raw_pages.rollup("file_name").agg(
        F.sum(F.octet_length("file_data")).alias("bytes"), F.sum("file_size").alias("file_size")
    )
