"""Bag append of tables that may miss some columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)
