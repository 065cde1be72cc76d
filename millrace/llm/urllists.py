"""Temporal list join: dated list changes become validity intervals; captures meet the entries active when fetched.

Nulls and odd input: a change without list, key or day is left out; changes of one list and key on one day count as one,
a removal before an addition; an addition that is never removed stays open. A capture without a host or a day has no
active entry. Every capture row gives one result row, repeated rows too. Empty tables give no rows or no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checked_broadcast
from .text import name


def url_host(url: Column) -> Column:
    """Lower-case host without user and port; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.when(host != "", host)


def host_keys(host: Column) -> Column:
    """The host and all domains above it."""
    parts = F.split(host, r"\.")
    size = F.size(parts)
    return F.transform(
        F.sequence(F.lit(1), size), lambda i: F.array_join(F.slice(parts, i, size), ".")
    )


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def validity_intervals(changes: DataFrame) -> DataFrame:
    """(list, key, changed date, active boolean) -> (list, key, since, until): days since <= day < until (null: open)."""
    days = (
        changes.select("list", "key", "changed", "active")
        .where("list IS NOT NULL AND key IS NOT NULL AND changed IS NOT NULL AND active IS NOT NULL")
        .groupBy("list", "key", "changed")
        .agg(F.min("active").alias("active"))
    )
    history = Window.partitionBy("list", "key").orderBy("changed")
    return (
        days.withColumn("until", F.lead("changed").over(history))
        .where("active")
        .select("list", "key", F.col("changed").alias("since"), "until")
    )


def listed_captures(captures: DataFrame, intervals: DataFrame, url: str, day: str) -> DataFrame:
    """Every row of ``captures`` (as struct ``row``) with host, fetched, n_active (entries), lists (sorted names, joined
    by commas, null if none), newest (latest since) and blocked.

    The join is on (key, month): a key's long history meets a capture only where it is active in that month, and a host
    with very many captures is spread over the months. Entries are broadcast only if few by count.
    """
    rows = captures.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(*map(name, captures.columns)).alias("row"),
        url_host(name(url)).alias("host"),
        name(day).cast("date").alias("fetched"),
    )
    # Months that captures were made in: no more than the calendar has, and one far date adds one.
    fetched = captures.select(_month(name(day).cast("date")).alias("month")).where("month IS NOT NULL").distinct()
    seen = F.lit(sorted(row.month for row in fetched.collect())).cast("array<int>")
    first, last = _month(F.col("since")), _month(F.date_sub("until", 1))
    valid = F.filter(seen, lambda month: (month >= first) & (F.col("until").isNull() | (month <= last)))
    months = intervals.select("list", "key", "since", "until", F.explode(valid).alias("month"))
    keyed = rows.select(
        "*", F.explode_outer(F.when(F.col("host").isNotNull(), host_keys(F.col("host")))).alias("key"),
        _month(F.col("fetched")).alias("month"),
    )
    then = (F.col("since") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    few = checked_broadcast(months)
    met = keyed.join(
        few.withColumnsRenamed({"key": "entry_key", "month": "entry_month"}),
        (F.col("key") == F.col("entry_key")) & (F.col("month") == F.col("entry_month")) & then,
        "left",
    )
    found = met.groupBy("rid").agg(
        *(F.any_value(c).alias(c) for c in ("row", "host", "fetched")),
        F.count("list").alias("n_active"),
        F.collect_set("list").alias("names"),  # names of lists: few
        F.max("since").alias("newest"),
    )
    return found.select(
        "row", "host", "fetched", "n_active",
        F.when(F.size("names") > 0, F.array_join(F.sort_array("names"), ",")).alias("lists"),
        "newest", (F.col("n_active") > 0).alias("blocked"),
    )
