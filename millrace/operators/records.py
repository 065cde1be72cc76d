"""Index lines -> conformed, cleaned records and the analytics view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    digits_timestamp, empty_to_null, general_timestamp, is_full_digits, judge_number, rarely, url_domain, url_path,
)
from ..schemas import INDEX_RECORDS, PAGE_KEYS

INDEX_COLUMNS = INDEX_RECORDS.fieldNames()
# Fixed value: width of the digest column.
DIGEST_WIDTH = 32
# Narrow types of the analytics table.
NARROW = {"status": "smallint", "length": "int"}


def conform(df: DataFrame, columns: list[str] = PAGE_KEYS) -> DataFrame:
    """Exactly ``columns``, as text and in that order: missing ones NULL, others dropped, NaN as NULL."""
    types = dict(df.dtypes)

    def one(name: str) -> Column:
        if name not in types:
            return F.lit(None).cast("string").alias(name)
        value = F.col(f"`{name}`")
        if types[name] in ("float", "double"):
            value = F.when(~F.isnan(value), value)
        return value.cast("string").alias(name)

    return df.select(*map(one, columns))


def with_lineage(df: DataFrame, raw_id: Column, source_file: Column) -> DataFrame:
    """Prepend the id and the name of the file each record came from."""
    return df.select(raw_id.alias("raw_id"), source_file.alias("source_file"), "*")


def clean_index_lines(lines: DataFrame) -> DataFrame:
    """The eleven record columns plus ``mime_detected`` and the reject columns; a narrow, all-native projection.

    ``lines`` holds raw_id, source_file and the text keys; further columns (segment, page, ...) are kept.
    """
    numbers = {"status": "status", "length": "length", "offset": "file_offset"}
    kept = [c for c in lines.columns if c not in {*INDEX_COLUMNS, *PAGE_KEYS, "reject_reason", "raw"}]
    # Judged once for each row in an operator of its own, below which no filter on the results is pushed: written out in the
    # main projection, the rare long cases would outgrow the method that is compiled, and a filter would do them again. The
    # array is made in a projection, whose code is generated: within ``inline`` it would be interpreted. It has one item, but
    # only the outer form infers no filter on the array, which would make it twice.
    stamp = F.col("timestamp")
    when = F.when(is_full_digits(stamp), digits_timestamp(stamp)).otherwise(rarely(stamp, general_timestamp))
    fields = [judge_number(F.col(key)).alias(f"_{name}") for key, name in numbers.items()]
    lines = lines.select("*", F.array(F.struct(*fields, when.alias("_time"))).alias("_judged"))
    lines = lines.select("*", F.inline_outer("_judged"))
    reasons = [F.col("reject_reason")] if "reject_reason" in lines.columns else []
    reasons += [F.when(F.col(f"_{name}.unusable"), f"{key} is no integer") for key, name in numbers.items()]
    cleaned = {
        "raw_id": F.col("raw_id"),
        "source_file": F.col("source_file"),
        "crawl_timestamp": F.col("_time"),
        **{name: F.col(f"_{name}.value") for name in numbers.values()},
        **{name: empty_to_null(F.col(name)) for name in ("urlkey", "url", "filename", "mime", "digest")},
    }
    return lines.select(
        *(cleaned[name].alias(name) for name in INDEX_COLUMNS),
        empty_to_null(F.col("`mime-detected`")).alias("mime_detected"),
        *kept,
        F.coalesce(*reasons).alias("reject_reason"),
        (F.col("raw") if "raw" in lines.columns else F.lit(None).cast("string")).alias("raw"),
    )


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull())


def rejects(df: DataFrame) -> DataFrame:
    """Rows kept aside: where they came from, why, and the input as it was."""
    return df.where(F.col("reject_reason").isNotNull()).select("source_file", "reject_reason", "raw")


def index_records(cleaned: DataFrame) -> DataFrame:
    return good(cleaned).select(*INDEX_COLUMNS)


def in_scope(status: Column, urlkey: Column, url: Column, tld: str = "au", code: str = "200") -> Column:
    """Captures with HTTP status ``code`` under a top-level domain."""
    host = rf"(?i)^https?://(?:[^/@]*@)?[^/:]*\.{tld}(?::[0-9]+)?(?:[/?#]|$)"
    under = (urlkey == tld) | urlkey.startswith(f"{tld},") | url.rlike(host)
    return (status.cast("string") == code) & under


def broken_constraints(cleaned: DataFrame) -> DataFrame:
    """Rows the analytics table cannot hold, with the reason."""
    missing = [
        F.when(F.col(name).isNull(), F.lit(f"{label} is null"))
        for name, label in (("urlkey", "urlkey"), ("url", "url"), ("crawl_timestamp", "timestamp"))
    ]
    too_long = F.when(F.length("digest") > DIGEST_WIDTH, F.lit("digest is too long"))
    too_large = [
        F.when(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull(), F.lit(f"{name} is out of range"))
        for name, kind in NARROW.items()
    ]
    return good(cleaned).withColumn("reject_reason", F.coalesce(*missing, too_long, *too_large)).where(
        F.col("reject_reason").isNotNull()
    )


def index_flat(cleaned: DataFrame, inserted_at: Column) -> DataFrame:
    """Analytics view: typed narrow numbers, derived domain and path, load stamp."""
    whole = F.coalesce(F.length("digest") <= DIGEST_WIDTH, F.lit(True))
    for name, kind in NARROW.items():
        whole = whole & (F.col(name).isNull() | F.col(name).try_cast(kind).isNotNull())
    return (
        good(cleaned)
        .where(F.col("urlkey").isNotNull() & F.col("url").isNotNull() & F.col("crawl_timestamp").isNotNull() & whole)
        .select(
            "urlkey",
            "url",
            F.col("crawl_timestamp").alias("timestamp"),
            F.col("status").try_cast(NARROW["status"]).alias("status"),
            "mime",
            "mime_detected",
            "digest",
            F.col("length").try_cast(NARROW["length"]).alias("length"),
            "file_offset",
            "filename",
            url_domain(F.col("url")).alias("domain"),
            url_path(F.col("url")).alias("path"),
            inserted_at.cast("timestamp_ntz").alias("inserted_at"),
        )
    )


def repeated_keys(rows: DataFrame, keys: list[str], stored: DataFrame | None = None) -> DataFrame:
    """Key values that more than one row has, in ``rows`` alone or with those ``stored`` before, and how many (n).

    Exact counts with partial sums in the tasks: a key that very many rows have is no hot group. Of the stored table only the
    keys are read. A key with a NULL in it is not counted: that is a broken constraint of its own.
    """
    parts = rows.select(*keys) if stored is None else rows.select(*keys).unionByName(stored.select(*keys))
    return parts.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
