from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import empty_to_null

# The two derived-column patterns, and the suffix of an index endpoint.
DOMAIN_PATTERN = "https?://([^/]+)/"
PATH_PATTERN = "(?s)https?://[^/]+(/.*)"
ENDPOINT_SUFFIX = "-index"


def segment_name(endpoint: Column) -> Column:
    """Crawl name of an index endpoint: last path part, every ``-index`` removed."""
    return F.replace(F.regexp_extract(endpoint, "([^/]*)/*$", 1), F.lit(ENDPOINT_SUFFIX), F.lit(""))


def page_file_name(segment: Column, page: Column) -> Column:
    return F.format_string("%s-%d.parquet.gz", segment, page.cast("bigint"))


def page_raw_id(segment: Column, page: Column) -> Column:
    """Stable key of a page; the same page has the same key in every run."""
    return F.xxhash64(segment, page.cast("bigint"))


def url_domain(url: Column) -> Column:
    """Host part as written (user and port kept); NULL unless an http(s) host is followed by ``/``."""
    return empty_to_null(F.regexp_extract(url, DOMAIN_PATTERN, 1))


def url_path(url: Column) -> Column:
    """Path with query and fragment; NULL without one."""
    return empty_to_null(F.regexp_extract(url, PATH_PATTERN, 1))
