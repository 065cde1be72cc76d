"""Column -> Column functions; all native expressions."""

from .numbers import is_unusable_number, judge_number, to_bigint
from .rare import rarely
from .temporal import (
    crawl_timestamp, digits_timestamp, extract_time, general_timestamp, is_full_digits, iso_date, typed_date,
)
from .text import empty_to_null, safe_text, strip
from .urls import page_file_name, page_raw_id, segment_name, url_domain, url_path

__all__ = [
    "crawl_timestamp", "digits_timestamp", "empty_to_null", "extract_time", "general_timestamp", "is_full_digits",
    "is_unusable_number", "iso_date", "judge_number", "page_file_name", "page_raw_id", "rarely", "safe_text", "segment_name",
    "strip", "to_bigint", "typed_date", "url_domain", "url_path",
]
