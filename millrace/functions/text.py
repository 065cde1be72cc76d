from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove Unicode whitespace from both ends (SQL ``trim`` takes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def safe_text(text: Column) -> Column:
    """Strip; nothing left means NULL."""
    return empty_to_null(strip(text))
