"""Lenient date and time parsing.

All results are zone-free: text is brought to ``yyyy-MM-dd HH:mm:ss`` and cast to TIMESTAMP_NTZ, so the
session time zone never enters. A zone suffix in the input is dropped and the wall clock kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rare import rarely
from .text import empty_to_null, strip

# Accepted shapes. Years are those a nanosecond clock can hold in full, 1678 to 2261.
_YEAR = r"(1(?:6(?:7[89]|[89][0-9])|[7-9][0-9]{2})|2(?:[01][0-9]{2}|2(?:[0-5][0-9]|6[01])))"
_FULL_DIGITS = rf"^{_YEAR}[0-9]{{10,}}\z"
_SOME_DIGITS = rf"^{_YEAR}(?:[0-9]{{4}}|[0-9]{{8}}|[0-9]{{10,}})?\z"
_SPLIT_DIGITS = (r"^([0-9]{4})([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})[0-9]*\z", "$1-$2-$3 $4:$5:$6")
_UNGIVEN_DIGITS = "00000101000000"
_EIGHT_DIGITS = (r"^([0-9]{4})([0-9]{2})([0-9]{2})\z", "$1-$2-$3")
# Shapes of a date, and how its parts and what follows (the last group) are put in the order year-month-day.
_REST = r"(?:[Tt ](.*))?\z"
_DATES = [
    (rf"(?s)^{_YEAR}[-/. ]([0-9]{{1,2}})[-/. ]([0-9]{{1,2}}){_REST}", "$1-$2-$3 $4"),
    (rf"(?s)^{_YEAR}([0-9]{{2}})([0-9]{{2}})[Tt ](.*)\z", "$1-$2-$3 $4"),
    (rf"(?s)^(1[3-9]|[2-9][0-9])[-/. ]([0-9]{{1,2}})[-/. ]({_YEAR}|[0-9]{{2}}){_REST}", "$3-$2-$1 $5"),
    (rf"(?s)^([0-9]{{1,2}})[-/. ]([0-9]{{1,2}})[-/. ]({_YEAR}|[0-9]{{2}}){_REST}", "$3-$1-$2 $5"),
    (rf"^{_YEAR}[-/.]([0-9]{{1,2}})\z", "$1-$2-1 "),
    (rf"^([0-9]{{1,2}})[-/]{_YEAR}\z", "$2-$1-1 "),
]
_ZONE = r"\s*(?:[Zz]|UTC|GMT|[+-][0-9]{2}(?::?[0-9]{2})?)?\s*\z"
_CLOCK = rf"^(\S+) ([0-9]{{1,2}})(?::([0-9]{{1,2}})(?::([0-9]{{1,2}})(?:[.,][0-9]+)?)?)?{_ZONE}"
_CLOCK_DIGITS = rf"^(\S+) ([0-9]{{2}})([0-9]{{2}})([0-9]{{2}})?(?:(?<=[0-9]{{6}})[.,][0-9]+)?{_ZONE}"
_ISO = (
    r"(?s)^([0-9]{4})(-?)([0-9]{2})\2([0-9]{2})"
    r"(?:.([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?\z"
)


def general_timestamp(raw: Column) -> Column:
    """Time of a text in one of the usual shapes, else NULL.

    A date with the year first (``2025-1-3``, ``20250103``) or last (month first, unless the first number is beyond 12; two
    digits of a year are those within fifty years of today), a year, a year and a month; then a clock time, plain or with
    colons. Fractions of a second and the zone are dropped, the wall clock is kept.
    """

    def found(t: Column) -> Column:
        filled = F.concat(t, F.substr(F.lit(_UNGIVEN_DIGITS), F.length(t) + 1))
        dated = F.coalesce(*(F.when(t.rlike(shape), F.regexp_replace(t, shape, order)) for shape, order in _DATES))
        digits = F.regexp_replace(filled, *_SPLIT_DIGITS)
        return F.when(t.rlike(_SOME_DIGITS), digits).otherwise(rarely(rarely(dated, _with_century), _with_clock))

    return rarely(strip(raw), found).try_cast("timestamp_ntz")


def _with_century(dated: Column) -> Column:
    """``year-month-day clock`` with a full year."""
    this_year, year = F.year(F.current_date()), F.substring_index(dated, "-", 1)
    short = year.cast("int") + F.floor(this_year / 100) * 100
    near = F.when(short >= this_year + 50, short - 100).when(short < this_year - 50, short + 100).otherwise(short)
    return F.when(F.length(year) == 2, F.concat(near.cast("string"), F.substring(dated, 3, 1 << 20))).otherwise(dated)


def _with_clock(dated: Column) -> Column:
    """``year-month-day hour:minute:second``."""
    clock = (
        F.when(dated.endswith(" "), F.concat(dated, F.lit("0:0:0")))
        .when(dated.rlike(_CLOCK), F.regexp_replace(dated, _CLOCK, "$1 $2:$3:$4"))
        .when(dated.rlike(_CLOCK_DIGITS), F.regexp_replace(dated, _CLOCK_DIGITS, "$1 $2:$3:$4"))
    )
    return F.when(clock.rlike(r":(?::|\z)"), F.regexp_replace(clock, r":(?=:|\z)", ":00")).otherwise(clock)


def is_full_digits(raw: Column) -> Column:
    """Whether a capture time is 14 or more digits, as in nearly all index lines; false for NULL."""
    return F.coalesce(raw.rlike(_FULL_DIGITS), F.lit(False))


def digits_timestamp(raw: Column) -> Column:
    """Time of 14 or more digits; further ones are ignored."""
    return F.regexp_replace(raw, *_SPLIT_DIGITS).try_cast("timestamp_ntz")


def crawl_timestamp(raw: Column) -> Column:
    """Capture time of an index record: 14 or more digits, else a date in one of the usual shapes, else NULL."""
    return F.when(is_full_digits(raw), digits_timestamp(raw)).otherwise(rarely(raw, general_timestamp))


def _iso_stamp(t: Column) -> Column:
    """NTZ time of ISO 8601 text (calendar dates, extended or basic form); NULL when it is none."""
    cut = F.regexp_replace(t, _ISO, "$1-$3-$4 $5:$6:$7")
    filled = F.regexp_replace(F.regexp_replace(cut, r":(?=:|\z)", ":00"), " :", " 00:")
    return F.when(t.rlike(_ISO), filled.try_cast("timestamp_ntz"))


def iso_date(raw: Column) -> Column:
    """ISO date text. Eight digits are only re-punctuated, not checked; other text must be valid ISO 8601."""
    t = strip(raw)
    return (
        F.when(raw.rlike(r"^[0-9]{8}\z"), F.regexp_replace(raw, *_EIGHT_DIGITS))
        .when(t.rlike(r"^[0-9]{8}\z"), F.regexp_replace(t, *_EIGHT_DIGITS))
        .otherwise(_iso_stamp(t).cast("date").cast("string"))
    )


def typed_date(iso_text: Column) -> Column:
    """DATE companion of an ``iso_date`` column: NULL for impossible dates."""
    return iso_text.try_cast("date")


def extract_time(text: Column) -> Column:
    """ISO time in one normal form (``T``, seconds, ``+hh:mm``); text that is no ISO time stays as it is."""
    stamp = F.replace(F.substring(_iso_stamp(text).cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    micros = F.substring(F.rpad(F.regexp_extract(text, _ISO, 8), 6, "0"), 1, 6)
    zone = F.regexp_extract(text, _ISO, 9)
    offset = F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, -2, 2))
    normal = F.concat(
        stamp,
        F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
        F.when(zone == "", F.lit(""))
        .when((zone == "Z") | (offset == "-00:00"), F.lit("+00:00"))
        .otherwise(offset),
    )
    return F.coalesce(normal, empty_to_null(text))
