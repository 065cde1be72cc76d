"""Literal edge tables of the scalar functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace import functions as fn

TIMESTAMPS = {
    "20080708222025": "2008-07-08 22:20:25", " 20080708222025\t": "2008-07-08 22:20:25",
    " 20080708222025　": "2008-07-08 22:20:25", "20250231000000": None, "20250101240000": None,
    "20250101000060": None, "200807082220251234": "2008-07-08 22:20:25", "2025": "2025-01-01 00:00:00",
    "20250101": "2025-01-01 00:00:00", "202501021130": "2025-01-02 11:30:00", "202501": None, "12": None,
    "2025010211301": None, "01/02/2025": "2025-01-02 00:00:00", "31/12/2025": "2025-12-31 00:00:00",
    "2025-03-04T05:06:07Z": "2025-03-04 05:06:07", "2025-03-04T05:06:07+05:00": "2025-03-04 05:06:07",
    "2025-03-04 05:06:07.999": "2025-03-04 05:06:07", "2025-03-04": "2025-03-04 00:00:00",
    "2025-1-3": "2025-01-03 00:00:00", "2025/01/02": "2025-01-02 00:00:00", "2025.01.02": "2025-01-02 00:00:00",
    "2025-01-31T10": "2025-01-31 10:00:00", "2025-01-02 11:22": "2025-01-02 11:22:00", "now": None, "nan": None,
    "": None, None: None, "junk": None, "99990101000000": None, "16000101000000": None, "22620101000000": None,
    "22611231235959": "2261-12-31 23:59:59", "16780101000000": "1678-01-01 00:00:00", "16771231000000": None,
}
NUMBERS = {
    "200": (200, False), " 200 ": (200, False), "1e3": (1000, False), "200.0": (200, False), "1.": (1, False),
    "+5": (5, False), "-0": (0, False), "\t8\n": (8, False), "-": (None, False), "": (None, False),
    "0x10": (None, False), "nan": (None, False), "True": (None, False), "1_000": (None, False), "1,000": (None, False),
    "1.5": (None, True), "inf": (None, True), "-Infinity": (None, True), "9223372036854775808": (None, True),
    "9007199254740993": (9007199254740993, False), "9223372036854775807": (9223372036854775807, False), None: (None, False),
}
DATES = {
    "20250131": ("2025-01-31", datetime.date(2025, 1, 31)), "20259999": ("2025-99-99", None),
    " 20250131 ": ("2025-01-31", datetime.date(2025, 1, 31)), "2025-01-31": ("2025-01-31", datetime.date(2025, 1, 31)),
    "2025-01-31T10:11:12": ("2025-01-31", datetime.date(2025, 1, 31)), "2025-01-31T10": ("2025-01-31", datetime.date(2025, 1, 31)),
    "20250131T101112": ("2025-01-31", datetime.date(2025, 1, 31)), "2025-01-31T25:00": (None, None),
    "2025": (None, None), "2025-1-3": (None, None), "2025-02-30": (None, None), "2025-0131": (None, None),
    "": (None, None), "  ": (None, None), "junk": (None, None), None: (None, None),
}
EXTRACTS = {
    "2025-01-01 10:00": "2025-01-01T10:00:00", "2025-01-01T10:00:00Z": "2025-01-01T10:00:00+00:00",
    "2025-01-01T10:00:00.5+0530": "2025-01-01T10:00:00.500000+05:30", "2025-01-01T10:00:00,123456789": "2025-01-01T10:00:00.123456",
    "20250101": "2025-01-01T00:00:00", "2025-01-01": "2025-01-01T00:00:00", "2025-02-30": "2025-02-30", "x": "x",
    "2025-01-01T10:00:00-00:00": "2025-01-01T10:00:00+00:00", "": None, None: None,
}
URLS = {
    "https://a.com/p?q=1#f": ("a.com", "/p?q=1#f"), "https://a.com": (None, None), "http://u@a.com:80/": ("u@a.com:80", "/"),
    "ftp://a/b": (None, None), "x https://b.org/z": ("b.org", "/z"), "HTTPS://A.com/p": (None, None),
    "https://a.com/p\nq": ("a.com", "/p\nq"), "": (None, None), None: (None, None),
}
TEXTS = {
    " a b ": "a b", "\t\n": None, " x ": "x", "": None, None: None, "　": None, "a b": "a b",
}
SEGMENTS = {
    "https://i.example.org/CC-MAIN-2025-43-index": "CC-MAIN-2025-43", "https://i.example.org/CC-MAIN-2025-43-index//": "CC-MAIN-2025-43",
    "a-index-index": "a", "x/y": "y", "": "", "-index/": "",
}


def apply(spark, values, *columns):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = rows.select("i", *columns).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in got]


S = "s"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_crawl_timestamp(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = apply(spark, TIMESTAMPS, fn.crawl_timestamp(F.col(S)).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert dict(zip(TIMESTAMPS, got)) == TIMESTAMPS


def test_numbers(spark):
    got = apply(spark, NUMBERS, fn.to_bigint(F.col(S)), fn.is_unusable_number(F.col(S)))
    assert dict(zip(NUMBERS, got)) == NUMBERS


def test_integers_at_the_limits(spark):
    """Short integers, those a cast takes beyond them, and texts that are none: no cast that must fail is tried."""
    values = {
        "\x007\x1f": (7, False), "\x7f-007 ": (-7, False), "9" * 18: (10**18 - 1, False), str(2**63 - 1): (2**63 - 1, False),
        "\x01" + str(2**63 - 1): (2**63 - 1, False), "-" + str(2**63): (-(2**63), False), str(2**63): (None, True),
        "0" * 25 + "3": (3, False), "+" + "0" * 20 + "3\x02": (3, False), "\x01" + str(2**63): (None, False), "1_0": (None, False),
        "\u00a07": (None, False), "\u06617": (None, False), "+": (None, False), "": (None, False), "7\n": (7, False), "5.": (5, False),
    }
    number = fn.judge_number(F.col(S))
    got = apply(spark, values, fn.to_bigint(F.col(S)), fn.is_unusable_number(F.col(S)), number["value"], number["unusable"])
    assert dict(zip(values, got)) == {text: (*want, *want) for text, want in values.items()}


def test_dates(spark):
    date = fn.iso_date(F.col(S))
    assert dict(zip(DATES, apply(spark, DATES, date, fn.typed_date(date)))) == DATES


def test_extract_time(spark):
    assert dict(zip(EXTRACTS, apply(spark, EXTRACTS, fn.extract_time(F.col(S))))) == EXTRACTS


def test_urls(spark):
    assert dict(zip(URLS, apply(spark, URLS, fn.url_domain(F.col(S)), fn.url_path(F.col(S))))) == URLS


def test_text(spark):
    assert dict(zip(TEXTS, apply(spark, TEXTS, fn.safe_text(F.col(S))))) == TEXTS


def test_segment_name(spark):
    assert dict(zip(SEGMENTS, apply(spark, SEGMENTS, fn.segment_name(F.col(S))))) == SEGMENTS


# What a general date parser makes of these shapes; NULL where it refuses them.
SHAPES = {
    "20250101T101010": "2025-01-01 10:10:10", "20250101T101010Z": "2025-01-01 10:10:10", "20250101 101010": "2025-01-01 10:10:10",
    "20250101T1010": "2025-01-01 10:10:00", "20250101T10": "2025-01-01 10:00:00", "20250101 10:11:12": "2025-01-01 10:11:12",
    "20250101 10:11:12.5": "2025-01-01 10:11:12", "20250101T10:11:12+0930": "2025-01-01 10:11:12",
    "20250101T101010+09:30": "2025-01-01 10:10:10", "202501011010": "2025-01-01 10:10:00", "2025010110": None,
    "01/02/2025 10:00": "2025-01-02 10:00:00", "01/02/2025 10:00:05.25": "2025-01-02 10:00:05", "1/2/2025 1:02": "2025-01-02 01:02:00",
    "13/02/2025 10:00": "2025-02-13 10:00:00", "13/13/2025": None, "01-02-2025": "2025-01-02 00:00:00",
    "13-02-2025": "2025-02-13 00:00:00", "1.2.2025": "2025-01-02 00:00:00", "01 02 2025": "2025-01-02 00:00:00",
    "01-02-2025 10:00": "2025-01-02 10:00:00", "01/02/25": "2025-01-02 00:00:00", "25/02/13": "2013-02-25 00:00:00",
    "01-02-25": "2025-01-02 00:00:00", "01/02/99": "1999-01-02 00:00:00", "2025-03": "2025-03-01 00:00:00",
    "2025/03": "2025-03-01 00:00:00", "2025.03": "2025-03-01 00:00:00", "03/2025": "2025-03-01 00:00:00",
    "3/2025": "2025-03-01 00:00:00", "03.2025": None, "2025-13": None, "202503": None, "2025 1 3": "2025-01-03 00:00:00",
    "2025-01-02 10:5": "2025-01-02 10:05:00", "2025-01-02 10:11:12 +0100": "2025-01-02 10:11:12",
    "2025-01-02 10:11:12 UTC": "2025-01-02 10:11:12", "2025-01-02T10:11-05": "2025-01-02 10:11:00",
    "2025-01-02T101010": "2025-01-02 10:10:10", "2025-01-02T10:11:12z": "2025-01-02 10:11:12", "2025-W03": None,
    "2025-01-02 10:11:12,5": "2025-01-02 10:11:12", "20250101T": "2025-01-01 00:00:00", "2025-01-02T24:00:00": None,
    "02/30/2025": None, "2025-02-30": None, "99999": None, "12": None, "1677-01-01": None, "01/02/1500": None, "10:11:12x": None,
}


def test_general_shapes_of_time(spark):
    rows = spark.createDataFrame([(k,) for k in SHAPES], "s string")
    got = {r.s: r.t for r in rows.select("s", fn.crawl_timestamp(F.col("s")).cast("string").alias("t")).collect()}
    assert got == SHAPES
