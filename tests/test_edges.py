"""Inputs that a kinder fixture leaves out: odd numbers, late files, copies with one id, gaps, narrow types."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.functions import crawl_timestamp, is_unusable_number, iso_date, to_bigint
from millrace.operators.pages import bookmarks_from_ledger, latest_blobs, latest_pages
from millrace.operators.records import broken_constraints, index_flat, repeated_keys
from millrace.sources.blobs import oldest_blobs
from millrace.streaming.pages import land_pages, landed_pages


@pytest.mark.parametrize(
    "text, value, unusable",
    [
        ("1e29", None, True), ("1e30", None, True), ("9" * 32, None, True), ("1.0000000001", None, True),
        ("0.0000000004", None, True), ("1e-20", None, True), ("200.0", 200, False), ("1e3", 1000, False),
        ("12.50e1", 125, False), ("000.00", 0, False), ("0e999999999999", 0, False), ("-9223372036854775808.0", -(2**63), False),
        ("9223372036854775808", None, True), ("1e99999999999", None, True), (" +7.00 ", 7, False), ("abc", None, False),
        ("0" * 60 + "12.0", 12, False), (".5", None, True), ("inf", None, True), (None, None, False),
    ],
)
def test_numbers(spark, text, value, unusable):
    row = spark.createDataFrame([(text,)], "s string").select(to_bigint(F.col("s")), is_unusable_number(F.col("s"))).first()
    assert tuple(row) == (value, unusable)


def test_anchors_stop_at_the_end(spark):
    row = spark.createDataFrame([("20250101\n", "20250101101010\n")], "d string, t string").select(
        iso_date(F.col("d")), crawl_timestamp(F.col("t")).cast("string")
    ).first()
    assert tuple(row) == ("2025-01-01", "2025-01-01 10:10:10")


def test_latest_blob_where_all_copies_bear_one_id(spark):
    at = dt.datetime(2025, 1, 1)
    rows = [(1, "S-0", at, b"old"), (1, "S-0", at + dt.timedelta(1), b"new"), (2, "S-1", None, b"only"), (3, None, at, b"x")]
    raw = spark.createDataFrame(rows, "id long, file_name string, uploaded_at timestamp, file_data binary")
    for most in (100, 0):
        assert sorted(bytes(r.file_data) for r in latest_blobs(raw, most).collect()) == [b"new", b"only", b"x"]


def test_files_without_a_page_are_pages_of_their_own(spark):
    at = dt.datetime(2025, 1, 1)
    kinds = "segment string, page long, load_batch long, source_path string, landed_at timestamp"
    ledger = spark.createDataFrame([(None, None, 0, "a", at), (None, None, 0, "b", at), ("S", 1, 0, "c", at), ("S", 1, 1, "d", at)], kinds)
    lines = ledger.select("load_batch", "source_path")
    assert sorted(r.source_path for r in latest_pages(lines, ledger).collect()) == ["a", "b", "d"]


def test_bookmark_stops_before_a_gap(spark):
    rows = [("A", 0, 5), ("A", 1, 5), ("A", 5, 5), ("B", 0, 3), ("B", 1, 0), ("C", 4, 2), ("C", 4, 2), (None, 1, 1)]
    ledger = spark.createDataFrame(rows, "segment string, page long, records long")
    assert {tuple(r) for r in bookmarks_from_ledger(ledger).collect()} == {("A", 1), ("B", 0)}
    stored = spark.createDataFrame([("A", 4), ("B", None), ("C", 3), ("D", 7)], "cc_index string, bookmark long")
    assert {tuple(r) for r in bookmarks_from_ledger(ledger, stored).collect()} == {("A", 5), ("B", 0), ("C", 4)}


def test_repeated_keys(spark):
    kind = "k string, v long, w int"
    rows = spark.createDataFrame([("a", 1, 0), ("a", 1, 1), ("b", 1, 0), ("c", 2, 0), (None, 1, 0), (None, 1, 0)], kind)
    stored = spark.createDataFrame([("b", 1, 9), ("d", 5, 9), ("b", 2, 9)], kind)
    assert {tuple(r) for r in repeated_keys(rows, ["k", "v"]).collect()} == {("a", 1, 2)}
    assert {tuple(r) for r in repeated_keys(rows, ["k", "v"], stored).collect()} == {("a", 1, 2), ("b", 1, 2)}


def test_values_beyond_the_narrow_types_are_rejects(spark):
    kinds = (
        "source_file string, urlkey string, url string, crawl_timestamp timestamp_ntz, status long, mime string, "
        "mime_detected string, digest string, length long, file_offset long, filename string, reject_reason string"
    )
    at = dt.datetime(2025, 1, 1)
    make = lambda status, length: ("f", "k", "http://a/b", at, status, "m", "m", "d", length, 1, "n", None)
    rows = spark.createDataFrame([make(200, 5), make(70000, 5), make(200, 3_000_000_000), make(None, None)], kinds)
    assert sorted(r.reject_reason for r in broken_constraints(rows).collect()) == [
        "length is out of range", "status is out of range",
    ]
    assert index_flat(rows, F.current_timestamp()).count() == 2


def test_oldest_blobs_beyond_the_list(spark):
    raw = spark.range(3000).select(
        "id", F.concat(F.lit("p-"), "id", F.lit(".parquet.gz")).alias("file_name"),
        F.timestamp_seconds(F.lit(10_000) - F.col("id")).alias("uploaded_at"), F.lit(b"x").alias("file_data"),
    )
    assert oldest_blobs(raw, 1500).agg(F.min("id"), F.count("*")).first() == (1500, 1500)


def test_old_files_land_too(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()

    def page(number, days):
        file = landing / f"CC-MAIN-2025-01-{number}.jsonl"
        file.write_text(json.dumps({"urlkey": f"au,a)/{number}", "url": "http://a.au/", "status": "200"}) + "\n")
        then = dt.datetime.now().timestamp() - 86400 * days
        os.utime(file, (then, then))

    page(1, 0)
    land_pages(spark, str(landing), target).awaitTermination()
    page(2, 30)
    page(3, 0)
    land_pages(spark, str(landing), target).awaitTermination()
    assert landed_pages(spark, target).count() == 3
