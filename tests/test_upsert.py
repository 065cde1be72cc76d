"""Catalog and bookmark upserts, versions, CSV."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.upsert import lookup_bookmarks, upsert_bookmarks
from millrace.plans.index_pull import CATALOG, load_catalog, pull, start_pages
from millrace.schemas import BOOKMARKS
from millrace.sinks.export import read_csv, write_csv
from millrace.sinks.versions import current_version, read_current, write_next
from millrace.sources.catalog import read_catalog



def write(folder, name, entries):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(json.dumps(entries, indent=1))
    return str(folder)


def test_catalog_versions(spark, tmp_path):
    target = str(tmp_path / "target")
    first = write(tmp_path / "one", "c.json", [
        {"id": "A", "name": "a", "cdx-api": "https://x/A-index", "from": "2025-01-01T00:00:00Z", "other": 1},
        {"id": "B", "name": "b"}, {"name": "no id"},
    ])
    load_catalog(spark, first, target, F.lit("2025-01-01"))
    second = write(tmp_path / "two", "c.json", [
        {"id": "B", "name": "b2", "cdx-api": "https://x/B-index/"}, {"id": "C"}, {"id": "B", "name": "b3", "cdx-api": None},
    ])
    assert load_catalog(spark, second, target, F.lit("2025-02-01")) == 2
    rows = {r.id: r for r in read_current(spark, f"{target}/catalog", CATALOG).collect()}
    assert set(rows) == {"A", "B", "C"}
    assert (rows["A"].name, rows["A"].crawl_start) == ("a", datetime.datetime(2025, 1, 1))
    assert (rows["B"].name, rows["B"].cdx_api) == ("b3", "https://x/B-index/")
    assert rows["B"].created_at == datetime.datetime(2025, 1, 1) and rows["C"].created_at == datetime.datetime(2025, 2, 1)
    load_catalog(spark, second, target, F.lit("2025-03-01"))
    again = {r.id: r for r in read_current(spark, f"{target}/catalog", CATALOG).collect()}
    assert again == rows and current_version(spark, f"{target}/catalog") == 3


def test_catalog_that_is_no_json_fails(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"id": "A"')
    with pytest.raises(Exception, match="FAILFAST|Malformed|MALFORMED|FAILED_READ_FILE"):
        read_catalog(spark, str(tmp_path)).collect()


def test_bookmarks(spark):
    old = spark.createDataFrame(
        [("same", 5), ("back", 9), ("null", None), ("untouched", None), ("ahead", 1)], "cc_index string, bookmark long"
    ).select("cc_index", "bookmark", *(F.lit("2024-01-01").cast("timestamp_ntz").alias(c) for c in ("created_at", "last_updated")))
    new = spark.createDataFrame(
        [("same", 5), ("back", 3), ("null", -1), ("ahead", 4), ("ahead", 2), ("new", -1)], "cc_index string, bookmark long"
    )
    merged = upsert_bookmarks(old, new, F.lit("2025-01-01"))
    assert merged.columns == BOOKMARKS.fieldNames()
    got = {r.cc_index: (r.bookmark, r.created_at.year, r.last_updated.year) for r in merged.collect()}
    assert got == {
        "same": (5, 2024, 2024), "back": (9, 2024, 2024), "null": (0, 2024, 2025), "untouched": (None, 2024, 2024),
        "ahead": (4, 2024, 2025), "new": (0, 2025, 2025),
    }
    twice = upsert_bookmarks(merged, new, F.lit("2026-01-01"))
    assert {tuple(r) for r in twice.collect()} == {tuple(r) for r in merged.collect()}
    crawls = spark.createDataFrame([("same",), ("untouched",), ("unknown",)], "cc_index string")
    assert {tuple(r) for r in lookup_bookmarks(crawls, old).collect()} == {("same", 5), ("untouched", 0), ("unknown", 0)}


def test_pull(spark, tmp_path):
    catalog = write(tmp_path / "cat", "c.json", [{"id": "S", "cdx-api": "https://x/S-index/"}, {"id": "T", "cdx-api": "https://x/T-index"}])
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "S-0.jsonl").write_text('{"url": "u"}\n')
    (landing / "S-1.jsonl").write_text('{"url": "u"}\n')
    target = str(tmp_path / "target")
    for day in ("2025-01-01", "2025-01-02"):
        pull(spark, catalog, str(landing), target, F.lit(day))
    assert {(r.cc_index, r.bookmark) for r in start_pages(spark, target).collect()} == {("S", 1), ("T", 0)}
    assert [r.last_updated.day for r in read_current(spark, f"{target}/bookmarks", BOOKMARKS).collect()] == [1]


def test_csv_keeps_null_and_empty_apart(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])
    rows = [("", 1), (None, None), (" x ", 2), ('q"q', 3), ("a,b", 4), ("two\nlines", 5), ('""', 6)]
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame(rows, schema).coalesce(1), path)
    assert {tuple(r) for r in read_csv(spark, path, schema).collect()} == set(rows)
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*"))
    assert text.startswith('a,n\n"",1\n,\n') and '"q""q",3' in text


def test_a_version_without_an_entry_does_not_count(spark, tmp_path):
    path, schema = str(tmp_path / "t"), T.StructType([T.StructField("k", T.LongType())])
    assert read_current(spark, path, schema).count() == 0
    assert write_next(spark.range(3).toDF("k"), path, schema) == 1
    # A driver that is lost after the data and before the entry leaves this:
    spark.range(9).toDF("k").withColumn("version", F.lit(2).cast("long")).write.mode("append").partitionBy("version").parquet(path)
    assert current_version(spark, path) == 1 and read_current(spark, path, schema).count() == 3
    assert write_next(spark.range(4).toDF("k"), path, schema) == 3
    assert read_current(spark, path, schema).count() == 4


def test_entries_with_dates_that_are_none_are_rejects(spark, tmp_path):
    target = str(tmp_path / "target")
    source = write(tmp_path / "one", "c.json", [
        {"id": "A", "from": "soon"}, {"id": "B", "to": "2025-02-30T00:00:00"}, {"id": "C", "from": "2025-01-01T00:00:00Z", "to": None},
        {"from": "x"}, {"id": "D", "from": ""},
    ])
    load_catalog(spark, source, target, F.lit("2025-01-01"))
    assert [r.id for r in read_current(spark, f"{target}/catalog", CATALOG).collect()] == ["C"]
    refused = spark.read.parquet(f"{target}/catalog_rejects").select("id", "reject_reason").collect()
    assert {tuple(r) for r in refused} == {
        ("A", "from is no date"), ("B", "to is no date"), (None, "id is null"), ("D", "from is no date"),
    }
