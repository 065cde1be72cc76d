"""Index pages, blobs, landing and flattening."""

import gzip
import io
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.operators.append import append_all
from millrace.operators.pages import bookmarks_from_ledger, latest_blobs, latest_ledger, latest_pages
from millrace.operators.records import (
    INDEX_COLUMNS, broken_constraints, clean_index_lines, conform, good, in_scope, index_flat, index_records, rejects,
)
from millrace.operators.upsert import unprocessed
from millrace.plans.index_flatten import flatten_blobs_once, flatten_pages, page_records
from millrace.session import small_files
from millrace.sinks.blobs import pack_blobs
from millrace.sources.blobs import decode_blobs, oldest_blobs, parquet_blobs, read_raw_pages
from millrace.sources.listing import snapshot
from millrace.sources.pages import read_index_pages
from millrace.streaming import blobs as blob_stream
from millrace.streaming import pages as page_stream


def line(i, **more):
    return json.dumps({"urlkey": f"au,a)/{i}", "timestamp": "20250102030405", "url": f"https://a.au/{i}", "status": "200",
                       "length": str(i), "offset": "5", "digest": "D" * 32, "mime": "", **more})


def write_page(folder, segment, page, lines):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / f"{segment}-{page}.jsonl").write_text("\n".join(lines) + "\n")


def blob(table, gz=False):
    buffer = io.BytesIO()
    pq.write_table(table, buffer)
    return gzip.compress(buffer.getvalue()) if gz else buffer.getvalue()


def test_page_identity_and_bad_lines(spark, tmp_path):
    write_page(tmp_path, "CC-MAIN-2025-43", 17, [line(1), "", '{"urlkey": "cut', line(2, extra={"a": 1}, status=200)])
    nested = tmp_path / "segment=S-1" / "page=3"
    nested.mkdir(parents=True)
    (nested / "part-00000-x.json").write_text(line(3))
    (tmp_path / "unnamed.json").write_text(line(4))
    rows = read_index_pages(spark, str(tmp_path)).collect()
    places = sorted((r.segment or "", r.page or -1, r.source_file.rsplit("/", 1)[-1], r.reject_reason or "") for r in rows)
    assert places == [
        ("", -1, "unnamed.json", "no page identity"),
        ("CC-MAIN-2025-43", 17, "CC-MAIN-2025-43-17.parquet.gz", ""),
        ("CC-MAIN-2025-43", 17, "CC-MAIN-2025-43-17.parquet.gz", ""),
        ("CC-MAIN-2025-43", 17, "CC-MAIN-2025-43-17.parquet.gz", "malformed json"),
        ("S-1", 3, "S-1-3.parquet.gz", ""),
    ]
    assert {r.raw for r in rows if r.reject_reason == "malformed json"} == {'{"urlkey": "cut'}


def test_clean_and_flat(spark, tmp_path):
    write_page(tmp_path, "S", 0, [
        line(1, **{"mime-detected": "text/html"}), line(2, length="1.5"), line(3, digest="D" * 33),
        line(4, urlkey=""), line(5, timestamp="x"), line(6, length=None), line(7, status="99999"),
    ])
    lines = clean_index_lines(read_index_pages(spark, str(tmp_path)))
    assert index_records(lines).columns == INDEX_COLUMNS
    assert [r.reject_reason for r in rejects(lines).collect()] == ["length is no integer"]
    broken = {r.url[-1]: r.reject_reason for r in broken_constraints(lines).collect()}
    assert broken == {"3": "digest is too long", "4": "urlkey is null", "5": "timestamp is null", "7": "status is out of range"}
    flat = {r.path: r for r in index_flat(lines, F.lit("2025-01-01")).collect()}
    assert set(flat) == {"/1", "/6"}
    assert flat["/1"].mime is None and flat["/1"].mime_detected == "text/html"
    assert flat["/6"].length is None and flat["/6"].domain == "a.au" and flat["/6"].status == 200


def test_scope(spark):
    rows = [
        ("200", "au,a)/", None), ("200", "au", None), ("200", "aus,b)/", "https://b.aus/"), ("404", "au,a)/", None),
        ("200", None, "https://u@x.au:80/y"), ("200", None, "https://x.com/.au/"), ("200", None, "http://x.au"), (None, "au,", None),
    ]
    df = spark.createDataFrame(rows, "status string, urlkey string, url string")
    kept = df.where(in_scope(F.col("status"), F.col("urlkey"), F.col("url"))).collect()
    assert [tuple(r) for r in kept] == [rows[0], rows[1], rows[4], rows[6]]


def test_conform(spark):
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 2.5, "y")], "a int, b double, c string")
    assert [tuple(r) for r in conform(df, ["b", "z", "a"]).collect()] == [(None, None, "1"), ("2.5", None, "2")]


def test_decode_isolates_bad_blobs(spark):
    good_table = pa.table({"url": ["u1", None], "status": [200, 404], "length": [1.0, float("nan")], "extra": [1, 2]})
    rows = [
        (1, "a.parquet", blob(good_table)), (2, "b.PARQUET.GZ", blob(good_table, gz=True)), (3, "c.parquet.gz", b"junk"),
        (4, "d.parquet", b"junk"), (5, "e.parquet", None), (6, "f.parquet", blob(good_table.slice(0, 0))), (7, "g.json", b"{}"),
        (8, "h.parquet.gz", blob(good_table, gz=True)[:-20]),
    ]
    blobs = spark.createDataFrame(rows, "id long, file_name string, file_data binary")
    decoded = decode_blobs(parquet_blobs(blobs))
    assert sorted((r.raw_id, r.url or "", r.status) for r in good(decoded).collect()) == [
        (1, "", "404"), (1, "u1", "200"), (2, "", "404"), (2, "u1", "200"),
    ]
    bad = {r.raw_id: r.reject_reason.split(": ")[1] for r in decoded.where("reject_reason is not null").collect()}
    assert set(bad) == {3, 4, 5, 8}
    cleaned = good(clean_index_lines(decoded))
    assert {(r.status, r.length) for r in cleaned.collect()} == {(200, 1), (404, None)}


@pytest.mark.parametrize("clustered", [True, False])
def test_pack_splits_large_pages(spark, tmp_path, clustered):
    write_page(tmp_path, "S", 1, [line(i) for i in range(25)])
    write_page(tmp_path, "S", 2, [line(i) for i in range(5)])
    lines = read_index_pages(spark, str(tmp_path))
    packed = pack_blobs(lines, F.col("source_file"), F.lit("2025-01-01"), max_rows=10, clustered=clustered).cache()
    assert sorted((r.file_name, r.part, r.nth) for r in packed.collect()) == [
        ("S-1.parquet.gz", 0, 0), ("S-1.parquet.gz", 0, 1), ("S-1.parquet.gz", 0, 2), ("S-2.parquet.gz", 0, 0)
    ]
    assert packed.select("id").distinct().count() == 2
    urls = [r.url for r in good(decode_blobs(packed)).collect()]
    assert sorted(urls) == sorted([f"https://a.au/{i}" for i in range(25)] + [f"https://a.au/{i}" for i in range(5)])


def raw_pages(spark, path, rows):
    df = spark.createDataFrame(rows, "id long, file_name string, file_data binary, file_size long, uploaded_at string")
    df.withColumn("uploaded_at", F.col("uploaded_at").cast("timestamp_ntz")).repartition(3, "id").write.mode("append").parquet(path)
    return read_raw_pages(spark, path)


def test_oldest_latest_and_unprocessed(spark, tmp_path):
    rows = [(1, "a.parquet", b"x", 1, None), (2, "b.parquet", b"x", 1, "2025-01-02"), (3, "a.parquet", b"x", 1, "2025-01-01"),
            (4, "c.txt", b"x", 1, "2024-01-01"), (5, "a.parquet", b"x", 1, "2025-01-01")]
    blobs = raw_pages(spark, str(tmp_path / "raw"), rows)
    assert {r.id for r in oldest_blobs(blobs, 2).collect()} == {3, 5}
    assert {r.id for r in oldest_blobs(blobs, None).collect()} == {1, 2, 3, 5}
    assert {r.id for r in oldest_blobs(blobs, 5000).collect()} == {1, 2, 3, 5}
    for limit in (200_000, 0):
        assert {r.id for r in latest_blobs(blobs, limit).collect()} == {2, 4, 5}
    done = spark.createDataFrame([(1,), (1,), (9,)], "raw_id long")
    assert {r.id for r in unprocessed(blobs, done).collect()} == {2, 3, 4, 5}


def test_incremental_landing_dedup_and_flatten(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "target")

    def run():
        page_stream.land_pages(spark, str(landing), target, max_files=2).awaitTermination(120)
        return page_stream.ledger(spark, target)

    for page in range(5):
        write_page(landing / "day1", "S", page, [line(page * 10 + i) for i in range(3)] + ["{bad"])
    assert run().select("load_batch").distinct().count() == 3
    assert run().count() == 5  # nothing new, nothing added
    write_page(landing / "day2", "S", 4, [line(99)])
    write_page(landing / "day2", "S", 5, [line(100)])
    write_page(landing / "day2", "T", 0, [""])
    ledger = run()
    assert ledger.count() == 7
    assert {(r.cc_index, r.bookmark) for r in bookmarks_from_ledger(ledger).collect()} == {("S", 5)}
    assert latest_ledger(ledger).count() == 6
    landed = page_stream.landed_pages(spark, target)
    for limit in (200_000, 0):  # broadcast list of superseded files, and the join beyond it
        latest = good(latest_pages(landed, ledger, limit))
        assert {(r.page, r.n) for r in latest.groupBy("page").agg(F.count("*").alias("n")).collect()} == {
            (0, 3), (1, 3), (2, 3), (3, 3), (4, 1), (5, 1)
        }
    assert flatten_pages(spark, target) and not flatten_pages(spark, target)
    records = page_records(spark, target)
    assert good(records).count() == 14 and rejects(records).count() == 4
    counts = {r.source_file: (r.records, r.rejects) for r in page_stream.running_counts(spark, target).collect()}
    assert counts["S-0.parquet.gz"] == (3, 1) and counts["S-4.parquet.gz"] == (4, 1)


def test_many_small_pages_are_landed_in_few_files(spark, tmp_path):
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 256  # tasks that list them
    target = tmp_path / "out"
    for page in range(40):
        write_page(tmp_path / "in", "S", page, [line(page), line(page + 100)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a task for every file
    try:
        page_stream.land_pages(spark, str(tmp_path / "in"), str(target)).awaitTermination(120)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert 1 < len(list(target.glob("pages/*/*/*.parquet"))) <= 4 * spark.sparkContext.defaultParallelism
    assert page_stream.landed_pages(spark, str(target)).distinct().count() == 80
    assert page_stream.ledger(spark, str(target)).where("records = 2").count() == 40


def test_many_small_pages_are_packed_in_few_files(spark, tmp_path):
    for page in range(40):
        write_page(tmp_path / "in", "S", page, [line(page), line(page + 100)])
    cost, most = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(cost), spark.conf.get(most)
    spark.conf.set(most, "8m")
    try:
        with pytest.raises(ValueError), small_files(spark):
            lines = read_index_pages(spark, str(tmp_path / "in"))
            pack_blobs(lines, F.col("source_file"), F.lit("2025-01-01 00:00:00")).write.parquet(str(tmp_path / "raw"))
            raise ValueError
    finally:
        spark.conf.set(most, before[1])
    assert (spark.conf.get(cost), spark.conf.get(most)) == before
    assert 1 < len(list((tmp_path / "raw").glob("*.parquet"))) <= 8  # 20 with the usual cost
    raw = read_raw_pages(spark, str(tmp_path / "raw"))
    assert raw.select("id").distinct().count() == raw.count() == 40 and good(decode_blobs(raw)).count() == 80


def test_numbers_and_times_are_judged_in_generated_code(spark, tmp_path):
    write_page(tmp_path, "S", 1, [line(1), line(2, status="2e2", timestamp=""), line(3, length="1.5")])
    cleaned = clean_index_lines(read_index_pages(spark, str(tmp_path)))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline_outer(_judged" in plan.replace("inline(", "inline_outer(") and "size(" not in plan
    assert {(r.url[-1], r.status, r.reject_reason) for r in cleaned.collect()} == {
        ("1", 200, None), ("2", 200, None), ("3", 200, "length is no integer")
    }


def test_landing_a_batch_again_replaces_it(spark, tmp_path):
    write_page(tmp_path / "in", "S", 1, [line(1), line(2)])
    lines, target = read_index_pages(spark, str(tmp_path / "in")), str(tmp_path / "out")
    for _ in range(2):
        page_stream.land_batch(lines, target, 7)
    assert page_stream.landed_pages(spark, target).count() == 2
    assert [r.records for r in page_stream.ledger(spark, target).collect()] == [2]


def test_blob_streams_and_batches_do_each_file_once(spark, tmp_path):
    table = pa.table({"url": ["u1", "u2"], "status": ["200", "1.5"]})
    path = str(tmp_path / "raw")
    rows = [(i, f"p{i}.parquet.gz", blob(table, gz=True), 1, f"2025-01-0{i}") for i in range(1, 6)]
    raw_pages(spark, path, [*rows, (6, "bad.parquet", b"junk", 1, None), (7, "empty.parquet", blob(table.slice(0, 0)), 1, None)])
    stream = str(tmp_path / "stream")
    for _ in range(2):
        blob_stream.flatten_blobs(spark, path, stream, max_files=1).awaitTermination(120)
    batch = str(tmp_path / "batch")
    assert [flatten_blobs_once(spark, path, batch, limit) for limit in (2, None, None)] == [1, 2, None]
    for target in (stream, batch):
        cleaned = blob_stream.cleaned(spark, target)
        assert good(cleaned).count() == 5 and rejects(cleaned).count() == 6
        done = {r.raw_id: (r.records, r.rejects) for r in blob_stream.loads(spark, target).collect()}
        assert done == {**{i: (1, 1) for i in range(1, 6)}, 6: (0, 1), 7: (0, 0)}


def test_page_packed_again_with_fewer_lines(spark, tmp_path):
    """Library ids, pages of several blobs: the later copy replaces the earlier one, on both routes and across them."""
    raw = str(tmp_path / "raw")

    def pack(day, sizes):
        for page, n in sizes.items():
            write_page(tmp_path / day, "S.x", page, [line(100 * page + i) for i in range(n)])
        lines = read_index_pages(spark, str(tmp_path / day))
        pack_blobs(lines, F.col("source_file"), F.lit(day), max_rows=4).write.mode("append").parquet(raw)

    def kept(target):
        rows = good(blob_stream.latest_cleaned(spark, target)).groupBy("source_file").agg(F.count("*").alias("n"))
        return {r.source_file: r.n for r in rows.collect()}

    pack("2025-01-01", {1: 10, 2: 5})
    stream, batch, both = (str(tmp_path / x) for x in ("stream", "batch", "both"))
    blob_stream.flatten_blobs(spark, raw, stream, max_files=1).awaitTermination(120)
    blob_stream.flatten_blobs(spark, raw, both).awaitTermination(120)
    assert flatten_blobs_once(spark, raw, batch) == 1 and flatten_blobs_once(spark, raw, both) is None
    pack("2025-01-02", {1: 3})
    blob_stream.flatten_blobs(spark, raw, stream, max_files=1).awaitTermination(120)
    assert flatten_blobs_once(spark, raw, batch) == 2 and flatten_blobs_once(spark, raw, both) == 2
    blob_stream.flatten_blobs(spark, raw, both).awaitTermination(120)
    for target in (stream, batch, both):
        assert kept(target) == {"S.x-1.parquet.gz": 3, "S.x-2.parquet.gz": 5}
        assert good(blob_stream.cleaned(spark, target)).count() == 18
    assert good(decode_blobs(latest_blobs(read_raw_pages(spark, raw)))).count() == 8
    late = str(tmp_path / "late")
    flatten_blobs_once(spark, raw, late)  # both copies at once: the older one is not decoded
    assert kept(late) == {"S.x-1.parquet.gz": 3, "S.x-2.parquet.gz": 5} and blob_stream.cleaned(spark, late).count() == 8


def test_files_overwritten_in_place_and_lost_checkpoint(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "target")
    for page in range(3):
        write_page(landing, "S", page, [line(i) for i in range(3)])
    page_stream.land_pages(spark, str(landing), target).awaitTermination(120)
    assert page_stream.land_changed(spark, str(landing), target) is None
    write_page(landing, "S", 1, [line(i) for i in range(4)])
    (landing / "S-2.jsonl").write_text("\n")
    for name, then in (("S-1.jsonl", 1_000_000), ("S-2.jsonl", 2_000_000)):  # restored files have old times
        os.utime(landing / name, (then, then))
    page_stream.land_pages(spark, str(landing), target).awaitTermination(120)
    assert page_stream.land_changed(spark, str(landing), target) == 2
    assert page_stream.land_changed(spark, str(landing), target) is None

    def pages():
        lines = latest_pages(page_stream.landed_pages(spark, target), page_stream.ledger(spark, target))
        return {r.page: r.n for r in lines.groupBy("page").agg(F.count("*").alias("n")).collect()}

    assert pages() == {0: 3, 1: 4}
    assert {r.path for r in snapshot(spark, str(landing)).collect()} == {r.source_path for r in page_stream.ledger(spark, target).collect()}
    os.rename(f"{target}/_checkpoint", tmp_path / "lost")
    write_page(landing, "S", 3, [line(9)])
    page_stream.land_pages(spark, str(landing), target).awaitTermination(120)
    assert pages() == {0: 3, 1: 4, 3: 1}
    assert page_stream.landed_pages(spark, target).count() == 3 * 3 + 4 + 1


def test_append_keeps_duplicates(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(1,), (1,)], "i int")
    assert sorted(append_all(a, b, b).collect(), key=str) == sorted(
        append_all(a, b).collect() + spark.createDataFrame([(1, None), (1, None)], "i int, s string").collect(), key=str
    )


@pytest.mark.parametrize("streamed", [False, True])
def test_damaged_packed_pages_are_one_reject_each(spark, tmp_path, streamed):
    landing, target = tmp_path / "in", str(tmp_path / "out")
    write_page(landing, "S", 0, [line(1), line(2)])
    text = "\n".join(["", line(3), '{"cut', line(4, status=200), " "]).encode()
    (landing / "S-1.jsonl.gz").write_bytes(gzip.compress(text))
    (landing / "S-2.jsonl.GZ").write_bytes(gzip.compress(text)[:-9])
    (landing / "S-3.json.gz").write_bytes(b"junk")
    (landing / "S-4.json.gz").write_bytes(gzip.compress(b""))
    if streamed:
        for _ in range(2):
            page_stream.land_pages(spark, str(landing), target, 1).awaitTermination()
        rows = page_stream.landed_pages(spark, target).collect()
    else:
        rows = read_index_pages(spark, str(landing)).collect()
    found = sorted((r.page, r.reject_reason or "good", r.url or "") for r in rows)
    assert found == [
        (0, "good", "https://a.au/1"), (0, "good", "https://a.au/2"), (1, "good", "https://a.au/3"), (1, "good", "https://a.au/4"),
        (1, "malformed json", ""), (2, "unreadable file: EOFError", ""), (3, "unreadable file: BadGzipFile", ""),
    ]
    assert {r.raw for r in rows if r.reject_reason == "malformed json"} == {'{"cut'}
    assert all(r.landed_at is not None and r.source_path.startswith("file:") for r in rows)


def test_a_page_overwritten_with_no_bytes_loses_its_lines(spark, tmp_path):
    landing, target = tmp_path / "in" / "day 1", str(tmp_path / "out")
    write_page(landing, "S", 0, [line(1)])
    write_page(landing, "S", 1, [line(2), line(3)])
    page_stream.land_pages(spark, str(tmp_path / "in"), target).awaitTermination(120)
    assert page_stream.land_changed(spark, str(tmp_path / "in"), target) is None
    (landing / "S-1.jsonl").write_bytes(b"")
    assert page_stream.land_changed(spark, str(tmp_path / "in"), target) == 2
    assert page_stream.land_changed(spark, str(tmp_path / "in"), target) is None
    lines = latest_pages(page_stream.landed_pages(spark, target), page_stream.ledger(spark, target))
    assert [r.page for r in lines.collect()] == [0]


def test_a_run_of_many_batches_reads_the_ledger_once(spark, tmp_path, monkeypatch):
    landing, target, read = tmp_path / "landing", str(tmp_path / "target"), []
    known = page_stream.ledger

    def ledger(*given):
        read.append(given)
        return known(*given)

    monkeypatch.setattr(page_stream, "ledger", ledger)
    for run in range(2):
        for page in range(4):
            write_page(landing / f"day{run}", "S", 4 * run + page, [line(page)])
        page_stream.land_pages(spark, str(landing), target, max_files=1).awaitTermination(120)
        assert len(read) == run + 1
    entries = known(spark, target).collect()
    assert sorted(r.page for r in entries) == list(range(8)) and len({r.load_batch for r in entries}) == 8
    assert page_stream.landed_pages(spark, target).count() == 8


def test_one_trigger_lands_many_batches_and_repeats_what_was_not_entered(spark, tmp_path):
    landing, target = tmp_path / "landing", tmp_path / "target"
    for n in range(21):  # the later a page's number the older its file, but for page 0, which is fetched again last
        write_page(landing / f"day {n}", "S", n % 20, [line(n), line(n + 100)])
        os.utime(landing / f"day {n}" / f"S-{n % 20}.jsonl", (10_000 - n % 20 + n // 20,) * 2)
    for n in range(3):
        (landing / f"T-{n}.jsonl.gz").write_bytes(gzip.compress(line(n + 50).encode()))
    page_stream.land_pages(spark, str(landing), str(target), max_files=2).awaitTermination(120)
    assert [p.name for p in (target / "_checkpoint" / "commits").glob("[0-9]*")] == ["0"]

    def entered():
        batches = {}
        for row in page_stream.ledger(spark, str(target)).collect():
            batches.setdefault(row.load_batch, []).append((row.segment, row.landed_at))
        return batches

    def lines():
        latest = latest_pages(page_stream.landed_pages(spark, str(target)), page_stream.ledger(spark, str(target)))
        return sorted(r.url for r in latest.collect())

    batches = entered()
    assert sorted(batches) == list(range(1, 12))
    plain = [sorted(at for s, at in batches[n] if s == "S") for n in sorted(batches)]
    assert [len(p) for p in plain] == [2] * 10 + [1] and sum(plain, []) == sorted(sum(plain, []))
    assert [sum(s == "T" for s, _ in batches[n]) for n in sorted(batches)] == [2, 1] + [0] * 9
    expected = sorted(f"https://a.au/{i}" for i in [*range(1, 21), *range(101, 121), 50, 51, 52])
    assert lines() == expected
    # The driver is lost while the ledger is written: some batches have been entered, and the trigger is repeated.
    lost = {min(batches), max(batches)}
    for n in lost:
        os.rename(target / "ledger" / f"load_batch={n}", tmp_path / f"lost-{n}")
    for name in ("0", ".0.crc"):
        os.rename(target / "_checkpoint" / "commits" / name, tmp_path / f"lost-commit-{name}")
    assert len(lines()) < len(expected)
    page_stream.land_pages(spark, str(landing), str(target), max_files=2).awaitTermination(120)
    assert lines() == expected and page_stream.landed_pages(spark, str(target)).count() == 21 * 2 + 3
    assert set(batches) - set(entered()) == lost and sum(map(len, entered().values())) == 24


def test_batches_run_together_until_a_page_comes_again(spark):
    rows = [(n, f"f{n}.{'GZ' if n % 5 == 4 else 'json'}", "S" if n else None, n % 7) for n in range(10)]
    lines = spark.createDataFrame([r for r in rows for _ in range(3)], "landed_at int, source_path string, segment string, page long")
    runs = page_stream._batches(lines, 2)
    # Plain files 0 1 | 2 3 | 5 6 | 7 8 with packed ones 4 9 | beside them: page 1 of file 8 and page 2 of file 9 come twice.
    assert [[sorted(p[1] for p in files) for files in run] for run in runs] == [
        [["0", "1", "4", "9"]], [["2", "3"], ["5", "6"], ["7", "8"]],
    ]
    assert page_stream._batches(lines.limit(0), 2) == []


def test_a_first_trigger_without_any_line_lands_nothing(spark, tmp_path):
    write_page(tmp_path / "in", "S", 0, [""])
    for page in (0, 1):
        page_stream.land_pages(spark, str(tmp_path / "in"), str(tmp_path / "out"), max_files=1).awaitTermination(120)
        assert page_stream.ledger(spark, str(tmp_path / "out")).count() == page
        write_page(tmp_path / "in", "S", 1, [line(1)])
