"""Register XML: splitting, awkward documents, headers, loads."""

import gzip
import os
import random
import re
import shutil
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.operators.register import (
    REGISTER_COLUMNS, attach_headers, flatten_register, header_rejects, header_spans, project_register, register_events,
)
from millrace.plans.register_load import load_register, parse, read_register, read_register_rejects, register_files
from millrace.session import shared_dir, stage
from millrace.sources import streams
from millrace.sources.register import (
    discover_register_files, read_archived_register_chunks, read_register_chunks,
)


def name(text, kind="MN", tag="NonIndividualName"):
    attribute = "" if kind is None else f' type="{kind}"'
    return f"<{tag}{attribute}><NonIndividualNameText>{text}</NonIndividualNameText></{tag}>"


def header(number="1", count="2", time="2025-01-01"):
    return (
        f"<TransferInfo><FileSequenceNumber>{number}</FileSequenceNumber><RecordCount>{count}</RecordCount>"
        f"<ExtractTime>{time}</ExtractTime></TransferInfo>"
    )


def flatten(spark, folder):
    return {r.abn: r for r in flatten_register(parse(read_register_chunks(spark, str(folder)))).collect()}


def test_awkward_records(spark, tmp_path):
    records = [
        "<ABR/>",
        f'<ABR replaced=""><ABN status=" A "> 01 </ABN><ABN>zz</ABN><MainEntity><Group>{name("deep", "D")}</Group>{name("late")}'
        "<BusinessAddress><X><AddressDetails><State>no</State></AddressDetails></X></BusinessAddress>"
        "<More><BusinessAddress><AddressDetails><State> VIC </State><Postcode>0800</Postcode></AddressDetails></BusinessAddress></More>"
        "</MainEntity></ABR >",
        f"<ABR><ABN>02</ABN><MainEntity>\n{name('&#160;A &amp; &lt;B&gt; ')}\n</MainEntity>"
        f"<OtherEntity><W>{name('o &amp; 1', 'T')}</W>{name('not me')}</OtherEntity><OtherEntity/><OtherEntity a='/'/>"
        f"<OtherEntity>{name(' ', 'T')}</OtherEntity><OtherEntity>{name('o2', '')}</OtherEntity></ABR>",
        "<!-- <ABR><ABN>no</ABN> --><ABR recordLastUpdatedDate='20250102'><ABN>0<!-- x -->3</ABN>"
        f"<OtherEntity>{name('p', 'T')}</OtherEntity><OtherEntity>{name('q', None)}</OtherEntity></ABR>",
        "<ABRX>no record</ABRX><ABR\n><ABN>04</ABN><EntityType><EntityTypeInd>I</EntityTypeInd></EntityType><EntityType>"
        "<EntityTypeInd>second</EntityTypeInd></EntityType><GST status='' GSTStatusFromDate='20000701'/></ABR>",
        "<ABR><ABN>05</ABN><MainEntity><BusinessAddress/><BusinessAddress><AddressDetails><State>NT</State></AddressDetails>"
        "</BusinessAddress></MainEntity></ABR>",
        "<ABR><ABN>bad</ABR>",
        "<ABR><ABN>06</ABN></ABR>",
    ]
    (tmp_path / "a.xml").write_text("<T>" + "\n".join(records) + "</T>")
    rows = flatten(spark, tmp_path)
    assert set(rows) == {None, "01", "02", "03", "04", "05", "06"}
    first = rows["01"]
    assert (first.abn_status, first.replaced) == (" A ", "")
    assert (first.mainentity_name_type, first.mainentity_name_text) == ("D", "deep")
    assert (first.businessaddress_state, first.businessaddress_postcode) == ("VIC", "0800")
    assert rows["02"].mainentity_name_text == "A & <B>"
    assert rows["02"].other_entities == "T:o & 1; o2"
    assert (rows["03"].record_last_updated_date, rows["03"].other_entities) == ("2025-01-02", "T:p; q")
    assert (rows["04"].entity_type_ind, rows["04"].gst_status, rows["04"].gst_status_from_date) == ("I", "", "2000-07-01")
    assert rows["05"].businessaddress_state == "NT"


def test_every_record_counts_once(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<T><ABR/><ABR a='1'/>\n<ABR><ABN>1</ABN></ABR><ABR><ABN>bad</ABR><ABR><ABN>2</ABN></ABR></T>")
    flat = flatten_register(parse(read_register_chunks(spark, str(tmp_path))))
    assert flat.count() == 5
    assert [r.raw for r in flat.where("reject_reason is not null").collect()] == ["<ABR><ABN>bad</ABR>"]


@pytest.fixture(scope="module")
def long_file(spark, tmp_path_factory):
    """One file read by many tasks, with three headers; the middle one brings one field only."""
    folder = tmp_path_factory.mktemp("long")
    parts = ["<?xml version='1.0'?><T><ABR><ABN>00000</ABN></ABR>", header("7", "", "2025-01-01 10:00")]
    for i in range(1, 6000):
        if i == 2500:
            parts.append("<TransferInfo><RecordCount>12</RecordCount></TransferInfo>")
        if i == 4000:
            parts.append(header("x", "13", "soon"))
        parts.append(f"<ABR>\n<ABN>{i:05d}</ABN>{'<Filler>f</Filler>' * 20}</ABR>")
    (folder / "long.xml").write_text("\n".join(parts) + "</T>")
    return folder


@pytest.mark.parametrize("broadcast", [True, False])
def test_headers_hold_from_their_place_on(spark, long_file, broadcast):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        chunks = read_register_chunks(spark, str(long_file))
        assert chunks.select("block").distinct().count() > 5
        projected = parse(chunks)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    records = projected.where("is_record").select("source_file", "block", "seq", "pos", "abn")
    joined = attach_headers(records, header_spans(projected), broadcast)
    got = {r.abn: (r.file_sequence_number, r.record_count, r.extract_time) for r in joined.collect()}
    assert len(got) == 6000 and joined.count() == 6000
    for i in range(6000):
        want = (7, None, "2025-01-01T10:00:00") if i else (None, None, None)
        if i >= 2500:
            want = (7, 12, "2025-01-01T10:00:00")
        if i >= 4000:
            want = (None, 13, "soon")
        assert got[f"{i:05d}"] == want, i
    assert [r.reject_reason for r in header_rejects(projected).collect()] == ["FileSequenceNumber is no integer"]


def test_agrees_with_whole_file_reader(spark, long_file):
    ours = register_events(read_register_chunks(spark, str(long_file))).where("xml is not null")
    whole = spark.read.format("xml").option("rowTag", "ABR").schema("ABN string").load(str(long_file))
    got = ours.select(F.regexp_extract("xml", "<ABN>([0-9]+)", 1).alias("ABN"))
    assert got.exceptAll(whole).count() == 0 and whole.exceptAll(got).count() == 0


def test_discovery_and_containers(spark, tmp_path):
    document = f"<T>{header()}<ABR><ABN>%s</ABN></ABR></T>"
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.XML").write_text(document % 1)
    (tmp_path / "sub" / "b.xml.gz").write_bytes(gzip.compress((document % 2).encode()))
    (tmp_path / "sub" / "c.GZ").write_bytes(gzip.compress((document % 3).encode()))
    (tmp_path / "d.txt").write_text(document % 4)
    found = {r.path.rsplit("/", 1)[1] for r in discover_register_files(spark, str(tmp_path)).collect()}
    assert found == {"a.XML", "b.xml.gz", "c.GZ"}
    assert set(flatten(spark, tmp_path)) == {"1", "2", "3"}


def test_archives(spark, tmp_path):
    document = f"<T>{header()}<ABR><ABN>%s</ABN></ABR></T>"
    with zipfile.ZipFile(tmp_path / "one.ZIP", "w") as out:
        out.writestr("x/a.xml", document % 1)
        out.writestr("x/b.xml.gz", gzip.compress((document % 2).encode()))
        out.writestr("x/c.txt", document % 3)
        out.writestr("broken.gz", b"no gzip")
    (tmp_path / "two.zip").write_bytes(b"no archive")
    target = str(tmp_path / "out")
    load_register(spark, str(tmp_path), target, archived=True)
    assert {r.abn for r in read_register(spark, target).collect()} == {"1", "2"}
    reasons = {r.source_file.rsplit("/", 1)[1]: r.reject_reason for r in read_register_rejects(spark, target).collect()}
    assert reasons == {"two.zip": "unreadable archive", "broken.gz": "unreadable member: BadGzipFile"}


def test_large_member_is_streamed_in_order(spark, tmp_path):
    records = "".join(f"<ABR><ABN>{i}</ABN>{'x' * 900}</ABR>" for i in range(8000))
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("big.xml", f"<T>{header()}{records}</T>")
    chunks = read_archived_register_chunks(spark, str(tmp_path))
    rows = register_events(chunks).where("xml is not null").orderBy("seq").select(F.regexp_extract("xml", "<ABN>([0-9]+)", 1)).collect()
    assert [int(r[0]) for r in rows] == list(range(8000))


def test_load_replaces_by_file(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.xml").write_text(f"<T>{header()}<ABR><ABN>1</ABN></ABR><ABR><ABN>2</ABN></ABR></T>")
    (source / "b.xml").write_text(f"<T>{header()}<ABR><ABN>3</ABN></ABR></T>")
    load_register(spark, str(source), target)
    load_register(spark, str(source), target)
    assert sorted(r.abn for r in read_register(spark, target).collect()) == ["1", "2", "3"]
    (source / "a.xml").write_text(f"<T>{header()}<ABR><ABN>4</ABN></ABR></T>")
    (source / "b.xml").unlink()
    load_register(spark, str(source), target)
    table = read_register(spark, target)
    assert sorted(r.abn for r in table.collect()) == ["3", "4"] and table.columns == REGISTER_COLUMNS


def test_load_of_an_emptied_file(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.xml").write_text(f"<T>{header()}<ABR><ABN>1</ABN></ABR><ABR><ABN>2</ABN></ABR></T>")
    (source / "b.xml").write_text(f"<T>{header()}<ABR><ABN>3</ABN></ABR></T>")
    load_register(spark, str(source), target)
    (source / "a.xml").write_text(f"<T>{header()}</T>")
    load_register(spark, str(source), target)
    assert [r.abn for r in read_register(spark, target).collect()] == ["3"]
    rejects = [(r.source_file.rsplit("/", 1)[1], r.reject_reason) for r in read_register_rejects(spark, target).collect()]
    assert rejects == [("a.xml", "no records")]


def test_staged_and_lazy_agree(spark, long_file):
    lazy = project_register(register_events(read_register_chunks(spark, str(long_file))))
    columns = [c for c in flatten_register(lazy).columns if c != "source_file"]
    assert flatten_register(lazy).select(columns).exceptAll(flatten_register(stage(lazy, "x")).select(columns)).count() == 0


def test_damaged_packed_files_are_one_reject_each(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    whole = gzip.compress(f"<T>{header()}{''.join(f'<ABR><ABN>{i}</ABN><x>{i * 7919}</x></ABR>' for i in range(3000))}</T>".encode())
    (source / "good.xml.gz").write_bytes(whole)
    (source / "twice.xml.gz").write_bytes(gzip.compress(b"<T><ABR><ABN>a</ABN></ABR>") + gzip.compress(b"<ABR><ABN>b</ABN></ABR></T>"))
    (source / "cut.xml.gz").write_bytes(whole[:-2000])
    (source / "flipped.xml.gz").write_bytes(whole[:5000] + bytes([whole[5000] ^ 255]) + whole[5001:])
    (source / "junk.gz").write_bytes(b"no gzip at all")
    (source / "nothing.gz").write_bytes(gzip.compress(b""))
    load_register(spark, str(source), target)
    assert {r.abn for r in read_register(spark, target).collect()} == {*map(str, range(3000)), "a", "b"}
    rejects = sorted((r.source_file.rsplit("/", 1)[1], r.reject_reason) for r in read_register_rejects(spark, target).collect())
    assert [r[0] for r in rejects] == ["cut.xml.gz", "flipped.xml.gz", "junk.gz", "nothing.gz"]
    assert rejects[0][1] == "unreadable file: EOFError" and rejects[2][1] == "unreadable file: BadGzipFile"
    assert rejects[1][1].startswith("unreadable file: ") and rejects[3][1] == "no records"


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("encoding", ["ISO-8859-1", "windows-1252", "UTF-16", "UTF-8", "us-ascii", "utf-8-sig"])
def test_declared_encodings(spark, tmp_path, encoding, packed):
    name_ = "Café & Söhne" if encoding != "us-ascii" else "Cafe"
    said = "UTF-8" if encoding == "utf-8-sig" else encoding
    text = f"<?xml version='1.0' encoding='{said}'?><T><ABR><ABN>1</ABN><MainEntity>{name(name_.replace('&', '&amp;'))}</MainEntity></ABR></T>"
    data = text.encode(encoding)
    (tmp_path / ("a.xml.gz" if packed else "a.xml")).write_bytes(gzip.compress(data) if packed else data)
    assert flatten(spark, tmp_path)["1"].mainentity_name_text == name_


def test_bytes_that_are_not_what_they_are_said_to_be(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes(b"<T><ABR><ABN>1</ABN></ABR><ABR><ABN>2</ABN><x>Caf\xe9</x></ABR></T>")
    (tmp_path / "b.xml").write_text("<?xml version='1.0' encoding='klingon'?><T><ABR><ABN>3</ABN></ABR></T>")
    rows = flatten_register(parse(read_register_chunks(spark, str(tmp_path)))).collect()
    assert [r.abn for r in rows if r.reject_reason is None] == ["1"]
    assert sorted(r.reject_reason for r in rows if r.reject_reason) == ["record is not utf-8", "unreadable file: unknown encoding: klingon"]


def test_files_cut_off_in_a_record(spark, tmp_path):
    records = "".join(f"<ABR><ABN>{i}</ABN><x/></ABR>" for i in range(3))
    (tmp_path / "between.xml").write_text(f"<T>{records}<ABR><ABN>3</ABN>")
    (tmp_path / "inside.xml").write_text(f"<T>{records}<ABR><ABN>4</")
    (tmp_path / "after.xml").write_text(f"<T>{records}")
    (tmp_path / "bare.xml").write_text(f"<T>{records}<ABR/><ABR a='1'/>\n</T>")
    (tmp_path / "packed.xml.gz").write_bytes(gzip.compress(f"<T>{records}<ABR><ABN>5</ABN>\n".encode()))
    rows = flatten_register(parse(read_register_chunks(spark, str(tmp_path)))).collect()
    kinds = {}
    for r in rows:
        kinds.setdefault(r.source_file.rsplit("/", 1)[1], []).append(r.reject_reason or "good")
    cut_off = ["good"] * 3 + ["malformed xml"]
    assert {k: sorted(v) for k, v in kinds.items()} == {
        "between.xml": cut_off, "inside.xml": cut_off, "packed.xml.gz": cut_off, "after.xml": ["good"] * 3, "bare.xml": ["good"] * 5,
    }


def test_loosely_closed_files_are_read_in_pieces(spark, tmp_path, monkeypatch):
    records = "\n".join(f"<ABR><ABN>{i}</ABN>{'y' * 300}</ABR{' ' * (i % 3 + 1)}>" for i in range(2000))
    (tmp_path / "loose.xml").write_text(f"<T>{records}</T>")
    chunks = read_register_chunks(spark, str(tmp_path))
    assert chunks.agg(F.max(F.length("value"))).first()[0] < 400
    rows = flatten_register(parse(chunks))
    assert rows.where("reject_reason is null").select("abn").distinct().count() == rows.count() == 2000


def test_pieces_have_a_bound():
    start, end = re.compile(rb"<R[\s/>]"), re.compile(rb"</R\s*>")
    text = b"<R>" + b"a" * 500 + b"</R><R>ok</R><R>" + b"b" * 100 + b"<R>c</R><R>d</R >e"
    for k in (1, 7, 50, 1000):
        found = list(streams.cut((text[i : i + k] for i in range(0, len(text), k)), end, start, longest=60))
        assert [(p, closed) for p, closed, fits in found if fits] == [
            (b"<R>ok", True), (b"<R>c", True), (b"<R>d", True), (b"e", False)
        ]
        assert [p[:5] for p, _, fits in found if not fits] == [b"<R>aa", b"<R>bb"]
    parts = [b"</R>", b"</R  >", b"<R>", b"abc", b"x", b"</RX>", b"<R a>"]
    draw = random.Random(2)
    for _ in range(500):
        text, k = b"".join(draw.choices(parts, k=draw.randrange(20))), draw.randrange(1, 9)
        whole = end.split(text)
        want = [(p, True, True) for p in whole[:-1]] + [(p, False, True) for p in whole[-1:] if p]
        assert list(streams.cut((text[i : i + k] for i in range(0, len(text), k)), end, start)) == want


def test_member_without_an_end_is_one_reject(spark, tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("flat.xml", "<T><ABR>" + "z" * (streams.LONGEST + (2 << 20)))
        out.writestr("good.xml", f"<T>{header()}<ABR><ABN>1</ABN></ABR></T>")
    target = str(tmp_path / "out")
    load_register(spark, str(tmp_path), target, archived=True)
    assert [r.abn for r in read_register(spark, target).collect()] == ["1"]
    rejects = read_register_rejects(spark, target).collect()
    assert [(r.source_file.rsplit("/", 1)[1], r.reject_reason, len(r.raw)) for r in rejects] == [("flat.xml", "record too long", 1000)]


def test_a_file_of_no_bytes_loses_its_rows(spark, tmp_path):
    source, target = tmp_path / "in" / "deep er", str(tmp_path / "out")
    source.mkdir(parents=True)
    (source / "a b.xml").write_text(f"<T>{header()}<ABR><ABN>1</ABN></ABR></T>")
    (source / "b.xml").write_text(f"<T>{header()}<ABR><ABN>2</ABN></ABR></T>")
    load_register(spark, str(tmp_path / "in"), target)
    (source / "a b.xml").write_bytes(b"")
    load_register(spark, str(tmp_path / "in"), target)
    assert [r.abn for r in read_register(spark, target).collect()] == ["2"]
    rejects = [(r.source_file.rsplit("/", 1)[1], r.reject_reason) for r in read_register_rejects(spark, target).collect()]
    assert rejects == [("a%20b.xml", "no records")]
    found = {(r.source_file.rsplit("/", 1)[1], r.records, r.load) for r in register_files(spark, target).collect()}
    assert found == {("a%20b.xml", 1, 1), ("b.xml", 1, 1), ("a%20b.xml", 0, 2), ("b.xml", 1, 2)}


def test_a_load_that_broke_off_does_not_count_and_stages_go(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.xml").write_text(f"<T>{header()}<ABR><ABN>1</ABN></ABR></T>")
    load_register(spark, str(source), target)
    (source / "a.xml").write_text(f"<T>{header()}<ABR><ABN>2</ABN></ABR></T>")
    load_register(spark, str(source), target)
    shutil.rmtree(tmp_path / "out" / "rows_log")  # as if neither had come to its end
    assert read_register(spark, target).count() == 0
    assert load_register(spark, str(source), target) == 3
    assert [r.abn for r in read_register(spark, target).collect()] == ["2"]
    assert not [d for d in os.listdir(f"{shared_dir(spark)}/millrace") if d.startswith("passing-")]


def test_many_headers_without_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.operators.register.STRETCH", 7)
    parts = [f"{header(str(i), '', '') if i % 3 == 0 else ''}<ABR><ABN>{i}</ABN></ABR>" for i in range(200)]
    (tmp_path / "a.xml").write_text(f"<T>{''.join(parts)}</T>")
    rows = flatten_register(parse(read_register_chunks(spark, str(tmp_path))), broadcast=False).collect()
    assert len(rows) == 200 and all(r.file_sequence_number == int(r.abn) // 3 * 3 for r in rows)


def test_many_odd_files_are_joined_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.sources.register._LISTED", 1)
    for i in range(6):
        end, first = ("</ABR >", "") if i % 2 else ("</ABR>", "<?xml version='1.0'?>")
        records = "".join(f"<ABR><ABN>{i}{j}</ABN>{end}" for j in range(3))
        (tmp_path / f"f{i}.xml").write_text(f"{first}<T>{records}</T>")
    chunks = read_register_chunks(spark, str(tmp_path))
    rows = flatten_register(parse(chunks)).collect()
    assert sorted(r.abn for r in rows) == sorted(f"{i}{j}" for i in range(6) for j in range(3))
    assert not [r for r in rows if r.reject_reason]


def test_ends_of_stretches_need_no_sort(spark):
    places = "source_file string, block long, seq long, pos int"
    records = spark.createDataFrame([("a", 0, i, 0) for i in range(9)], places)
    spans = spark.sql("""SELECT 'a' AS source_file, struct(0L AS block, 3L AS seq, 0 AS pos) AS from_at,
        CAST(NULL AS struct<block: bigint, seq: bigint, pos: int>) AS to_at, 1L AS file_sequence_number, 2L AS record_count,
        'x' AS extract_time""")
    joined = attach_headers(records, spans, broadcast=False)
    assert "SortAggregate" not in joined._jdf.queryExecution().executedPlan().toString()
    assert {r.seq: r.file_sequence_number for r in joined.collect()} == {i: 1 if i >= 3 else None for i in range(9)}
