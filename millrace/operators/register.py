"""Register XML text -> one flat row per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import empty_to_null, extract_time, iso_date, safe_text
from ..schemas import CORRUPT, REGISTER_FLAT, REGISTER_HEADER, REGISTER_RECORD
from ..session import fits_broadcast
from ..sources.register import RECORD_END

REGISTER_COLUMNS = REGISTER_FLAT.fieldNames()
HEADER_FIELDS = ["FileSequenceNumber", "RecordCount", "ExtractTime"]
PLACE = ["source_file", "block", "seq", "pos"]
# Chunks of a file that meet its headers in one task when these are too many to broadcast.
STRETCH = 50_000

_RECORD_START = r"<ABR[\s/>]"
_SELF_CLOSED = r"^(<ABR(?:\s[^>]*)?/>)"
_CLOSED = r"(?s)^(.*</ABR\s*>)"
_HEADER = r"(?s)<TransferInfo[\s>].*?</TransferInfo\s*>"
_OTHER_ENTITY = r"(?s)<OtherEntity(?:\s[^>]*?)?(?:/>|>.*?</OtherEntity\s*>)"
_XML = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "ignoreSurroundingSpaces": "false"}


def _first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def _headers(text: Column) -> Column:
    found = F.array_join(F.regexp_extract_all(text, F.lit(_HEADER), F.lit(0)), "")
    return F.when(text.contains("<TransferInfo"), empty_to_null(found))


def register_events(chunks: DataFrame) -> DataFrame:
    """One row per record or header-bearing stretch of text, in document order of (block, seq, pos).

    Nearly every chunk is one whole record once its start is found; plain string functions cut it out. Chunks
    with headers, comments, several starts, self-closed records or loosely written end tags are split by pattern.
    Rows that stand for unreadable input (``reject_reason`` of the chunk) are passed on.
    """
    reason = F.col("reject_reason") if "reject_reason" in chunks.columns else F.lit(None).cast("string")
    closed = F.col("closed") if "closed" in chunks.columns else F.lit(True)
    value, piece, pos = F.col("value"), F.col("piece"), F.col("pos")
    starts = F.octet_length(value) - F.octet_length(F.replace(value, F.lit("<ABR"), F.lit("")))
    after = F.substring_index(value, "<ABR", -1)
    tag = F.substring_index(after, ">", 1)
    opened = ((tag == "") | F.substring(tag, 1, 1).isin(" ", "\t", "\n", "\r")) & ~tag.endswith("/")
    odd = value.contains("<TransferInfo") | value.contains("</ABR") | value.contains("<!--")
    whole = (starts == 4) & opened & ~odd & closed & reason.isNull()
    bare = F.when(value.contains("<!--"), F.regexp_replace(value, "(?s)<!--.*?-->", "")).otherwise(value)
    pieces = (
        F.when(F.col("whole"), F.array(F.concat(F.lit("<ABR"), after, F.lit(RECORD_END))))
        .when(F.col("unreadable").isNotNull(), F.array(F.coalesce(value, F.lit(""))))
        .otherwise(F.split(bare, f"(?={_RECORD_START})"))
    )
    found = chunks.where((starts > 0) | odd | reason.isNotNull()).select(
        "source_file", "block", "seq", "value", whole.alias("whole"), closed.alias("closed"), reason.alias("unreadable")
    )
    found = found.select("source_file", "block", "seq", "whole", "closed", "unreadable", pieces.alias("pieces"))
    # The outer form adds no filter on the size, which would make the array twice.
    split = found.select(
        "source_file", "block", "seq", "whole", "closed", "unreadable", F.size("pieces").alias("n"),
        F.posexplode_outer("pieces").alias("pos", "piece"),
    )
    # The reader took the end tag off the last piece of a closed chunk; an earlier piece must bring its own.
    record = (
        F.when(piece.rlike(_SELF_CLOSED), F.regexp_extract(piece, _SELF_CLOSED, 1))
        .when(piece.contains("</ABR"), F.regexp_extract(piece, _CLOSED, 1))
        .when((pos == F.col("n") - 1) & F.col("closed"), F.concat(piece, F.lit(RECORD_END)))
        .otherwise(piece)
    )
    readable = F.col("unreadable").isNull()
    return split.select(
        *PLACE,
        F.when(F.col("whole"), piece).when(readable & piece.rlike(f"^{_RECORD_START}"), record).alias("xml"),
        F.when(~F.col("whole") & readable, _headers(piece)).alias("header_xml"),
        "unreadable",
        F.when(~readable, F.nullif(piece, F.lit(""))).alias("shown"),
    ).where(F.coalesce("xml", "header_xml", "unreadable").isNotNull())


def _label(kind: Column, text: Column) -> Column:
    """``type:text`` or ``text``; NULL without a text."""
    return F.when(F.length(kind) > 0, F.concat(kind, F.lit(":"), text)).otherwise(text)


def other_entities(others: Column) -> Column:
    """First name of each other entity, in order, joined by ``; ``; no shuffle, all inside the row's array."""

    def label(other: Column) -> Column:
        name = _first(other["NonIndividualName"])
        return _label(name["_type"], safe_text(_first(name["NonIndividualNameText"])))

    return empty_to_null(F.array_join(F.transform(others, label), "; "))


def _deep_other_entities(xml: Column) -> Column:
    """The same for names nested deeper: each other entity is searched in document order."""
    first = "(/OtherEntity//NonIndividualName)[1]"

    def label(other: Column) -> Column:
        text = safe_text(F.xpath_string(other, F.lit(f"{first}/NonIndividualNameText")))
        return _label(_first(F.xpath(other, F.lit(f"{first}/@type"))), text)

    found = F.regexp_extract_all(xml, F.lit(_OTHER_ENTITY), F.lit(0))
    return empty_to_null(F.array_join(F.transform(found, label), "; "))


def project_register(events: DataFrame) -> DataFrame:
    """Parse each record once and project it to the seventeen record columns; malformed records are rejects.

    Names and addresses are looked up at any depth. Records whose main and other entities hold only the
    declared children take them from the parsed struct; the rest (``xs_any`` is set) are searched by XPath.
    """
    head = F.when(
        F.col("header_xml").isNotNull(),
        F.from_xml(F.concat(F.lit("<h>"), "header_xml", F.lit("</h>")), REGISTER_HEADER, _XML),
    )
    record = F.from_xml("xml", REGISTER_RECORD, _XML)
    # Bytes that are no UTF-8 would be parsed with other characters in their place.
    foreign = F.col("xml").isNotNull() & ~F.is_valid_utf8("xml")
    events = events.withColumns({
        "unreadable": F.when(foreign, "record is not utf-8").otherwise(F.col("unreadable")),
        "shown": F.when(foreign, F.make_valid_utf8("xml")).otherwise(F.col("shown")),
        "xml": F.when(~foreign, F.col("xml")),
    })
    parsed = events.select(*PLACE, "xml", "unreadable", "shown", record.alias("rec"), head.alias("head"))
    rec, xml = F.col("rec"), F.col("xml")
    abn, entity, main = _first(rec["ABN"]), _first(rec["EntityType"]), _first(rec["MainEntity"])
    asic, gst, others = _first(rec["ASICNumber"]), _first(rec["GST"]), rec["OtherEntity"]

    business, name = main["BusinessAddress"], _first(main["NonIndividualName"])
    details = F.filter(business["AddressDetails"], lambda a: a.isNotNull())
    address = F.when(F.size(business) == 1, _first(_first(business)["AddressDetails"])).otherwise(_first(F.flatten(details)))
    deep_main = main["xs_any"].isNotNull() | F.coalesce(
        F.when(F.size(business) == 1, _first(business)["xs_any"].isNotNull()).otherwise(
            F.exists(business, lambda b: b["xs_any"].isNotNull())
        ),
        F.lit(False),
    )
    deep_others = F.coalesce(F.exists(others, lambda o: o["xs_any"].isNotNull()), F.lit(False))
    found_name = "(/ABR/MainEntity[1]//NonIndividualName)[1]"
    found_address = "(/ABR/MainEntity[1]//BusinessAddress/AddressDetails)[1]"

    def searched(path: str, plain: Column) -> Column:
        return safe_text(F.when(deep_main, F.xpath_string(xml, F.lit(path))).otherwise(plain))

    columns = {
        "record_last_updated_date": iso_date(rec["_recordLastUpdatedDate"]),
        "replaced": rec["_replaced"],
        "abn": safe_text(abn["_VALUE"]),
        "abn_status": abn["_status"],
        "abn_status_from_date": iso_date(abn["_ABNStatusFromDate"]),
        "entity_type_ind": safe_text(_first(entity["EntityTypeInd"])),
        "entity_type_text": safe_text(_first(entity["EntityTypeText"])),
        "mainentity_name_type": F.when(deep_main, _first(F.xpath(xml, F.lit(f"{found_name}/@type")))).otherwise(
            name["_type"]
        ),
        "mainentity_name_text": searched(f"{found_name}/NonIndividualNameText", _first(name["NonIndividualNameText"])),
        "businessaddress_state": searched(f"{found_address}/State", _first(address["State"])),
        "businessaddress_postcode": searched(f"{found_address}/Postcode", _first(address["Postcode"])),
        "asicnumber": safe_text(asic["_VALUE"]),
        "asicnumber_type": asic["_ASICNumberType"],
        "gst_status": gst["_status"],
        "gst_status_from_date": iso_date(gst["_GSTStatusFromDate"]),
        "other_entities": F.when(deep_others, _deep_other_entities(xml)).otherwise(other_entities(others)),
    }
    broken = rec[CORRUPT].isNotNull()

    def last_given(field: str) -> Column:
        """Last element of that name as a one-item array; NULL when no header here has it."""
        given = F.filter(F.transform(F.col("head.TransferInfo"), lambda h: h[field]), lambda a: F.size(a) > 0)
        return F.when(F.size(given) > 0, F.slice(F.flatten(given), -1, 1))

    return parsed.select(
        *PLACE,
        (xml.isNotNull() | F.col("unreadable").isNotNull()).alias("is_record"),
        *(value.alias(name) for name, value in columns.items()),
        F.when(F.col("head").isNotNull(), F.struct(*(last_given(f).alias(f) for f in HEADER_FIELDS))).alias("header"),
        F.coalesce("unreadable", F.when(broken, F.lit("malformed xml"))).alias("reject_reason"),
        F.coalesce("shown", F.when(broken, rec[CORRUPT])).alias("raw"),
    )


def split_heads(projected: DataFrame) -> DataFrame:
    """The same rows with those that bring a header once more, told apart by ``is_head``: staged by it, the few headers are a
    table of their own, and the records are read once."""
    roles = F.array_compact(F.array(F.when(F.col("is_record"), False), F.when(F.col("header").isNotNull(), True)))
    return projected.withColumn("is_head", F.explode(roles))


def _records(projected: DataFrame) -> DataFrame:
    kept = projected.where("NOT is_head").drop("is_head") if "is_head" in projected.columns else projected
    return kept.where("is_record").drop("header", "is_record")


def header_spans(projected: DataFrame) -> DataFrame:
    """Header values and the stretch of the document they hold for.

    A later header replaces only the fields it brings. There are few headers per file, so the window is small.
    """
    at = F.struct("block", "seq", "pos")
    order = Window.partitionBy("source_file").orderBy("at")
    if "is_head" in projected.columns:
        projected = projected.where("is_head")
    heads = projected.where(F.col("header").isNotNull()).select("source_file", at.alias("at"), "header.*")

    def current(field: str) -> Column:
        return safe_text(_first(F.last(F.col(field), ignorenulls=True).over(order)))

    texts = heads.select(
        "source_file", F.col("at").alias("from_at"), F.lead("at").over(order).alias("to_at"),
        *(current(field).alias(field) for field in HEADER_FIELDS),
    )
    whole = {"FileSequenceNumber": "file_sequence_number", "RecordCount": "record_count"}
    numbers = {name: F.when(F.col(f).rlike("^[+-]?[0-9]+$"), F.col(f).try_cast("bigint")) for f, name in whole.items()}
    wrong = [F.when(F.col(f).isNotNull() & numbers[name].isNull(), F.lit(f"{f} is no integer")) for f, name in whole.items()]
    return texts.select(
        "source_file", "from_at", "to_at",
        *(value.alias(name) for name, value in numbers.items()),
        extract_time(F.col("ExtractTime")).alias("extract_time"),
        F.coalesce(*wrong).alias("reject_reason"),
        F.concat_ws(",", *HEADER_FIELDS).alias("raw"),
    )


def attach_headers(records: DataFrame, spans: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Give each record the header values in force at its place; NULLs before the first header of a file.

    The header table is broadcast when its counted size allows. Otherwise the file is taken in stretches of ``STRETCH``
    chunks: each gets the spans that reach into it, and meets them by (file, stretch), so that neither a huge file nor one
    with very many headers is a hot key.
    """
    if broadcast is None:
        broadcast = fits_broadcast(spans)
    heads = spans.select(
        F.col("source_file").alias("h_file"), "from_at", "to_at", "file_sequence_number", "record_count", "extract_time"
    )
    at, same_file = F.struct("block", "seq", "pos"), F.col("source_file") == F.col("h_file")
    inside = (at >= F.col("from_at")) & (F.col("to_at").isNull() | (at < F.col("to_at")))
    if broadcast:
        return records.join(F.broadcast(heads), same_file & inside, "left").drop("h_file", "from_at", "to_at")
    records = records.withColumn("stretch", F.floor(F.col("seq") / STRETCH))
    # A stretch is bounded by its number: its records are neither sorted nor compared to find its ends.
    stretches = records.select("source_file", "block", "stretch").distinct()
    first, least = F.col("stretch") * STRETCH, F.lit(-(1 << 31))
    lowest = F.struct(F.col("block"), first.alias("seq"), least.alias("pos"))
    beyond = F.struct(F.col("block"), (first + STRETCH).alias("seq"), least.alias("pos"))
    reaches = (F.col("from_at") < beyond) & (F.col("to_at").isNull() | (F.col("to_at") > lowest))
    reaching = stretches.join(heads, same_file & reaches).drop("source_file")
    reaching = reaching.withColumnsRenamed({"block": "h_block", "stretch": "h_stretch"})
    same = same_file & (F.col("block") == F.col("h_block")) & (F.col("stretch") == F.col("h_stretch"))
    return records.join(reaching, same & inside, "left").drop("h_file", "from_at", "to_at", "stretch", "h_block", "h_stretch")


def flatten_register(projected: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Nineteen columns per record, plus source_file and the reject columns.

    ``projected`` feeds both sides of the header join: pass a table staged by ``split_heads`` so that the text is read once.
    """
    joined = attach_headers(_records(projected), header_spans(projected), broadcast)
    return joined.select(*REGISTER_COLUMNS, "source_file", "reject_reason", "raw")


def header_rejects(projected: DataFrame) -> DataFrame:
    """Headers whose numbers are none."""
    spans = header_spans(projected)
    return spans.where(F.col("reject_reason").isNotNull()).select("source_file", "reject_reason", "raw")
