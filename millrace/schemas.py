"""Column contracts of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


CORRUPT = "_corrupt_record"

# Key names of the index-page JSON lines.
PAGE_KEYS = ["urlkey", "timestamp", "url", "mime", "mime-detected", "status", "digest", "length", "offset", "filename"]

PAGE_LINE = T.StructType(_strings(*PAGE_KEYS, CORRUPT))

# Key names of the crawl catalog and the columns they map to.
CATALOG_ALIASES = {"cdx-api": "cdx_api", "from": "crawl_start", "to": "crawl_end"}

CATALOG_ENTRY = T.StructType(_strings("id", "name", "timegate", "cdx-api", "from", "to"))

CATALOG_COLUMNS = ["id", "name", "timegate", "cdx_api", "crawl_start", "crawl_end", "created_at"]

RAW_PAGES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_data", T.BinaryType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("uploaded_at", T.TimestampNTZType()),
])

BOOKMARKS = T.StructType([
    T.StructField("cc_index", T.StringType()),
    T.StructField("bookmark", T.LongType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("last_updated", T.TimestampNTZType()),
])

# The eleven columns of the cleaned index records, in order.
INDEX_RECORDS = T.StructType([
    T.StructField("raw_id", T.LongType()),
    *_strings("source_file", "urlkey"),
    T.StructField("crawl_timestamp", T.TimestampNTZType()),
    T.StructField("status", T.LongType()),
    *_strings("url", "filename"),
    T.StructField("length", T.LongType()),
    *_strings("mime"),
    T.StructField("file_offset", T.LongType()),
    *_strings("digest"),
])

# The nineteen columns of the flattened register, in order.
REGISTER_FLAT = T.StructType([
    T.StructField("file_sequence_number", T.LongType()),
    T.StructField("record_count", T.LongType()),
    *_strings(
        "extract_time", "record_last_updated_date", "replaced", "abn", "abn_status", "abn_status_from_date",
        "entity_type_ind", "entity_type_text", "mainentity_name_type", "mainentity_name_text",
        "businessaddress_state", "businessaddress_postcode", "asicnumber", "asicnumber_type",
        "gst_status", "gst_status_from_date", "other_entities",
    ),
])

# Element names of one register record. Everything that may repeat is an array, so that the
# first occurrence can be taken; ``xs_any`` collects children that are not declared.
_NAME = "array<struct<_type:string,NonIndividualNameText:array<string>>>"
REGISTER_RECORD = (
    "_recordLastUpdatedDate string, _replaced string, "
    "ABN array<struct<_VALUE:string,_status:string,_ABNStatusFromDate:string>>, "
    "EntityType array<struct<EntityTypeInd:array<string>,EntityTypeText:array<string>>>, "
    f"MainEntity array<struct<NonIndividualName:{_NAME},"
    "BusinessAddress:array<struct<AddressDetails:array<struct<State:array<string>,Postcode:array<string>>>,"
    "xs_any:array<string>>>,xs_any:array<string>>>, "
    "ASICNumber array<struct<_VALUE:string,_ASICNumberType:string>>, "
    "GST array<struct<_status:string,_GSTStatusFromDate:string>>, "
    f"OtherEntity array<struct<NonIndividualName:{_NAME},xs_any:array<string>>>, "
    f"{CORRUPT} string"
)

REGISTER_HEADER = (
    "TransferInfo array<struct<FileSequenceNumber:array<string>,RecordCount:array<string>,ExtractTime:array<string>>>"
)
