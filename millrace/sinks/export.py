"""CSV hand-off and relational sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header line, quotes doubled, NULL as an empty unquoted field, empty text as "", spaces kept.
_CSV = {
    "header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
# Fixed value: rows per bulk batch.
BATCH_ROWS = 8000


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """``compression`` by gzip makes files a fifth to a tenth as large; files are read whole by a task in any case, as fields may
    have line breaks."""
    df.write.mode("errorifexists").options(**_CSV, compression=compression).csv(path)


# Stands for quoted empty text while reading: Spark takes an empty field and "" for the same otherwise.
_EMPTY = "\ue000"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read the hand-off back; quoted line breaks inside fields are kept together."""
    rows = spark.read.schema(schema).options(**{**_CSV, "emptyValue": _EMPTY, "multiLine": True}).csv(path)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return rows.withColumns({t: F.when(F.col(t) == _EMPTY, "").otherwise(F.col(t)) for t in texts})


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_rows: int = BATCH_ROWS) -> None:
    """Append to a relational table, ``batch_rows`` per round trip; the driver jar must be on the class path."""
    df.write.mode("append").option("batchsize", batch_rows).jdbc(url, table, properties=properties)
