"""Pack index lines into raw page rows: a Parquet file, gzipped, as one binary value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import PAGE_KEYS

# Lines of one blob. An index page has at most 15,000.
BLOB_ROWS = 50_000
_PACKED = "id long, file_name string, part long, nth long, file_data binary, file_size long"


def _packer(keys: list[str], max_rows: int):
    """Task body: runs of lines of the same (page, part) -> one row per run, at most ``max_rows`` lines each."""

    def pack(batches):
        import gzip
        import io

        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq

        schema = pa.schema([
            ("id", pa.int64()), ("file_name", pa.string()), ("part", pa.int64()), ("nth", pa.int64()),
            ("file_data", pa.binary()), ("file_size", pa.int64()),
        ])

        def blob(mark, nth, rows):
            raw_id, name, part = mark
            buffer = io.BytesIO()
            pq.write_table(pa.Table.from_batches(rows), buffer, compression="snappy")
            data = buffer.getvalue()
            if name.endswith(".gz"):
                data = gzip.compress(data, mtime=0)
            values = [[raw_id], [name], [part], [nth], [data], [len(data)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

        mark, nth, rows, size = None, 0, [], 0
        for batch in batches:
            ids, parts = batch.column("raw_id").to_numpy(), batch.column("part").to_numpy()
            lines = batch.select(keys)
            changes = np.flatnonzero((ids[1:] != ids[:-1]) | (parts[1:] != parts[:-1])) + 1
            cuts = [0, *changes.tolist(), len(ids)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                run = (int(ids[start]), batch.column("file_name")[start].as_py(), int(parts[start]))
                if run != mark:
                    if rows:
                        yield blob(mark, nth, rows)
                    mark, nth, rows, size = run, 0, [], 0
                while start < end:
                    take = min(max_rows - size, end - start)
                    rows.append(lines.slice(start, take))
                    start, size = start + take, size + take
                    if size == max_rows:
                        yield blob(mark, nth, rows)
                        nth, rows, size = nth + 1, [], 0
        if rows:
            yield blob(mark, nth, rows)

    return pack


def pack_blobs(
    lines: DataFrame, file_name: Column, uploaded_at: Column, max_rows: int = BLOB_ROWS, clustered: bool = True
) -> DataFrame:
    """Raw page rows from index lines (raw_id, part and the text keys).

    Works on runs of lines as the page reader delivers them: a page file is read in order by one task, or by
    one task per file split (``part``), so nothing is shuffled and no page is gathered into a group. A page
    beyond ``max_rows`` lines or one split becomes several blobs, all with the page's own id and name and told
    apart by (part, nth); no line is lost. Lines that were shuffled since they were read need
    ``clustered=False``: they are sorted by (page, part) again.
    """
    if not clustered:
        lines = lines.repartition("raw_id", "part").sortWithinPartitions("raw_id", "part")
    named = lines.select("raw_id", file_name.alias("file_name"), "part", *(F.col(f"`{key}`") for key in PAGE_KEYS))
    return named.mapInArrow(_packer(PAGE_KEYS, max_rows), _PACKED).select(
        "id", "file_name", "file_data", "file_size", uploaded_at.cast("timestamp_ntz").alias("uploaded_at"), "part", "nth"
    )
