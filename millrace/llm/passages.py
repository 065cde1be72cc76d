"""Bytes of passages that also stand in a document with a smaller id, by a prefix-free parse and its suffix arrays.

*Parse.* A rolling hash over ``trigger`` bytes makes triggers of a text: every string of ``length`` bytes has one, the place
in it with the least hash (ties: the first), so equal strings have it at the same place. Cut at its triggers a text is a
parse of phrases. The strings that share a trigger start in the phrase before it: one is a suffix of that phrase, ``ahead``
bytes up to the trigger, and goes on with the text from the trigger, the phrases after it. Suffixes of one ``ahead`` with
their trigger have one length, so none is a prefix of another.

*Corpus order.* Where triggers meet, the different phrases are the dictionary: its suffix array is the order of the bytes read
backwards from the triggers; the order of what follows the triggers is the suffix array of the parse. For each ``ahead`` the
pair of ranks puts the strings into order, equal ones side by side by exact comparison, and the least id of each is known.

*Spark.* 1. Fingerprints of triggers go to buckets; those of more than one document come back to their documents (a filter: a
collision only adds candidates). 2. Phrases at such triggers go, with ``length`` bytes after the trigger, to the bucket of the
trigger; of phrases that stand repeatedly in one piece of some MB only the first document's goes on. 3. Each bucket makes its
order and gives back byte ranges. Triggers that many pieces have are split further, by single strings of ``length`` bytes.
Nothing but these is shuffled, besides the documents once by id to meet their fingerprints, and once more to meet their
ranges if these are too large to be broadcast.

Nulls and odd input: a null or empty text has no bytes; a document without an id neither loses bytes nor takes any; rows of
one id take no bytes from each other, whether they are equal or not; further columns of any name do not matter; an empty
table gives an empty one. Texts are cut into overlapping stretches in memory, so one may be very long.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .text import name, pieces, ragged

LENGTH, TRIGGER = 50, 20
# Pieces with one trigger from which its strings are dealt out one by one (a matter of memory, not of results).
CROWD = 2_000
# Bytes of text that share a bucket of fingerprints, of documents, of phrases; bytes of ranges that are broadcast.
_FINGERPRINTS, _DOCUMENTS, _PHRASES, _BROADCAST = 128 << 20, 32 << 20, 8 << 20, 64 << 20
# Phrases that a task remembers, so as to hand on the first document's only (a matter of memory, not of results).
_REMEMBERED = 200_000
# Bytes hashed at once, and documents of a piece.
_STRETCH, _ROWS = 1 << 20, 1 << 16
_BASE, _MIX, _WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` bytes, put together from hashes of 1, 2, 4, ... bytes."""
    part, power, size = data.astype(np.uint64) + np.uint64(11), _BASE, 1
    hashes, done = None, 0
    while True:
        if width & size:  # hash of the first ``done`` bytes, then of the next ``size``
            if hashes is None:
                hashes = part
            else:
                n = len(data) - done - size + 1
                hashes = hashes[:n] * np.uint64(power) + part[done : done + n]
            done += size
        if 2 * size > width:
            break
        part = part[:-size] * np.uint64(power) + part[size:]
        power, size = power * power & _WORD, 2 * size
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(_MIX)
    return hashes ^ (hashes >> np.uint64(29))


def _least_places(hashes: np.ndarray, span: int) -> np.ndarray:
    """Place of the least of every ``span`` hashes, by their upper 28 bits, the first if equal."""
    least = (hashes >> np.uint64(36) << np.uint64(36)) | np.arange(len(hashes), dtype=np.uint64)
    n, size = len(hashes) - span + 1, 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return (np.minimum(least[:n], least[span - size : span - size + n]) & np.uint64((1 << 36) - 1)).astype(np.int64)


class Phrases:
    """Triggers of some texts: document, trigger place, first and last start of the strings that have it, hash. Places count
    from the start of the text; ``data[shift + place]`` is the byte there."""

    def __init__(self, stretches: list[tuple[int, int, bytes]], length: int, trigger: int):
        size = np.array([len(s[2]) for s in stretches], np.int64)
        bounds = np.cumsum(size) - size
        self.bytes = b"".join(s[2] for s in stretches)
        hashes = rolling_hashes(np.frombuffer(self.bytes, np.uint8), trigger)
        starts = ragged(bounds, np.maximum(size - length + 1, 0))
        place = _least_places(hashes, length - trigger + 1)[starts]
        heads = np.flatnonzero(np.diff(place, prepend=-1))
        self.at, self.first = place[heads], starts[heads]
        self.last = starts[np.append(heads[1:], len(starts)) - 1] if len(heads) else starts
        self.hash = hashes[self.at]
        own = np.searchsorted(bounds, self.first, "right") - 1
        self.doc = np.array([s[0] for s in stretches], np.int64)[own]
        self.shift = bounds[own] - np.array([s[1] for s in stretches], np.int64)[own]

    def fingerprint(self) -> np.ndarray:
        return (self.hash >> np.uint64(16)).astype(np.int64)


def phrases_of(texts: list[bytes], length: int, trigger: int):
    """``Phrases`` of texts, in stretches of bounded size that overlap by ``length`` - 1 bytes."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, _STRETCH):
            stretch = text[start : start + _STRETCH + length - 1]
            held.append((i, start, stretch))
            size += len(stretch)
            if size >= _STRETCH:
                yield Phrases(held, length, trigger)
                held, size = [], 0
    if held:
        yield Phrases(held, length, trigger)


def _cut_rows(batches):
    for batch in batches:
        for piece in pieces(batch, "text"):
            for start in range(0, piece.num_rows, _ROWS):
                part = piece.slice(start, _ROWS)
                ids, marks = part.column("doc_id").to_numpy(), part.column("mark").to_numpy()
                yield part, ids, marks, part.column("text").to_pylist()


def _blobs(key: np.ndarray, *columns: np.ndarray):
    """Rows (key, bytes of each column): the columns cut by key."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.diff(key, prepend=-1))
    ends = np.append(heads[1:], len(key))
    columns = [c[order] for c in columns]
    return key[heads], [[c[a:b].tobytes() for a, b in zip(heads, ends)] for c in columns]


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(data, asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def _join(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), kind)


_TRIGGERS = "bucket int, ids binary, marks binary, who binary, high binary, low binary"
_SEEN = "dest int, ids binary, marks binary, prints binary, crowded binary"


def _emit_triggers(length: int, trigger: int, buckets: int):
    def run(batches):
        for _, ids, marks, texts in _cut_rows(batches):
            pairs = [np.empty((0, 3), np.int64)]
            for p in phrases_of(texts, length, trigger):
                pairs.append(np.stack([(p.hash & np.uint64(0xFFFFFF)).astype(np.int64) % buckets, p.fingerprint(), p.doc], 1))
            pairs = np.concatenate(pairs)
            pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 1], pairs[:, 0]))]
            pairs = pairs[np.any(np.diff(pairs, axis=0, prepend=-1), 1)]
            cut = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))
            rows = []
            for a, b in zip(cut, [*cut[1:], len(pairs)]):
                docs, who = np.unique(pairs[a:b, 2], return_inverse=True)
                print_ = pairs[a:b, 1]
                rows.append((
                    int(pairs[a, 0]), ids[docs].astype(np.int64).tobytes(), marks[docs].astype(np.int32).tobytes(),
                    who.astype(np.uint16).tobytes(), (print_ >> 16).astype(np.uint32).tobytes(), print_.astype(np.uint16).tobytes(),
                ))
            types = [pa.int32(), *[pa.binary()] * 5]
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "ids", "marks", "who", "high", "low"]
            )

    return run


def _seen_twice(dests: int, crowd: int):
    """Fingerprints of more than one document, back to the places of their documents."""

    def run(table: pa.Table) -> pa.Table:
        sizes = [len(x) // 2 for x in table.column("who").to_pylist()]
        docs = [len(x) // 8 for x in table.column("ids").to_pylist()]
        shift = np.repeat(np.cumsum(docs) - docs, sizes)
        ids, marks = _join(table.column("ids"), np.int64), _join(table.column("marks"), np.int32)
        who = _join(table.column("who"), np.uint16) + shift
        prints = _join(table.column("high"), np.uint32).astype(np.int64) << 16 | _join(table.column("low"), np.uint16)
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((row, prints))
        prints, who, row = prints[order], who[order], row[order]
        first = np.diff(prints, prepend=-1) != 0
        heads = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        low, high = np.minimum.reduceat(ids[who], heads), np.maximum.reduceat(ids[who], heads)
        in_pieces = np.add.reduceat(first | (np.diff(row, prepend=-1) != 0), heads, dtype=np.int64)
        keep = (low < high)[group]
        who, prints, crowded = who[keep], prints[keep], (in_pieces >= crowd)[group][keep]
        order = np.lexsort((who,))
        who, prints, crowded = who[order], prints[order], crowded[order]
        dest, columns = _blobs((marks[who] & 0x7FFFFFFF) % dests, ids[who], marks[who], prints, crowded)
        return pa.table([pa.array(dest, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], _SEEN_NAMES)

    return run


_SEEN_NAMES = ["dest", "ids", "marks", "prints", "crowded"]


def _per_document(table: pa.Table) -> pa.Table:
    ids, marks = _join(table.column("ids"), np.int64), _join(table.column("marks"), np.int32)
    prints, crowded = _join(table.column("prints"), np.int64), _join(table.column("crowded"), np.bool_)
    order = np.lexsort((prints, marks, ids))
    ids, marks, prints, crowded = ids[order], marks[order], prints[order], crowded[order]
    heads = np.flatnonzero((np.diff(ids, prepend=0) != 0) | (np.diff(marks, prepend=0) != 0) | (np.arange(len(ids)) == 0))
    ends = np.append(heads[1:], len(ids))
    return pa.table([
        pa.array(ids[heads]), pa.array(marks[heads]),
        pa.array([prints[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
        pa.array([crowded[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
    ], ["doc_id", "mark", "prints", "crowded"])


_PHRASE_ROWS = ["bucket", "ids", "marks", "first", "ahead", "strings", "content", "known"]
_PHRASE_TYPES = "bucket int, ids binary, marks binary, first binary, ahead binary, strings binary, content binary, known binary"
# A byte range of a document: strings that start at first, first + 1, ..., n of them.
_RANGE = np.dtype([("doc_id", np.int64), ("mark", np.int32), ("first", np.int64), ("n", np.int64)])


def _emit_phrases(length: int, trigger: int, buckets: int):
    """Phrases at triggers that other documents have, the first document's of each piece; ranges of the others, which are
    known to stand there."""

    def run(batches):
        own = {}
        for part, ids, marks, texts in _cut_rows(batches):
            n = [len(x.as_buffer()) // 8 for x in part.column("prints")]
            seen = np.repeat(np.arange(len(n)), n) << 48 | _join(part.column("prints"), np.int64)
            crowded = _join(part.column("crowded"), np.bool_)
            rows, known = [], []
            if len(own) > _REMEMBERED:
                own.clear()
            by_id = np.argsort(ids, kind="stable")  # the smallest id of the piece comes first
            repeated = {}
            for i in by_id:
                repeated.setdefault((ids[i], marks[i]), i)
            order = [i for i in by_id if repeated[ids[i], marks[i]] == i]
            for p in phrases_of([texts[i] for i in order], length, trigger):
                doc = np.array(order, np.int64)[p.doc]
                key = doc << 48 | p.fingerprint()
                at = np.minimum(np.searchsorted(seen, key), len(seen) - 1) if len(seen) else np.zeros(len(key), np.int64)
                hits = np.flatnonzero(seen[at] == key) if len(seen) else []
                for k, many in zip(hits, crowded[at[hits]] if len(seen) else []):
                    first, last, i, shift = int(p.first[k]), int(p.last[k]), int(doc[k]), int(p.shift[k])
                    cuts = range(first, last + 1) if many else (first,)
                    for start in cuts:
                        end = start if many else last
                        ahead = 0 if many else int(p.at[k]) - first
                        content = p.bytes[start : end + length]
                        owner = own.setdefault((content, ahead), ids[i])
                        if owner < ids[i]:
                            known.append((ids[i], marks[i], start - shift, end - start + 1))
                        else:
                            own[content, ahead] = ids[i]
                            bucket = zlib.crc32(content) if many else int(p.hash[k])
                            rows.append((bucket % buckets, ids[i], marks[i], start - shift, ahead, end - start + 1, content))
            out = {}
            for row in rows:
                out.setdefault(row[0], []).append(row[1:])
            ranges = merged(np.array(known, _RANGE)).tobytes()
            if ranges and not out:
                out[int(ids[0]) % buckets] = []
            columns = []
            for bucket, found in out.items():
                found.sort(key=lambda r: r[5])  # like beside like: the bytes are packed
                c = list(zip(*found)) or [[]] * 6
                columns.append((
                    bucket, np.array(c[0], np.int64).tobytes(), np.array(c[1], np.int32).tobytes(), np.array(c[2], np.int64).tobytes(),
                    np.array(c[3], np.uint16).tobytes(), np.array(c[4], np.uint16).tobytes(), _packed(b"".join(c[5])), ranges,
                ))
                ranges = b""
            columns = list(zip(*columns)) or [[]] * 8
            types = [pa.int32(), *[pa.binary()] * 7]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _PHRASE_ROWS)

    return run


def merged(ranges: np.ndarray) -> np.ndarray:
    """The ranges in order, those that touch made one."""
    if not len(ranges):
        return ranges
    ranges = ranges[np.lexsort((ranges["first"], ranges["mark"], ranges["doc_id"]))]
    new = np.ones(len(ranges), bool)
    end = ranges["first"] + ranges["n"]
    same = (ranges["doc_id"][1:] == ranges["doc_id"][:-1]) & (ranges["mark"][1:] == ranges["mark"][:-1])
    new[1:] = ~same | (ranges["first"][1:] > end[:-1])
    heads = np.flatnonzero(new)
    out = ranges[heads].copy()
    out["n"] = np.maximum.reduceat(end, heads) - out["first"]
    return out


def _sorted_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the byte rows of a matrix, and how many bytes each row shares with the one before it."""
    n, width = matrix.shape
    packed = np.zeros((n, -(-max(width, 1) // 8) * 8), np.uint8)
    packed[:, :width] = matrix
    order = np.lexsort(packed.view(">u8").astype(np.uint64).T[::-1])
    rows = matrix[order]
    differs = np.ones((n, width + 1), bool)
    differs[1:, :width] = rows[1:] != rows[:-1]
    shared = differs.argmax(1)
    shared[0] = 0
    return order, shared


def earlier_elsewhere(
    ids: np.ndarray, ahead: np.ndarray, strings: np.ndarray, content: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases are in order of ``ids``; phrase k has ``ahead[k]`` bytes before its trigger and stands for ``strings[k]``
    strings, whose bytes lie end to end in ``content``. Returns the runs (phrase, first string, number) of the strings that a
    phrase of a smaller id has as well."""
    n = len(ids)
    size = strings + length - 1
    start = np.cumsum(size) - size
    trigger = start + ahead
    padded = np.append(content, np.zeros(1, np.uint8))
    back, on = np.arange(max(int(ahead.max(initial=0)), 1)), np.arange(length)
    # The dictionary's suffixes, read backwards from the triggers, and what the parse goes on with.
    cells = trigger[:, None] - 1 - back
    suffix_order, suffix_shared = _sorted_rows(padded[np.where(back < ahead[:, None], cells, len(content))])
    cells = trigger[:, None] + on
    parse_order, parse_shared = _sorted_rows(padded[np.where(cells < (start + size)[:, None], cells, len(content))])
    found = np.zeros((n, int(strings.max(initial=0)) + 2), bool)  # by place, after an empty column and before another
    suffix_rank, parse_rank = np.empty(n, np.int64), np.empty(n, np.int64)
    for depth in range(int(ahead.max(initial=0)) + 1):
        mine = np.flatnonzero((ahead - strings < depth) & (depth <= ahead))
        suffix_rank[suffix_order] = np.cumsum(suffix_shared < depth)
        parse_rank[parse_order] = np.cumsum(parse_shared < length - depth)
        key = suffix_rank[mine] * (n + 1) + parse_rank[mine]
        order = np.argsort(key, kind="stable")
        key, mine = key[order], mine[order]
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        least = np.repeat(ids[mine[heads]], np.diff(heads, append=len(mine)))
        hit = mine[ids[mine] > least]
        found[hit, ahead[hit] - depth + 1] = True
    phrase, first = np.nonzero(found[:, 1:] & ~found[:, :-1])
    last = np.nonzero(found[:, :-1] & ~found[:, 1:])[1]
    return phrase, first, last - first


def _resolve(length: int, dests: int):
    def run(table: pa.Table) -> pa.Table:
        ids, marks = _join(table.column("ids"), np.int64), _join(table.column("marks"), np.int32)
        first, ahead, strings = (
            _join(table.column(c), t) for c, t in (("first", np.int64), ("ahead", np.uint16), ("strings", np.uint16))
        )
        content = np.frombuffer(b"".join(map(_unpacked, table.column("content").to_pylist())), np.uint8)
        known = _join(table.column("known"), _RANGE)
        made = [known]
        if len(ids):
            order = np.argsort(ids, kind="stable")
            size = strings.astype(np.int64) + length - 1
            content = content[ragged((np.cumsum(size) - size)[order], size[order])]
            ids, marks, first = ids[order], marks[order], first[order]
            phrase, string, number = earlier_elsewhere(
                ids, ahead[order].astype(np.int64), strings[order].astype(np.int64), content, length
            )
            ranges = np.empty(len(phrase), _RANGE)
            ranges["doc_id"], ranges["mark"], ranges["n"] = ids[phrase], marks[phrase], number
            ranges["first"] = first[phrase] + string
            made.append(merged(ranges))
        made = np.concatenate(made)
        dest, columns = _blobs((made["mark"] & 0x7FFFFFFF) % dests, made)
        return pa.table([pa.array(dest, pa.int32()), pa.array(columns[0], pa.binary())], ["dest", "ranges"])

    return run


def _spans(length: int):
    def run(table: pa.Table) -> pa.Table:
        ranges = merged(_join(table.column("ranges"), _RANGE).copy())
        ranges["n"] += length - 1  # bytes instead of strings: more ranges may touch
        ranges = merged(ranges)
        heads = np.flatnonzero(np.diff(ranges["doc_id"], prepend=0) | np.diff(ranges["mark"], prepend=0) | (np.arange(len(ranges)) == 0))
        ends = np.append(heads[1:], len(ranges))
        place = np.stack([ranges["first"], ranges["first"] + ranges["n"]], 1)
        return pa.table([
            pa.array(ranges["doc_id"][heads]), pa.array(ranges["mark"][heads]),
            pa.array([place[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
        ], ["doc_id", "mark", "spans"])

    return run


def _cut_out(batches):
    for batch in batches:
        for piece in pieces(batch, "text"):
            size, spans, kept = [], [], []
            for text, places in zip(piece.column("text").to_pylist(), piece.column("spans").to_pylist()):
                own = np.frombuffer(places or b"", np.int64).reshape(-1, 2).tolist()
                edges = [0, *(x for span in own for x in span), len(text)]
                size.append(len(text))
                spans.append(own)
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if own else text)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(size, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )


def repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, trigger: int = TRIGGER, crowd: int = CROWD
) -> DataFrame:
    """doc_id, n_bytes, spans (array of [first byte, byte behind]) and kept (binary): every document without the bytes of
    strings of ``length`` bytes that also start in a document with a smaller id, judged on the documents as they are."""
    spark = docs.sparkSession
    key, whole = name(id_column).cast("long"), F.coalesce(name(text), F.lit(""))
    own = docs.select(key.alias("doc_id"), F.hash(key, whole).alias("mark"), whole.cast("binary").alias("text"))
    some = own.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length))
    total = some.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = 2 * spark.sparkContext.defaultParallelism
    prints, dests, buckets = (max(least, total // most) for most in (_FINGERPRINTS, _DOCUMENTS, _PHRASES))
    seen = some.mapInArrow(_emit_triggers(length, trigger, prints), _TRIGGERS).groupBy("bucket").applyInArrow(
        _seen_twice(dests, crowd), _SEEN
    )
    lists = seen.groupBy("dest").applyInArrow(_per_document, "doc_id long, mark int, prints binary, crowded binary")
    phrases = some.join(lists, ["doc_id", "mark"]).mapInArrow(_emit_phrases(length, trigger, buckets), _PHRASE_TYPES)
    ranges = phrases.groupBy("bucket").applyInArrow(_resolve(length, dests), "dest int, ranges binary")
    spans = stage(ranges.groupBy("dest").applyInArrow(_spans(length), "doc_id long, mark int, spans binary"), "spans")
    if (spans.agg(F.sum(F.octet_length("spans") + 24)).first()[0] or 0) <= _BROADCAST:
        spans = F.broadcast(spans)
    return own.join(spans, ["doc_id", "mark"], "left").select("doc_id", "text", "spans").mapInArrow(
        _cut_out, "doc_id long, n_bytes long, spans array<array<bigint>>, kept binary"
    )
