"""What the text operators share: words, bounded pieces of Arrow batches, word caches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A word: a longest run without space, tab, line feed, vertical tab, form feed, carriage return. The same set
# separates words in bytes.split(), so Python code splits UTF-8 bytes and needs no pattern.
WORD = r"[^\x20\x09-\x0D]+"

# Words whose results one Python worker keeps (a matter of speed and memory, not of results).
CACHE_WORDS = 60_000

_held: dict = {}


def worker_held(key: tuple, make: Callable):
    """What a Python worker keeps from task to task: one operator's tables at a time, so that a worker that serves several
    stages holds the tables of the last only."""
    if key not in _held:
        _held.clear()
        give_back()
        _held[key] = make()
    return _held[key]


def give_back() -> None:
    """Hand memory that is free back to the system: a worker that waits, or serves another stage, would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library alone has it
    if trim:
        trim(0)


def name(column: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_draw(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) that depends on ``seed`` and ``keys`` alone; nulls count as empty text."""
    key = F.concat_ws(":", F.lit(seed), *(F.coalesce(k.cast("string"), F.lit("")) for k in keys))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def pieces(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each (one row may be longer)."""
    size = np.asarray(pc.binary_length(batch.column(column))).cumsum()
    start = 0
    while start < batch.num_rows:
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def schema_of(df: DataFrame, schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else df.sparkSession.createDataFrame([], schema).schema


def with_row(rows: DataFrame, more: str) -> StructType:
    """The type of column ``row`` as it is, whatever its fields are called, and further columns."""
    return StructType([rows.schema["row"], *schema_of(rows, more).fields])


def map_texts(
    df: DataFrame, columns: dict[str, Column], text: Column, make: Callable[[], Callable], schema: str | StructType,
    most: int = 2 << 20,
) -> DataFrame:
    """A narrow pass over whole texts. ``make()`` runs once a task and gives ``f(piece, texts) -> columns`` where
    ``piece`` holds ``columns`` and ``texts`` the UTF-8 bytes (null: empty), about ``most`` of them; rows keep their order."""
    out = schema_of(df, schema)
    narrow = df.select(*(c.alias(n) for n, c in columns.items()), F.coalesce(text, F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        f, arrow = make(), to_arrow_schema(out)
        for batch in batches:
            for piece in pieces(batch, "text", most):
                made = f(piece, piece.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, t.type) for x, t in zip(made, arrow)], schema=arrow
                )
                del made
            batch = piece = None
        give_back()

    return narrow.mapInArrow(run, out)


class WordIndex(dict):
    """Word -> row number, by first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = row = len(self)
        return row

    def rows(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class WordTable:
    """What ``learn(words)`` says of words: the number of values of each and the values, end to end, in one or more
    arrays. A worker keeps up to ``most`` words; beyond that, those of the piece at hand that it knew before."""

    def __init__(self, learn: Callable, types: tuple, most: int = CACHE_WORDS):
        self.learn, self.most, self.index = learn, most, WordIndex()
        self.lengths, self.values = np.empty(0, np.int64), [np.empty(0, t) for t in types]
        self.starts = self.lengths

    def _keep(self, words: list[bytes]) -> None:
        kept = [w for w in set(words) if w in self.index]
        rows = self.index.rows(kept)
        at = ragged(self.starts[rows], self.lengths[rows])
        self.values, self.lengths = [v[at] for v in self.values], self.lengths[rows]
        self.index = WordIndex(zip(kept, range(len(kept))))

    def rows(self, words: list[bytes] | list[str]) -> np.ndarray:
        """Row of each word; its values are values[k][starts[row] : starts[row] + lengths[row]]."""
        if len(self.index) > self.most:
            self._keep(words)
        seen = len(self.index)
        rows = self.index.rows(words)
        if len(self.index) > seen:
            new = islice(self.index, seen, None)
            lengths, *values = self.learn([w if isinstance(w, str) else w.decode() for w in new])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.values = [np.concatenate([old, new]) for old, new in zip(self.values, values)]
        self.starts = np.cumsum(self.lengths) - self.lengths
        return rows


def flatten(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words of some texts in one list, and the bounds of each text in it."""
    words: list[bytes] = []
    bounds = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        words += text.split()
        bounds[i + 1] = len(words)
    return words, bounds


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[0], starts[0]+1, ..., of runs laid end to end."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
