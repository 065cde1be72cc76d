"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

The words of many texts stand in one array of numbers, each text closed by a number of its own, so that no match crosses texts.
Suffix array by prefix doubling (only suffixes that are not yet told apart are sorted again), LCP values from the ranks of its
rounds. An LCP interval of depth d that boundary k cuts in two holds suffixes i and i + d on different sides exactly where a
square of period d starts at i and cannot be moved on by one word; only the suffixes of the smaller side are looked up, by
ISA[i + d] and ISA[i - d]. No tree is built. Each run has one such square at its end; rotating it to the left gives the run.

A narrow pass: texts are not shuffled, memory goes by the piece of 2 MB or by the longest text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import WORD, WordIndex, flatten, map_texts, name, ragged

# Suffixes looked up at once (a matter of memory, not of results).
LOOKUPS = 1 << 21


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of ``ids`` (the last number stands once) and the ranks of suffixes by their first 1, 2, 4, ... numbers."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    slots, keys = np.arange(n), ids[order]
    rank, levels, ahead = np.empty(n, np.int64), [], 1
    while True:
        first = np.ones(len(slots), bool)
        first[1:] = keys[1:] != keys[:-1]
        heads = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        rank[order[slots]] = slots[heads][group]
        levels.append(rank.astype(np.int32 if n < 1 << 31 else np.int64))
        slots = slots[np.diff(heads, append=len(slots))[group] > 1]
        if not len(slots):
            return order, levels
        # Suffixes that share ``ahead`` numbers end beyond these: the number that closes a text stands once.
        open_ = order[slots]
        keys = rank[open_] * n + rank[open_ + ahead]
        by_key = np.argsort(keys, kind="stable")
        order[slots], keys = open_[by_key], keys[by_key]
        ahead *= 2


def lcp_array(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Numbers that the suffixes left and right of each boundary of ``order`` share; -1 at both ends."""
    n = len(order)
    lcp = np.zeros(n + 1, np.int64)
    lcp[0] = lcp[n] = -1
    at = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    left, right, shared = order[at - 1], order[at], np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        shared += (levels[k][left + shared] == levels[k][right + shared]).astype(np.int64) << k
    lcp[at] = shared
    return lcp


def _bounds(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each boundary: the last one before with a smaller value, the first one after with one no larger. Equal boundaries
    of one interval so cut off one child after the other."""
    found = []
    for step in (-1, 1):
        to = np.arange(len(lcp)) + step
        open_ = at
        while len(open_):
            over = lcp[to[open_]] >= lcp[open_] if step < 0 else lcp[to[open_]] > lcp[open_]
            open_ = open_[over]
            to[open_] = to[to[open_]]
        found.append(to[at])
    return found[0], found[1]


def branching_squares(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of the squares whose next number differs from the one a period before."""
    order, levels = suffix_array(ids)
    lcp = lcp_array(order, levels)
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    cut = np.flatnonzero(lcp > 0)
    low, high = _bounds(lcp, cut)
    left_is_small = cut - low <= high - cut
    start, end = np.where(left_is_small, low, cut), np.where(left_is_small, cut, high)
    other, past = np.where(left_is_small, cut, low), np.where(left_is_small, high, cut)
    size = end - start
    starts, periods = [], []
    part = np.searchsorted(np.cumsum(size), np.arange(0, size.sum() + LOOKUPS, LOOKUPS))
    for a, b in zip(part[:-1], part[1:]):
        one = slice(a, b)
        suffix = order[ragged(start[one], size[one])]
        depth, lo, hi = (np.repeat(x[one], size[one]) for x in (lcp[cut], other, past))
        for partner, first in ((suffix + depth, suffix), (suffix - depth, suffix - depth)):
            inside = (partner >= 0) & (partner < len(ids))
            at = place[np.where(inside, partner, 0)]
            hit = inside & (lo <= at) & (at < hi)
            starts.append(first[hit])
            periods.append(depth[hit])
    return np.concatenate([*starts, np.empty(0, np.int64)]), np.concatenate([*periods, np.empty(0, np.int64)])


def _rotations(ids: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How often each square can be moved one to the left: compared in blocks of 4, 8, 16, ... numbers."""
    moved, open_, block = np.zeros(len(start), np.int64), np.flatnonzero(start > 0), 4
    while len(open_):
        at = start[open_] - moved[open_]
        size = np.minimum(block, at)
        cells = ragged(at - size, size)
        differs = ids[cells] != ids[cells + np.repeat(period[open_], size)]
        head = np.cumsum(size) - size
        last = np.maximum.reduceat(np.where(differs, cells + 1, -1), head)
        same = at - np.maximum(last, at - size)
        moved[open_] += same
        open_ = open_[(same == size) & (size < at)]
        block *= 2
    return moved


def find_runs(ids: np.ndarray, min_exponent: int = 2, min_length: int = 2) -> np.ndarray:
    """Rows (start, length, smallest period) of the maximal repetitions of ``min_exponent`` periods and ``min_length`` numbers
    at least, by start and period. The exponent asked for is 2 or more."""
    start, period = branching_squares(ids)
    end = start + 2 * period
    found = []
    while len(start):
        by = np.lexsort((period, end))
        start, period, end = start[by], period[by], end[by]
        heads = np.flatnonzero(np.diff(end, prepend=-1))
        # The least period of an end is no multiple of another; what it repeats within the run is.
        root, from_ = period[heads], start[heads] - _rotations(ids, start[heads], period[heads])
        length = end[heads] - from_
        found.append(np.stack([from_, length, root], 1))
        group = np.repeat(np.arange(len(heads)), np.diff(heads, append=len(end)))
        left = (period % root[group] != 0) | (2 * period > length[group])
        start, period, end = start[left], period[left], end[left]
    runs = np.concatenate([*found, np.empty((0, 3), np.int64)])
    runs = runs[(runs[:, 1] >= min_length) & (runs[:, 1] >= min_exponent * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    best = None
    for run in runs:  # in order of start and period: the first of equal exponents stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_exponent: int = 4, min_length: int = 6
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words, by start and period), strongest (the run of the greatest
    length / period; ties: smallest start, then period) and collapsed (the words but for what repeats the first period of a
    run, joined by one space).

    Nulls and odd input: a null or empty text has no words, no runs and an empty collapsed text; rows, repeated ones and
    null ids included, are judged one by one; further columns of any name do not matter; an empty table gives an empty one.
    """
    run = "struct<start: bigint, length: bigint, period: bigint>"

    def make():
        def one_piece(piece, texts):
            words, bounds = flatten(texts)
            index = WordIndex()
            ids = index.rows(words)
            n, at = len(texts), np.arange(len(texts))
            closed = np.insert(ids, bounds[1:], len(index) + at)
            runs = find_runs(closed, min_exponent, min_length)
            first = bounds[:-1] + at
            owner = np.searchsorted(first, runs[:, 0], "right") - 1
            runs[:, 0] -= first[owner]
            mine = np.searchsorted(owner, np.arange(n + 1))
            found, best, kept = [], [], []
            for i in range(n):
                own = list(map(tuple, runs[mine[i] : mine[i + 1]].tolist()))
                text_words = words[bounds[i] : bounds[i + 1]]
                if own:
                    keep = np.ones(len(text_words), bool)
                    for s, length, period in own:
                        keep[s + period : s + length] = False
                    text_words = [text_words[k] for k in np.flatnonzero(keep)]
                found.append(own)
                best.append(_strongest(own))
                kept.append(b" ".join(text_words).decode())
            return [piece.column("doc_id"), np.diff(bounds), found, best, kept]

        return one_piece

    schema = f"doc_id {dict(docs.dtypes)[id_column]}, n_words bigint, runs array<{run}>, strongest {run}, collapsed string"
    return map_texts(docs, {"doc_id": name(id_column)}, name(text), make, schema)


def with_planted_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repetition planted in a tenth of them, by the id's CRC h and g = h / 10: of n words, word i from
    a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8). Null ids count as empty text."""
    words, n, a, p = F.col("words"), F.size("words"), F.col("a"), F.col("p")
    h = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    own = docs.select(name(id_column).alias("id"), name(text).alias("text"))
    own = own.withColumn("words", F.when(h % 10 == 0, found))
    own = own.withColumn("a", F.when(n > 0, (g % n).cast("int")))
    own = own.withColumn("p", F.when(n > 0, (1 + F.floor((n - a) / (3 + g % 8))).cast("int")))
    planted = F.transform(words, lambda word, i: F.when(i < a, word).otherwise(F.get(words, a + (i - a) % p)))
    return own.select(
        F.col("id").alias("doc_id"), F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text")
    )
