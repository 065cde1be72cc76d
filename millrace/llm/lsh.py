"""Approximate nearest neighbours: p-stable hashing with several probes a table, exact distances for all candidates.

A table hashes a vector by ``floor((a . v + b) / width)`` for some Gaussian directions a. A query visits the buckets of
each table in the order of the probability that a neighbour at the expected distance lies there (each direction's
difference is Gaussian), until these probabilities sum to the share that gives ``recall`` over all tables; so the number
of probes follows from the query and is not capped. The first expected distance is one that nine of ten rows of a bounded
sample have their k-th neighbour within. The numbers of tables and of directions a table are those of the least cost, by the
probes and candidates of some queries of the sample.

Each query's own result is checked: with fewer than k neighbours, or a k-th one beyond the distance probed for, it is
probed again for its own distance, that of the k-th neighbour found or of the k-th in the sample, whichever is less; both
are bounds of the true one. The tables of such a round are drawn for the median of these distances; queries with much
larger ones wait for the next round. What is open after ``REPROBES`` rounds, or too little to index all rows again, is
compared with every row, block by block.

Rows and probes of a bucket are packed into blocks and joined on (table, bucket); a bucket with very many rows is many
blocks, dealt over the cluster. A task measures all queries of one block against all rows of the other in 64-bit floats
and hands on the nearest of each query; a last window merges the tables.

Nulls and odd input: vectors that are null, zero, or hold a null, NaN or infinite component take no part, nor do vectors
of another length than most have, nor rows without an id. Of repeated ids each row is a candidate of its own (the same id
and distance is given once). Ties go to the smaller id. With fewer candidates than k all are found only if they share
buckets or in the last pass; tables up to ``SMALL`` rows are probed in full.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage
from .text import name

K, TABLES, FUNCTIONS, RECALL, SAMPLE, WIDTH, SMALL = 10, (2, 4), 4, 0.985, 2_000, 2.0, 2_000
# Seconds for a probe, for measuring a candidate and for a row in a table of the index; queries tried for the choice of tables,
# and probes beyond which a choice is out of the question.
A_PROBE, A_CANDIDATE, AN_ENTRY, TRIED, PROBES = 60e-6, 0.2e-6, 30e-6, 24, 500
ROWS_A_BLOCK, QUERIES_A_BLOCK = 512, 256
# Further rounds of probing; how far beyond the distance of a round its tables are probed; open queries that are compared
# with every row at once, as this costs less than a round; most open queries that are broadcast for that.
REPROBES, BEYOND, EXACT, SENT = 3, 1.25, 256, 16_384
# Part of the sample's queries whose distance to the k-th neighbour the first round is made for.
FIRST = 0.9


@dataclass
class Tables:
    """The hash functions of all tables and what a probe needs to know."""

    directions: np.ndarray  # (tables, functions, dimensions)
    shifts: np.ndarray  # (tables, functions)
    width: float
    distance: float
    share: float  # of the neighbours, in the probed buckets of one table

    @staticmethod
    def draw(dimensions: int, functions: int, distance: float, tables: int = 4, recall: float = RECALL, seed: int = 7) -> Tables:
        rng = np.random.default_rng(seed)
        width = WIDTH * distance
        return Tables(
            rng.normal(size=(tables, functions, dimensions)), rng.uniform(0, width, (tables, functions)), width, distance,
            1.0 if recall >= 1 else 1 - (1 - recall) ** (1 / tables),
        )

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """(vectors, tables, functions): place on each line in units of the width."""
        return (np.einsum("tfd,nd->ntf", self.directions, vectors) + self.shifts) / self.width

    def keys(self, slots: np.ndarray) -> np.ndarray:
        """One number for the slots of a bucket; buckets that share one only meet more candidates."""
        with np.errstate(over="ignore"):
            key = np.zeros(slots.shape[:-1], np.uint64)
            for f in range(slots.shape[-1]):
                key = (key ^ slots[..., f].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
        return key.view(np.int64)

    def probes(self, place: np.ndarray, distance: float | None = None, most: float = math.inf) -> np.ndarray:
        """Slots of the buckets of one table to visit, likeliest first, for a query at ``place`` (and its own distance); for an
        estimate of the cost no more than ``most``."""
        sigma = (self.distance if distance is None else distance) / self.width
        reach = max(1, math.ceil(4 * sigma))
        steps = np.arange(-reach, reach + 1)
        home = np.floor(place)
        edge = (home[:, None] + np.arange(-reach, reach + 2) - place[:, None]) / (sigma * math.sqrt(2))
        cdf = np.array([[0.5 * math.erfc(-e) for e in row] for row in edge])
        chance = np.maximum(np.diff(cdf, axis=1), 1e-300)
        order = np.argsort(-chance, axis=1, kind="stable")
        loss = -np.log(np.take_along_axis(chance, order, 1))  # ascending for each function
        extra = loss - loss[:, :1]
        base = math.exp(-loss[:, 0].sum())
        # function by function, the ranks of the next best step: states in order of their probability
        found, total, heap, seen = [], 0.0, [(0.0, (0,) * len(place))], {(0,) * len(place)}
        while heap and total < self.share and len(found) < most:
            lost, ranks = heapq.heappop(heap)
            found.append(ranks)
            total += base * math.exp(-lost)
            for f, r in enumerate(ranks):
                if r + 1 < len(steps):
                    after = (*ranks[:f], r + 1, *ranks[f + 1 :])
                    if after not in seen:
                        seen.add(after)
                        heapq.heappush(heap, (lost + extra[f, r + 1] - extra[f, r], after))
        return home + steps[order[np.arange(len(place)), np.array(found)]]


def choose(sample: np.ndarray, distance: float, rows: int, asked: int, recall: float = RECALL) -> tuple[int, int]:
    """Tables and functions a table of the least cost: what ``TRIED`` queries of the sample need in probes and find in candidates,
    and what the index costs. More functions make smaller buckets, of which more must be visited: where vectors have little
    contrast the probes multiply and the candidates hardly fall."""
    tried = sample[:: max(1, len(sample) // TRIED)][:TRIED]
    best = (math.inf, TABLES[0], FUNCTIONS)
    for tables in TABLES:
        least = math.inf
        for functions in range(FUNCTIONS, max(FUNCTIONS + 1, round(math.log2(max(2, rows))) - 4)):
            of = Tables.draw(sample.shape[1], functions, distance, 1, 1 - (1 - recall) ** (1 / tables))
            there, places = of.keys(np.floor(of.places(sample)))[:, 0], of.places(tried)[:, 0]
            probes = [of.keys(of.probes(p, most=PROBES)) for p in places]
            share = np.mean([np.isin(there, p).mean() for p in probes])
            visited = np.mean([len(p) for p in probes])
            cost = tables * (asked * (visited * A_PROBE + share * rows * A_CANDIDATE) + rows * AN_ENTRY)
            best = min(best, (cost, tables, functions))
            if cost > 2 * least or visited >= PROBES:  # the probes outgrow what they save
                break
            least = min(least, cost)
    return best[1:]


def valid_vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    v = F.transform(name(vector), lambda x: x.cast("double"))
    rows = df.select(name(id_column).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))


def _sample(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a bounded sample by hash."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "v").collect()
    return np.array([r["id"] for r in sample], np.int64), np.array([r["v"] for r in sample])


def _sample_distance(sample: np.ndarray, k: int) -> float:
    """Median distance to the k-th neighbour within the sample."""
    if len(sample) < 3:
        return 1.0
    return float(np.median(_kth(sample, k))) or float(_kth(sample, len(sample)).mean()) or 1.0


def _kth(sample: np.ndarray, k: int) -> np.ndarray:
    """Distance of each row of the sample to its k-th neighbour there."""
    square = (sample**2).sum(1)
    apart = np.sqrt(np.maximum(square[:, None] + square - 2 * sample @ sample.T, 0))
    return np.sort(apart, axis=1)[:, min(k, len(sample) - 1)]


def _bounds(batches, sample, k: int):
    """Rows (id, v, kth) -> with ``own``: no more than kth and the distance to the k-th other id of the sample."""
    ids, vectors = sample.value
    for batch in batches:
        own = np.array(batch.column("kth"), np.float64)
        at = np.asarray(batch.column("id"))
        v = np.asarray(batch.column("v").flatten()).reshape(batch.num_rows, -1)
        for i in range(batch.num_rows):
            apart = ((vectors[ids != at[i]] - v[i]) ** 2).sum(1)
            if len(apart) >= k:
                own[i] = min(own[i], np.sqrt(np.partition(apart, k - 1)[k - 1]))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(own)], ["id", "v", "own"])


def _least(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> list[np.ndarray]:
    """The k nearest of each query, repeated pairs once."""
    order = np.lexsort((ids, score, query))
    query, ids, score = query[order], ids[order], score[order]
    same = query[1:] == query[:-1]
    new = np.append(True, ~(same & (ids[1:] == ids[:-1]) & (score[1:] == score[:-1])))[: len(query)]
    query, ids, score = query[new], ids[new], score[new]
    first = np.flatnonzero(np.append(True, query[1:] != query[:-1])[: len(query)])
    near = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query)))) < k
    return [query[near], ids[near], score[near]]


def _pack(batches, size: int, names: tuple[str, str]):
    """Rows (tbl, bucket, id, v) -> a row for each bucket of a batch and at most ``size`` of its rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, table = np.asarray(batch.column("bucket")), np.asarray(batch.column("tbl"))
        order = np.lexsort((bucket, table))
        table, bucket = table[order], bucket[order]
        ids = np.asarray(batch.column("id"))[order]
        vectors = np.asarray(batch.column("v").flatten()).reshape(batch.num_rows, -1)[order]
        new = np.append(True, (bucket[1:] != bucket[:-1]) | (table[1:] != table[:-1]))
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(ids))
        cut = [(a, min(a + size, z)) for s, z in zip(starts, ends) for a in range(s, z, size)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(table[[a for a, _ in cut]]), pa.array(bucket[[a for a, _ in cut]]),
                pa.array([ids[a:z] for a, z in cut], pa.list_(pa.int64())),
                pa.array([vectors[a:z].tobytes() for a, z in cut], pa.binary()),
            ],
            ["tbl", "bucket", *names],
        )


def _blocks(rows: DataFrame, size: int, names: tuple[str, str]) -> DataFrame:
    """Packed blocks. Buckets are brought together by ranges whose large ones adaptive execution splits."""
    schema = f"tbl int, bucket long, {names[0]} array<long>, {names[1]} binary"
    return rows.hint("rebalance", "tbl", "bucket").mapInArrow(lambda batches: _pack(batches, size, names), schema)


def nearest(df: DataFrame, queries: Column, id_column: str = "vec_id", vector: str = "embedding", k: int = K, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` (of column ``id``) selects, its k nearest others."""
    rows = valid_vectors(df, id_column, vector)
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    d, n = (lengths[0]["d"], lengths[0]["n"]) if lengths else (1, 0)
    rows = rows.where(F.size("v") == d)
    whole = n <= SMALL
    context = df.sparkSession.sparkContext
    ids, sample = _sample(rows)
    distance = _sample_distance(sample, k)
    asked = rows.where(queries).withColumn("probed", F.lit(distance))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def best(found: DataFrame) -> DataFrame:
        ranked = found.distinct().select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")
        return ranked.where(F.col("rank") <= k)

    if whole:
        return best(_probed(rows, asked, Tables.draw(d, 1, distance, 1, 1.0), k, True))
    many = asked.count()
    first = max(distance, float(np.quantile(_kth(sample, k), FIRST)))  # most queries are done after the first round
    asked = asked.withColumn("probed", F.lit(first))
    tables, functions = choose(sample, first, n, many, recall)
    found = stage(best(_probed(rows, asked, Tables.draw(d, functions, first, tables, recall), k)), "found")
    _, one = np.unique(ids, return_index=True)
    sent = context.broadcast((ids[one], sample[one]))
    for again in range(REPROBES + 1):
        kth = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.max("score").alias("far"))
        enough = F.coalesce(F.col("n") >= k, F.lit(False))
        left = asked.join(kth, "id", "left").where(~(enough & (F.col("far") <= F.col("probed"))))
        left = left.select("id", "v", F.when(enough, F.col("far")).otherwise(F.lit(float("inf"))).alias("kth"))
        left = stage(left.mapInArrow(lambda b: _bounds(b, sent, k), "id long, v array<double>, own double"), "left")
        many = left.count()
        if not many:
            return found
        middle = max(first, left.approxQuantile("own", [0.5], 0.01)[0])
        if again == REPROBES or many <= EXACT or middle == float("inf"):
            more = _compared(rows, left, many, k)
            return best(found.drop("rank").unionByName(more))
        asked = left.select("id", "v", F.least("own", F.lit(middle * BEYOND)).alias("probed"))
        asked = asked.withColumn("probed", F.greatest("probed", F.lit(first)))
        tables, functions = choose(sample, middle, n, many, recall)
        drawn = Tables.draw(d, functions, middle, tables, recall, seed=8 + again)
        found = stage(best(found.drop("rank").unionByName(_probed(rows, asked, drawn, k))), "found")


def _probed(rows: DataFrame, asked: DataFrame, tables: Tables, k: int, whole: bool = False) -> DataFrame:
    """(query_id, vec_id, score) of rows in the probed buckets; ``asked`` is (id, v, probed): for which distance."""
    sent = rows.sparkSession.sparkContext.broadcast(tables)

    def hashed(batches, probe: bool):
        of = sent.value
        for batch in batches:
            vectors = np.asarray(batch.column("v").flatten()).reshape(batch.num_rows, -1)
            places = of.places(vectors) if batch.num_rows else np.zeros((0, 1, 1))
            if whole:
                row, table = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int32)
                key = np.zeros(batch.num_rows, np.int64)
            elif probe:
                far = np.asarray(batch.column("probed"))
                parts = [
                    (i, t, of.keys(of.probes(places[i, t], far[i]))) for i in range(len(places)) for t in range(places.shape[1])
                ]
                row = np.concatenate([np.full(len(p), i) for i, _, p in parts] or [np.zeros(0, np.int64)])
                table = np.concatenate([np.full(len(p), t, np.int32) for _, t, p in parts] or [np.zeros(0, np.int32)])
                key = np.concatenate([p for *_, p in parts] or [np.zeros(0, np.int64)])
            else:
                row = np.repeat(np.arange(len(places)), places.shape[1])
                table = np.tile(np.arange(places.shape[1], dtype=np.int32), len(places))
                key = of.keys(np.floor(places)).reshape(-1)
            for a in range(0, len(row), 20_000):
                at = pa.array(row[a : a + 20_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(table[a : a + 20_000]), pa.array(key[a : a + 20_000]), batch.column("id").take(at), batch.column("v").take(at)],
                    ["tbl", "bucket", "id", "v"],
                )

    schema = "tbl int, bucket long, id long, v array<double>"
    index = _blocks(rows.mapInArrow(lambda b: hashed(b, False), schema), ROWS_A_BLOCK, ("ids", "vectors"))
    asked = _blocks(asked.mapInArrow(lambda b: hashed(b, True), schema), QUERIES_A_BLOCK, ("query_ids", "query_vectors"))
    return _measured(stage(asked, "asked").join(stage(index, "index"), ["tbl", "bucket"]), k)


def _compared(rows: DataFrame, asked: DataFrame, many: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of all rows, for each of ``many`` queries (id, v)."""
    flat = lambda df: df.select(F.lit(0).alias("tbl"), F.lit(0).cast("long").alias("bucket"), "id", "v")
    schema = "tbl int, bucket long, ids array<long>, vectors binary"
    index = flat(rows).mapInArrow(lambda b: _pack(b, ROWS_A_BLOCK, ("ids", "vectors")), schema)
    asked = stage(_blocks(flat(asked), QUERIES_A_BLOCK, ("query_ids", "query_vectors")), "asked").drop("tbl", "bucket")
    return _measured(index.crossJoin(F.broadcast(asked) if many <= SENT else asked), k)


def _measured(met: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): of each batch of met blocks, the k nearest of each query."""

    def measure(batches):
        for batch in batches:
            out = ([], [], [])
            for qi, qv, ci, cv in zip(*(batch.column(c) for c in ("query_ids", "query_vectors", "ids", "vectors"))):
                qi, ci = np.asarray(qi.values), np.asarray(ci.values)
                qv = np.frombuffer(qv.as_buffer(), np.float64).reshape(len(qi), -1)
                cv = np.frombuffer(cv.as_buffer(), np.float64).reshape(len(ci), -1)
                for q, v in zip(qi, qv):
                    score = np.sqrt(((cv - v) ** 2).sum(1))
                    other = np.flatnonzero(ci != q)
                    best = other[np.lexsort((ci[other], score[other]))]
                    ids, apart = ci[best], score[best]
                    again = (ids[1:] == ids[:-1]) & (apart[1:] == apart[:-1])  # repeated rows give one id and distance
                    best = best[np.append(True, ~again)[: len(best)]][:k]
                    out[0].append(np.full(len(best), q))
                    out[1].append(ci[best])
                    out[2].append(score[best])
            if out[0]:
                least = _least(*(np.concatenate(o) for o in out), k)
                yield pa.RecordBatch.from_arrays([pa.array(o) for o in least], ["query_id", "vec_id", "score"])

    schema = "query_id long, vec_id long, score double"
    return met.select("query_ids", "query_vectors", "ids", "vectors").mapInArrow(measure, schema)
