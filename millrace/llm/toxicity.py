"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, weighted votes.

Terms are words and the 4-letter runs of words (word ends marked), lower-cased. The space has every term whose presence in
the labelled examples goes with the label: rare or frequent, as many as there are, so that of those chosen at most one in
twenty (``FALSE_SHARE``) is expected to be there by chance. Other terms would only add the noise of chance neighbours. Their
document counts, for the inverse document frequency, are taken over all training documents. The examples are a bounded
sample by label and hash (``examples`` rows, of a rare label at least one in ``LEAST_SHARE`` or all there are), weighted
back to the labels' shares in the calibration; everything else covers all rows.

The index holds the examples in blocks of like terms, for each term its postings and the largest weight in each block. A
document's blocks are visited from the highest bound on, until the k-th best cosine is above what is left; the result is
that of comparing with every example, ties to the smaller example number (a hash order).

The k nearest vote with weights that fall with their distance, drawn towards the share of toxic examples; what a vote is
worth comes from the examples, each voted on by the others. Examples without any term of the space are the neighbours of
documents without any.

Nulls and odd input: a null or empty text has no terms; a null label or doc_id is no example; repeated rows are examples
and scored one by one; without examples, or with one label alone, every score is the share of toxic examples (0 if none).
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .text import WordTable, map_texts, name, pieces, ragged, with_row, worker_held

# Most labelled rows that are examples; of a rare label at least one in LEAST_SHARE.
EXAMPLES, LEAST_SHARE = 8_000, 8
# Terms of the space: the share that may be there by chance, and how many times the share of toxic examples a term must have
# among the texts that hold it.
FALSE_SHARE, LIFT = 0.05, 2.0
NEIGHBOURS, BLOCK = 25, 64
THRESHOLD = 0.3
GRAM = 4

_WORDS = re.compile(r"[^\W_]+")


def terms_of(word: str) -> set[str]:
    marked = f"<{word}>"
    return {marked, *(marked[i : i + GRAM] for i in range(len(marked) - GRAM + 1))}


def words_of(text: bytes) -> list[str]:
    return _WORDS.findall(text.decode().lower())


class Terms:
    """Numbers of the terms of texts, with a bounded memory of words already split."""

    def __init__(self, space: dict[str, int]):
        self.space = space
        self.table = WordTable(self._learn, (np.int64,))

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [[self.space[t] for t in terms_of(w) if t in self.space] for w in words]
        return np.array([len(f) for f in found], np.int64), np.array([t for f in found for t in f], np.int64)

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of each text, its terms in ascending order and how often it has them, end to end."""
        words: list[str] = []
        often: list[int] = []
        size = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = Counter(words_of(text))  # a very long text has far fewer different words
            size[i] = len(own)
            words += own.keys()
            often += own.values()
        rows = self.table.rows(words)
        lengths = self.table.lengths[rows]
        at = ragged(self.table.starts[rows], lengths)
        text = np.repeat(np.repeat(np.arange(len(texts)), size), lengths)
        every = max(1, len(self.space))
        key, same = np.unique(text * every + self.table.values[0][at], return_inverse=True)
        times = np.bincount(same, np.repeat(np.array(often, np.int64), lengths), len(key)).astype(np.int64)
        return np.searchsorted(key // every, np.arange(len(texts) + 1)), key % every, times


def _term_rows(batches):
    """(term, clean, toxic): how many texts of each label hold a term, for each piece."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            found = (Counter(), Counter())
            for text, label in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist()):
                found[label].update(set().union(*map(terms_of, set(words_of(text)))))
            every = list(found[0].keys() | found[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(every, pa.string()), *(pa.array([f[t] for t in every], pa.int64()) for f in found)],
                ["term", "clean", "toxic"],
            )


@dataclass
class Index:
    """Examples with terms, placed so that like ones share a block: postings (place, weight), block maxima, labels."""

    space: dict[str, int]
    idf: np.ndarray
    starts: np.ndarray  # postings of term t in block b: from starts[t * blocks + b] to the next
    place: np.ndarray
    weight: np.ndarray
    most: np.ndarray  # (terms, blocks)
    label: np.ndarray  # by place: 0 or 1
    number: np.ndarray  # by place: the example's number, for ties
    share: float
    empty: float  # score of a document without terms
    neighbours: int = NEIGHBOURS
    odds: tuple[float, float] = (1.0, 1.0)  # what an example of each label stands for
    votes: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    meaning: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    @staticmethod
    def build(space: dict[str, int], idf: np.ndarray, rows: list[tuple[dict[int, int], int]], neighbours: int = NEIGHBOURS, odds: tuple[float, float] = (1.0, 1.0)) -> Index:
        """From (term counts, label) of each example, in example order."""
        label = np.array([y for _, y in rows], np.int64)
        stands = np.array(odds)[label]
        share = float(stands @ label / stands.sum()) if len(label) else 0.0
        bare = np.array([not t for t, _ in rows], bool)
        empty = float((stands[bare] @ label[bare] + share * min(odds)) / (stands[bare].sum() + min(odds))) if len(rows) else 0.0
        vectors = [unit(t, idf) for t, _ in rows]
        full = [i for i in range(len(rows)) if not bare[i]]
        full.sort(key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), i))  # like terms side by side
        example = np.array(full, np.int64)
        at = np.concatenate([np.full(len(vectors[i][0]), k) for k, i in enumerate(full)] or [np.zeros(0, np.int64)])
        term = np.concatenate([vectors[i][0] for i in full] or [np.zeros(0, np.int64)])
        weight = np.concatenate([vectors[i][1] for i in full] or [np.zeros(0)])
        blocks = -(-len(full) // BLOCK)
        cell = term * blocks + at // BLOCK
        order = np.argsort(cell, kind="stable")
        starts = np.searchsorted(cell[order], np.arange(len(idf) * blocks + 1))
        most = np.zeros(len(idf) * blocks)
        np.maximum.at(most, cell, weight)
        index = Index(
            space, idf, starts, at[order], weight[order], most.reshape(len(idf), blocks), label[example], example, share, empty,
            neighbours, odds,
        )
        index.calibrate([vectors[i] for i in full])
        return index

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, above: float = -1.0) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the nearest examples, nearest first, ties to the smaller example number; blocks that cannot
        reach ``above`` are left out."""
        blocks, size = self.most.shape[1], len(self.label)
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound >= above)]
        found, scores, least = np.zeros(0, np.int64), np.zeros(0), above
        first, step = 0, 4
        while first < len(order):
            some = order[first : first + step]
            first, step = first + step, 2 * step
            some = some[bound[some] + 1e-9 >= least]
            if not len(some):
                break
            cells = (terms[:, None] * blocks + some).ravel()
            starts = self.starts[cells]
            lengths = self.starts[cells + 1] - starts
            at = ragged(starts, lengths)
            sums = np.bincount(self.place[at], np.repeat(np.repeat(weights, len(some)), lengths) * self.weight[at], size)
            places = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            places = places[places < size]
            found, scores = np.concatenate([found, places]), np.concatenate([scores, sums[places]])
            best = np.lexsort((self.number[found], -np.round(scores, 12)))[:k]
            found, scores = found[best], scores[best]
            if len(found) == k:
                least = max(above, scores[-1])
        return found, scores

    def vote(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[float, np.ndarray]:
        """Share of toxic among the neighbours, weighted by nearness, and their places; ``without`` is no neighbour."""
        places, cosine = self.nearest(terms, weights, self.neighbours + (without >= 0), above=1e-12)
        near = (cosine > 0) & (places != without)
        places, cosine = places[near][: self.neighbours], np.minimum(cosine[near], 1.0)[: self.neighbours]
        weight = 1 / (0.1 + np.sqrt(2 - 2 * cosine))  # distance of unit vectors
        return (float(weight @ self.label[places]) + self.share) / (float(weight.sum()) + 1), places

    def calibrate(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Each example is voted on by the others; the share of toxic ones by vote, made monotone, is what a vote says.
        ``vectors`` by place."""
        votes = np.array([self.vote(*v, without=i)[0] for i, v in enumerate(vectors)])
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # toxic, examples, least and largest vote; neighbours that fall are pooled
        for vote, label in zip(votes[order], self.label[order]):
            pools.append([self.odds[label] * label, self.odds[label], float(vote), float(vote)])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                toxic, size, _, most = pools.pop()
                pools[-1] = [pools[-1][0] + toxic, pools[-1][1] + size, pools[-1][2], most]
        unit = min(self.odds)
        share = [(toxic + self.share * unit) / (size + unit) for toxic, size, *_ in pools]
        self.votes = np.array([0.0, *(v for pool in pools for v in pool[2:]), 1.0])
        self.meaning = np.array([0.0, *(s for s in share for _ in range(2)), 1.0])
        self.meaning = np.maximum.accumulate(self.meaning)

    def score(self, terms: np.ndarray, times: np.ndarray) -> tuple[float, list[int]]:
        """Score of a document and the example numbers it rests on."""
        if not len(terms):
            return self.empty, []
        vote, places = self.vote(terms, _weights(terms, times, self.idf))
        sure = float(np.interp(vote, self.votes, self.meaning))
        return min(1.0, max(0.0, 0.98 * sure + 0.02 * vote)), self.number[places].tolist()  # votes still order equal shares

    def scores(self, bounds: np.ndarray, terms: np.ndarray, times: np.ndarray) -> list[tuple[float, list[int]]]:
        """Scores of the texts of a piece; those with the same terms are scored once."""
        known: dict[bytes, tuple[float, list[int]]] = {}
        out = []
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            key = terms[a:z].tobytes() + times[a:z].tobytes()
            if key not in known:
                known[key] = self.score(terms[a:z], times[a:z])
            out.append(known[key])
        return out


def _weights(terms: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights of length 1: (1 + log tf) * idf."""
    weight = (1 + np.log(times)) * idf[terms]
    length = np.sqrt((weight**2).sum())
    return weight / length if length else weight


def unit(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights) of length 1."""
    terms = np.array(sorted(counts), np.int64)
    return terms, _weights(terms, np.array([counts[t] for t in terms.tolist()], float), idf)


def _by_chance(texts: int, share: float, logs: np.ndarray) -> np.ndarray:
    """Chance that at least 0, 1, ..., ``texts`` of a term's texts are toxic if each is with chance ``share``; ``logs`` are
    the logarithms of the factorials."""
    n = np.arange(texts + 1)
    each = logs[texts] - logs[n] - logs[texts - n] + n * np.log(share) + (texts - n) * np.log1p(-share)
    return np.minimum(np.cumsum(np.exp(each)[::-1])[::-1], 1.0)


def choose_terms(counts: DataFrame, clean: int, toxic: int) -> list[str]:
    """Terms that go with the label more often than chance lets them: the bound on the chance of a term is the largest one
    at which FALSE_SHARE of the chosen terms are expected to be no better than any other, counted by how many texts hold a
    term (a term of two texts cannot be as sure as one of twenty). ``counts``: a row a term of the examples."""
    share = toxic / (clean + toxic)
    alike = counts.groupBy("clean", "toxic").count().collect()  # by the examples at most as many as their terms
    logs = np.concatenate([np.zeros(1), np.cumsum(np.log(np.arange(1, clean + toxic + 1)))])
    held: Counter = Counter()
    for r in alike:
        held[r["clean"] + r["toxic"]] += r["count"]
    chances = {n: _by_chance(n, share, logs) for n in held}
    bounds = np.logspace(-1, -12, 111)
    expected = np.zeros(len(bounds))
    for n, chance in chances.items():
        reached = chance[np.minimum(len(chance) - 1, np.searchsorted(-chance, -bounds))]
        expected += held[n] * np.where(reached <= bounds, reached, 0.0)
    better = [r for r in alike if r["toxic"] > 1 and r["toxic"] >= min(LIFT * share, (1 + share) / 2) * (r["clean"] + r["toxic"])]
    reached = np.array([chances[r["clean"] + r["toxic"]][r["toxic"]] for r in better])
    terms = np.array([r["count"] for r in better])
    chosen = (reached[:, None] <= bounds).T @ terms if better else np.zeros(len(bounds))
    sure = np.flatnonzero((expected <= FALSE_SHARE * chosen) & (chosen > 0))
    if not len(sure):
        return []
    pairs = [(r["clean"], r["toxic"]) for r, chance in zip(better, reached) if chance <= bounds[sure[0]]]
    of = counts.sparkSession.createDataFrame(pairs, counts.select("clean", "toxic").schema)
    return sorted(r["term"] for r in counts.join(F.broadcast(of), ["clean", "toxic"], "left_semi").select("term").collect())


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def _take(every: list[int], examples: int) -> list[int]:
    """How many examples of each label: by its share, but of a rare one at least one in LEAST_SHARE or all there are."""
    if sum(every) <= examples:
        return every
    rare = int(every[1] <= every[0])
    some = min(every[rare], max(examples // LEAST_SHARE, round(examples * every[rare] / sum(every))))
    return [some if label == rare else examples - some for label in (0, 1)]


def fit(docs: DataFrame, labels: DataFrame, id_column: str, text: str, aside, examples: int = EXAMPLES) -> Index:
    """The index over a sample of the labelled training rows; what the driver holds is bounded by examples and terms."""
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select(
        F.col("doc_id").alias("of"), F.col("toxic").cast("int").alias("toxic")
    ).distinct()
    known = known.where(~aside(F.col("of")))
    every = dict(known.groupBy("toxic").count().collect())
    every = [every.get(label, 0) for label in (0, 1)]
    take = _take(every, examples)
    odds = [n / max(1, t) * sum(take) / max(1, sum(every)) for n, t in zip(every, take)]
    odds = tuple(o or 1.0 for o in odds)
    first, second = (known.where(F.col("toxic") == y).orderBy(F.xxhash64("of"), "of").limit(t) for y, t in enumerate(take))
    chosen = first.unionByName(second)
    rows = docs.select(name(id_column).alias("doc_id"), F.coalesce(name(text), F.lit("")).cast("binary").alias("text"))
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).select("doc_id", "toxic", "text").distinct()
    # An id may have many rows of different texts: the bound holds for the examples themselves.
    first, second = (
        found.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(t) for y, t in enumerate(take)
    )
    sample = stage(first.unionByName(second), "examples")
    texts = sample.select("toxic", "text").distinct()  # copies of one text would make its rare words look telling
    labels_seen = dict(texts.groupBy("toxic").count().collect())
    clean, toxic = labels_seen.get(0, 0), labels_seen.get(1, 0)
    found = texts.mapInArrow(_term_rows, "term string, clean long, toxic long")
    counts = stage(found.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "counts")
    space = {t: i for i, t in enumerate(choose_terms(counts, clean, toxic) if clean and toxic else [])}

    # document counts of the terms over all training documents: a row a term and task at most
    training = rows.where(~aside(F.col("doc_id")))

    def count(batches):
        terms, n, seen = Terms(space), 0, np.zeros(len(space), np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                n += piece.num_rows
                seen += np.bincount(terms.counts(piece.column("text").to_pylist())[1], minlength=len(seen))
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1), pa.int32()), pa.array(np.append(seen[held], n), pa.int64())], ["term", "n"]
        )

    totals = training.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = dict(totals.collect())  # one row a term
    every = df.pop(-1, 0)
    idf = np.array([np.log((1 + every) / (1 + df.get(t, 0))) + 1 for t in range(len(space))])

    def vectors(piece: pa.RecordBatch, texts: list[bytes]):
        bounds, terms, times = Terms(space).counts(texts)
        lists = (pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, pa.int32())) for x in (terms, times))
        return [piece.column("doc_id"), piece.column("toxic"), *lists]

    kind = dict(rows.dtypes)["doc_id"]
    table = map_texts(
        sample, {"doc_id": F.col("doc_id"), "toxic": F.col("toxic")}, F.col("text").cast("string"), lambda: vectors,
        f"doc_id {kind}, toxic int, terms array<int>, times array<int>",
    )
    table = table.select(F.xxhash64("doc_id").alias("h"), "doc_id", "toxic", "terms", "times").collect()  # examples
    table.sort(key=lambda r: (r["h"], r["doc_id"], r["toxic"], sorted(zip(r["terms"], r["times"]))))
    return Index.build(space, idf, [(dict(zip(r["terms"], r["times"])), r["toxic"]) for r in table], odds=odds)


def scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", aside=held_out, **how) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted, evidence (example numbers, nearest first).

    ``labels`` has doc_id and toxic; ``aside`` says of a doc_id whether its label must not be learnt from.
    """
    columns = {"doc_id": name(id_column), "held_out": aside(name(id_column))}
    kind = dict(docs.dtypes)[id_column]
    schema = f"doc_id {kind}, held_out boolean, score double, evidence array<int>"
    made = map_texts(docs, columns, name(text), _scorer(docs, labels, id_column, text, aside, how), schema)
    return made.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def _scorer(docs, labels, id_column, text, aside, how, keep: tuple[str, ...] = ("doc_id", "held_out")):
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_column, text, aside, **how))
    mark = uuid.uuid4().hex

    def make():
        # What other operators left in this worker goes before the index comes.
        terms = worker_held(("toxicity", mark), lambda: Terms(sent.value.space))
        index = sent.value

        def one_piece(piece: pa.RecordBatch, texts: list[bytes]):
            found = index.scores(*terms.counts(texts))
            return [*(piece.column(c) for c in keep), [s for s, _ in found], [e for _, e in found]]

        return one_piece

    return make


def keep_clean(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", aside=held_out, **how) -> DataFrame:
    """The documents that are not predicted toxic, with the columns of ``docs``."""
    rows = docs.select(F.struct(*map(name, docs.columns)).alias("row"), name(text).alias("text"))
    schema = with_row(rows, "score double, evidence array<int>")
    scorer = _scorer(docs, labels, id_column, text, aside, how, ("row",))
    made = map_texts(rows, {"row": F.col("row")}, F.col("text"), scorer, schema)
    return made.where(F.col("score") < THRESHOLD).select("row.*")
