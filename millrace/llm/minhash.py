"""Near duplicates: fast similarity sketches, banding, exact verification, connected components.

A text's set is its distinct 5-word shingles, lower-cased in A-Z only (with fewer words, the whole sequence). A sketch has
``BANDS * ROWS`` coordinates. In round i each element is hashed to a bin and offers i plus a fraction; from round
``coordinates`` on, round i serves one fixed bin, so after twice as many rounds every coordinate is filled, and all
coordinates are as good as independent minima: the share of equal ones estimates the similarity with Chernoff bounds.
Rounds stop as soon as all bins are filled.

Equal sets are one node, keyed by a 128-bit digest, before any banding: a group of copies of any size is one node. In
each band's bucket all nodes are compared with the least one; nodes of a bucket that are still in several components are
then joined across them by prefix filter (similar sets share one of their rarest shingles), so no link between nodes of a
bucket is lost and a family of texts just below the threshold does not meet pair by pair. A parity bitmap of each set
bounds from below how far two sets differ, which spares most pairs just below the threshold the comparison (an exact bound:
no link is lost). Candidates are confirmed on the full sets of 64-bit shingle hashes.

Nulls and odd input: a null, empty or blank text has an empty set and is linked with nothing; a null doc_id takes part,
but never names a component; repeated rows and repeated ids are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checked_broadcast, stage
from .components import components
from .text import WordTable, flatten, map_texts, name, worker_held

SHINGLE = 5
BANDS, ROWS = 24, 6
# A link: 100 * intersection >= LEAST * union.
LEAST = 85
# Words of 64 bits of a set's parity bitmap.
BITMAP = 8
SETS = "wanted binary, node binary, set array<long>, bits array<long>"

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix64(x: np.ndarray) -> np.ndarray:
    """A strong one-to-one mix of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _word_hashes() -> WordTable:
    def learn(words: list[str]):
        return np.ones(len(words), np.int64), np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)

    return WordTable(learn, (np.uint64,))


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """The set of each text: sorted distinct 64-bit hashes of its shingles."""
    words, bounds = flatten([t.lower() for t in texts])
    table = worker_held(("minhash",), _word_hashes)
    rows = table.rows(words)
    hashes = table.values[0][rows]
    with np.errstate(over="ignore"):
        n = max(0, len(hashes) - width + 1)
        key = np.zeros(n, np.uint64)
        for k in range(width):
            key = mix64(key * _M1 + hashes[k : k + n] + np.uint64(k + 1))
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= width:
                out.append(np.unique(key[a : b - width + 1]))
            elif b > a:
                one = np.zeros(1, np.uint64)
                for k, h in enumerate(hashes[a:b]):
                    one = mix64(one * _M1 + h + np.uint64(k + 1))
                out.append(mix64(one + np.uint64(b - a)))  # apart from the start of a longer shingle
            else:
                out.append(np.empty(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``size`` 64-bit coordinates for each set; rows of empty sets stay at the largest value."""
    empty = np.iinfo(np.uint64).max
    table = np.full((len(sets), size), empty, np.uint64)
    open_rows = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    t = np.uint64(size)
    with np.errstate(over="ignore"):
        for i in range(2 * size):
            if not len(open_rows):
                break
            x = np.concatenate([sets[r] for r in open_rows])
            row = np.repeat(open_rows, [len(sets[r]) for r in open_rows])
            h = mix64(x + np.uint64(i + 1) * _M1)
            into = ((h >> np.uint64(32)) * t >> np.uint64(32)).astype(np.int64) if i < size else np.full(len(x), i - size)
            # the round stands above the fraction: what an earlier round has put into a bin stays
            value = (np.uint64(i) << np.uint64(48)) | (mix64(h ^ _M3) >> np.uint64(16))
            np.minimum.at(table.reshape(-1), row * size + into, value)
            open_rows = open_rows[(table[open_rows] == empty).any(axis=1)]
    return table


def _bands(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    with np.errstate(over="ignore"):
        key = np.zeros((len(table), bands), np.uint64)
        for k in range(rows):
            key = mix64(key * _M1 + table[:, k::rows][:, :bands] + np.uint64(k + 1))
        return key.view(np.int64)


def _sketch_pass(bands: int, rows: int):
    def make():
        def sketch(piece: pa.RecordBatch, texts: list[bytes]):
            sets = shingle_sets(texts)
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            first = {n: i for i, n in reversed(list(enumerate(nodes))) if n is not None}  # copies of a piece: one sketch
            own = list(first.values())
            keys = dict(zip(first, _bands(sketches([sets[i] for i in own], bands * rows), bands, rows).tolist()))
            return [
                piece.column("doc_id"), piece.column("text_key"), [len(s) for s in sets], nodes,
                [keys[n] if n is not None and first[n] == i else None for i, n in enumerate(nodes)],
            ]

        return sketch

    return make


def bitmap(found: np.ndarray, words: int = BITMAP) -> np.ndarray:
    """Bit i tells whether an odd number of the set's elements fall to i. Two sets differ in at least as many elements as
    their bitmaps in bits."""
    at = (mix64(found ^ _M2) >> np.uint64(32)) * np.uint64(64 * words) >> np.uint64(32)
    odd = np.bincount(at.astype(np.int64), minlength=64 * words).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _sets_pass():
    def sets(piece: pa.RecordBatch, texts: list[bytes]):
        found = shingle_sets(texts)
        nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found]
        return [piece.column("wanted"), nodes, [s.view(np.int64) for s in found], [bitmap(s) for s in found]]

    return sets


def _verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b")

    def check(batches):
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.asarray(x.values), np.asarray(y.values)
                inner = len(x) + len(y) - len(np.union1d(x, y))
                kept.append(100 * inner >= least * (len(x) + len(y) - inner))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(check, "a binary, b binary")


def _of_several(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the groups by ``keys`` that hold several roots, with the root most rows have as ``main``."""
    parts = rows.groupBy(*keys, "root").agg(F.count("*").alias("size"))
    main = parts.groupBy(*keys).agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("parts"))
    return rows.join(main.where("parts > 1").drop("parts"), keys)


def _prefixes(nodes: DataFrame, least: int) -> DataFrame:
    """(node, n, root, set, bits) -> (node, n, root, token, at, short, bits): each set's rarest tokens with their place in
    the order.

    Of two similar sets the larger one's tokens here (``short`` or not) hold one of the smaller one's short ones.
    """
    tokens = nodes.select("node", "n", "root", F.explode("set").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    rarest = Window.partitionBy("node").orderBy("df", "token")
    own = F.col("n") - F.count("*").over(Window.partitionBy("node"))  # tokens of this set alone come first
    ranked = tokens.join(shared, "token").select(
        "node", "n", "root", "token", (own + F.row_number().over(rarest)).alias("at")
    )
    needed = lambda share, of: F.floor((F.lit(share) * F.col("n") + (of - 1)) / of)  # noqa: E731  rounded up
    long, short = F.col("n") - needed(least, 100) + 1, F.col("n") - needed(2 * least, 100 + least) + 1
    rare = ranked.where(F.col("at") <= long).withColumn("short", F.col("at") <= short)
    return rare.join(nodes.select("node", "bits"), "node")  # dealt by node already


def _rare_pairs(rows: DataFrame, least: int) -> DataFrame:
    """Pairs (a > b) with different roots that may be similar. Every pair meets at a short token of its smaller set; of
    each token's rows, those of its main root meet the others only."""
    rows = _of_several(rows, ["token"])
    smaller = rows.where("short").select("token", "main", *(F.col(c).alias(f"{c}_s") for c in ("node", "n", "root", "at", "bits")))
    foreign, main = (rows.where(w).drop("main") for w in ("root <> main", "root = main"))
    few = smaller.where("root_s <> main").drop("main")
    order = (F.col("n_s") < F.col("n")) | ((F.col("n_s") == F.col("n")) & (F.col("node_s") < F.col("node")))
    overlap = F.ceil(least * (F.col("n") + F.col("n_s")) / (100 + least) - 1e-9)
    left = 1 + F.least(F.col("n") - F.col("at"), F.col("n_s") - F.col("at_s"))  # if this is the first they share
    word = lambda of, k: F.get(of, F.lit(k))
    apart = sum(F.bit_count(word("bits", k).bitwiseXOR(word("bits_s", k))) for k in range(BITMAP))
    alike = F.col("n") + F.col("n_s") - apart >= 2 * overlap
    fits = (100 * F.col("n_s") >= least * F.col("n")) & (left >= overlap) & alike
    meets = (F.col("root") != F.col("root_s")) & order & fits
    pairs = smaller.drop("main").join(foreign, "token").where(meets).unionByName(few.join(main, "token").where(meets))
    return pairs.select(F.greatest("node", "node_s").alias("a"), F.least("node", "node_s").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row a document: doc_id, text_key (hash of the text), n_shingles, node, component_id, kept.

    ``component_id`` is the least doc_id reachable over links; ``kept`` says whether it is the row's own.
    """
    kind = dict(docs.dtypes)[id_column]
    columns = {"doc_id": name(id_column), "text_key": F.xxhash64(name(text))}
    schema = f"doc_id {kind}, text_key long, n_shingles long, node binary, bands array<long>"
    marked = stage(map_texts(docs, columns, name(text), _sketch_pass(bands, rows), schema), "sketches")

    # one row a node; its bands stand in at least one row
    nodes = stage(
        marked.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.any_value("bands", True).alias("bands")
        ),
        "nodes",
    )
    members = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("band", "key").agg(F.min("node").alias("leader"), F.count("*").alias("size"))
    shared = buckets.where("size > 1").drop("size")
    members = stage(members.join(shared, ["band", "key"]), "members")
    sizes = nodes.select(F.col("node").alias("leader"), F.col("n").alias("leader_n"))
    first = members.where("node <> leader").select(F.col("node").alias("a"), "n", F.col("leader").alias("b")).distinct()
    first = first.join(sizes.withColumnRenamed("leader", "b"), "b")
    fits = lambda x, y: 100 * F.least(x, y) >= least * F.greatest(x, y)  # noqa: E731  else no overlap is enough
    first = stage(first.where(fits(F.col("n"), F.col("leader_n"))).select("a", "b"), "leaders")

    # sets of all nodes in shared buckets, from the texts of one document each
    wanted = members.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    source = docs.select(name(id_column).alias("doc_id"), name(text).alias("text"))
    found = source.join(
        checked_broadcast(stage(wanted.withColumnRenamed("doc_id", "of"), "wanted")), F.col("doc_id").eqNullSafe(F.col("of"))
    )
    sets = map_texts(found, {"wanted": F.col("node")}, F.col("text"), _sets_pass, SETS)
    sets = stage(sets.where("wanted = node").dropDuplicates(["node"]).select("node", "set", "bits"), "sets")

    links = stage(_verified(first, sets, least), "links")
    roots = components(links)

    # what is left: buckets whose members are in several components
    rooted = stage(
        members.join(roots, "node", "left").select("band", "key", "node", "n", F.coalesce("root", "node").alias("root")), "rooted"
    )
    unsettled = stage(_of_several(rooted, ["band", "key"]).select("node", "n", "root").distinct(), "open")
    rest = _rare_pairs(stage(_prefixes(unsettled.join(sets, "node"), least), "prefixes"), least)
    again = rest.join(first, ["a", "b"], "left_anti")
    more = stage(_verified(again, sets, least), "more")
    roots = components(links.unionByName(more))

    named = nodes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least_id = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    names = stage(named.join(least_id, "root").select("node", "component_id"), "names")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        marked.drop("bands")
        .join(names, "node", "left")
        .withColumn("component_id", component)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "text_key", "n_shingles", "node", "component_id", "kept")
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each component, the columns of ``docs``; rows without words all stay, but copies of a row with its id."""
    found = stage(near_duplicates(docs, id_column, text, **how), "found")
    key = ["doc_id", "text_key"]
    per_row = found.groupBy(*key).agg(F.count("*").alias("n"), F.bool_and("kept").alias("kept"), F.max("n_shingles").alias("s"))
    few = checked_broadcast(stage(per_row.where("NOT kept OR (n > 1 AND s > 0)"), "decided"))
    rows = docs.select(
        F.struct(*map(name, docs.columns)).alias("row"), name(id_column).alias("doc_id"), F.xxhash64(name(text)).alias("text_key")
    )
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("text_key") == F.col("text_key_"))
    decided = few.select(*(F.col(c).alias(f"{c}_") for c in key), F.col("kept").alias("keep_one"))
    joined = rows.join(decided, same, "left")
    single = joined.where("keep_one IS NULL").select("row.*")
    repeated = joined.where("keep_one").groupBy(*key).agg(F.any_value("row").alias("row")).select("row.*")
    return single.unionByName(repeated)
