"""Operators over the whole corpus against brute force: near duplicates, neighbours, toxicity, language model, pipeline."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import components, hmm, lsh, minhash, toxicity

KIND = "doc_id long, text string, lang string, source string, node string, bands string"


def family(draw, size, n, edits):
    base = [f"w{draw.randrange(500)}" for _ in range(size)]
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(size)] = f"x{draw.randrange(10**6)}"
        yield " ".join(copy)


def corpus():
    draw = random.Random(5)
    out = [None, "", " \n", "one two", "ONE two", "one two three four five", "É é", "é É", "z " * 500]
    for size, n, edits in ((60, 25, 3), (200, 25, 7), (150, 40, 6), (12, 10, 1), (7, 10, 1)):
        out += family(draw, size, n, edits)
    out += [out[20]] * 15 + [" ".join(f"u{draw.randrange(10**6)}" for _ in range(80)) for _ in range(30)]
    return out


def sets(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(texts):
    found = [sets(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            inner = len(found[i] & found[j])
            if inner and 100 * inner >= 85 * (len(found[i]) + len(found[j]) - inner):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return found, label


@pytest.mark.parametrize("bands, rows", [(24, 6), (30, 2)])
def test_near_duplicates(spark, bands, rows):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", "n", "b") for i, t in enumerate(texts)], KIND)
    found, label = brute(texts)
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, bands=bands, rows=rows).collect()}
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(found[i]), label[i], label[i] == i), texts[i]


def test_keep_one(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (1, "other words are here now"), (None, "null id"),
            (None, "null id"), (3, None), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", "n", "b") for i, t in rows], KIND)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [g for g in got if g[0] in (1, 2)] == [(1, "a b c d e f"), (1, "other words are here now")]
    assert [g[0] for g in got if g[0] in (3, 4, 5)] == [3, 4, 5]
    assert minhash.keep_one(docs.limit(0)).count() == 0


def test_sketches_fill_and_estimate():
    draw = random.Random(1)
    base = [f"t{k}" for k in range(400)]
    other = [w if draw.random() < 0.97 else f"q{k}" for k, w in enumerate(base)]
    found = minhash.shingle_sets([" ".join(base).encode(), " ".join(other).encode(), b"only two", b""])
    table = minhash.sketches(found, 1024)
    top = np.iinfo(np.uint64).max
    assert (table[:3] != top).all() and (table[3] == top).all()
    inner = len(np.intersect1d(found[0], found[1]))
    assert (table[0] == table[1]).mean() == pytest.approx(inner / (len(found[0]) + len(found[1]) - inner), abs=0.06)


def test_bitmaps_never_overstate_the_difference():
    rng = np.random.default_rng(3)
    for size in (1, 40, 300, 5000):
        x = rng.integers(0, 1 << 63, size, np.int64).astype(np.uint64)
        y = np.concatenate([x[size // 6 :], rng.integers(0, 1 << 63, size // 5, np.int64).astype(np.uint64)])
        bits = sum(int(w).bit_count() for w in (minhash.bitmap(x) ^ minhash.bitmap(y)).view(np.uint64))
        assert bits <= len(np.setxor1d(x, y)) and len(minhash.bitmap(x)) == minhash.BITMAP
        assert not (minhash.bitmap(x) ^ minhash.bitmap(x[::-1])).any()
    assert not minhash.bitmap(x[:0]).any()


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (201, 200), (200, 201)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {k: 0 for k in range(41)} | {100 + k: 100 for k in range(60)} | {200: 200, 201: 200}
    assert {r.node: r.root for r in found} == want and len(found) == len(want)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + 0.4 * rng.normal(size=16)]) for i in range(4000)]
    rows += [(5000 + i, rows[0][1]) for i in range(700)]
    bad = [(9000, None), (9100, [0.0] * 16), (9200, [float("nan")] * 16), (9300, [1.0]), (None, rows[1][1]), (9400, [None] * 16)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    found = {}
    for r in lsh.nearest(table, F.col("id") % 100 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], np.float32).astype(float)
    hits = 0
    queries = [i for i in ids if i % 100 == 0]
    assert sorted(found) == sorted(queries)
    for q in queries:
        apart = np.sqrt(((points - points[ids == q][0]) ** 2).sum(1))
        order = [k for k in np.lexsort((ids, apart)) if ids[k] != q][:10]
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 11)) and got == sorted(got, key=lambda g: (g[1], g[2]))
        assert all(g[1] == pytest.approx(apart[ids == g[2]][0], abs=1e-12) for g in got)
        hits += len({g[2] for g in got} & set(ids[order].tolist()))
    assert hits >= 0.9 * 10 * len(queries)


def test_repeated_rows_take_one_place(spark):
    rows = [(0, [0.0, 1.0])] + [(1, [0.5, 1.0])] * 30 + [(i, [float(i), 1.0]) for i in range(2, 15)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.vec_id, r.score) for r in lsh.nearest(table, F.col("id") == 0).orderBy("rank").collect()]
    assert got == [(1, 0.5)] + [(i, float(i)) for i in range(2, 11)]


@pytest.mark.parametrize("exact, spread", [(256, 0.02), (0, 0.02), (0, 0.0)])
def test_sparse_rows_beside_dense_groups(spark, monkeypatch, exact, spread):
    monkeypatch.setattr(lsh, "EXACT", exact, raising=False)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 12))
    dense = centres[np.arange(2400) % 20] + spread * rng.normal(size=(2400, 12))
    points = np.concatenate([dense, rng.normal(size=(600, 12)), 5 * rng.normal(size=(300, 12))])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    got = {}
    for r in lsh.nearest(table, F.col("id") % 10 == 0).collect():
        got.setdefault(r.query_id, []).append(r.score)
    parts = {"dense": [], "sparse": [], "far": []}
    for q in range(0, 3300, 10):
        apart = np.sqrt(((points - points[q]) ** 2).sum(1))
        kth = np.sort(np.delete(apart, q))[9] * (1 + 1e-9)
        found = sum(s <= kth for s in got.get(q, ()))
        parts["dense" if q < 2400 else "sparse" if q < 3000 else "far"].append(found)
    assert all(np.mean(found) >= 9.7 and min(found) >= 7 for found in parts.values()), {p: np.mean(f) for p, f in parts.items()}


def test_few_vectors_are_all_found(spark):
    table = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.score) for r in lsh.nearest(table, F.col("id") == 0).orderBy("rank").collect()] == [
        (1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0),
    ]
    assert lsh.nearest(table.limit(0), F.col("id") == 0).count() == 0


def test_probes_come_in_order_of_probability():
    tables = lsh.Tables.draw(8, 3, 1.0, tables=1, recall=0.999)
    place = tables.places(np.random.default_rng(0).normal(size=(1, 8)))[0, 0]
    slots = tables.probes(place)
    sigma = tables.distance / tables.width
    cdf = lambda x: 0.5 * math.erfc(-x / (sigma * math.sqrt(2)))
    chance = [math.prod(cdf(s + 1 - p) - cdf(s - p) for s, p in zip(row, place)) for row in slots]
    assert chance == sorted(chance, reverse=True) and sum(chance) >= tables.share - 1e-9 and len(set(map(tuple, slots))) == len(slots)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    idf = rng.uniform(1, 5, 40)
    rows = [({int(t): int(n) for t, n in zip(rng.choice(40, k, False), rng.integers(1, 4, k))}, int(rng.random() < 0.3)) for k in rng.integers(0, 6, 700)]
    index = toxicity.Index.build({}, idf, rows)
    vectors = [toxicity.unit(t, idf) for t, _ in rows]
    dense = np.zeros((len(rows), 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    bare = np.array([not t for t, _ in rows])
    for t, w in vectors[:200]:
        if not len(t):
            continue
        q = np.zeros(40)
        q[t] = w
        cosine = dense @ q
        order = [i for i in np.lexsort((np.arange(len(rows)), -np.round(cosine, 12))) if not bare[i]][:25]
        places, scores = index.nearest(t, w, 25)
        assert np.allclose(scores, cosine[order]) and np.allclose(np.sort(cosine[index.number[places]]), np.sort(cosine[order]))
        assert index.number[places].tolist() == order


def test_toxicity_on_unseen_texts(spark):
    draw = random.Random(8)
    bad = ["grobnik", "zlurvan", "mufheit"]
    rows = []
    for i in range(900):
        toxic = i % 5 == 0
        body = [f"w{draw.randrange(3000)}" for _ in range(draw.randrange(30, 90))]
        if toxic:
            for _ in range(3):
                body[draw.randrange(len(body))] = draw.choice(bad) + draw.choice(["", "a", "est", "."])
        rows.append((i, " ".join(body), "en", "s", "n", "b", int(toxic)))
    rows += [(1000, None, "en", "s", "n", "b", 0), (1001, "", "en", "s", "n", "b", 0)]
    table = spark.createDataFrame(rows, KIND + ", toxic int")
    labels = table.select("doc_id", "toxic")
    got = {r.doc_id: r for r in toxicity.scores(table, labels).collect()}
    assert len(got) == len(rows)
    for i, *_, toxic in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1
    unseen = [(got[r[0]].predicted, r[-1]) for r in rows if got[r[0]].held_out]
    assert sum(a == b for a, b in unseen) >= 0.97 * len(unseen)
    clean = toxicity.keep_clean(table, labels)
    assert clean.columns == table.columns and clean.count() == sum(not r.predicted for r in got.values())
    for none in (labels.limit(0), labels.where("toxic = 0")):
        assert toxicity.scores(table, none).where("predicted = 1 OR score > 0.3").count() == 0
    assert toxicity.scores(table.limit(0), labels).count() == 0


def test_rare_toxic_labels_are_examples(spark):
    draw = random.Random(18)
    rows = []
    for i in range(4000):
        body = [f"w{draw.randrange(3000)}" for _ in range(12)] + (["grobnik"] if i % 100 == 0 else [])
        rows.append((i, " ".join(body), int(i % 100 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.scores(table, table.select("doc_id", "toxic"), examples=400).where("held_out")
    marked = {r.doc_id: r.predicted for r in got.collect()}
    toxic = [i for i in marked if i % 100 == 0]
    assert toxic and all(marked[i] for i in toxic) and sum(marked.values()) <= len(toxic) + 0.01 * len(marked)


def test_words_of_few_toxic_texts_are_learnt(spark):
    draw = random.Random(3)
    names = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(75)]
    rows = []
    for i in range(3000):
        body = [f"w{draw.randrange(3000)}" for _ in range(12)]
        if i % 10 == 0:  # each word in four texts
            body[draw.randrange(12)] = names[i // 40]
        rows.append((i, " ".join(body), int(i % 10 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.scores(table, table.select("doc_id", "toxic")).where("held_out").collect()
    toxic = [r.predicted for r in got if r.doc_id % 10 == 0]
    assert sum(toxic) >= 0.93 * len(toxic) > 0
    assert sum(r.predicted for r in got if r.doc_id % 10) <= 0.01 * len(got)


def test_rare_and_shared_terms_are_chosen(spark):
    counts = spark.createDataFrame([("rare", 0, 8), ("shared", 60, 40), ("clean", 90, 2)], "term string, clean long, toxic long")
    assert sorted(toxicity.choose_terms(counts, 3520, 480)) == ["rare", "shared"]


def test_hmm_recursions_by_enumeration():
    rng = np.random.default_rng(1)
    share = lambda *shape: (x := rng.uniform(0.1, 1, shape)) / x.sum(-1, keepdims=True)
    model = hmm.Hmm(share(3), share(3, 3), share(3, 5).T.copy())
    texts = [rng.integers(0, 5, n).astype(np.int32) for n in (1, 4, 2, 4)]
    group = hmm.Lockstep(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for text, log in zip(texts, group.log10(model)):
        paths = np.array(np.meshgrid(*[range(3)] * len(text))).reshape(len(text), -1).T
        chance = np.array([model.start[p[0]] * np.prod(model.emit[text, p]) * np.prod(model.move[p[:-1], p[1:]]) for p in paths])
        assert 10**log == pytest.approx(chance.sum())
        for p, c in zip(paths, chance / chance.sum()):
            start[p[0]] += c
            np.add.at(emit, (text, p), c)
            np.add.at(move, (p[:-1], p[1:]), c)
    for got, want in zip(group.expected(model), (start, move, emit)):
        assert np.allclose(got, want)


def test_hmm_scores(spark):
    draw = random.Random(6)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{int(draw.paretovariate(0.6))}" for _ in range(40)).title()) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "Never seen words"), (None, "a1 b1"), (3, rows[3][1])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = hmm.score(table, states=3, rounds=4, head=50).collect()
    assert len(got) == len(rows)
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    aside = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not aside(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = {(i, t): tokens(t) for i, t in rows}
    texts = dict(rows)
    for r in got:
        w = want[r.doc_id, texts[r.doc_id]]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (aside(r.doc_id), len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
    unseen = [r for r in got if r.held_out and r.n_tokens == 41]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert hmm.score(table.limit(0), states=2, rounds=1).count() == 0


def test_hmm_shuffles_packed_numbers(spark):
    rng = np.random.default_rng(4)
    for states in (1, 3, 8):
        table = np.exp(rng.normal(0, 6, (50, states)))
        table[3] = 0
        longs = hmm.packed(table, -32)
        assert len(longs) == -(-states // 3)
        back = hmm.unpacked(longs, states, -32, 0.5)
        assert np.allclose(back, table, rtol=2e-5, atol=0) and not back[3].any()
        names = [f"s{k}" for k in range(states)]
        rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(table)], ["i", *names])
        rows = rows.select("i", *hmm._packed([F.col(s) for s in names], -32))
        rows = rows.select("*", *(v.alias(s) for s, v in zip(names, hmm._unpacked(states, -32, 0.5)))).orderBy("i").collect()
        assert np.allclose([[r[s] for s in names] for r in rows], table, rtol=2e-5, atol=0)
    texts = [rng.integers(0, 200_000, n).astype(np.int32) for n in (1, 0, 2000)]
    small = [hmm.shrunk(t) for t in texts]
    assert len(small[2]) < 4 * 2000 * 0.7
    flat, bounds = hmm.numbers(pa.array(small, pa.binary()).slice(1))
    assert bounds.tolist() == [0, 0, 2000] and (flat == texts[2]).all()


def test_hmm_is_the_same_for_any_head(spark):
    draw = random.Random(16)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{int(draw.paretovariate(0.6))}" for _ in range(30))) for i in range(200)]
    rows += [(1000, None), (1001, "never seen words"), (1002, "never a1 seen b99999999 seen")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    runs = [{r.doc_id: r for r in hmm.score(table, states=3, rounds=3, head=h).collect()} for h in (20, 10**6)]
    assert len(runs[0]) == len(runs[1]) == len(rows)
    for i, r in runs[1].items():
        assert runs[0][i][:5] == r[:5]
        assert (runs[0][i].base_score, runs[0][i].score) == pytest.approx((r.base_score, r.score), rel=1e-5)


def test_hmm_rows_grow_with_chunks_and_not_with_words(spark, monkeypatch):
    """Chunks and blocks, however many, give the model of one; what a round stages has far fewer rows than there are words."""
    draw = random.Random(26)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{int(draw.paretovariate(0.4))}" for _ in range(40))) for i in range(300)]
    rows += [(1000, None), (1001, "never seen words"), (None, "a1 b1"), (3, rows[3][1])]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    staged, stage = [], hmm.stage

    def counted(df, name):
        made = stage(df, name)
        staged.append((name, made.count()))
        return made

    monkeypatch.setattr(hmm, "stage", counted)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
    whole = sorted(hmm.score(table, states=3, rounds=3, head=20).collect(), key=key)
    words = dict(staged)["counts"]
    rounds = [n for name, n in staged if name == "summed"]
    assert len(rounds) == 3 and words > 1000 and max(rounds) < words / 20
    for chunk, block in ((3000, 10**6), (10**6, 300), (1000, 1000)):
        monkeypatch.setattr(hmm, "_CHUNK", chunk)
        monkeypatch.setattr(hmm, "_BLOCK", block)
        cut = sorted(hmm.score(table, states=3, rounds=3, head=20).collect(), key=key)
        assert [r[:5] for r in cut] == [r[:5] for r in whole]
        for a, b in zip(cut, whole):
            assert (a.base_score, a.score) == pytest.approx((b.base_score, b.score), rel=2e-5)


def test_hmm_messages_and_words():
    rng = np.random.default_rng(5)
    tables = [np.exp(rng.normal(0, 12, (n, 8))) for n in (3, 0, 50)]
    tables[0][1] = 0
    small = [hmm.shortened(t) for t in tables]
    assert [len(x) for x in small] == [24 * len(t) for t in tables]
    assert np.allclose(hmm.lengthened(small, 8), np.concatenate(tables), rtol=1.6e-5, atol=0)
    assert hmm.lengthened([], 8).shape == (0, 8)
    draw = random.Random(3)
    odd = b" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\xc2\xc3ABab\x00"
    texts = [b"", b" ", b" A b ", *(bytes(draw.choices(odd, k=draw.randint(0, 40))) for _ in range(200))]
    for part in (texts, texts[2:], []):
        flat, words, sizes = hmm.tokens(pa.array(texts, pa.binary()).slice(len(texts) - len(part)))
        words = words.to_pylist()
        assert [words[i] for i in flat] == [w for t in part for w in t.lower().split()]
        assert sizes.tolist() == [len(t.split()) for t in part]


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("extra", F.lit(1))
    total = docs.count()
    for k, (label, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, folder)
        assert k == len(corpus_pipeline.STAGES) - 1 or made.columns == docs.columns, label
        docs = made
    assert 0 < docs.count() < 2 * total
