"""Repeated passages against brute force; odd input."""

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import passages, queries

LONG = 50


def expected(rows, length=LONG):
    least = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for s in range(len(data) - length + 1) if doc_id is not None else ():
            w = data[s : s + length]
            least[w] = min(least.get(w, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - length + 1) if doc_id is not None else ():
            if least[data[s : s + length]] < doc_id:
                gone[s : s + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int(np.sum(gone[1:] & ~gone[:-1]) + gone[0])
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdeé東 ") for _ in range(draw.randrange(1, 9))) for _ in range(60)]
    prose = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    shared = [prose(draw.randrange(8, 60)) for _ in range(6)]
    texts = [None, "", "x" * 49, "x" * 50, "x" * 500, "ab" * 300, "x" * 51, shared[0], shared[0]]
    for _ in range(60):
        parts = [draw.choice(shared) if draw.random() < 0.4 else prose(draw.randrange(40)) for _ in range(draw.randrange(1, 6))]
        text = " ".join(parts)
        texts.append(text[draw.randrange(9) :])
        if draw.random() < 0.3:  # a near copy
            cut = draw.randrange(len(text) + 1)
            texts.append(text[:cut] + draw.choice(["", "q", "zz"]) + text[cut:])
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    return [*rows, rows[3], (None, shared[1]), (None, None), (7, shared[2]), (7, shared[3]), (-5, shared[2] + "tail")]


@pytest.mark.parametrize("crowd, stretch", [(2000, 1 << 20), (2, 64)])
def test_query_is_brute_force(spark, tmp_path, monkeypatch, crowd, stretch):
    rows = corpus(stretch)
    spark.createDataFrame([(i, t, "s", b"k") for i, t in rows], "doc_id long, text string, spans string, mark binary").repartition(
        5
    ).write.parquet(f"{tmp_path}/documents.parquet")
    if crowd == 2:  # short stretches of text and single strings; the settings reach the workers in the closures' arguments
        docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
        found = passages.repeated_passages(docs, crowd=crowd)
        got = [
            (r.doc_id, r.n_bytes, sum(b - a for a, b in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
            for r in found.collect()
        ]
    else:
        got = [tuple(r) for r in queries.op13_repeated_passages(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == expected(rows)


def test_other_lengths_and_names(spark):
    rows = [(3, "hello wonderful world"), (1, "a wonderful day"), (2, "wonder why"), (9, "nothing")]
    docs = spark.createDataFrame([(t, i, 0) for i, t in rows], "`the text` string, `x.id` int, `a-b` int")
    found = passages.repeated_passages(docs, "x.id", "the text", length=6, trigger=3).collect()
    got = [(r.doc_id, r.n_bytes, sum(b - a for a, b in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found]
    assert sorted(got, key=repr) == expected(rows, 6)


def test_stretches_do_not_change_the_phrases(monkeypatch):
    text = "".join(random.Random(5).choice("abc") for _ in range(5000)).encode()

    def strings():
        return {
            s: int(p.at[k] - p.shift[k])
            for p in passages.phrases_of([text[:700], text], 50, 20) for k in range(len(p.at))
            for s in range(int(p.first[k] - p.shift[k]) + 10_000 * int(p.doc[k]), int(p.last[k] - p.shift[k]) + 1 + 10_000 * int(p.doc[k]))
        }

    whole = strings()
    assert len(whole) == 651 + 4951
    monkeypatch.setattr(passages, "_STRETCH", 100)
    assert strings() == whole


def test_rolling_hashes_are_those_of_the_bytes():
    data = np.frombuffer(b"abcabcabcdabcabcabcd" * 3, np.uint8)
    for width in (1, 2, 5, 7, 20, 24):
        found = passages.rolling_hashes(data, width)
        assert len(found) == len(data) - width + 1
        by_bytes = {}
        for i, h in enumerate(found.tolist()):
            assert by_bytes.setdefault(data[i : i + width].tobytes(), h) == h
        assert len(set(by_bytes.values())) == len(by_bytes)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert passages.repeated_passages(empty).count() == 0
