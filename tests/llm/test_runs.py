"""Periodic runs against brute force; odd input."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import queries, runs


def slow_runs(x, exponent, least):
    found = set()
    for q in range(1, len(x) // exponent + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            length = j + q - i
            whole = j > i and length >= max(least, exponent * q)
            if whole and not any(x[i : i + length - r] == x[i + r : i + length] for r in range(1, q)):
                found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words_are_those_of_brute_force():
    draw = random.Random(7)
    for _ in range(600):
        x = [draw.randrange(draw.choice([1, 2, 3, 6])) for _ in range(draw.randrange(70))]
        if x and draw.random() < 0.5:
            a, p = draw.randrange(len(x)), 1 + draw.randrange(7)
            x = [x[i] if i < a else x[min(a + (i - a) % p, len(x) - 1)] for i in range(len(x))]
        for exponent, least in ((2, 2), (3, 1), (4, 6)):
            got = [tuple(r) for r in runs.find_runs(np.array([*x, 99]), exponent, least).tolist()]
            assert got == slow_runs(x, exponent, least)


def test_one_word_very_often():
    x = np.zeros(300_001, np.int64)
    x[-1] = 1
    assert runs.find_runs(x, 4, 6).tolist() == [[0, 300_000, 1]]


def test_lookups_in_parts(monkeypatch):
    x = np.array([0, 1] * 40 + [2] * 9 + [3])
    whole = runs.find_runs(x, 2, 2).tolist()
    monkeypatch.setattr(runs, "LOOKUPS", 3)
    assert runs.find_runs(x, 2, 2).tolist() == whole


TEXTS = [
    None, "", " \n", "a", "a a a a a a", "a a a a a", "x y x y x y x y", "b a a a a a a c", "é é  é\té é é é",
    "p q p q p q p q p q r r r r r r r", "word " * 20_000, " ".join(map(str, range(500))) + " z" * 7, "a b c " * 50 + "a b",
]


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = slow_runs(w, 4, 6) if n < 1000 else [(0, n, 1)]
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    lost = {i for s, length, q in found for i in range(s + q, s + length)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(found), *best, 1000 * best[1] // best[2] if found else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in found)), digest(" ".join(x for i, x in enumerate(w) if i not in lost)),
    )


def test_query_is_brute_force(spark, tmp_path):
    draw = random.Random(11)
    texts = TEXTS + [" ".join(draw.choice("ab") for _ in range(draw.randrange(80))) for _ in range(150)]
    rows = [(i, t, "r", 1, "s") for i, t in enumerate(texts)]
    rows += [rows[4], (None, "k " * 9, "r", 1, "s"), (None, None, "r", 1, "s")]
    columns = "doc_id long, text string, runs string, id int, words string"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op12_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted([(r[0], *expected(r[0], r[1])) for r in rows], key=repr)
    assert any(r[1] and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in got)


def test_planted_names_and_empty_table(spark):
    empty = spark.createDataFrame([], "`a-b` int, `x.y` string, doc_id long, text string")
    assert runs.periodic_runs(runs.with_planted_runs(empty)).count() == 0
    odd = spark.createDataFrame([("n1", "q q q q q q", 3)], "`x.id` string, `the text` string, `a-b` int")
    row = runs.periodic_runs(odd, "x.id", "the text").select("doc_id", "n_words", F.col("strongest.length"), "collapsed").first()
    assert tuple(row) == ("n1", 6, 6, "q")
