"""Narrow text operators against brute force: words, tokenisers, licences, mixing, lists; and odd input."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from millrace.llm import bpe, licenses, mixing, quality, unigram, urllists

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, words string"


def texts():
    draw = random.Random(3)
    alphabet = "abcde éßΣİ東😀'12.,!#|<>\t\n ​ь"
    odd = [
        None, "", " \n\t", "a", "a a a a a a", "x " * 60, "don't I'LL <|endoftext|> go<|startoftext|>", "a" * 3000,
        "one two three\none two three\nfour", "\x1c\x1da\x85b c", "ΑΣ ΟΔΟΣ", "<unk> <0x41> ▁▁ ▁", "word " * 20_000,
    ]
    return odd + ["".join(draw.choice(alphabet) for _ in range(draw.randrange(400))) for _ in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 7 else None, 0, 5, "r", "w") for i, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[5], (None, "no id " * 30, "fr", "s1", 0, 5, "r", "w")], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_base_columns(docs):
    rows = quality.quality(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    for i, text in enumerate(texts()):
        w, r = words(text), by_id[i]
        windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert r.kept == (r.reason is None) and not (r.base_failed and r.kept)


def test_quality_tokens_are_those_of_the_library(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=quality.VOCABULARY)
    by_id = {r.doc_id: r for r in quality.quality(docs).collect()}
    for i, text in enumerate(texts()):
        ids = [t for w in words(text) for t in model.encode(w)]
        assert by_id[i].n_tokens == len(ids) and by_id[i].n_byte_tokens == sum(map(model.IsByte, ids))


def test_quality_bands_reject(spark):
    junk = [(1, "ab " * 80, "en"), (2, " ".join(f"w{k}x{k * 7}" for k in range(200)), "en"), (3, " ".join(map(chr, range(0x13000, 0x13100))), "xx")]
    got = {r.doc_id: r.reason for r in quality.quality(spark.createDataFrame(junk, "doc_id int, text string, lang string")).collect()}
    assert got[1] == "base" and got[2] == "few characters a token" and got[3] in ("few characters a token", "byte fallback")


def test_unigram_counts_are_those_of_the_library(docs):
    vocabulary = unigram.zipf_vocabulary()
    for fallback in (True, False):
        own = [v for v in vocabulary if fallback or not v[0].startswith("<0x")]
        library, viterbi = models.Unigram(own, 0, fallback), unigram.CountingViterbi(own)
        for word in {w for t in texts() for w in words(t)}:
            assert viterbi.count("▁" + word)[0] == len(library.tokenize("▁" + word)), word
    library = models.Unigram(vocabulary, 0, True)
    by_id = {r.doc_id: r.n_tokens for r in unigram.token_counts(docs).collect()}
    for i, text in enumerate(texts()):
        assert by_id[i] == sum(len(library.tokenize("▁" + w)) for w in words(text))


def test_unigram_ties_go_to_the_earliest_start():
    own = [("<unk>", -9.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0), ("ab", -2.0)]
    library, viterbi = models.Unigram(own, 0, False), unigram.CountingViterbi(own)
    for word in ("a", "aa", "aaaa", "aaab", "abab", "bcb", "ccc", "acca"):
        assert viterbi.count(word)[0] == len(library.tokenize(word)), word


def test_bpe_is_the_library(docs):
    library = Tokenizer.from_file(bpe.VOCABULARY)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = {r.doc_id: r.ids for r in bpe.encode(docs).collect()}
    rows = {r.doc_id: r for r in bpe.digests(docs).collect()}
    for i, text in enumerate(texts()):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids[i] == want and rows[i].n_tokens == len(want)
        assert rows[i].ids_sha256 == digest(" ".join(map(str, want)))
        assert rows[i].decoded_sha256 == digest(library.decode(want, skip_special_tokens=False)) == digest(bpe.decode(want))


def test_bpe_overlapping_and_long_words():
    library, own = Tokenizer.from_file(bpe.VOCABULARY), bpe.Bpe(bpe.VOCABULARY)
    some = ["a" * n for n in range(1, 40)] + ["ab" * 500, "ééé", "the", "😀" * 9]
    ids, counts = own.encode_words(some)
    ends = counts.cumsum()
    for word, a, b in zip(some, ends - counts, ends):
        assert ids[a:b].tolist() == library.encode(word, add_special_tokens=False).ids


def test_license_rules(spark):
    s = licenses.SENTENCES
    mit = f"# {s['mit_grant']}:\n\n{s['mit_notice']}.\n\n{s['as_is_upper']}."
    cases = [
        ("no dot before\nLicensed under the Apache License, Version 2.0.\nmore", "Apache-2.0-notice"),
        (mit, "MIT"), (mit.replace(" of ", "\n  * of "), "MIT"), (s["mit_notice"] + ". " + s["mit_grant"] + ".", ""),
        (f"{s['gpl_free']}; {s['gpl_2_later']}; {s['gpl_2_version']}. {s['gpl_hope']}.", "GPL-2.0-or-later"),
        ("Released under the MIT License. Licensed under CC BY-NC 4.0. Released under the MIT License.", "CC-BY-NC-4.0-notice,MIT-notice"),
        (None, ""), ("", ""), ("We released the film under the rules.", ""),
    ]
    found = licenses.scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id int, text string")).collect()
    assert [",".join(r.licenses) for r in sorted(found)] == [want for _, want in cases]


def level(sizes, weights, total):
    """Targets by trying every set of full sources, smallest ratio first."""
    order = sorted(range(len(sizes)), key=lambda i: 2 * sizes[i] / weights[i])
    full = set()
    for i in [None, *order]:
        full |= {i} - {None}
        rest = [j for j in range(len(sizes)) if j not in full]
        if not rest:
            break
        share = (total - sum(2 * sizes[j] for j in full)) / sum(weights[j] for j in rest)
        if all(share * weights[j] < 2 * sizes[j] for j in rest):
            return [2 * sizes[j] if j in full else share * weights[j] for j in range(len(sizes))]
    return [2 * x for x in sizes]


def test_mix(spark, docs):
    big = [(i, "w " * (1 + i % 40), "en", f"t{'zyx'[i % 3]}" if i % 11 else None, 0, 5, "r", "w") for i in range(3000)]
    table = docs.unionByName(spark.createDataFrame(big, DOCS))
    rows = mixing.mix_sizes(table).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    names = sorted((n for n in sizes if n is not None)) + [None]
    want = dict(zip(names, level([sizes[n] for n in names], [(5, 2, 1)[k % 3] for k in range(len(names))], 1.5 * sum(sizes.values()))))
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for n in (None, "tx", "ty", "tz"):
        assert taken[n] == pytest.approx(want[n], rel=0.25)
    again = mixing.mix(table)
    assert again.columns == table.columns
    assert again.count() == sum(r.copies for r in rows)


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert mixing.mix_sizes(none).count() == 0 and mixing.mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, "en", None, 0, 5, "r", "w")], DOCS)
    assert [(r.target, r.taken) for r in mixing.mix_sizes(blank).collect()] == [(0.0, 0)]


def test_list_intervals_and_hosts(spark):
    changes = spark.createDataFrame(
        [("x", "a.com", "2024-01-10", True), ("x", "a.com", "2024-02-01", False), ("x", "a.com", "2024-02-01", True),
         ("x", "a.com", "2024-03-05", True), ("y", "com", "2024-01-20", True), (None, "a.com", "2024-01-01", True),
         ("z", "b.com", "2024-01-01", None)],
        "list string, key string, changed string, active boolean",
    ).withColumn("changed", F.col("changed").cast("date"))
    captures = spark.createDataFrame(
        [(1, "http://u@S.A.com:80/x", "2024-01-09"), (2, "http://a.com", "2024-01-31"), (3, "http://a.com", "2024-02-01"),
         (4, "https://a.com?q", "2025-06-01"), (5, "no url", "2024-03-05"), (6, None, "2024-03-05"), (7, "http://a.com", None),
         (2, "http://a.com", "2024-01-31"), (8, "http://xa.com/", "2024-03-06")],
        "rid int, url string, day string",
    )
    intervals = urllists.validity_intervals(changes)
    found = urllists.listed_captures(captures, intervals, "url", "day").select("row.rid", "lists", "n_active", "blocked").collect()
    assert sorted(map(tuple, found)) == [
        (1, None, 0, False), (2, "x,y", 2, True), (2, "x,y", 2, True), (3, "y", 1, True), (4, "x,y", 2, True),
        (5, None, 0, False), (6, None, 0, False), (7, None, 0, False), (8, "y", 1, True),
    ]
    assert urllists.listed_captures(captures.limit(0), intervals, "url", "day").count() == 0
    assert urllists.listed_captures(captures, intervals.limit(0), "url", "day").where("blocked").count() == 0


@pytest.mark.parametrize("scan", [quality.quality, unigram.token_counts, bpe.digests, licenses.scan])
def test_empty_tables(spark, scan):
    assert scan(spark.createDataFrame([], DOCS)).count() == 0


def test_bpe_workers_hold_the_vocabulary_once():
    model, full = bpe.Bpe(bpe.VOCABULARY), Tokenizer.from_file(bpe.VOCABULARY)
    assert model.library.get_vocab_size() == 0  # it normalises and splits only
    text = "Ab \u03a3\u0130 x<|endoftext|>\u01c5\U0001f600 e\u0301\u3000 it's 12"
    assert model.library.normalizer.normalize_str(text) == full.normalizer.normalize_str(text)
    assert model.library.pre_tokenizer.pre_tokenize_str(text) == full.pre_tokenizer.pre_tokenize_str(text)
