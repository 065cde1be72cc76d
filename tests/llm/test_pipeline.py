"""Each stage of the pipeline on what the one before kept: base rules, near duplicates, mix and tokens by brute force, the
verdicts of the token bands and of toxicity against the operators' own scores."""

import hashlib
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import bpe, quality, toxicity

from .test_corpus_ops import brute
from .test_text_ops import level

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
STAGES = dict(corpus_pipeline.STAGES)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(9000, None, "en", "web"), (9001, "", None, None), (9002, " \n", "xx", "web"), (9003, "short text", "en", None)]
    more = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.lit(0))
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    more = more.select(*(F.col(c).cast(t) for c, t in table.dtypes))
    return table.unionByName(more).unionByName(table.where("doc_id < 20")).withColumn("a-b", F.lit(1))


def test_quality_stage(spark, docs):
    made = STAGES["quality rules"](spark, docs, FOLDER)
    assert made.columns == docs.columns
    want = Counter()
    verdict = {r.doc_id: r.kept for r in quality.quality(docs).select("doc_id", "kept").collect()}
    for r in docs.collect():
        w = words(r.text)
        windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        if len(w) < 50 or 2 * len(covered) > len(w):
            assert not verdict[r.doc_id]
        elif verdict[r.doc_id]:
            want[r.doc_id] += 1
    assert ids(made) == want and len(want) > 50


def test_toxicity_stage(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic")
    made = STAGES["toxicity"](spark, docs, FOLDER)
    assert made.columns == docs.columns
    clean = {r.doc_id for r in toxicity.scores(docs, labels).where("predicted = 0").collect()}
    assert ids(made) == Counter({i: n for i, n in ids(docs).items() if i in clean})


def test_near_duplicate_stage(spark, docs):
    made = STAGES["near duplicates"](spark, docs, FOLDER)
    assert made.columns == docs.columns
    rows = sorted({(r.doc_id, r.text or "") for r in docs.collect()})
    _, label = brute([t for _, t in rows])
    assert ids(made) == Counter(rows[k][0] for k in range(len(rows)) if label[k] == k)


def test_mix_stage(spark, docs):
    made = STAGES["source mix"](spark, docs, FOLDER)
    assert made.columns == docs.columns
    sizes, rows = Counter(), docs.collect()
    for r in rows:
        sizes[r.source] += len(words(r.text))
    names = sorted(n for n in sizes if n is not None) + [None]
    targets = level([sizes[n] for n in names], [(5, 2, 1)[k % 3] for k in range(len(names))], 1.5 * sum(sizes.values()))
    rate = {n: t / sizes[n] if sizes[n] else 0.0 for n, t in zip(names, targets)}
    want = Counter()
    for r in rows:
        draw = int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        want[r.doc_id] += int(rate[r.source]) + (draw < rate[r.source] % 1)
    assert ids(made) == +want


def test_bpe_stage(spark, docs):
    made = Counter(map(tuple, STAGES["word BPE"](spark, docs, FOLDER).collect()))
    library, want = Tokenizer.from_file(bpe.VOCABULARY), Counter()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in docs.collect():
        found = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(found), digest(" ".join(map(str, found))), digest(library.decode(found, skip_special_tokens=False))] += 1
    assert made == want


def test_empty_documents(spark, docs):
    for label, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs.limit(0), FOLDER)
        assert made.columns == docs.columns and made.count() == 0, label
