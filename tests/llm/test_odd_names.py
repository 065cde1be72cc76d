"""Stages that hand on whole rows, under column names that need quoting; repeated ids; far dates."""

import datetime

from millrace.llm import quality, toxicity, urllists

ODD = "doc_id long, text string, lang string, `a-b` string, `x.y` struct<`two words`: int>, `row` int, score string"


def test_rows_with_odd_names_pass(spark):
    words = "the quick brown fox jumps over lazy dogs while many other small animals watch them from distant hills and rivers"
    good = " ".join(f"{w}{'s' if k % 3 else ''}" for k, w in enumerate((words + " ") .split() * 4))
    rows = [(i, None if i == 3 else "" if i == 4 else good + f" {i}", "en", "q", (i,), i, "s") for i in range(6)]
    docs = spark.createDataFrame([*rows, rows[0]], ODD)
    assert quality.keep_good(docs).schema == docs.schema
    assert {r.doc_id for r in quality.keep_good(docs).collect()} <= {0, 1, 2, 5}
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, toxic int")
    kept = toxicity.keep_clean(docs, labels)
    assert kept.schema == docs.schema and kept.count() <= docs.count()
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_examples_are_bounded_whatever_the_rows(spark, monkeypatch):
    staged, stage = [], toxicity.stage
    monkeypatch.setattr(toxicity, "stage", lambda df, what: staged.append(stage(df, what)) or staged[-1])
    texts = [(1, f"bad word{i}") for i in range(300)] + [(2, "fine words")] * 300 + [(k, f"text {k}") for k in range(3, 40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)] * 50 + [(k, k % 2) for k in range(3, 40)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, "doc_id", "text", toxicity.held_out, 20)
    assert 0 < staged[0].count() <= 20 and staged[0].distinct().count() == staged[0].count()


def test_one_far_capture_does_not_multiply_the_entries(spark):
    day = datetime.date
    intervals = spark.createDataFrame(
        [("spam", "a.org", day(2020, 1, 1), None), ("adult", "a.org", day(2021, 1, 1), day(2021, 2, 1))],
        "list string, key string, since date, until date",
    )
    rows = [("http://a.org/", day(2019, 12, 31)), ("http://x.a.org/", day(2021, 1, 31)), ("http://a.org/", day(2021, 2, 1)),
            ("http://a.org/", day(9999, 12, 31)), ("http://b.org/", None), (None, day(2021, 1, 1))]
    captures = spark.createDataFrame([(*r, i, "k", "h") for i, r in enumerate(rows)], "url string, day date, rid int, key string, host string")
    found = {r["row"].rid: (r.n_active, r.lists) for r in urllists.listed_captures(captures, intervals, "url", "day").collect()}
    assert found == {0: (0, None), 1: (2, "adult,spam"), 2: (1, "spam"), 3: (1, "spam"), 4: (0, None), 5: (0, None)}
    assert urllists.listed_captures(captures.limit(0), intervals, "url", "day").count() == 0
