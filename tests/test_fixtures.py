"""Inputs made from the tables: tasks that grow with the rows, pages parsed once."""

import gzip
import os
import zipfile

import pytest

from millrace.session import tune
from queries import fixtures as fx
from queries import index, register


@pytest.fixture
def folder(spark, tmp_path):
    tune(spark)
    spark.range(3000).selectExpr(
        "id AS c_custkey", "concat('C', id) AS c_name", "'K' AS c_mktsegment", "CAST(id % 5 AS int) AS c_nationkey"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3000).selectExpr(
        "id AS o_orderkey", "'1-URGENT' AS o_orderpriority", "'O' AS o_orderstatus", "id % 7 AS o_custkey"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(300).selectExpr("id AS page_id", "concat('https://a', id, '.au/x') AS url", "'<p>' AS html").write.parquet(
        f"{tmp_path}/pages.parquet")
    spark.range(900).selectExpr("id AS event_id", "id % 9 AS user_id", "'view' AS event_type").write.parquet(
        f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_tasks_grow_with_the_rows_and_archives_stay_whole(spark, folder, monkeypatch):
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 500)
    assert fx.register_text(spark, folder).rdd.getNumPartitions() == 12
    path = fx.register_zips(spark, folder)
    with zipfile.ZipFile(f"{path}/archive-0.zip") as found:
        assert sorted(found.namelist()) == ["data/part0.XML", "data/part0.txt", "data/part1.XML", "data/part1.txt"]
        texts = [found.read(f"data/part{g}.XML").decode() for g in (0, 1)]
    assert [t.count("</ABR>") for t in texts] == [4096, 1904]
    assert all(t.startswith("<?xml") and t.endswith("</Transfer>") for t in texts)


def test_pages_are_parsed_once_for_all_constraints(spark, folder):
    read = index.constraint_rejects(spark, folder).inputFiles()
    assert read and all(".jsonl" not in file for file in read)


def test_csv_hand_off_and_what_it_is_made_of_are_packed(spark, folder, tmp_path, monkeypatch):
    paths = []

    def scratch_path(spark, name):
        paths.append(f"{tmp_path}/scratch/{len(paths)}/{name}")
        return paths[-1]

    for module in (register, fx):
        monkeypatch.setattr(module, "scratch_path", scratch_path)
    exported = register.csv_export(spark, folder)
    made = [os.path.join(at, file) for path in paths for at, _, files in os.walk(path) for file in files]
    held = [file for file in made if not os.path.basename(file).startswith((".", "_"))]
    assert held and all(file.lower().endswith(".gz") for file in held)
    texts = [gzip.open(file, "rt").read() for file in held if file.endswith(".csv.gz")]
    assert texts and all(text.startswith("file_sequence_number,") for text in texts)
    staged = register._projected(spark, folder, fx.register_gz)
    assert all(".zstd." in file for file in staged.inputFiles())
    assert exported.count() == exported.select("abn").distinct().count() == staged.where("is_record").count() == 6000
    assert exported.where("replaced = ''").count() and exported.where("replaced IS NULL").count()
