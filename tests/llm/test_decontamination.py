from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from closebook.llm import decontamination as dc
from tests.conftest import SMALL
from tests.llm import brute


def rows(frame):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["items"])) for r in frame.collect()}


def test_whole_tables_against_brute_force(spark):
    docs = [tuple(r) for r in
            spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"])
           for r in dc.op1(spark, SMALL).collect()}
    want = brute.contamination(docs, items)
    assert got == want
    assert any(x[1] for x in want.values())


@pytest.fixture
def tables(spark):
    long = " ".join(f"w{k}" for k in range(3000))
    docs = spark.createDataFrame([
        (1, "zero ONE two three four five six seven eight nine ten eleven", "x"),
        (2, "Two Words, here", "x"), (3, None, None), (4, "", "x"), (5, long, "x"),
        (6, "one two three four five. six seven eight nine", "x"),
        (6, "one two three four five. six seven eight nine", "x"), (None, "two-words", "x"),
        (7, "ten eleven", None), (8, "Éa éB two words two words", "x"),
    ], "doc_id bigint, text string, n_words string")
    bench = spark.createDataFrame([
        ("a", "one two three four five six seven eight nine ten eleven"), ("b", "two words"),
        ("c", None), ("d", "..."), ("b", "two words"), ("e", long), (None, "zero"),
        ("f", "éB two words two"),
    ], "item_id string, text string")
    return docs, bench


def test_edges_against_brute_force(spark, tables):
    docs, bench = tables
    own = [tuple(r)[:2] for r in docs.collect()]
    want = brute.contamination(own, [tuple(r) for r in bench.where("item_id <> ''").collect()])
    got = dc.contamination(docs, bench)
    assert got.count() == len(own)
    assert rows(got) == {k: v[:3] for k, v in want.items()}
    assert want[5][1] == 3000


def test_portions_of_a_large_benchmark_give_the_same(spark, tables, monkeypatch):
    docs, bench = tables
    whole = dc.contamination(docs.where("doc_id <> 6"), bench).orderBy("doc_id").collect()
    monkeypatch.setattr(dc, "PHRASES_AT_ONCE", 700)
    parts = dc.contamination(docs.where("doc_id <> 6"), bench).orderBy("doc_id").collect()
    assert whole == parts


def test_portions_keep_repeated_and_null_ids(spark, tables, monkeypatch):
    docs, bench = tables
    more = docs.unionByName(spark.createDataFrame(
        [(None, "other words", "x"), (6, "words two two words a b c d e", "x")], docs.schema))

    def found():
        return sorted(map(tuple, dc.contamination(more, bench).collect()), key=str)
    whole = found()
    monkeypatch.setattr(dc, "PHRASES_AT_ONCE", 700)
    assert found() == whole
    assert len(whole) == 12


def test_empty_tables(spark, tables):
    docs, bench = tables
    assert dc.contamination(docs.limit(0), bench).count() == 0
    none = dc.contamination(docs, bench.limit(0))
    assert none.count() == 10
    assert none.agg(F.sum("n_hit")).first()[0] == 0


def test_proximity_finds_the_words_in_any_order(spark):
    docs = spark.createDataFrame(
        [(1, "red house on a green hill"), (2, "green fields, a red barn and a house"),
         (3, "red " + "x " * 20 + "house green"), (4, "red green")], "doc_id int, text string")
    phrases = dc.phrase_table(
        spark.createDataFrame([("p", "red green house")], "item_id string, text string"))
    index = dc.build_index(docs)
    near = dc.find_phrases(index, phrases, distance=7).where("size(items) > 0")
    assert sorted(r["doc_id"] for r in near.collect()) == [1, 2]
    assert dc.find_phrases(index, phrases).where("size(items) > 0").count() == 0
