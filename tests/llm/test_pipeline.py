from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from closebook.llm import decontamination, jaccard_join
from tests.conftest import SMALL


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), "test")
        assert docs.columns == columns, name
        rows.append(docs.count())
    assert sorted(rows, reverse=True) == rows and rows[-1] > 0
    found = jaccard_join.near_duplicates(docs)
    assert found.where("component_id <> doc_id").count() == 0
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert decontamination.contamination(docs, benchmark).where("contaminated").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.columns == [*columns, "copies"]
    assert last.where("copies < 1 or copies > 3").count() == 0


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "en", None, 5),
            (3, "a line\na line", "en", "s", 13), (3, "a line\na line", "en", "s", 13)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).collect()
        stage(spark, docs.limit(0), SMALL).collect()


def test_rows_that_share_an_id_get_their_own_verdicts(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("length(text) > 100") \
        .first()["text"]
    clean = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(4)]
    rows = [(None, item), (None, clean[0]), (7, item), (7, clean[1]), (None, clean[2]),
            (None, clean[2]), (8, clean[3]), (8, clean[3]), (9, clean[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "'en' as lang", "'s' as source", "cast(length(text) as bigint) as n_chars")

    def texts(frame):
        return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)
    assert texts(corpus_pipeline.decontaminate(spark, docs, SMALL)) == sorted(
        (r for r in rows if r[1] != item), key=str)
    assert texts(corpus_pipeline.near_duplicates(spark, docs, SMALL)) == sorted(
        [(None, item), (None, clean[0]), (7, clean[1]), (None, clean[2]), (8, clean[3])], key=str)
    many = spark.createDataFrame(
        [(5 if k < 60 else None, f"w{k} " * 10, "en", "s" if k < 60 else "t", 40)
         for k in range(120)], docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    copies = corpus_pipeline.mixture(spark, many, SMALL).groupBy("source").agg(
        F.sum("copies").alias("n"))
    assert sorted(map(tuple, copies.collect())) == [("s", 40), ("t", 80)]
    alike = many.withColumn("text", F.lit("a b c"))
    copies = corpus_pipeline.mixture(spark, alike, SMALL).groupBy("source").agg(
        F.sum("copies").alias("n"))
    assert sorted(map(tuple, copies.collect())) == [("s", 40), ("t", 80)]
