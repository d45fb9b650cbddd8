"""The operators that learn: held-out accuracy, gradients, edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from closebook.llm import language_id, license_scan, quality_classifier, toxicity
from tests.conftest import MEDIUM, TESTDATA

ODD = [(1, None, None, 1), (2, "", "x", 1), (3, "12 34", "x", 2), (3, "12 34", "x", 2),
       (None, "abc def", None, 1), (4, "word " * 30000, "x", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, score int")


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    got = language_id.op5(spark, MEDIUM).join(docs, "doc_id").where("held_out")
    row = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
                  F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert row["right"] >= 0.97
    assert 0 <= row["low"] <= row["high"] <= 1


def test_language_edges(spark, odd):
    net = language_id.train(odd.withColumn("lang", F.lit("zz")))
    got = sorted((r["doc_id"] or 0, r["lang_pred"]) for r in
                 language_id.predict(odd, net).collect())
    assert got == [(0, "zz"), (1, "und"), (2, "und"), (3, "und"), (3, "und"), (4, "zz")]
    assert language_id.train(odd.limit(0)) is None
    assert {r["lang_pred"] for r in language_id.predict(odd, None).collect()} == {"und"}


def test_language_gradients():
    rng = np.random.default_rng(1)
    net = language_id.Network.new(["a", "b", "c"])
    x = rng.integers(0, 256, (6, language_id.WINDOW), dtype=np.uint8)
    y = np.array([0, 1, 2, 0, 1, 2])

    def loss() -> float:
        return float(-np.log(net.probabilities(x)[np.arange(6), y]).mean())
    for value, slope in zip(net.parameters(), net.gradients(x, y), strict=True):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        value[at] += 5e-3
        up = loss()
        value[at] -= 1e-2
        assert (up - loss()) / 1e-2 == pytest.approx(slope[at], rel=0.1, abs=1e-3)
        value[at] += 5e-3


def test_toxicity_locates_what_labels_only_mark_by_document(spark):
    rng = np.random.default_rng(2)
    names = [f"w{k}" for k in range(200)]
    rows, labels = [], []
    for doc in range(1600):
        parts = [" ".join(rng.choice(names, 8)) for _ in range(rng.integers(1, 12))]
        if doc % 4 == 0:
            parts[rng.integers(len(parts))] += " grumble" + str(rng.integers(30))
        rows.append((doc, ". ".join(parts)))
        labels.append((doc, int(doc % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(docs, marks.where("doc_id < 1200"))
    texts = dict(rows)
    scores = toxicity.score(docs, model, least=0.0).where("doc_id >= 1200").collect()
    for r in sorted(scores, key=lambda r: -r["score"])[:20]:
        assert r["doc_id"] % 4 == 0
        worst = max(r["offending"], key=lambda s: s["score"])
        assert "grumble" in texts[r["doc_id"]][worst["start"]:worst["end"]]


def test_toxicity_on_held_out_documents(spark):
    large = f"{TESTDATA}/sf0.1"  # the smaller tables hold out six toxic documents
    labels = spark.read.parquet(f"{large}/labels.parquet")
    got = toxicity.op6(spark, large)
    assert got.count() == 10_000
    held = got.where("held_out").join(labels, "doc_id").groupBy("toxic").agg(
        F.avg("predicted").alias("said"), F.count("*").alias("n"))
    said = {r["toxic"]: r["said"] for r in held.collect() if r["n"]}
    assert said[0] <= 0.1 and said[1] >= 0.6
    no_id = spark.createDataFrame([(None, "x")], "doc_id bigint, text string")
    assert no_id.select(F.coalesce(toxicity.remainder("doc_id", 5) == 0, F.lit(False))).first()[0] is False


def test_toxicity_learns_from_ten_documents(spark):
    rows = [(k, f"fine words here number {k}. " + ("you grumble" if k % 2 else "all good"))
            for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    scores = {r["doc_id"]: r["score"] for r in
              toxicity.score(docs, toxicity.train(docs, marks)).collect()}
    assert min(scores[k] for k in (1, 3, 5, 7, 9)) > 0.5 > max(scores[k] for k in (0, 2, 4, 6, 8))


def test_quality_learns_every_grade(spark):
    docs = spark.createDataFrame([(k, f"text {k} " * (k + 1)) for k in range(70)],
                                 "doc_id bigint, text string")
    model = quality_classifier.train(docs, docs.selectExpr("doc_id", "CAST(doc_id AS INT) AS grade"))
    assert model.grades == list(range(70))
    many = spark.range(2000).selectExpr("id AS doc_id", "CAST(id AS INT) AS grade")
    with pytest.raises(ValueError, match="2000"):
        quality_classifier.train(docs, many)


def test_language_shows_late(spark):
    """Windows are drawn from whole texts: what differs stands behind 100 KB of digits."""
    draw = np.random.default_rng(3)
    rows = []
    for k in range(40):
        letters = "abc" if k % 2 else "xyz"
        words_ = " ".join("".join(draw.choice(list(letters), 6)) for _ in range(2000))
        rows.append((k, "0 " * 50_000 + words_, "p" if k % 2 else "q"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = language_id.train(docs)
    asked = spark.createDataFrame([(1, "abcabc cba bac"), (2, "xyzzy zyx xxyz")],
                                  "doc_id bigint, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(asked, net).collect()}
    assert got == {1: "p", 2: "q"}


def test_toxicity_edges(spark, odd):
    labels = spark.createDataFrame([(1, 1), (3, 0), (77, 1), (4, None)], "doc_id int, toxic int")
    got = toxicity.score(odd, toxicity.train(odd, labels)).collect()
    assert len(got) == len(ODD)
    assert all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.train(odd, labels.limit(0))
    assert {r["score"] < 1e-6 for r in toxicity.score(odd, none).collect()} == {True}


def test_quality_separates_the_grades(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    train = quality_classifier.ratings_of(labels.where("doc_id % 3 <> 0"))
    model = quality_classifier.train(docs, train)
    assert model.grades == [0, 1, 2]
    assert (np.diff(model.thresholds) > 0).all()
    held = quality_classifier.grade(docs, model, 1).join(labels.where("doc_id % 3 = 0"), "doc_id")
    row = held.agg(F.avg(((F.col("tail") >= 0.5) == (F.col("quality") == 1)).cast("int"))
                   .alias("right")).first()
    assert row["right"] >= 0.95
    assert held.where("tail < 0.5 and expected_grade > 1.5").count() == 0
    kept = quality_classifier.selected(docs, model, 1, 0.5)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {
        r["doc_id"] for r in quality_classifier.grade(docs, model, 1).where("tail >= 0.5")
        .collect()}


def test_quality_edges(spark, odd):
    none = spark.createDataFrame([(1, None)], "doc_id bigint, grade int")
    model = quality_classifier.train(odd, none)
    assert [r["grade"] for r in quality_classifier.grade(odd, model, 0).collect()] == [0] * 6
    one = spark.createDataFrame([(1, 3), (2, 3)], "doc_id bigint, grade int")
    model = quality_classifier.train(odd, one)
    rows = quality_classifier.grade(odd, model, 3).collect()
    assert {(r["expected_grade"], r["tail"], r["grade"]) for r in rows} == {(3.0, 1.0, 3)}
    assert quality_classifier.grade(odd.limit(0), model, 3).count() == 0


def test_license_scan(spark, odd):
    lines = list(license_scan.TEMPLATES.items())
    prose = "some other words of no weight here " * 20
    rows = [(k, prose + text + " " + prose) for k, (_, text) in enumerate(lines)]
    rows += [(50, "Licensed under CC BY-ND 4.0."), (51, "his driving licence was lost"),
             (52, prose), (53, lines[0][1] + " " + prose * 3 + lines[5][1]),
             (54, "LICENSED under the Apache License version 2.0")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: [m["template"] for m in r["matches"]]
           for r in license_scan.scan(docs).collect()}
    for k, (name, _) in enumerate(lines):
        assert got[k] == [name]
    assert got[50] == got[51] == got[52] == []
    assert got[53] == [lines[0][0], lines[5][0]]
    assert got[54] == ["Apache-2.0"]
    assert license_scan.scan(odd).where("n_blocks > 0").count() == 0


def test_all_licenses_of_one_block():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    wordings = license_scan.TEMPLATES
    for names in (["Apache-2.0", "CC-BY-NC-4.0"], sorted(wordings), ["MIT", "MIT"]):
        text = " and some prose between them ".join(wordings[n] for n in names)
        assert len(license_scan.blocks(text)) == 1
        assert sorted(m["template"] for m in scanner.matches(text)) == names
