from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from closebook.llm import mixing
from tests.conftest import MEDIUM


def shares(sizes: list[int], cycle=(1, 2, 3), most=3) -> list[float]:
    """Targets by sharing the excess again until none is above its bound."""
    weight = [cycle[k % len(cycle)] for k in range(len(sizes))]
    out, left, free = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while free and left > 1e-9:
        total = sum(weight[k] for k in free)
        over = {k for k in free if left * weight[k] / total > most * sizes[k]}
        if not over:
            for k in free:
                out[k] = left * weight[k] / total
            break
        for k in over:
            out[k] = float(most * sizes[k])
        left -= sum(out[k] for k in over)
        free -= over
    return out


@pytest.mark.parametrize("sizes", [[5, 5, 5], [100, 1, 1], [1, 0, 50, 7, 300, 2], [0, 0], [9]])
def test_targets(spark, sizes):
    rows = [(k, "w " * n, None if k == len(sizes) - 1 else f"s{k}")
            for k, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r["rank"]: r["target"] for r in mixing.targets(mixing.with_sizes(docs)).collect()}
    assert [got[k + 1] for k in range(len(sizes))] == pytest.approx(shares(sizes))


def test_flight_keeps_both_sums():
    draw = random.Random(4)
    sizes = [draw.randrange(1, 500) for _ in range(300)]
    before = [0.37] * 300
    after = mixing.flight(sizes, before, draw)
    assert sum(0 < x < 1 for x in after) <= 2
    assert sum(after) == pytest.approx(sum(before))
    assert sum(a * s for a, s in zip(after, sizes, strict=True)) == pytest.approx(
        sum(a * s for a, s in zip(before, sizes, strict=True)))


def test_flight_keeps_probabilities():
    sizes, total = [3, 5, 8, 13, 21, 34], [0] * 6
    for seed in range(3000):
        after = mixing.flight(sizes, [0.4] * 6, random.Random(seed))
        total = [a + b for a, b in zip(total, after, strict=True)]
    assert [x / 3000 for x in total] == pytest.approx([0.4] * 6, abs=0.04)


def test_mix_comes_near_the_targets_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_UNITS", 12)  # several levels
    got = mixing.op10(spark, MEDIUM)
    first = sorted(map(tuple, got.collect()))
    assert first == sorted(map(tuple, mixing.op10(spark, MEDIUM).collect()))
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "source")
    sums = got.join(docs, "doc_id").groupBy("source").agg(
        F.sum("size").alias("size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.sum("taken").alias("taken"))
    for r in sums.collect():
        assert r["size"] == r["source_size"]
        assert abs(r["taken"] - r["target"]) <= 0.03 * r["target"]
    assert got.where("taken > 3 * size").count() == 0


def test_edges(spark):
    rows = [(1, None, None), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "z", "b")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = mixing.mix(docs.withColumn("size", F.lit("s")))
    assert got.count() == 5
    assert got.where("copies < 0 or copies > 3").count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_equal_rows_are_one_counted_unit(spark, monkeypatch):
    """A third of all rows equal: no task gets them one by one, and the mix still comes near."""
    monkeypatch.setattr(mixing, "CHUNK", 100)
    flown = []
    monkeypatch.setattr(mixing, "stored", lambda frame, purpose: (
        flown.append(frame.cache()) or frame if purpose == "flight" else frame.cache()))
    rows = [(7, "a b c", "hot")] * 3000 + [(k, "w " * (k % 9), f"s{k % 3}") for k in range(100, 6100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(docs)
    assert got.count() == len(rows)
    assert flown[0].where("size = 3 and doc_id = 7").count() == 1
    sums = got.groupBy("source").agg(F.sum(F.expr("size * copies")).alias("taken"),
                                     F.first("target").alias("target"))
    for r in sums.collect():
        assert abs(r["taken"] - r["target"]) <= 0.01 * r["target"] + 9
    assert got.where("copies < 0 or copies > 3").count() == 0
