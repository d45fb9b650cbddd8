from __future__ import annotations

import random

import numpy as np
import pytest

from closebook.llm import jaccard_join as jj
from tests.conftest import SMALL
from tests.llm import brute


def result(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_whole_table_against_all_pairs(spark, size, percent):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = [tuple(r) for r in table.select("doc_id", "text").collect()]
    want = brute.linked_components(docs, size, percent)
    assert result(jj.near_duplicates(table, size, percent)) == want
    assert any(k != v[1] for k, v in want.items())


def near_copies(seed: int, groups: int, copies: int, edits: float) -> list[tuple[int, str]]:
    """Copies with a share of edited words around the threshold."""
    draw, out = random.Random(seed), []
    for group in range(groups):
        base = [f"g{group}w{draw.randrange(400)}" for _ in range(draw.randint(8, 300))]
        for _ in range(copies):
            own = list(base)
            for _ in range(int(draw.random() * edits * len(own))):
                own[draw.randrange(len(own))] = f"e{draw.randrange(10**9)}"
            out.append((len(out) * 7 % 100_003, " ".join(own)))
    return out


def some_tokens(draw: random.Random, size: int) -> set[int]:
    return {draw.randrange(1 << 64) for _ in range(size)}


def bucket_keys(tokens: set[int], percent: int) -> set[int]:
    sets = np.array(sorted(tokens), np.uint64)
    return {int(k) for keys in jj._keys(sets, jj._Ranges(percent)) for k in keys}


@pytest.mark.parametrize("percent", [30, 80, 90, 100])
def test_similar_sets_share_a_bucket(percent):
    draw = random.Random(percent)
    for size in (*range(1, 60), *range(60, 700, 37)):
        common = some_tokens(draw, size)
        # as many further tokens as the threshold allows, on one side and on both
        more = size * (100 - percent) // percent
        for own in (0, more // 2):
            x = common | some_tokens(draw, own)
            y = common | some_tokens(draw, more - own)
            assert bucket_keys(x, percent) & bucket_keys(y, percent), (size, own)


def test_unlike_sets_share_no_bucket_though_parts_of_both_are_empty():
    draw = random.Random(5)
    for size in (5, 20, 90, 400):
        found = [bucket_keys(some_tokens(draw, size), 80) for _ in range(60)]
        assert len(set().union(*found)) == sum(map(len, found)), size


def test_near_copies_of_long_texts_at_the_pipelines_threshold(spark):
    docs = near_copies(3, groups=12, copies=20, edits=0.08)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert result(jj.near_duplicates(frame, 5, 80)) == brute.linked_components(docs, 5, 80)


def test_near_copies_around_the_threshold(spark):
    docs = near_copies(1, groups=12, copies=25, edits=0.06)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert result(jj.near_duplicates(frame, 3, 90)) == brute.linked_components(docs, 3, 90)


def test_groups_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_SETS", 6)
    docs = near_copies(2, groups=5, copies=40, edits=0.08)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert result(jj.near_duplicates(frame, 3, 90)) == brute.linked_components(docs, 3, 90)


def test_edges(spark):
    docs = spark.createDataFrame([
        (5, "a b c d"), (3, "A B C D"), (9, None), (8, ""), (7, " \n"), (6, "a"), (4, "a"),
        (2, "a b"), (None, "a b c d"), (5, "a b c d"), (1, "x " * 5000),
    ], "doc_id int, text string").selectExpr("*", "'z' as component_id", "1 as n_shingles")
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"])
                 for r in jj.near_duplicates(docs, 3, 90).collect())
    assert got == [(0, 2, None), (1, 1, 1), (2, 1, 2), (3, 2, 3), (4, 1, 4), (5, 2, 3),
                   (5, 2, 3), (6, 1, 4), (7, 0, 7), (8, 0, 8), (9, 0, 9)]
    assert jj.near_duplicates(docs.limit(0)).count() == 0


def test_tree_traversal_loses_no_pair():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(150):
        if sets and rng.random() < 0.5:
            base = sets[rng.integers(len(sets))]
            keep = base[rng.random(len(base)) > rng.random() * 0.12]
            new = rng.integers(0, 1 << 63, rng.integers(0, 8), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([keep, new])))
        else:
            sets.append(np.unique(rng.integers(0, 1 << 63, rng.integers(1, 200),
                                               dtype=np.uint64)))
    label = list(range(len(sets)))
    for a, b in jj.similar_pairs(sets, None, 90):
        x, y = label[a], label[b]
        label = [x if z == y else z for z in label]
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 90 * (len(sets[a]) + len(sets[b]) - common) and common:
                assert label[a] == label[b]
