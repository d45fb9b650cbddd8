from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from closebook.llm import merkle
from tests.conftest import SMALL


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, add: int = 0) -> str:
    out = []
    for name in merkle.FIELDS:
        value = row[name]
        if value is None:
            out.append("-")
        else:
            text = str(value + add if name == "n_chars" else value)
            out.append(f"{len(text.encode())}:{text}")
    return h(*out)


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h(*last[k:k + 2]) for k in range(0, len(last), 2)])
    return out


def siblings(tree: list[list[str]], at: int):
    for level in tree[:-1]:
        other = at ^ 1
        yield level[other] if other < len(level) else "", other < at
        at //= 2


def brute(rows) -> list[tuple]:
    """The contract, restated plainly."""
    runs = {}
    for row in rows:
        runs.setdefault(row["lang"], []).append(row)
    order = sorted(runs, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in order:
        runs[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in runs[lang]])
    top = levels([trees[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for at, row in enumerate(runs[lang]):
            proof = [*siblings(trees[lang], at), *siblings(top, k)]
            tampered = (row["doc_id"] is not None and row["n_chars"] is not None
                        and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0)
            fold = leaf(row, int(tampered))
            for other, left in proof:
                fold = h(other, fold) if left else h(fold, other)
            out.append((row["doc_id"], leaf(row), trees[lang][-1][0], top[-1][0],
                        h(*[p for p, _ in proof]), fold, fold == top[-1][0]))
    return out


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def query(spark, tmp_path, rows, schema="doc_id bigint, text string, lang string, source string, "
                                        "n_chars bigint"):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    return merkle.op11(spark, str(tmp_path))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = sorted((tuple(r) for r in merkle.op11(spark, SMALL).collect()), key=key)
    assert got == sorted(brute(docs), key=key)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("seed", range(4))
def test_many_rounds(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(merkle, "LEVELS", 2)  # blocks of four leaves
    draw = random.Random(seed)
    langs = [None, "", "de", "zz", "é", *[f"l{k}" for k in range(draw.randrange(8))]]
    rows = [(draw.choice([None, k, draw.randrange(20)]), draw.choice([None, "", f"t{k % 9}"]),
             draw.choice(langs[:2] + ["de"] * 3 + langs), draw.choice([None, "s"]),
             draw.choice([None, 3, 4])) for k in range(150)]
    got = query(spark, tmp_path, rows)
    names = ("doc_id", "text", "lang", "source", "n_chars")
    want = brute([dict(zip(names, r, strict=True)) for r in rows])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 16, 17])
def test_sizes(spark, tmp_path, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(k, "x", "de", None, k) for k in range(n)]
    names = ("doc_id", "text", "lang", "source", "n_chars")
    want = brute([dict(zip(names, r, strict=True)) for r in rows])
    got = query(spark, tmp_path, rows)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_equal_rows_and_clashing_names(spark, tmp_path):
    rows = [(1, "a" * 200_000, "de", "s", 1, "run", 5, "at")] * 5 + [
        (None, None, None, None, None, None, None, None)] * 3
    schema = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "run string, pos bigint, hash string")
    got = query(spark, tmp_path, rows, schema)
    names = schema.replace(" bigint", "").replace(" string", "").split(", ")
    want = brute([dict(zip(names, r, strict=True)) for r in rows])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_no_task_holds_a_group(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'de' as lang", "'x' as text")
    plan = merkle._climb(docs.selectExpr("lang as run", "doc_id as pos", "5000l as size",
                                         "text as hash"), merkle.LEVELS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1  # all levels share one shuffle, by run and block
