from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from closebook.llm import collocations as c
from closebook.llm.storage import WorkingTables
from tests.conftest import SMALL
from tests.llm.brute import lower

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, top: int = 2000) -> list[tuple]:
    """The contract, restated plainly."""
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            words = re.findall("[^ \t]+", piece)
            own.update(tuple(words[k:k + size]) for size in range(1, 5)
                       for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(x for p, x in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 30}
        gone = set()
        for longer, b in candidates.items():
            for size in range(2, len(longer)):
                for k in range(len(longer) - size + 1):
                    inner = longer[k:k + size]
                    if 100 * b >= 80 * candidates[inner]:
                        gone.add(inner)
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k)
                               for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def made(seed: int, texts: int) -> list[tuple]:
    draw = random.Random(seed)
    words = ["the", "The", "of", "New", "york", "x", "été", "漢字", "\x01a", "\xa0", "b-c"]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "\r\n", "!", " ; "]
    out = []
    for _ in range(texts):
        text = "".join(draw.choice(words[:draw.randrange(2, len(words))]) + draw.choice(gaps)
                       for _ in range(draw.randrange(40)))
        out.append((draw.choice([None, "und", "en", "fr", "é"]), text))
    return out + [("en", None), (None, ""), ("en", "...")] + [("fr", "de la  mer du nord")] * 40


def collected(frame) -> list[tuple]:
    return sorted(map(tuple, frame.select(COLUMNS).collect()))


def test_whole_table(spark):
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .collect()]
    assert collected(c.op13(spark, SMALL)) == brute(rows) != []


@pytest.mark.parametrize("seed", range(3))
def test_many_shards_and_ranges(spark, monkeypatch, seed):
    monkeypatch.setattr(c, "CHUNK_BYTES", 700)
    monkeypatch.setattr(c, "RANGE_CHARS", 1 << 9)
    monkeypatch.setattr(c, "SAMPLES_PER_RANGE", 16)
    rows = made(seed, 300)
    docs = spark.createDataFrame(
        [(*row, "x", 1) for row in rows], "lang string, text string, phrase string, f int"
    ).repartition(5)
    bounds = c.prefix_ranges(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"))
    assert sum(map(len, bounds.values())) > 5
    assert collected(c.collocations(docs, top=15)) == brute(rows, 15)


def test_edges(spark):
    schema = "lang string, text string, range int, words string, arcs string"
    empty = spark.createDataFrame([], schema)
    assert c.collocations(empty).count() == 0
    rows = [(None, None), ("en", ""), ("en", "a b " * 50_000), ("und", "q r. " * 30),
            (None, "s t\n" * 29), ("de", "one")]
    docs = spark.createDataFrame([(*r, 1, "w", "a") for r in rows], schema)
    assert collected(c.collocations(docs)) == brute(rows)


def test_products_beyond_64_bits(spark):
    big = 10 ** 13
    candidates = spark.createDataFrame(
        [("en", "a b", big + 1, 2, ["a", "b"])],
        "lang string, phrase string, f bigint, n_words int, words array<string>")
    counts = spark.createDataFrame([("en", "a", 3 * big), ("en", "b", 2 * big)],
                                   "lang string, phrase string, f bigint")
    row = c.scored(candidates, counts).first()
    assert row["score"] == 2000000 * (big + 1) // (5 * big)


def paths(words, levels) -> dict:
    out, above = {}, {-1: ()}
    for depth, (parent, label, weight) in enumerate(levels):
        here = {}
        for k, (p, w, n) in enumerate(zip(parent, label, weight, strict=True)):
            here[k] = (above[p] if depth else ()) + (words[int(w)].as_py(),)
            if n:
                out[here[k]] = int(n)
        above = here
    return out


@pytest.mark.parametrize("seed", range(5))
def test_cuts_and_union_keep_every_path(seed):
    draw = random.Random(seed)
    texts = [" ".join(draw.choice("abcdefg") for _ in range(30)) for _ in range(6)]
    want: Counter = Counter()
    bounds = sorted({tuple(draw.choice("abcdeghz").encode() for _ in range(2))
                     for _ in range(6)})
    ranges: dict[int, list] = {}
    for text in texts:
        words, at, goes_on = c._words(pa.array([text]))
        passes = np.ones(len(at), bool)
        levels = c._levels(len(words), at, c._long(at, goes_on, passes), (1, 2, 3, 4))
        want.update(paths(words, levels))
        for k, own, cut in c._segments(words, levels, bounds):
            ranges.setdefault(k, []).append(c._read(*c._written(own, cut)))
    got = {}
    for k, parts in ranges.items():
        for path, n in paths(*c.union(parts)).items():
            assert path not in got
            assert c._range_of(bounds, b" ".join(path).decode()) == k
            got[path] = n
    assert got == want


def test_transducer_is_minimal_and_composes():
    phrases = {(b"a", b"x"): 3, (b"a", b"y"): 4, (b"b", b"x"): 3, (b"b", b"y"): 4, (b"c",): 9,
               (b"c", b"x"): 3}
    transducer = c.CountTransducer()
    for phrase in sorted(phrases):
        transducer.add(phrase, phrases[phrase])
    transducer.finished()
    # the start, the one behind a and b, the one behind c, and the end
    assert transducer.states() == 4
    asked = sorted([*phrases, (b"a",), (b"a", b"z"), (b"zz", b"x"), (b"c", b"x", b"q")])
    assert dict(transducer.compose(asked)) == phrases


def test_parts_of_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(c, "RANGE_CHARS", 1 << 9)
    monkeypatch.setattr(c, "SAMPLES_PER_RANGE", 16)
    docs = spark.createDataFrame([("en", row[1]) for row in made(9, 200)],
                                 "lang string, text string").fillna("")
    bounds = c.prefix_ranges(docs)
    with WorkingTables(spark) as tables:
        frequent = c.frequent_phrases(docs, bounds, tables)
        known = frequent.where("n_words > 0").select("lang", "phrase", "f")
        got = c.part_counts(frequent, known.select("lang", "phrase"), bounds)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, known.collect()))
