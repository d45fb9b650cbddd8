from __future__ import annotations

import random
from decimal import Decimal

import pytest

from closebook.llm import line_dedup, storage
from tests.conftest import SMALL
from tests.llm import brute


def removed(docs: list[tuple[int, str]], size: int = 5, percent: int = 80) -> set:
    """(id, line) of every line that resembles an earlier one, by comparing all pairs."""
    earlier, out = [], set()
    for doc, text in sorted(docs):
        for k, line in enumerate((text or "").split("\n")):
            own = brute.shingle_set(line.lower(), size)
            if not own:
                continue
            for other in earlier:
                common = len(own & other)
                if 100 * common >= percent * (len(own) + len(other) - common):
                    out.add((doc, k))
                    break
            if (doc, k) not in out or own not in earlier:
                earlier.append(own)
    return out


def got(frame) -> set:
    return {tuple(r) for r in line_dedup.removed_lines(frame).collect()}


def test_whole_table_against_all_pairs(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert got(table) == removed(docs)


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_around_the_threshold(spark, seed):
    draw = random.Random(seed)
    bases = [[f"w{draw.randrange(60)}" for _ in range(draw.randint(3, 60))] for _ in range(8)]
    docs = []
    for doc in range(40):
        rows = []
        for _ in range(5):
            line = list(draw.choice(bases))
            for _ in range(draw.randint(0, 2)):
                line[draw.randrange(len(line))] = f"e{draw.randrange(1000)}"
            rows.append(" ".join(line))
        docs.append((doc, "\n".join(rows)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert got(frame) == removed(docs)


def test_edges(spark):
    rows = [(3, "a b\nx\n\n a  B \r", "s"), (1, "a b", None), (7, None, "s"), (8, "", "s"),
            (9, " \n ", "s"), (None, "q r s", "s"), (10, "q r s\nnew", "s"), (1, "a b", None),
            (11, "long " * 4000 + "\n" + "long " * 3999, "s")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, line string")
    out = [tuple(r) for r in line_dedup.deduplicate(docs).collect()]
    assert sorted(out, key=str) == sorted([
        (3, "x\n", "s"), (1, "a b", None), (1, "a b", None), (7, None, "s"), (8, "", "s"),
        (9, " \n ", "s"), (None, "q r s", "s"), (10, "new", "s"),
        (11, "long " * 4000, "s")], key=str)
    assert line_dedup.deduplicate(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_operator_compares_words(spark, seed):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(400)}" for _ in range(14)]
    docs = [(1, " ".join(base)), (2, " ".join([*base[:7], "other", *base[8:]]))]
    for doc in range(3, 40):
        line = draw.sample(base, 14)[:draw.randint(3, 14)]
        docs.append((doc, " ".join(line + [f"e{draw.randrange(50)}" for _ in range(draw.randint(0, 3))])))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    out = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate(frame).collect()}
    assert out[2] == ""
    assert {(d, 0) for d, text in out.items() if not text} == removed(docs, size=1)


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    rows = [(None, "alpha beta\nonly here"), (None, "one more\nalpha beta"), (4, "p q r\nown one"),
            (4, "own two\np q r"), (5, "same place"), (5, "same place\nmore"), (None, "alpha beta")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = [(r["doc_id"], x) for r in line_dedup.deduplicate(docs).collect()
            for x in r["text"].split("\n") if x]
    assert sorted(left, key=str) == sorted([
        (None, "alpha beta"), (None, "only here"), (None, "one more"), (4, "p q r"),
        (4, "own one"), (4, "own two"), (5, "same place"), (5, "more")], key=str)


def test_registered_form_against_all_pairs(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = [tuple(r) for r in table.select("doc_id", "text").collect()]
    found = {(r["doc_id"], int(k)) for r in line_dedup.op9(spark, SMALL).collect()
             for k in r["removed"].split(",") if k}
    assert found == removed(docs, size=1)


def test_built_in_functions_only(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ranks = line_dedup._ranks(docs, 1, "text")
    different = line_dedup._different(docs, ranks, 1, 80, "doc_id", "text")
    pairs = line_dedup._meetings(
        line_dedup._prefixes(different, different.select("num").limit(0)), 80)
    for frame in (line_dedup._stars(different, 80), line_dedup._later(pairs, different, 1, 80)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))


def test_names_that_clash_and_text_ids(spark):
    rows = [("a", "x y\nkeep", 1, 2, 3, 4), ("b", "x  Y\nown", 5, 6, 7, 8), (None, "own", 9, 9, 9, 9)]
    docs = spark.createDataFrame(
        rows, "doc_id string, text string, doc int, version int, kept int, its_version int")
    out = line_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("a", "x y\nkeep", 1, 2, 3, 4), ("b", "", 5, 6, 7, 8), (None, "own", 9, 9, 9, 9)], key=str)


def test_very_long_line_and_many_lines(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, long), (2, f"{long} more"), (3, "\n".join(f"n{k}" for k in range(60_000)) + "\n"),
            (4, "n7\n" * 5 + "\n" * 20_000)]
    out = {r["doc_id"]: r["removed"] for r in line_dedup.removed(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {1: [], 2: [0], 3: [], 4: [0, 1, 2, 3, 4]}


def test_near_copies_of_one_line_meet_few_others(spark):
    draw, size = random.Random(5), 150
    words = spark.range(5000).selectExpr("concat('c', id) w").selectExpr("w", "xxhash64(w) h")
    low, *_, high = [r["w"] for r in words.orderBy("h").collect()]
    base = [f"b{k}" for k in range(58)]
    # an unlike line, the first of all, has the smallest and the greatest hash of a token
    docs = [(0, " ".join([low, high, *(f"other{k}" for k in range(58))])), (1, f"{low} {high} " + " ".join(base))]
    for doc in range(2, size):
        line = list(base)
        for k in draw.sample(range(58), 3):
            line[k] = f"e{draw.randrange(10**9)}"
        docs.append((doc, f"{low} {high} " + " ".join(line)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    different = line_dedup._different(frame, line_dedup._ranks(frame, 1, "text"), 1, 80, "doc_id", "text").cache()
    stars = line_dedup._stars(different, 80).cache()
    gone = line_dedup._later(stars, different, 1, 80)
    pairs = line_dedup._meetings(line_dedup._prefixes(different, gone), 80)
    assert stars.count() + pairs.count() < 2 * line_dedup.LEADERS * size + 4 * size
    assert {(d, 0) for d in range(2, size)} == {
        (r["doc_id"], 0) for r in line_dedup.removed(frame).collect() if r["removed"]}


@pytest.mark.parametrize("kind", ["string", "int", "decimal(9,2)"])
def test_earlier_lines_by_ids_of_any_type(spark, kind):
    draw = random.Random(6)
    ids = {"string": ["", "a", "abcdefg", "abcdefgh", "abcdefgha", "abcdefg\x00", "z\u00e9", "\u00e9"],
           "int": [-5, -1, 0, 3, 10, 2**31 - 1, -2**31, 77]}.get(kind) or [
               Decimal(x) for x in ("-1.5", "0", "0.25", "3", "7.75", "8", "100", "-20")]
    base = [f"w{k}" for k in range(30)]
    docs = []
    for doc in draw.sample(ids, 8):
        rows = []
        for _ in range(6):
            line = list(base)
            for k in draw.sample(range(30), draw.randint(0, 5)):
                line[k] = f"e{draw.randrange(20)}"
            rows.append(" ".join(line))
        docs.append((doc, "\n".join(rows)))
    frame = spark.createDataFrame(docs, f"doc_id {kind}, text string")
    found = {(r["doc_id"], k) for r in line_dedup.removed(frame).collect() for k in r["removed"]}
    assert found == removed(docs, size=1)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_lines_of_a_common_token_meet_by_size(spark, percent):
    sizes = range(1, 301)
    rows = spark.range(1, 301).selectExpr(
        "7 key", "0L low", "id num", "0L high", "id turn", "shiftleft(id, 32) shape")
    asking, asked = line_dedup._sides(rows, percent)
    met = [(a, b) for a, b in asking.alias("x").join(asked.alias("y"), ["key", "band"])
           .selectExpr("x.num", "y.num").collect()]
    assert len(met) == len(set(met)) < len(sizes) ** 2 / (2 if percent == 50 else 3)
    assert {(a, b) for a, b in set(met) if a > b and 100 * b >= percent * a} == {
        (a, b) for a in sizes for b in sizes if a > b and 100 * b >= percent * a}


def test_prefix_rows_are_moved_once(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    different = line_dedup._different(docs, line_dedup._ranks(docs, 1, "text"), 1, 80, "doc_id", "text")
    different.write.parquet(f"{tmp_path}/lines")
    lines = spark.read.parquet(f"{tmp_path}/lines")
    with storage._setting(spark, **{storage.ALL_KEYS: "false"}):
        pairs = line_dedup._meetings(line_dedup._prefixes(lines, lines.select("num").limit(0)), 80)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("REPARTITION_BY_COL") == 2 and "hashpartitioning(key" in plan
    assert ", band#" not in "".join(x for x in plan.split("\n") if "Exchange hashpartitioning" in x)
