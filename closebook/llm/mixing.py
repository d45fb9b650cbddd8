"""Mixing sources to target weights by the cube method.

Targets: the sources, in code point order with null last, share the corpus by their weights; a
source gets at most `MOST` times its size and what is left over is shared again by
weight.  A document of a source with target / size = r is taken floor(r) times, and once more with
probability r - floor(r).

Sampling: the fractional probabilities of a source are balanced by the cube method.  The flight
moves the probabilities of three documents along the null space of the constraints (words,
documents) until one of them is 0 or 1, and goes on with the next one, so the sums of
words and of documents stay as they are and at most two stay undecided.  Blocks of documents fly
independently in tasks; what a block leaves undecided flies on in blocks of the next level, until
each source has one block.  The landing decides its last documents, at most two a source, so that
words, then documents, end nearest to the target; if one of them is long, up to `TURNS` documents
of that block are turned over to make up for it.

Draws follow a hash of the block and the ids, so that reruns agree.

Edge cases: a null or empty text has size 0 and costs nothing; null is a source of its own; a
source of size 0 has target 0 and takes nothing; equal rows (id, source, size) are one counted unit; an
empty table gives an empty result; only id, text and source are read.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.storage import stored

CYCLE = (1, 2, 3)
MOST = 3
BLOCK_UNITS = 2000
TURNS = 3
#: probabilities this close to 0 or 1 are decided
NEAR = 1e-9

UNITS = ("rank bigint, unit bigint, doc_id bigint, size bigint, share double, taken int, "
         "n bigint, sure bigint")
#: equal rows that are written out at a time
CHUNK = 1 << 16


def with_sizes(docs: DataFrame) -> DataFrame:
    """`doc_id`, `source`, `size`: the number of words."""
    words = r"size(filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x <> ''))"
    return docs.select(F.col("doc_id").cast("bigint"), "source",
                       F.expr(words).cast("bigint").alias("size"))


def targets(sized: DataFrame, cycle: Iterable[int] = CYCLE, most: int = MOST) -> DataFrame:
    """`source`, `rank`, `source_size`, `units`, `target`; one row per source.

    With l as the words per weight, a source gets least(most * size, l * weight).  Ordered by
    most * size / weight, the sources before some place are at their bound and l follows
    from the rest; the place is the first whose l does not exceed its own bound.
    """
    cycle = list(cycle)
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count("*").alias("units"))
    ranked = sums.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())).cast("bigint"))
    ranked = ranked.withColumn("weight", F.get(
        F.array(*map(F.lit, cycle)), ((F.col("rank") - 1) % len(cycle)).cast("int")))
    order = Window.orderBy("bound", "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything)
             - F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(before), F.lit(0))
             ) / F.sum("weight").over(onward)
    found = ranked.withColumn("bound", F.lit(most) * F.col("source_size") / F.col("weight")) \
        .withColumn("level", level) \
        .withColumn("fits", F.when(F.col("level") <= F.col("bound"), F.col("level"))) \
        .withColumn("l", F.first("fits", ignorenulls=True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    return found.select("source", "rank", "source_size", "units", F.when(
        F.col("l").isNull(), cap).otherwise(F.least(cap, F.col("l") * F.col("weight")))
        .alias("target"))


def flight(sizes: list[int], shares: list[float], draw: random.Random) -> list[float]:
    """Shares after the flight: at most two are not 0 or 1, and both sums are as before."""
    shares = list(shares)
    hand: list[int] = []
    for k in range(len(shares)):
        if not NEAR < shares[k] < 1 - NEAR:
            shares[k] = float(round(shares[k]))
            continue
        hand.append(k)
        while len(hand) == 3:
            a, b, c = (sizes[i] for i in hand)
            # a vector whose sum and whose sum weighted by size are 0
            way = (b - c, c - a, a - b) if not a == b == c else (1, -1, 0)
            up = min(((1 - shares[i]) / d if d > 0 else shares[i] / -d)
                     for i, d in zip(hand, way, strict=True) if d)
            down = min((shares[i] / d if d > 0 else (1 - shares[i]) / -d)
                       for i, d in zip(hand, way, strict=True) if d)
            step = up if draw.random() * (up + down) < down else -down
            for i, d in zip(hand, way, strict=True):
                shares[i] += step * d
                if shares[i] <= NEAR or shares[i] >= 1 - NEAR:
                    shares[i] = float(round(shares[i]))
            hand = [i for i in hand if 0 < shares[i] < 1]
    return shares


def landing(sizes: list[int], shares: list[float]) -> list[float]:
    """Decides the few shares left, nearest in words, then in documents, then in order.

    Then turns over up to `TURNS` decided ones, each time the one that brings the words nearest.
    """
    open_ = [k for k, s in enumerate(shares) if 0 < s < 1]
    if not open_:
        return shares
    words, number = sum(sizes[k] * shares[k] for k in open_), sum(shares[k] for k in open_)

    def distance(bits: int) -> tuple[float, float, int]:
        chosen = [k for j, k in enumerate(open_) if bits >> j & 1]
        return (abs(sum(sizes[k] for k in chosen) - words), abs(len(chosen) - number), bits)
    best = min(range(1 << len(open_)), key=distance)
    out = list(shares)
    for j, k in enumerate(open_):
        out[k] = float(best >> j & 1)
    over = sum(sizes[k] * out[k] for k in open_) - words
    for _ in range(TURNS):
        after, k = min((abs(over + (sizes[k] if out[k] == 0 else -sizes[k])), k)
                       for k in range(len(out)))
        if after >= abs(over):
            break
        over += sizes[k] if out[k] == 0 else -sizes[k]
        out[k] = 1 - out[k]
    return out


def _fly(land: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # the largest fly first, so that those left in the end are small
        rows = rows.sort_values(["size", "unit", "doc_id"], ascending=False, ignore_index=True)
        draw = random.Random(f"{key[0]}/{key[1]}/{len(rows)}/{rows['unit'].iloc[0]}")
        sizes = rows["size"].tolist()
        shares = flight(sizes, rows["share"].tolist(), draw)
        rows["share"] = landing(sizes, shares) if land else shares
        return rows[["rank", "unit", "doc_id", "size", "share", "taken", "n", "sure"]]
    return run


def mix(docs: DataFrame, cycle: Iterable[int] = CYCLE, most: int = MOST) -> DataFrame:
    """One row per document: `doc_id`, `source`, `size`, `source_size`, `target`, `copies`."""
    sized = stored(with_sizes(docs), "sizes")
    wanted = stored(targets(sized, cycle, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # n equal rows of share p are n p taken for sure, rounded down, and one unit of what is left;
    # a unit is a position in the hash order
    equal = sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n"))
    part = F.col("n") * (rate - F.floor(rate))
    units = equal.join(wanted, equal["source"].eqNullSafe(wanted["source"])).select(
        "rank", F.xxhash64("doc_id", "size").alias("unit"), "doc_id", "size",
        (part - F.floor(part)).alias("share"), F.floor(rate).cast("int").alias("taken"), "n",
        F.floor(part).alias("sure"), F.ceil(F.col("units") / BLOCK_UNITS).alias("blocks"))
    decided, level = [], 0
    blocks = wanted.agg(F.max(F.ceil(F.col("units") / BLOCK_UNITS))).first()[0] or 0
    while True:
        last = blocks <= 1
        number = F.pmod(F.xxhash64("unit", F.lit(level)), F.greatest("blocks", F.lit(1)))
        flown = stored(
            units.withColumn("block", number).groupBy("rank", "block")
            .applyInPandas(_fly(last), UNITS), "flight")
        decided.append(flown.where("share = 0 or share = 1"))
        if last:
            break
        undecided = flown.where("share > 0 and share < 1")
        left = undecided.groupBy("rank").agg(F.count("*").alias("units"))
        units = undecided.join(left, "rank").withColumn(
            "blocks", F.ceil(F.col("units") / BLOCK_UNITS)).drop("units")
        blocks = left.agg(F.max(F.ceil(F.col("units") / BLOCK_UNITS))).first()[0] or 0
        level += 1
    every = decided[0]
    for part in decided[1:]:
        every = every.unionByName(part)
    # equal rows in chunks, which several tasks write out
    chunks = every.withColumn("first", F.explode(F.expr(
        f"sequence(1L, n, {CHUNK}L)"))).repartition("rank", "doc_id", "size", "first")
    rows = chunks.withColumn("place", F.explode(F.expr(
        f"sequence(first, least(n, first + {CHUNK - 1}))")))
    return rows.join(wanted, "rank").select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("taken") + (F.col("place") <= F.col("sure") + F.col("share")).cast("int"))
        .alias("copies"))


def op10(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))
