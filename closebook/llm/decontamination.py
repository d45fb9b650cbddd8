"""Benchmark decontamination with a distributed positional inverted index.

The words of the training texts are stored as postings in blocks: a block covers whole
documents of about `BLOCK_BYTES` bytes and holds, for each term, the ascending positions at
which it stands.  A gap between documents keeps matches from crossing them.  A phrase is found
by taking the postings of its rarest term (by the counts of the whole corpus), shifting them to
the phrase's start, and intersecting them with the shifted postings of the other terms, rarest
first.  Blocks are independent, so matching shuffles nothing; a lost block is read again.

Terms are 64-bit hashes of words.  Phrases are handed to the tasks in portions of at most
`PHRASES_AT_ONCE`; a larger benchmark takes more passes over the index, whose findings are put
together by a document's block and its place there, so rows that share an id stay apart.

Edge cases: a null or empty text has no words and no hits; an item without words is never
found; repeated items and items that share passages all count; an empty table gives an empty
result or no hits.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm import words
from closebook.llm.storage import stored

WINDOW_WORDS = 10
BLOCK_BYTES = 8 << 20
#: positions left free between two documents of a block; also the longest phrase and distance
GAP = 64
#: stands for a null id in the index
NO_ID = -(1 << 63)
#: phrases that one pass hands to each task: 20,000 of 10 words are about 3 MB
PHRASES_AT_ONCE = 20_000

INDEX_SCHEMA = ("block string, doc_ids binary, doc_starts binary, doc_words binary, terms binary, "
                "counts binary, positions binary")
HITS_SCHEMA = ("doc_id bigint, n_words bigint, hits array<struct<start:int,end:int>>, "
               "items array<string>")
#: a document's block and place in it tell it from all others, whatever its id
KEYED_SCHEMA = f"block string, place int, {HITS_SCHEMA}"


@dataclass(frozen=True)
class Phrases:
    """Phrases of equal treatment: their terms and the items that hold them."""

    terms: list[np.ndarray]
    items: list[list[str]]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: one row per block."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            for first, last in words.runs(offsets, BLOCK_BYTES):
                hashes, firsts = words.hash_words(
                    data[offsets[first]:offsets[last]],
                    offsets[first:last + 1] - offsets[first], words.ALPHANUMERIC,
                )
                counts = np.diff(firsts)
                starts = firsts[:-1] + GAP * np.arange(last - first)
                at = np.arange(len(hashes)) + GAP * np.repeat(np.arange(last - first), counts)
                order = np.argsort(hashes, kind="stable")
                terms, n = np.unique(hashes[order], return_counts=True)
                steps = np.diff(at[order].astype(np.int32), prepend=np.int32(0))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([uuid.uuid4().hex]),
                    **{name: pa.array([value], pa.binary()) for name, value in (
                        ("doc_ids", ids[first:last].tobytes()),
                        ("doc_starts", starts.astype(np.int64).tobytes()),
                        ("doc_words", counts.astype(np.int64).tobytes()),
                        ("terms", terms.tobytes()),
                        ("counts", pack(n.astype(np.int32).tobytes())),
                        ("positions", pack(steps.tobytes())),
                    )},
                })
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col))
    return stored(rows.mapInArrow(blocks, INDEX_SCHEMA), "postings")


def _unpack(value: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value), kind)


def phrase_table(items: DataFrame, window: int = WINDOW_WORDS, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """Every different window of the items, with the items that hold it.

    An item of fewer words than the window, but not none, is one window.
    """
    if not 0 < window <= GAP:
        raise ValueError(f"a window has 1 to {GAP} words")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            hashes, firsts = words.hash_words(data, offsets, words.ALPHANUMERIC)
            ids, terms = [], []
            for item, first, last in zip(batch.column(0).to_pylist(), firsts, firsts[1:],
                                         strict=False):
                for start in range(first, max(last - window + 1, min(first + 1, last))):
                    ids.append(item)
                    terms.append(hashes[start:min(start + window, last)].tobytes())
            yield pa.RecordBatch.from_pydict({
                "terms": pa.array(terms, pa.binary()), "item": pa.array(ids, pa.string()),
            })
    rows = items.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string"), F.col(text_col)
    )
    return rows.mapInArrow(windows, "terms binary, item string").groupBy("terms").agg(
        F.collect_set("item").alias("items")
    )


def _portions(phrases: DataFrame) -> Iterator[Phrases]:
    """The phrases in portions of bounded size, whatever the benchmark's size."""
    phrases = stored(phrases, "phrases")
    portions = -(-phrases.count() // PHRASES_AT_ONCE)
    for k in range(portions):
        part = phrases.where(F.pmod(F.xxhash64("terms"), F.lit(portions)) == k).collect()
        yield Phrases([np.frombuffer(r["terms"], np.uint64) for r in part],
                      [r["items"] for r in part])


def _corpus_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each term of the vocabulary stands in the whole corpus."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, counts in zip(*(batch.column(k).to_pylist() for k in (0, 1)),
                                     strict=True):
                at, found = _lookup(np.frombuffer(terms, np.uint64), vocabulary)
                total[found] += _unpack(counts, np.int32)[at[found]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"k": pa.array(some), "n": pa.array(total[some])})

    sums = index.select("terms", "counts").mapInArrow(count, "k bigint, n bigint") \
        .groupBy("k").agg(F.sum("n").alias("n"))
    out = np.zeros(len(vocabulary), np.int64)
    for row in sums.collect():  # at most one row per term of a portion
        out[row["k"]] = row["n"]
    return out


def _lookup(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted terms stand in the sorted terms, and which are there."""
    if not len(terms):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    return at, terms[at] == wanted


def _intersect(lists: list[np.ndarray], shifts: list[int]) -> np.ndarray:
    """Starts of a phrase, from the postings of its terms, rarest first."""
    starts = lists[0] - shifts[0]
    for postings, shift in zip(lists[1:], shifts[1:], strict=True):
        if not len(starts):
            break
        at = np.minimum(np.searchsorted(postings, starts + shift), len(postings) - 1)
        starts = starts[postings[at] == starts + shift]
    return starts


def _near(lists: list[np.ndarray], distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches around an occurrence of the rarest term in which every term stands.

    For each other term the occurrence closest to the rarest one counts; all must lie within
    `distance` of it, in any order.  Returns first and last position.
    """
    low = high = centre = lists[0]
    for postings in lists[1:]:
        if not len(centre):
            break
        at = np.searchsorted(postings, centre)
        after = postings[np.minimum(at, len(postings) - 1)]
        before = postings[np.maximum(at - 1, 0)]
        closest = np.where(np.abs(after - centre) < np.abs(before - centre), after, before)
        keep = np.abs(closest - centre) <= distance
        centre, closest = centre[keep], closest[keep]
        low, high = np.minimum(low[keep], closest), np.maximum(high[keep], closest)
    return low, high


def _search(index: DataFrame, phrases: Phrases, distance: int | None) -> DataFrame:
    """A keyed row for each document, with its hit stretches (word numbers) and items."""
    vocabulary = np.unique(np.concatenate(phrases.terms))
    frequency = _corpus_counts(index, vocabulary)
    numbers, shifts = [], []
    for terms in phrases.terms:
        own = np.searchsorted(vocabulary, terms)
        rarest = np.lexsort((np.arange(len(own)), frequency[own]))
        numbers.append(own[rarest])
        shifts.append(rarest)
    longest = max(len(x) for x in numbers)
    table = np.stack([np.pad(x, (0, longest - len(x)), mode="edge") for x in numbers])
    alive = np.flatnonzero((frequency[table] > 0).all(axis=1))

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _match_block(row)

    def _match_block(row: dict) -> pa.RecordBatch:
        ids = np.frombuffer(row["doc_ids"], np.int64)
        starts = np.frombuffer(row["doc_starts"], np.int64)
        n_words = np.frombuffer(row["doc_words"], np.int64)
        at, found = _lookup(np.frombuffer(row["terms"], np.uint64), vocabulary)
        ends = np.cumsum(_unpack(row["counts"], np.int32), dtype=np.int64)
        positions = np.cumsum(_unpack(row["positions"], np.int32), dtype=np.int64)
        hits: list[list[tuple[int, int]]] = [[] for _ in ids]
        items: list[set[str]] = [set() for _ in ids]

        def postings(term: int) -> np.ndarray:
            k = at[term]
            return positions[ends[k - 1] if k else 0:ends[k]]

        for k in alive[found[table[alive]].all(axis=1)]:
            lists = [postings(t) for t in numbers[k]]
            if distance is None:
                low = _intersect(lists, list(shifts[k]))
                high = low + len(numbers[k]) - 1
            else:
                low, high = _near(lists, distance)
            for doc, first, last in zip(np.searchsorted(starts, low, "right") - 1, low, high,
                                        strict=True):
                hits[doc].append((int(first - starts[doc]), int(last - starts[doc]) + 1))
                items[doc].update(phrases.items[k])
        return pa.RecordBatch.from_pydict({
            "block": pa.array([row["block"]] * len(ids), pa.string()),
            "place": pa.array(np.arange(len(ids), dtype=np.int32)),
            "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
            "n_words": pa.array(n_words, pa.int64()),
            "hits": pa.array(
                [[{"start": a, "end": b} for a, b in _merged(x)] for x in hits],
                pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
            ),
            "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        })

    return index.mapInArrow(matches, KEYED_SCHEMA)


def _merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(stretches):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def find_phrases(index: DataFrame, phrases: DataFrame, distance: int | None = None) -> DataFrame:
    """One row per indexed document: `n_words`, `hits`, `items`.

    `hits` are the disjoint stretches of words inside occurrences, ascending, end exclusive;
    `items` the benchmark items with an occurrence, sorted.  Without `distance` a phrase occurs
    where its words follow each other; with it, where all its words stand within that many
    words of its rarest one, in any order.
    """
    if distance is not None and not 0 <= distance < GAP:
        raise ValueError(f"a distance is less than {GAP}")
    parts = [stored(_search(index, p, distance), "hits") for p in _portions(phrases)]
    if not parts:
        def none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for ids, n in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                    rows = len(ids) // 8
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(known := np.frombuffer(ids, np.int64),
                                           mask=known == NO_ID),
                        "n_words": pa.array(np.frombuffer(n, np.int64)),
                        "hits": pa.array([[]] * rows, pa.list_(pa.struct(
                            [("start", pa.int32()), ("end", pa.int32())]))),
                        "items": pa.array([[]] * rows, pa.list_(pa.string())),
                    })
        return index.select("doc_ids", "doc_words").mapInArrow(none, HITS_SCHEMA)
    if len(parts) == 1:
        return parts[0].drop("block", "place")
    # a large benchmark: join the portions' findings of each document
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    every = found.groupBy("block", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return every.drop("block", "place").withColumn("hits", F.expr("""
        aggregate(array_sort(hits), cast(array() as array<struct<start:int,end:int>>),
          (done, x) -> if(size(done) > 0 and x.start <= element_at(done, -1).end,
            concat(slice(done, 1, size(done) - 1), array(named_struct(
              'start', element_at(done, -1).start,
              'end', greatest(element_at(done, -1).end, x.end)))),
            concat(done, array(x))))"""))


def contamination(docs: DataFrame, benchmark: DataFrame,
                  window: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: `n_words`, `n_hit`, `items`, `hits`, `contaminated`."""
    found = find_phrases(build_index(docs), phrase_table(benchmark, window))
    return found.select(
        "doc_id", "n_words",
        F.expr("aggregate(hits, 0L, (n, x) -> n + x.end - x.start)").alias("n_hit"),
        "items", "hits",
    ).withColumn("contaminated", F.col("n_hit") > 0)


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        "contaminated",
    )
