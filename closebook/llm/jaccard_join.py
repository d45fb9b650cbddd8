"""Exact n-gram Jaccard join with signature trees.

A document's set is its different word shingles.  Documents with equal sets form one class and
only the class's smallest id is compared further.

Routing: two sets whose Jaccard similarity reaches the threshold differ in a number of shingles
that is bounded by their sizes.  Shingles are dealt by hash to more parts than that, so two
similar sets agree completely in at least one part; the hash of a part is a bucket key.  Empty
parts, which unlike sets share too, are no keys: there are spare parts for them, and sets with more
empty parts meet by a prefix filter on their smallest shingles.  Sets of similar size only share
keys (size ranges), and no key is dropped.

Comparison: the sets that share a bucket with the bucket's smallest id form a group, cut into
blocks of `BLOCK_SETS`.  Sets whose bitmaps
rule out every partner in their block leave it.  A task builds a signature tree over the others: its nodes hold the OR of
the token bitmaps below them and the range of sizes.  Two trees are traversed together; a pair of
nodes is left when its greatest possible overlap, read from the bitmaps, cannot reach the
threshold for its sizes, or when all its sets are known to be connected.  What remains is
verified on the sets.  Every block holds the group's first set, so blocks of near copies
meet in it; sets of a large group that are still apart are compared with all its other blocks.

Edge cases: a null or empty text has no shingles and links with nothing; a text of fewer words
than a shingle has one, its whole sequence; equal rows are one class; a row without id keeps a
null component; an empty table gives an empty result.  Only the id and the text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm import words
from closebook.llm.graph import components
from closebook.llm.storage import stored

BLOCK_SETS = 256
FAN_OUT = 8
#: parts beyond the necessary number, so that agreement in empty parts need not count
SPARE_PARTS, FEW_PARTS = 2, 24
#: bucket keys that a task hands on at once
KEY_ROWS = 1 << 18

SUM_SCHEMA = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint"
KEY_SCHEMA = "key bigint, k1 bigint"
EDGE_SCHEMA = "a bigint, b bigint"
REST_COLUMNS = ["center", "block", "portion", "doc_id", "component", "asks"]


class _Ranges:
    """Size ranges: similar sets lie in the same or in neighbouring ranges."""

    def __init__(self, percent: int) -> None:
        self.percent, self.first = percent, [1]

    def of(self, size: int) -> int:
        while self.first[-1] <= size:
            low = self.first[-1]
            self.first.append(max(low + 1, (low - 1) * 100 // self.percent + 1))
        return int(np.searchsorted(self.first, size, "right")) - 1

    def parts(self, level: int) -> tuple[int, int]:
        """Parts of a level, and how many of them may be ignored when empty.

        Similar sets a <= b of ranges `level` and `level` + 1 differ in at most
        a * (100 - percent) / percent shingles.
        """
        largest = self.first[level + 1] - 1
        parts = largest * (100 - self.percent) // self.percent + 1
        if parts <= FEW_PARTS:
            return parts, 0
        # a part is empty with about this probability; twice the expected number is hardly
        # exceeded, and with low thresholds, where parts are mostly empty, is not worth its keys
        empty = math.exp(-self.percent / max(100 - self.percent, 1))
        spare = SPARE_PARTS + int(parts * min(2 * empty, 0.1))
        return parts + spare, spare

    def prefix(self, size: int) -> int:
        """Similar sets have one of so many smallest tokens in common."""
        return size - (self.percent * size + 99) // 100 + 1


def _keys(tokens: np.ndarray, ranges: _Ranges) -> list[np.ndarray]:
    """Bucket keys of one set.

    An empty part has no key, which all sets with this part empty would share.  Similar sets agree
    in more parts than `spare`, so in a filled one if either has at most `spare` empty ones.  Sets
    with more have their smallest tokens as further keys; two similar ones share one of these.
    """
    out = []
    own = ranges.of(len(tokens))
    high = tokens >> np.uint64(32)
    codes = words.mix(tokens)
    code_low = (codes & np.uint64(0xFFFFFFFF)).astype(np.float64)
    code_high = (codes >> np.uint64(32)).astype(np.float64)
    for level in ([own - 1] if own else []) + [own]:
        parts, spare = ranges.parts(level)
        part = ((high * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        sums = np.bincount(part, code_low, parts).astype(np.uint64)
        sums += np.bincount(part, code_high, parts).astype(np.uint64) << np.uint64(32)
        keys = words.mix(sums ^ words.mix(
            np.arange(parts, dtype=np.uint64) + np.uint64(level << 32) + np.uint64(1)
        ))
        filled = np.bincount(part, minlength=parts) > 0
        out.append(keys[filled])
        if (~filled).sum() > spare:
            salt = words.mix(np.array([(level << 32) + (1 << 31)], np.uint64))
            out.append(words.mix(tokens[:ranges.prefix(len(tokens))] ^ salt))
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def shingle_sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The sorted different shingles of each text of a batch (id, text)."""
    data, offsets = words.text_bytes(batch.column(1))
    for first, last in words.runs(offsets):
        hashes, firsts = words.hash_words(data[offsets[first]:offsets[last]],
                                          offsets[first:last + 1] - offsets[first],
                                          words.BLANK_SEPARATED)
        tokens, at = words.shingles(hashes, firsts, size)
        for a, b in zip(at, at[1:], strict=False):
            yield np.unique(tokens[a:b])


def _sums(tokens: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits that tell a set from others."""
    return words.mix(tokens).sum(dtype=np.uint64), words.mix(~tokens).sum(dtype=np.uint64)


def _classed(docs: DataFrame, size: int) -> DataFrame:
    """For each document the size of its set and the set's 128-bit sum."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(x), *_sums(x)) for x in shingle_sets(batch, size)]
            table = np.array(sets, np.uint64).reshape(-1, 3)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **{
                name: pa.array(_signed(np.ascontiguousarray(table[:, k])))
                for k, name in enumerate(("n_shingles", "k1", "k2"))}})
    return docs.mapInArrow(sums, SUM_SCHEMA)


def _routed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The bucket keys of the sets, each with half of the set's sum.

    A task routes equal sets once, so many copies make no more rows of a key than tasks.
    """
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, seen = _Ranges(percent), set()
        keys, sums, waiting = [], [], 0
        for batch in batches:
            for tokens in shingle_sets(batch, size):
                own = _sums(tokens)
                if len(tokens) and own not in seen:
                    seen.add(own)
                    own_keys = _keys(tokens, ranges)
                    keys += own_keys
                    sums += [own[0]] * len(own_keys)
                    waiting += sum(map(len, own_keys))
                if waiting > KEY_ROWS:
                    yield _key_batch(keys, sums)
                    keys, sums, waiting = [], [], 0
        if keys:
            yield _key_batch(keys, sums)
    return docs.mapInArrow(route, KEY_SCHEMA)


def _key_batch(keys: list[np.ndarray], sums: list[np.uint64]) -> pa.RecordBatch:
    own = np.repeat(np.array(sums, np.uint64), [len(k) for k in keys])
    return pa.RecordBatch.from_pydict({"key": pa.array(_signed(np.concatenate(keys))),
                                       "k1": pa.array(_signed(own))})


def _payload(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """`doc_id`, `tokens`, `n`, `map` (the token bitmap) of the documents whose ids are given."""
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch, size))
            maps = [bitmap(x, _bits(len(x))).tobytes() for x in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "tokens": pa.array([x.tobytes() for x in sets], pa.binary()),
                "n": pa.array([len(x) for x in sets], pa.int64()),
                "map": pa.array(maps, pa.binary())})
    return docs.join(ids, "doc_id", "left_semi").mapInArrow(
        tokens, "doc_id bigint, tokens binary, n bigint, map binary")


def _bits(size: int) -> int:
    """Width of the bitmap for sets of up to `size` tokens: a power of 2."""
    return 1 << int(np.clip(np.ceil(np.log2(4 * max(size, 1))), 9, 16))


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits // 64, np.uint64)
    at = (tokens >> np.uint64(20)) & np.uint64(bits - 1)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64),
                     np.uint64(1) << (at & np.uint64(63)))
    return out


def _block_survivors(percent: int):
    """The sets of a block whose bitmaps leave a similar partner in it possible.

    Bitmaps are a sixteenth of the sets; what they rule out needs no tokens.
    """
    def survivors(table: pa.Table) -> pa.Table:
        numbers = np.arange(table.num_rows)
        keep = _with_partner(table, [(k, numbers[k + 1:]) for k in numbers[:-1]], percent)
        return table.select(["center", "block", "doc_id"]).filter(pa.array(keep))
    return survivors


def _rest_survivors(percent: int):
    """The same for sets that ask and sets of other components that are told."""
    def survivors(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False)
        label = table["component"].to_numpy()
        told = np.flatnonzero(~asks)
        keep = _with_partner(table, [(k, told[label[told] != label[k]])
                                     for k in np.flatnonzero(asks)], percent)
        return table.select(REST_COLUMNS).filter(pa.array(keep))
    return survivors


def _with_partner(table: pa.Table, pairs: list[tuple[int, np.ndarray]],
                  percent: int) -> np.ndarray:
    """Which rows (n, map) have a possible partner among the pairs (one row, other rows)."""
    n = table["n"].to_numpy()
    maps = [np.frombuffer(x.as_py(), np.uint64) for x in table["map"]]
    width = min(map(len, maps))  # wider maps fold: a bit's place is a remainder of the token
    maps = np.stack([np.bitwise_or.reduce(x.reshape(-1, width), axis=0) for x in maps])
    slack = n - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
    keep = np.zeros(len(n), bool)
    for k, rest in pairs:
        rest = rest[100 * np.minimum(n[k], n[rest]) >= percent * np.maximum(n[k], n[rest])]
        most = np.bitwise_count(maps[k] & maps[rest]).sum(axis=1).astype(np.int64)
        most += np.minimum(slack[k], slack[rest])
        rest = rest[(100 + percent) * most >= percent * (n[k] + n[rest])]
        keep[k] |= len(rest) > 0
        keep[rest] = True
    return keep


class SignatureTree:
    """Sets as leaves; each node has the OR of the bitmaps below it and the range of sizes.

    `slack` is the largest number of tokens of one set below that share bits with others of the
    same set; a set's overlap with anything is at most its slack plus the common bits.
    """

    def __init__(self, sets: list[np.ndarray], bits: int) -> None:
        sizes = np.array([len(s) for s in sets])
        smallest = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
        #: neighbours in this order are alike: equal smallest token, then size
        self.order = np.lexsort((sizes, smallest))
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, k in enumerate(self.order):
            maps[row] = bitmap(sets[k], bits)
        sizes = sizes[self.order]
        slack = sizes - np.bitwise_count(maps).sum(axis=1)
        #: from the leaves to the root: bitmaps, smallest and largest size, slack
        self.levels = [(maps, sizes, sizes, slack)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, slack = self.levels[-1]
            cut = np.arange(0, len(maps), FAN_OUT)
            self.levels.append((np.bitwise_or.reduceat(maps, cut, axis=0),
                                np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut),
                                np.maximum.reduceat(slack, cut)))


def _possible(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether the node pairs (i of x, j of y) can hold a similar pair of sets."""
    small = np.maximum(x[1][i], y[1][j])  # the larger of the smallest sizes
    large = np.minimum(x[2][i], y[2][j])  # the smaller of the largest sizes
    fits = 100 * large >= percent * small
    i, j = i[fits], j[fits]
    common = np.bitwise_count(x[0][i] & y[0][j]).sum(axis=1)
    most = common + np.minimum(x[3][i], y[3][j])
    fits[fits] = (100 + percent) * most >= percent * (x[1][i] + y[1][j])
    return fits


def similar_pairs(sets: list[np.ndarray], other: list[np.ndarray] | None, percent: int,
                  labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs that connect every two similar sets, by dual traversal of signature trees.

    Numbers of a pair are places in `sets` followed by `other`; without `other`, pairs within
    `sets` are sought, else pairs between the two.  Pairs that earlier pairs or equal `labels`
    already connect are left out, so there are fewer pairs than sets.
    """
    every = sets + (other or [])
    label = np.arange(len(every)) if labels is None else labels.copy()
    edges: list[tuple[int, int]] = []

    def verify(a: int, b: int) -> None:
        if label[a] == label[b]:
            return
        x, y = every[a], every[b]
        common = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * common >= percent * (len(x) + len(y) - common):
            edges.append((a, b))
            label[label == label[b]] = label[a]

    for k in range(1, len(every)):  # the first set connects most of a group of near copies
        verify(0, k)
    if (label == label[0]).all():
        return edges
    bits = _bits(max(map(len, every)))
    left = SignatureTree(sets, bits)
    right = SignatureTree(other, bits) if other is not None else left
    shift = len(sets) if other is not None else 0
    depth = max(len(left.levels), len(right.levels)) - 1
    i = j = np.zeros(1, np.int64)
    for level in range(depth, -1, -1):
        x = left.levels[min(level, len(left.levels) - 1)]
        y = right.levels[min(level, len(right.levels) - 1)]
        lone = [label[t.order + s] for t, s in ((left, 0), (right, shift))]
        for k, part in enumerate(lone):
            width = FAN_OUT ** min(level, len((left, right)[k].levels) - 1)
            cut = np.arange(0, len(part), width)
            low, high = np.minimum.reduceat(part, cut), np.maximum.reduceat(part, cut)
            lone[k] = np.where(low == high, low, -1 - k)  # -1, -2: of several components
        keep = lone[0][i] != lone[1][j]
        i, j = i[keep], j[keep]
        keep = _possible(x, y, i, j, percent)
        i, j = i[keep], j[keep]
        if level:
            i, j = _children(i, j, left, right, level, other is None)
    a, b = left.order[i], right.order[j] + shift
    for p, q in zip(a, b, strict=True):
        verify(int(p), int(q))
    return edges


def _children(i: np.ndarray, j: np.ndarray, left: SignatureTree, right: SignatureTree,
              level: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    def below(k: np.ndarray, tree: SignatureTree) -> tuple[np.ndarray, np.ndarray]:
        if level >= len(tree.levels):  # a lower tree waits at its root
            return k[:, None], np.ones((len(k), 1), bool)
        child = k[:, None] * FAN_OUT + np.arange(FAN_OUT)
        return child, child < len(tree.levels[level - 1][0])
    a, a_there = below(i, left)
    b, b_there = below(j, right)
    there = a_there[:, :, None] & b_there[:, None, :]
    p = np.broadcast_to(a[:, :, None], there.shape)[there]
    q = np.broadcast_to(b[:, None, :], there.shape)[there]
    if same:  # each pair once; at the leaves no set with itself
        keep = p < q if level == 1 else p <= q
        p, q = p[keep], q[keep]
    return p, q


def _block_edges(percent: int):
    def edges(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        ids = table["doc_id"].to_numpy()
        first = int(np.argmax(ids == table["center"][0].as_py()))  # 0 if it has no partner
        order = [first, *(k for k in range(len(ids)) if k != first)]
        sets = [np.frombuffer(table["tokens"][k].as_py(), np.uint64) for k in order]
        pairs = similar_pairs(sets, None, percent)
        ids = ids[order]
        return _edge_table([(ids[a], ids[b]) for a, b in pairs])
    return edges


def _rest_edges(percent: int):
    """Edges between components, from the sets that ask and those that are told."""
    def edges(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False)
        label = table["component"].to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table["tokens"]]
        one, two = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(one) or not len(two):
            return _edge_table([])
        order = np.concatenate([one, two])
        pairs = similar_pairs([sets[k] for k in one], [sets[k] for k in two], percent,
                              label[order])
        return _edge_table([(label[order[a]], label[order[b]]) for a, b in pairs])
    return edges


def _edge_table(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([int(a) for a, _ in pairs], pa.int64()),
                     "b": pa.array([int(b) for _, b in pairs], pa.int64())})


def _links(docs: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame:
    """Components of the sets in `groups` (center, doc_id): node, component."""
    sizes = groups.groupBy("center").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK_SETS).cast("int"))
    members = groups.where("doc_id <> center").join(sizes, "center").withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.col("blocks").cast("bigint")).cast("int")
    ).select("center", "block", "doc_id", "blocks")
    firsts = sizes.select("center", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
                          F.col("center").alias("doc_id"), "blocks")
    rows = groups.count()
    placed = stored(members.unionByName(firsts), "blocks", 2 * rows)
    ids = placed.select("doc_id").distinct()
    payload = stored(_payload(docs, ids, size), "sets")
    likely = placed.select("center", "block", "doc_id").join(
        payload.select("doc_id", "n", "map"), "doc_id"
    ).groupBy("center", "block").applyInArrow(
        _block_survivors(percent), "center bigint, block int, doc_id bigint")
    loaded = stored(likely, "likely", 2 * rows).join(payload.select("doc_id", "tokens"), "doc_id")
    edges = stored(
        loaded.groupBy("center", "block").applyInArrow(_block_edges(percent), EDGE_SCHEMA),
        "links",
    )
    found = stored(components(edges), "components", 2 * rows)
    # sets of a group of several blocks that are not connected with its first set
    large = placed.where("blocks > 1 and (block = 0 or doc_id <> center)").join(
        found.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    ).withColumn("component", F.coalesce("component", "doc_id"))
    core = large.where("doc_id = center").select("center", F.col("component").alias("core"))
    large = stored(large.join(core, "center"), "large", rows)
    apart = large.where("component <> core")
    if apart.isEmpty():
        return found
    apart = apart.join(
        apart.groupBy("center").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int")
                                    .alias("asking")), "center",
    ).withColumn("portion", F.pmod(F.xxhash64("doc_id", F.lit(1)),
                                   F.col("asking").cast("bigint")).cast("int"))
    asks = apart.select("center", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
                        "portion", "doc_id", "component", F.lit(True).alias("asks"))
    told = large.join(apart.select("center", "asking").distinct(), "center").select(
        "center", "block", F.explode(F.expr("sequence(0, asking - 1)")).alias("portion"),
        "doc_id", "component", F.lit(False).alias("asks"),
    )
    likely = asks.unionByName(told).join(payload.select("doc_id", "n", "map"), "doc_id").groupBy(
        "center", "block", "portion"
    ).applyInArrow(_rest_survivors(percent), "center bigint, block int, portion int, "
                   "doc_id bigint, component bigint, asks boolean")
    rest = stored(likely, "likely").join(payload.select("doc_id", "tokens"), "doc_id").groupBy(
        "center", "block", "portion"
    ).applyInArrow(_rest_edges(percent), EDGE_SCHEMA)
    rest = stored(rest, "links")
    if rest.isEmpty():
        return found
    joined = components(rest).select(F.col("node").alias("component"),
                                     F.col("component").alias("joined"))
    return found.join(joined, "component", "left").select(
        "node", F.coalesce("joined", "component").alias("component")
    ).unionByName(
        # sets that had no link yet
        joined.join(found, joined["component"] == found["node"], "left_anti")
        .select(F.col("component").alias("node"), F.col("joined").alias("component"))
    )


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `n_shingles`, `class_id`, `component_id`.

    Two documents link when `percent` or more of the union of their sets is common.
    `class_id` is the smallest id with the same set, `component_id` the smallest id reachable by
    links, the document included.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent lies between 1 and 100")
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("text"))
    routed = stored(_classed(docs, shingle_words), "sums")
    some = routed.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("n_shingles", "k1", "k2").agg(F.min("doc_id").alias("class_id"))
    classes = stored(classes, "classes", routed.count())
    keyed = _routed(docs.where("doc_id is not null"), shingle_words, percent)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    # classes with equal halves of their sums only add candidates
    buckets = stored(
        keyed.join(shared, "key").distinct().join(
            classes.select("k1", F.col("class_id").alias("doc_id")), "k1")
        .select("key", "doc_id"), "buckets")
    centers = buckets.groupBy("key").agg(F.min("doc_id").alias("center"),
                                         F.max("doc_id").alias("last")).where("center < last")
    groups = stored(buckets.join(centers.select("key", "center"), "key")
                    .select("center", "doc_id").distinct(), "groups")
    found = _links(docs, groups, shingle_words, percent)
    classes = classes.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    return routed.select("doc_id", "n_shingles", "k1", "k2").join(
        classes, ["n_shingles", "k1", "k2"], "left"
    ).select("doc_id", "n_shingles",
             F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
             .alias("class_id"),
             F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id"))
             .alias("component_id"))


def op8(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, shingle_words=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")
