r"""Collocations: phrases whose words stand together more often than apart.

Words are counted in weighted acyclic automata.  An arc carries a word and how often the phrase
that ends with it was seen; a path from the start spells a phrase of one to four words.

1. `counted` makes transducers of shards of text, arc by arc from sorted n-grams, and cuts
   them at prefix ranges, which are quantiles of sampled word pairs.
2. `united` brings the cuts of one range together, unites them and sums the weights of equal paths.
   A phrase is frequent only where its parts are, so words and pairs come first; longer phrases
   are counted only where a sieve of the frequent pairs lets all their pairs pass.  The sieve is a
   bitmap: it may let others pass, whose exact sums then drop them.
3. `part_counts` builds one minimal transducer for each range from its frequent phrases, in order,
   sharing equal states, and composes it with the acceptor of the parts asked for.

Counts are 64-bit sums, products are decimals.  No list of words or phrases goes through the driver:
it holds one pair of words for each RANGE_CHARS of text (40 MB for 100 TB) and a sieve of
at most 16 MB.  Ranges hold about equal shares of the text, a phrase of any frequency is one arc
per shard, and shards hold at most CHUNK_BYTES or one longer text.

Edge cases: a null or empty text has no words; a null language is `und`, together with texts so
marked; repeated rows count each time; an empty table gives an empty table; only text and language
are read, whatever other columns are called.
"""

from __future__ import annotations

import io
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.storage import WorkingTables, stored
from closebook.llm.words import _LOWER, mix, text_bytes, word_bounds

#: fixed values: what ends a piece, and what parts words within it
PIECE_ENDS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
LEAST_COUNT, LONGEST, TOP = 30, 4, 2000
#: a phrase goes when a longer one has at least this many hundredths of its count
SWALLOWED = 80
#: bytes of text counted at once
CHUNK_BYTES = 1 << 23
#: code points of text for one prefix range, and sampled pairs for each
RANGE_CHARS, SAMPLES_PER_RANGE = 1 << 24, 256
#: bits of the sieve for each frequent pair, and at most
SIEVE_BITS_EACH, MOST_SIEVE_BITS = 32, 1 << 27
BITMAP_BITS = 1 << 15
#: parts of a language that are ranked before the language is
RANK_PARTS = 64

_SEPARATES = np.ones(256, bool)
_SEPARATES[list((PIECE_ENDS + BLANKS).encode())] = False
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(PIECE_ENDS.encode())] = True

#: one level of a transducer: for each arc the arc before it, its word, and its count;
#: sorted by arc before and word
Level = tuple[np.ndarray, np.ndarray, np.ndarray]
Bounds = dict[str, list[tuple[bytes, bytes]]]


# --- words of texts ---------------------------------------------------------------------------

def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words in byte order, the word at each place, and whether the next place
    goes on in the same piece."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    starts, ends, firsts = word_bounds(data, offsets, _SEPARATES)
    piece = np.cumsum(_ENDS_PIECE[data], dtype=np.int32)[starts] if len(starts) else starts
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    goes_on = np.zeros(len(starts), bool)
    goes_on[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    spelled = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts),
        [None, pa.py_buffer(at), pa.py_buffer(data[_SEPARATES[data]])]).dictionary_encode()
    order = pc.sort_indices(spelled.dictionary).to_numpy().astype(np.int64)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return spelled.dictionary.take(pa.array(order)), number[spelled.indices.to_numpy()], goes_on


def _word_hashes(words: Iterable[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words], np.uint64)


def _slots(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Places of pairs of word hashes in a sieve of `bits`, a power of two."""
    pair = mix(first * np.uint64(0x9E3779B97F4A7C15) + mix(second))
    return (pair & np.uint64(bits - 1)).astype(np.int64)


# --- transducers of shards ---------------------------------------------------------------------

def _levels(words: int, at: np.ndarray, starts: list[np.ndarray],
            counted: Iterable[int]) -> list[Level]:
    """Arcs of the n-grams that begin at `starts`, by length; those not `counted` weigh nothing.

    Every start of a longer n-gram must be one of the shorter ones, so states exist before the
    arcs that leave them.  Sorted n-grams put each state's arcs next to each other.
    """
    out, state = [], np.zeros(len(at), np.int64)
    for k, places in enumerate(starts):
        keys, inverse, counts = np.unique(
            state[places] * words + at[places + k], return_inverse=True, return_counts=True)
        state[places] = inverse
        weights = counts if k + 1 in counted else np.zeros(len(keys), np.int64)
        out.append((keys // words, keys % words, weights.astype(np.int64)))
    return out


def _short(at: np.ndarray, goes_on: np.ndarray) -> list[np.ndarray]:
    """Starts of words and pairs."""
    return [np.arange(len(at)), np.flatnonzero(goes_on)]


def _long(at: np.ndarray, goes_on: np.ndarray, passes: np.ndarray) -> list[np.ndarray]:
    """Starts of phrases of three and four words all of whose pairs pass."""
    pair = goes_on & passes
    three = np.flatnonzero(pair[:-1] & pair[1:])
    four = three[np.append(pair, [False, False])[three + 2]]
    return [three, three, three, four]


def _cuts(levels: list[Level], words: pa.Array, bounds: list[tuple[bytes, bytes]]
          ) -> list[np.ndarray]:
    """For each level, how many of its paths lie before each bound."""
    def insertion(word: bytes) -> tuple[int, bool]:
        low, high = 0, len(words)
        while low < high:
            mid = (low + high) // 2
            if words[mid].as_py() < word:
                low = mid + 1
            else:
                high = mid
        return low, low < len(words) and words[low].as_py() == word

    first, second = [], []
    for one, two in bounds:
        number, known = insertion(one)
        arc = int(np.searchsorted(levels[0][1], number))
        has = known and arc < len(levels[0][1]) and levels[0][1][arc] == number
        first.append(arc + has)
        # within the pairs of the first word, those before the second
        begin, end = np.searchsorted(levels[1][0], [arc, arc + has])
        second.append(begin + (np.searchsorted(levels[1][1][begin:end], insertion(two)[0])
                               if has else 0))
    out = [np.array([0, *first, len(levels[0][0])]), np.array([0, *second, len(levels[1][0])])]
    for parents, _, _ in levels[2:]:
        out.append(np.append(np.searchsorted(parents, out[-1][:-1]), len(parents)))
        out[-1][0] = 0
    return out


def _segments(words: pa.Array, levels: list[Level], bounds: list[tuple[bytes, bytes]]
              ) -> Iterator[tuple[int, pa.Array, list[Level]]]:
    """The transducer's part in each prefix range, with the states that lead to it."""
    cuts = _cuts(levels, words, bounds)
    for k in range(len(bounds) + 1):
        own = [(int(cut[k]), int(cut[k + 1])) for cut in cuts]
        taken, below = [], None
        for (low, high), (parents, labels, weights) in zip(reversed(own), reversed(levels),
                                                           strict=True):
            begin, end = low, high
            if below is not None:  # states of the level below come along without their weight
                begin, end = (min(low, below[0]), max(high, below[1])) if high > low else below
            inside = np.arange(begin, end)
            taken.append((parents[begin:end], labels[begin:end],
                          np.where((inside >= low) & (inside < high), weights[begin:end], 0),
                          begin))
            below = (int(parents[begin]), int(parents[end - 1]) + 1) if end > begin else None
        taken.reverse()
        if not len(taken[0][0]):
            continue
        used = np.unique(np.concatenate([t[1] for t in taken]))
        yield k, words.take(pa.array(used)), [
            (t[0] - (taken[d - 1][3] if d else 0), np.searchsorted(used, t[1]), t[2])
            for d, t in enumerate(taken)]


def _packed(batch: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema,
                           options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue()


def _written(words: pa.Array, levels: list[Level]) -> tuple[bytes, bytes]:
    """The words and the arcs of a transducer as bytes."""
    arcs = [np.concatenate([level[k] for level in levels]) for k in range(3)]
    depth = np.repeat(np.arange(len(levels), dtype=np.int8), [len(level[0]) for level in levels])
    return (
        _packed(pa.RecordBatch.from_arrays([words], ["word"])),
        _packed(pa.RecordBatch.from_arrays(
            [pa.array(depth), *[pa.array(a) for a in arcs]], ["depth", "parent", "word", "n"])))


def _read(words: bytes, arcs: bytes) -> tuple[pa.Array, list[Level]]:
    labels = pa.ipc.open_stream(words).read_all()["word"].combine_chunks()
    table = pa.ipc.open_stream(arcs).read_all()
    depth, *rest = (table[c].to_numpy() for c in ("depth", "parent", "word", "n"))
    ends = np.searchsorted(depth, np.arange(int(depth[-1]) + 2))
    return labels, [tuple(r[a:b] for r in rest) for a, b in zip(ends, ends[1:], strict=False)]


def _shards(batches, columns: tuple[int, int]) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language, at most CHUNK_BYTES together or one longer text."""
    waiting: dict[str, list[pa.Array]] = {}
    sizes: dict[str, int] = {}

    def flushed(lang):
        sizes.pop(lang)
        return lang, pa.concat_arrays(waiting.pop(lang))

    for batch in batches:
        langs = batch.column(columns[0]).dictionary_encode()
        texts = batch.column(columns[1]).fill_null("").cast(pa.large_string())
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            own = texts.take(pa.array(np.flatnonzero(codes == code)))
            ends = np.cumsum(pc.binary_length(own).to_numpy())
            first = 0
            while first < len(own):
                room = CHUNK_BYTES - sizes.get(lang, 0) + (ends[first - 1] if first else 0)
                last = max(first + 1, int(np.searchsorted(ends, room, "right")))
                size = ends[last - 1] - (ends[first - 1] if first else 0)
                if lang in sizes and sizes[lang] + size > CHUNK_BYTES:
                    yield flushed(lang)
                    continue
                waiting.setdefault(lang, []).append(own[first:last])
                sizes[lang] = sizes.get(lang, 0) + int(size)
                first = last
        while sum(sizes.values()) > 2 * CHUNK_BYTES:
            yield flushed(max(sizes, key=sizes.get))
    for lang in list(sizes):
        yield flushed(lang)


def counted(docs: DataFrame, bounds: Bounds, sieve: np.ndarray | None = None) -> DataFrame:
    """`lang`, `range`, `words`, `arcs`: cuts of the shards' transducers.

    Of words and pairs without a sieve, else of phrases of three and four words whose pairs pass it.
    """
    def transducers(batches):
        for lang, texts in _shards(batches, (0, 1)):
            words, at, goes_on = _words(texts)
            if sieve is None:
                levels = _levels(len(words), at, _short(at, goes_on), (1, 2))
            else:
                hashes = _word_hashes(words.to_pylist(), lang)[at]
                slots = _slots(hashes[:-1], hashes[1:], 8 * len(sieve))
                passes = np.append((sieve[slots >> 3] >> (slots & 7)) & 1 == 1, False)
                if not len(at):
                    continue
                levels = _levels(len(words), at, _long(at, goes_on, passes), (3, 4))
            rows = [(k, *_written(own, cut))
                    for k, own, cut in _segments(words, levels, bounds.get(lang, []))]
            for k, own, arcs in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([k], pa.int32()), pa.array([own], pa.binary()),
                     pa.array([arcs], pa.binary())], ["lang", "range", "words", "arcs"])

    return docs.mapInArrow(transducers, "lang string, range int, words binary, arcs binary")


# --- union by prefix range ---------------------------------------------------------------------

def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, where each key is among them, and the exact sums of their weights."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if len(keys) else np.zeros(0, bool)
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    return ordered[new], inverse, (np.add.reduceat(weights[order], begins) if len(keys)
                                   else weights)


def union(parts: list[tuple[pa.Array, list[Level]]]) -> tuple[pa.Array, list[Level]]:
    """One transducer with the paths of all and the sums of their weights."""
    every = pa.concat_arrays([words for words, _ in parts]).dictionary_encode()
    order = pc.sort_indices(every.dictionary).to_numpy().astype(np.int64)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    new = number[every.indices.to_numpy()]
    labels, at = [], 0
    for words, _ in parts:
        labels.append(new[at:at + len(words)])
        at += len(words)
    states = [np.zeros(1, np.int64) for _ in parts]
    out = []
    for depth in range(max(len(levels) for _, levels in parts)):
        keys, weights, sizes = [], [], []
        for k, (_, levels) in enumerate(parts):
            parent, label, n = levels[depth] if depth < len(levels) else (
                np.zeros(0, np.int64),) * 3
            before = states[k][parent] if depth else np.zeros(len(parent), np.int64)
            keys.append(before * len(order) + labels[k][label])
            weights.append(n)
            sizes.append(len(parent))
        merged, inverse, sums = _sums(np.concatenate(keys), np.concatenate(weights))
        states = np.split(inverse, np.cumsum(sizes)[:-1])
        out.append((merged // len(order), merged % len(order), sums))
    return every.dictionary.take(pa.array(order)), out


def _frequent(words: pa.Array, levels: list[Level]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each level the words of its frequent paths, as a matrix, and their counts."""
    for depth, (_, _, weights) in enumerate(levels):
        arc, columns = np.flatnonzero(weights >= LEAST_COUNT), []
        counts = weights[arc]
        for parent, label, _ in reversed(levels[:depth + 1]):
            columns.append(label[arc])
            arc = parent[arc]
        yield np.stack(columns[::-1], axis=1), counts


def united(cuts: DataFrame) -> DataFrame:
    """`lang`, `range`, `n_words`, `phrase`, `f`, `pair` of the frequent phrases.

    `pair` is the hash of a phrase of two words.  A row of no words has the sum of all words
    of its range, frequent or not.
    """
    def sums(key, table):
        lang, number = key[0].as_py(), key[1].as_py()
        words, levels = union([_read(w, a) for w, a in zip(
            table["words"].to_pylist(), table["arcs"].to_pylist(), strict=True)])
        out = [pa.table({"n_words": pa.array([0], pa.int32()), "phrase": pa.array([""]),
                         "f": pa.array([int(levels[0][2].sum())]),
                         "pair": pa.array([None], pa.int64())})]
        for ids, counts in _frequent(words, levels):
            spelled = [words.take(pa.array(c)).cast(pa.large_string()) for c in ids.T]
            pair = pa.nulls(len(ids), pa.int64())
            if len(spelled) == 2:
                hashes = [_word_hashes(s.cast(pa.large_binary()).to_pylist(), lang)
                          for s in spelled]
                pair = pa.array(_slots(*hashes, MOST_SIEVE_BITS))
            out.append(pa.table({
                "n_words": pa.array(np.full(len(ids), len(spelled), np.int32)),
                "phrase": pc.binary_join_element_wise(
                    *spelled, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                "f": pa.array(counts), "pair": pair}))
        rows = pa.concat_tables(out)
        return rows.add_column(0, "range", pa.array([number] * len(rows), pa.int32())).add_column(
            0, "lang", pa.array([lang] * len(rows), pa.string()))

    return cuts.groupBy("lang", "range").applyInArrow(
        sums, "lang string, range int, n_words int, phrase string, f bigint, pair bigint")


def prefix_ranges(docs: DataFrame) -> Bounds:
    """For each language the pairs of words at which its prefix ranges begin, but the first.

    Every step-th code point of a text offers the pair of words that follows it; the place of the
    first depends on the text.  Of the sorted pairs, one in SAMPLES_PER_RANGE is a bound.  The
    sample decides how even the ranges are, and nothing else.
    """
    step = RANGE_CHARS // SAMPLES_PER_RANGE
    word = f"([^{PIECE_ENDS}{BLANKS}]+)"
    pair = f"[{PIECE_ENDS}{BLANKS}]{word}[{BLANKS}]+{word}[{PIECE_ENDS}{BLANKS}]"
    found = docs.select(
        "lang", "text", F.expr(f"pmod(xxhash64(text), {step})").alias("shift")
    ).select("lang", "text", "shift", F.explode(F.expr(
        f"sequence(0, cast((length(text) + shift) div {step} as int))")).alias("k")
    ).where("k > 0").select("lang", F.expr(
        f"substring(text, cast(k * {step} - shift as int), 512)").alias("text")).select(
        "lang", _lower(F.regexp_extract("text", pair, 1)).alias("one"),
        _lower(F.regexp_extract("text", pair, 2)).alias("two")).where("one <> ''")
    ordered = found.orderBy("lang", "one", "two").withColumn(
        "at", F.monotonically_increasing_id()).where(
        f"at % {1 << 33} % {SAMPLES_PER_RANGE} = {SAMPLES_PER_RANGE // 2}")
    bounds: dict[str, set[tuple[bytes, bytes]]] = {}
    for row in ordered.select("lang", "one", "two").collect():
        bounds.setdefault(row["lang"], set()).add((row["one"].encode(), row["two"].encode()))
    return {lang: sorted(pairs) for lang, pairs in bounds.items()}


def sieve_of(frequent: DataFrame) -> np.ndarray:
    """A bitmap of the frequent pairs."""
    pairs = frequent.where("n_words = 2")
    bits = BITMAP_BITS
    least = SIEVE_BITS_EACH * pairs.count()
    while bits < min(least, MOST_SIEVE_BITS):
        bits *= 2
    place = F.col("pair").bitwiseAND(bits - 1) + 1
    maps = pairs.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((bits // BITMAP_BITS, BITMAP_BITS // 8), np.uint8)
    for row in maps.collect():
        out[row["k"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


# --- counts of parts ----------------------------------------------------------------------------

class CountTransducer:
    """A minimal acyclic transducer from phrases to counts, built from phrases in order.

    A state maps a word to the count of the phrase that ends there and the next state.  Once a
    phrase leaves a state behind, nothing can be added to it, and it becomes the known state
    that is equal to it, if there is one.
    """

    def __init__(self) -> None:
        self.start: dict = {}
        self._path: tuple = ()
        self._open = [self.start]
        self._known: dict = {}

    def add(self, phrase: tuple, count: int) -> None:
        """Phrases must come in ascending order."""
        common = 0
        while common < min(len(phrase), len(self._path)) and phrase[common] == self._path[common]:
            common += 1
        self._close(common)
        for word in phrase[common:]:
            state: dict = {}
            self._open[-1][word] = (0, state)
            self._open.append(state)
        before = self._open[len(phrase) - 1]
        before[phrase[-1]] = (count, before[phrase[-1]][1])
        self._path = phrase

    def _close(self, depth: int) -> None:
        while len(self._open) > depth + 1:
            state = self._open.pop()
            key = tuple((word, n, id(after)) for word, (n, after) in state.items())
            word = self._path[len(self._open) - 1]
            self._open[-1][word] = (self._open[-1][word][0], self._known.setdefault(key, state))

    def finished(self) -> CountTransducer:
        self._close(0)
        return self

    def states(self) -> int:
        return len(self._known) + 1

    def compose(self, phrases: Iterable[tuple]) -> Iterator[tuple[tuple, int]]:
        """The given phrases, in ascending order, that the transducer knows, with their counts."""
        path: tuple = ()
        states: list = [self.start]
        for phrase in phrases:
            common = 0
            while common < min(len(phrase), len(path)) and phrase[common] == path[common]:
                common += 1
            del states[common + 1:]
            path, count = phrase[:len(states) - 1], 0
            for word in phrase[len(path):]:
                arc = states[-1].get(word)
                if arc is None:
                    break
                states.append(arc[1])
                path += (word,)
            if len(path) == len(phrase):
                count = states[-2][phrase[-1]][0]
            if count:
                yield phrase, count


def _range_of(bounds: list[tuple[bytes, bytes]], phrase: str) -> int:
    """The prefix range of a phrase; a single word stands before all pairs that begin with it."""
    return bisect_right(bounds, tuple(w.encode() for w in phrase.split(" ")))


def part_counts(frequent: DataFrame, parts: DataFrame, bounds: Bounds) -> DataFrame:
    """`lang`, `phrase`, `f` for the `parts` (lang, phrase), which are among the frequent ones."""
    def placed(batches):
        for batch in batches:
            langs, phrases = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ranges = [_range_of(bounds.get(lang, []), phrase)
                      for lang, phrase in zip(langs, phrases, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(ranges, pa.int32())], ["lang", "phrase", "range"])

    def spelled(table, *others):
        columns = [table["phrase"].to_pylist(), *[table[c].to_pylist() for c in others]]
        return sorted((tuple(w.encode() for w in row[0].split(" ")), *row[1:])
                      for row in zip(*columns, strict=True))

    def composed(key, counts, wanted):
        transducer = CountTransducer()
        for phrase, count in spelled(counts, "f"):
            transducer.add(phrase, count)
        found = list(transducer.finished().compose(p for p, in spelled(wanted)))
        return pa.table({
            "lang": pa.array([key[0].as_py()] * len(found), pa.string()),
            "phrase": pa.array([b" ".join(p).decode() for p, _ in found], pa.string()),
            "f": pa.array([n for _, n in found], pa.int64())})

    asked = parts.select("lang", "phrase").distinct().mapInArrow(
        placed, "lang string, phrase string, range int")
    known = frequent.where("n_words > 0").select("lang", "range", "phrase", "f")
    return known.groupBy("lang", "range").cogroup(asked.groupBy("lang", "range")).applyInArrow(
        composed, "lang string, phrase string, f bigint")


# --- phrases ------------------------------------------------------------------------------------

def _lower(text):
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frequent_phrases(docs: DataFrame, bounds: Bounds, tables: WorkingTables) -> DataFrame:
    """All phrases of up to LONGEST words that are seen LEAST_COUNT times, with their counts."""
    short = tables.stored(united(counted(docs, bounds)), "short")
    long = united(counted(docs, bounds, sieve_of(short))).where("n_words > 2")
    return short.unionByName(tables.stored(long, "long"))


def swallowed(candidates: DataFrame) -> DataFrame:
    """`lang`, `phrase`: candidates within a longer one that is nearly as frequent."""
    inner = candidates.where("n_words > 2").select("lang", "f", F.explode(F.expr(
        "flatten(transform(sequence(2, n_words - 1), size -> transform("
        "sequence(1, n_words - size + 1), first -> array_join(slice(words, first, size), ' '))))"
    )).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    return candidates.join(inner, ["lang", "phrase"]).where(
        f"cast(longer as decimal(20)) * 100 >= cast(f as decimal(20)) * {SWALLOWED}"
    ).select("lang", "phrase")


def scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """`candidates` with `l`, `r` and `score` of their lowest cut, the first of equals."""
    cut = candidates.withColumn("k", F.explode(F.expr("sequence(1, n_words - 1)"))).select(
        "lang", "phrase", "f", "k",
        F.expr("array_join(slice(words, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(words, k + 1, n_words), ' ')").alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    return cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr("cast(cast(f as decimal(20)) * 2000000"
                        " div (cast(l as decimal(20)) + cast(r as decimal(20))) as bigint)")
    ).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("s"), F.first("f").alias("a")
    ).select("lang", "phrase", "a", "s.l", "s.r", "s.score")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                 top: int = TOP) -> DataFrame:
    """Each language's best phrases: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`."""
    docs = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bounds = prefix_ranges(docs)
    with WorkingTables(docs.sparkSession) as tables:
        frequent = frequent_phrases(docs, bounds, tables)
        candidates = tables.stored(frequent.where("n_words > 1").select(
            "lang", "phrase", "f", "n_words", F.split("phrase", " ").alias("words")), "candidates")
        parts = candidates.select("lang", F.explode(F.expr(
            "flatten(transform(sequence(1, n_words - 1), k -> array("
            "array_join(slice(words, 1, k), ' '),"
            "array_join(slice(words, k + 1, n_words), ' '))))")).alias("phrase"))
        counts = tables.stored(part_counts(frequent, parts, bounds), "parts")
        sums = frequent.where("n_words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        # parts of a language are ranked first, so no task ranks all its phrases
        part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
        best = scored(candidates.join(swallowed(candidates), ["lang", "phrase"], "left_anti"),
                      counts).withColumn("part", part)
        for key in (["lang", "part"], ["lang"]):
            best = best.withColumn(
                "rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))
            ).where(F.col("rank") <= top)
        return stored(best.join(sums, "lang").select(
            "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n",
            "score"), "collocations")


def op13(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
