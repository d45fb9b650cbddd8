"""Language identification by a byte convolutional network.

A text is cut into windows of `WINDOW` bytes (ASCII letters lower-cased, the last one padded).
Filters of several widths run over the bytes of a window; a filter of width k is k tables of 256
values, one for each byte at each of its places.  Each filter's maximum over the window goes
through a rectifier to a softmax over the languages.  A text's language is that of the
greatest mean probability over all its windows, and this mean is its score.

Fitting uses about `SAMPLE_PER_LANGUAGE` labelled texts of each language, chosen by a hash of the
id, and about `WINDOWS_PER_LANGUAGE` of all their windows, drawn by a hash from the whole texts, by
Adam in numpy.  Prediction covers every window of every text in one pass without a shuffle.

Edge cases: a null text and one without a letter are `und` with score 0, as is every text when
no labelled text is given; null languages and rows without id are not learned, and such rows are not held out; ties go to the language that sorts
first; an empty table gives an empty result; only id and text are read for a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm import words
from closebook.llm.sampling import remainder

WINDOW = 128
WIDTHS, FILTERS = (2, 3, 4), 8
SAMPLE_PER_LANGUAGE, WINDOWS_PER_LANGUAGE = 400, 4800
STEPS, BATCH, RATE = 500, 256, 0.02
#: windows worked on at once
AT_ONCE = 2048
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, and the number of windows of each text."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    row = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)[:-1]]) * WINDOW
    out = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    out[np.arange(len(data)) - offsets[row] + begin[row]] = words._LOWER[data]
    return out.reshape(-1, WINDOW), counts


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # for each width: (width, 256, FILTERS)
    weights: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], seed: int = 7) -> Network:
        draw = np.random.default_rng(seed)
        tables = [draw.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        return cls(languages, tables, draw.normal(0, 0.3, (n, len(languages)))
                   .astype(np.float32), np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, self.weights, self.bias]

    def pooled(self, x: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The greatest response of each filter in each window, and where it is."""
        best, where = [], []
        for table in self.tables:
            width = len(table)
            length = WINDOW - width + 1
            total = table[0].take(x[:, :length], axis=0)
            for k in range(1, width):
                total += table[k].take(x[:, k:k + length], axis=0)
            if places:
                at = total.argmax(axis=1)
                where.append(at)
                best.append(np.take_along_axis(total, at[:, None, :], 1)[:, 0])
            else:
                best.append(total.max(axis=1))
        return np.concatenate(best, 1), np.concatenate(where, 1) if places else best[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        parts = [np.zeros((0, len(self.languages)), np.float32)]
        for k in range(0, len(x), AT_ONCE):
            pooled, _ = self.pooled(x[k:k + AT_ONCE])
            parts.append(_softmax(np.maximum(pooled, 0) @ self.weights + self.bias))
        return np.concatenate(parts)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        pooled, where = self.pooled(x, places=True)
        hidden = np.maximum(pooled, 0)
        slope = _softmax(hidden @ self.weights + self.bias)
        slope[np.arange(len(y)), y] -= 1
        slope /= len(y)
        back = (slope @ self.weights.T) * (pooled > 0)
        out, rows = [], np.arange(len(x))[:, None]
        for i, table in enumerate(self.tables):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            grad = np.zeros_like(table)
            for k in range(len(table)):
                byte = x[rows, where[:, own] + k].astype(np.int64)
                flat = byte * FILTERS + np.arange(FILTERS)
                grad[k] = np.bincount(flat.ravel(), back[:, own].ravel(),
                                      256 * FILTERS).reshape(256, FILTERS)
            out.append(grad)
        return [*out, hidden.T @ slope, slope.sum(axis=0)]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam on batches drawn evenly from the languages."""
    net = Network.new(languages, seed)
    draw = np.random.default_rng(seed)
    own = [np.flatnonzero(y == k) for k in range(len(languages))]
    values = net.parameters()
    one, two = ([np.zeros_like(v) for v in values] for _ in range(2))
    for step in range(1, STEPS + 1):
        pick = np.concatenate([draw.choice(rows, BATCH // len(languages) + 1) for rows in own])
        rate = RATE * (1 - (step - 1) / STEPS)
        for k, slope in enumerate(net.gradients(x[pick], y[pick])):
            one[k] = 0.9 * one[k] + 0.1 * slope
            two[k] = 0.999 * two[k] + 0.001 * slope**2
            values[k] -= rate * (one[k] / (1 - 0.9**step)) / (
                np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)
    return net


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Network | None:
    """A network from documents (doc_id, text, lang); None without any labelled text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            x, counts = windows(data, offsets)
            seed = np.repeat(batch.column(3).to_numpy().view(np.uint64), counts)
            number = np.arange(len(x)) - np.repeat(np.cumsum(counts) - counts, counts)
            drawn = words.mix(seed + number.astype(np.uint64)) >> np.uint64(34)
            taken = drawn < np.repeat(batch.column(4).to_numpy() * 2**30, counts)
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "x": pa.array([x[e - n:e][taken[e - n:e]].tobytes()
                               for n, e in zip(counts, ends, strict=True)], pa.binary()),
                "lang": batch.column(2)})
    known = docs.where("doc_id is not null and lang is not null and text rlike '\\\\p{L}'").select(
        F.col("doc_id").cast("bigint"), "text", "lang")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    def rates(wanted: int, sums: dict[str, int]):
        """For each language the share that is expected to give as many as wanted."""
        return F.create_map(*[F.lit(v) for lang, n in sums.items()
                              for v in (lang, min(1.0, wanted / n))])[F.col("lang")]

    # a language's texts enter by a hash of the id, their windows by a hash of text and place
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) \
        < rates(per_language, counts) * (1 << 30)
    texts = known.where(chosen)
    held = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(
        F.sum(F.expr(f"(octet_length(text) + {WINDOW - 1}) div {WINDOW}")).alias("n")).collect()}
    if not held:
        return None
    found = texts.select(
        "doc_id", "text", "lang", F.xxhash64("doc_id", "text").alias("seed"),
        rates(WINDOWS_PER_LANGUAGE, held).alias("rate")
    ).mapInArrow(cut, "doc_id bigint, x binary, lang string").where("octet_length(x) > 0").collect()
    found.sort(key=lambda r: (r["doc_id"], r["x"]))
    languages = sorted({r["lang"] for r in found})
    x = [np.frombuffer(r["x"], np.uint8).reshape(-1, WINDOW) for r in found]
    y = np.repeat([languages.index(r["lang"]) for r in found], [len(v) for v in x])
    return fit(np.concatenate(x), y, languages) if found else None


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """One row per document: `lang_pred`, `score`."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text",
                       F.expr("coalesce(text rlike '\\\\p{L}', false)").alias("letters"))
    if net is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"),
                           F.lit(0.0).alias("score"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            best, score = [], []
            for first, last in words.runs(offsets):
                x, counts = windows(data[offsets[first]:offsets[last]],
                                    offsets[first:last + 1] - offsets[first])
                text = np.repeat(np.arange(last - first), counts)
                p = net.probabilities(x).astype(np.float64)
                mean = np.stack([np.bincount(text, p[:, k], last - first)
                                 for k in range(p.shape[1])], 1)
                mean = mean / np.maximum(counts, 1)[:, None]
                best.append(mean.argmax(axis=1))
                score.append(np.clip(mean.max(axis=1), 0, 1))
            none = [np.zeros(0)]
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            names = np.array(net.languages, object)[
                np.concatenate(best or none).astype(np.int64)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "lang_pred": pa.array(np.where(letters, names, UNKNOWN), pa.string()),
                "score": pa.array(np.where(letters, np.concatenate(score or none), 0.0)),
            })
    return rows.mapInArrow(ask, "doc_id bigint, lang_pred string, score double")


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = remainder("doc_id", FOLDS)
    net = train(docs.where(fold != HELD_OUT))
    return predict(docs, net).select(
        "doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")
