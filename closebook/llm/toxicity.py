"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence ends at a full stop, exclamation or question mark or line end.  Its score is
logistic(bias + sum of the weights of its words and of their stems, the first `STEM` bytes, both
hashed into `BUCKETS`).  A document is toxic if
any sentence is: P = 1 - product(1 - score), a noisy-or.  The weights are learned from document
labels through the noisy-or, so that the sentences that carry a label are found on the way.

Fitting uses at most `SAMPLE_PER_CLASS` labelled documents of each class, in hash order, with
whole texts; scoring covers whole texts of all documents in one pass without a shuffle.

Edge cases: a null or empty text has no sentence and scores 0; null labels and labels without a
document are not used, and a row without id is not held out; without labels of both classes every score is 0; an empty table gives an
empty result; only the id and the text are read for a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm import words
from closebook.llm.sampling import labelled_sample, remainder

BUCKETS = 1 << 18
SAMPLE_PER_CLASS = 2000
#: words of fewer documents than this power of the sample's size keep the weight 0: 2 of 10
#: documents, 8 of 4000
SELDOM = 0.25
STEPS, RATE, DECAY, FIRST_BIAS = 200, 0.15, 1e-4, -7.0
STEM = 4
#: shares of clean and toxic documents in the loss; most documents are clean
CLASS_SHARES = (0.75, 0.25)
FOLDS = 5
ENDS = np.zeros(256, bool)
ENDS[list(b".!?\n")] = True

SCORE_SCHEMA = ("doc_id bigint, score double, "
                "offending array<struct<start:int,end:int,score:double>>")


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Buckets of the words and stems, their sentences, and the sentences' texts, starts, ends.

    Sentences without a word are left out.
    """
    starts, _, _ = words.word_bounds(words._LOWER[data], offsets, words.ALPHANUMERIC)
    hashes, firsts = words.hash_words(data, offsets, words.ALPHANUMERIC)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    ended = np.concatenate([np.zeros(1, np.int64), np.cumsum(ENDS[data])])
    key = ended[starts] + text  # grows at every sentence end and at every new text
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    marks = np.flatnonzero(ENDS[data])
    begin = starts[first]
    close = np.append(marks, len(data))[np.searchsorted(marks, begin)]
    owner = text[first]
    stems, _ = words.hash_words(data, offsets, words.ALPHANUMERIC, prefix=STEM)
    buckets = np.stack([hashes % np.uint64(BUCKETS), words.mix(stems) % np.uint64(BUCKETS)], 1)
    return (buckets.astype(np.int64).ravel(), np.repeat(number, 2), owner, begin,
            np.minimum(close, offsets[1:][owner]))


@dataclass(frozen=True)
class NoisyOr:
    weights: np.ndarray
    bias: float

    def scores(self, buckets: np.ndarray, number: np.ndarray) -> np.ndarray:
        total = np.bincount(number, self.weights[buckets])
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def fit(buckets: np.ndarray, number: np.ndarray, owner: np.ndarray,
        toxic: np.ndarray) -> NoisyOr:
    """Weights that make the noisy-or of each document's sentences agree with its label."""
    weights, bias = np.zeros(BUCKETS), FIRST_BIAS
    if len(set(toxic.tolist())) < 2 or not len(buckets):
        return NoisyOr(weights, -30.0)
    learned = np.bincount(np.unique(owner[number] * BUCKETS + buckets) % BUCKETS,
                          minlength=BUCKETS) >= round(len(toxic) ** SELDOM)
    places, inverse = np.unique(buckets, return_inverse=True)
    free = learned[places]
    w = np.zeros(len(places))
    share = (np.array(CLASS_SHARES) / np.bincount(toxic))[toxic]
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        total = np.clip(np.bincount(number, w[inverse], len(owner)) + bias, -30, 30)
        score = 1 / (1 + np.exp(-total))
        clean = np.bincount(owner, np.log1p(-score), len(toxic))  # log of 1 - P
        p = -np.expm1(clean)
        # d loss / d log(1 - P): for toxic documents (1 - P) / P, for others -1
        on_clean = np.where(toxic == 1, np.exp(clean) / np.maximum(p, 1e-9), -1.0) * share
        # log(1 - P) falls by the score as a sentence's sum grows; toxic documents want it low
        on_total = -on_clean[owner] * score
        slope = np.bincount(inverse, on_total[number], len(w)) * free + DECAY * w
        slope_bias = on_total.sum()
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        mb, vb = 0.9 * mb + 0.1 * slope_bias, 0.99 * vb + 0.01 * slope_bias**2
        one, two = 1 - 0.9**step, 1 - 0.99**step
        w -= RATE * (m / one) / (np.sqrt(v / two) + 1e-8)
        bias -= RATE * (mb / one) / (np.sqrt(vb / two) + 1e-8)
    weights[places] = w
    return NoisyOr(weights, bias)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> NoisyOr:
    """A model from `labels` (doc_id, toxic)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            for first, last in words.runs(offsets):
                buckets, number, owner, *_ = sentences(
                    data[offsets[first]:offsets[last]],
                    offsets[first:last + 1] - offsets[first])
                cut = np.searchsorted(owner[number], np.arange(1, last - first))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0)[first:last],
                    "buckets": pa.array([x.tobytes() for x in
                                         np.split(buckets.astype(np.int32), cut)], pa.binary()),
                    "number": pa.array([x.tobytes() for x in
                                        np.split(number.astype(np.int32), cut)], pa.binary()),
                    "label": batch.column(2)[first:last],
                })
    labels = labels.where("toxic in (0, 1)").select(
        "doc_id", F.col("toxic").cast("int").alias("label"))
    sample = labelled_sample(docs, labels, (0, 1), per_class).select(
        F.col("doc_id").cast("bigint"), "text", "label")
    found = sample.mapInArrow(
        rows, "doc_id bigint, buckets binary, number binary, label int").collect()
    found.sort(key=lambda r: (r["doc_id"], r["label"], r["buckets"]))
    buckets, number, owner, total = [], [], [], 0
    for k, row in enumerate(found):
        own = np.frombuffer(row["number"], np.int32).astype(np.int64)
        if len(own):
            own = own - own[0]
            buckets.append(np.frombuffer(row["buckets"], np.int32).astype(np.int64))
            number.append(own + total)
            owner.append(np.full(int(own[-1]) + 1, k))
            total += int(own[-1]) + 1
    none = [np.zeros(0, np.int64)]
    return fit(np.concatenate(buckets or none), np.concatenate(number or none),
               np.concatenate(owner or none), np.array([r["label"] for r in found], np.int64))


def score(docs: DataFrame, model: NoisyOr, least: float = 0.5) -> DataFrame:
    """One row per document: `score` and the sentences whose own score reaches `least`.

    Starts and ends count code points, the end is exclusive.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            scores, spans = [], []
            for first, last in words.runs(offsets):
                part = data[offsets[first]:offsets[last]]
                own = offsets[first:last + 1] - offsets[first]
                buckets, number, owner, begin, end = sentences(part, own)
                p = model.scores(buckets, number)
                clean = np.bincount(owner, np.log1p(-p), last - first)
                scores.append(-np.expm1(clean))
                found = [[] for _ in range(last - first)]
                at = np.flatnonzero(p >= least)
                if len(at):
                    points = np.concatenate([np.zeros(1, np.int64),
                                             np.cumsum((part & 0xC0) != 0x80)])
                    shift = points[own[:-1]]
                    for k in at:
                        o = owner[k]
                        found[o].append({"start": int(points[begin[k]] - shift[o]),
                                         "end": int(points[end[k]] - shift[o]),
                                         "score": float(p[k])})
                spans += found
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "score": pa.array(np.concatenate(scores or [np.zeros(0)])),
                "offending": pa.array(spans, pa.list_(pa.struct(
                    [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))),
            })
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(rows, SCORE_SCHEMA)


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = remainder("doc_id", FOLDS)
    model = train(docs, labels.where(fold != 0))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending",
    )
