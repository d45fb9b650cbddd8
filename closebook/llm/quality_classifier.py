"""Quality grades by ordinal cumulative-link regression on hashed text.

A document's text is hashed into `BUCKETS` counts: trigrams of character kinds (case, digits,
blanks, each punctuation mark) in one half, words in the other, besides a few
statistics of the words as one-hot values.  One weight vector w, shared by all grades, gives
f(x) = w.x, and ordered thresholds t1 < t2 < ... give P(grade <= k) = logistic(t[k+1] - f(x)).
Expected grade and tail probability P(grade >= k) follow.

Fitting uses at most `SAMPLE_PER_GRADE` labelled documents of each grade, in hash order; scoring
covers whole texts of all documents in one pass without a shuffle.

Edge cases: a null or empty text has no counts and is scored by its statistics; labels that are
null or name no document are not used; with fewer than two grades among the labels the grade is
the only one known (0 without labels); an empty table gives an empty result; columns besides id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm import words
from closebook.llm.sampling import labelled_sample

BUCKETS = 8192
#: documents of each grade that are fitted on, and of all grades together
SAMPLE_PER_GRADE, SAMPLE = 1500, 6000
#: more different grades than these are refused
MOST_GRADES = 1000
STEPS, RATE, DECAY = 250, 0.1, 1e-4
#: statistics of the words, each in tenths
STATISTICS, TENTHS = 3, 11
WIDTH = BUCKETS + STATISTICS * TENTHS

SCORE_SCHEMA = "doc_id bigint, expected_grade double, tail double, grade int"


def _kinds() -> np.ndarray:
    """A kind for each byte: letters by case, digits, blanks, other marks by themselves."""
    kind = np.arange(256, dtype=np.int64)
    kind[48:58], kind[65:91], kind[97:123] = ord("0"), ord("A"), ord("a")
    kind[128:] = ord("a")
    kind[[9, 11, 12, 13]] = 32
    return kind


_KINDS = _kinds()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of `WIDTH` values for each text; both halves have length 1."""
    n, half = len(offsets) - 1, BUCKETS // 2
    row = np.repeat(np.arange(n), np.diff(offsets))
    out = np.zeros((n, WIDTH), np.float32)
    if len(data) > 2:
        kind = _KINDS[data]
        code = (kind[:-2] << 16) | (kind[1:-1] << 8) | kind[2:]
        within = row[:-2] == row[2:]
        place = (words.mix(code[within]) % np.uint64(half)).astype(np.int64)
        counts = np.bincount(row[:-2][within] * half + place, minlength=n * half)
        out[:, :half] = counts.reshape(n, half)
    hashes, firsts = words.hash_words(data, offsets, words.BLANK_SEPARATED, lower=False)
    count = np.diff(firsts)
    owner = np.repeat(np.arange(n), count)
    place = (hashes % np.uint64(half)).astype(np.int64)
    out[:, half:BUCKETS] = np.bincount(owner * half + place,
                                       minlength=n * half).reshape(n, half)
    np.sqrt(out, out=out)
    for part in (out[:, :half], out[:, half:BUCKETS]):
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-6)
    several = np.maximum(count, 1)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    shares = (np.bincount(owner[same], minlength=n) / several,
              np.bincount(owner[order][new], minlength=n) / several,
              np.minimum(np.log2(several) / 12, 1))
    for k, share in enumerate(shares):
        out[np.arange(n), BUCKETS + k * TENTHS + (share * 10).astype(np.int64)] = 1
    return out


@dataclass(frozen=True)
class OrdinalModel:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, x: np.ndarray) -> np.ndarray:
        """P(grade > grades[k]) for each row and k, decreasing in k."""
        score = (x @ self.weights).astype(np.float64)
        return 1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))


def fit(x: np.ndarray, grade: np.ndarray) -> OrdinalModel:
    """Maximum likelihood with weight decay, by Adam on the whole sample.

    Grades count alike whatever their number of rows.  Gaps between thresholds are exponentials
    of free parameters, which keeps the thresholds ordered.
    """
    grades = sorted({int(g) for g in grade})
    if len(grades) < 2:
        return OrdinalModel(grades or [0], np.zeros(WIDTH, np.float32), np.zeros(0))
    k = np.searchsorted(grades, grade)
    rows, cuts = np.arange(len(k)), len(grades) - 1
    share = 1 / np.bincount(k)[k] / len(grades)
    weights = np.zeros(WIDTH, np.float32)
    free = np.zeros(cuts)
    moments = [[np.zeros_like(v), np.zeros_like(v)] for v in (weights, free)]
    for step in range(1, STEPS + 1):
        gaps = np.exp(free[1:])
        cut = np.concatenate([free[:1], free[0] + np.cumsum(gaps)])
        score = (x @ weights).astype(np.float64)
        below = 1 / (1 + np.exp(np.clip(score[:, None] - cut[None, :], -30, 30)))
        below = np.concatenate([np.zeros((len(k), 1)), below, np.ones((len(k), 1))], axis=1)
        slope = below * (1 - below)
        chance = np.maximum(below[rows, k + 1] - below[rows, k], 1e-9)
        on_score = share * (slope[rows, k + 1] - slope[rows, k]) / chance
        on_cut = np.zeros((len(k), cuts + 2))
        on_cut[rows, k + 1] -= share * slope[rows, k + 1] / chance
        on_cut[rows, k] += share * slope[rows, k] / chance
        on_cut = on_cut[:, 1:-1].sum(axis=0)
        later = on_cut[::-1].cumsum()[::-1]
        on_free = np.concatenate([later[:1], gaps * later[1:]])
        on_weights = (on_score.astype(np.float32) @ x) + DECAY * weights
        for value, slope_of, moment in zip((weights, free), (on_weights, on_free), moments,
                                           strict=True):
            moment[0] = 0.9 * moment[0] + 0.1 * slope_of
            moment[1] = 0.99 * moment[1] + 0.01 * slope_of**2
            value -= (RATE * (moment[0] / (1 - 0.9**step))
                      / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)).astype(value.dtype)
    cut = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
    return OrdinalModel(grades, weights, cut)


def train(docs: DataFrame, ratings: DataFrame, per_grade: int = SAMPLE_PER_GRADE,
          id_col: str = "doc_id") -> OrdinalModel:
    """A model from `ratings` (id, grade) of documents.

    Every grade is learned, from at most `per_grade` documents and an even share of `SAMPLE`.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            for first, last in words.runs(offsets):
                x = features(data[offsets[first]:offsets[last]],
                             offsets[first:last + 1] - offsets[first])
                at, place = np.nonzero(x)
                cut = np.searchsorted(at, np.arange(1, len(x)))
                values = x[at, place].astype(np.float16)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0)[first:last],
                    "place": pa.array([p.tobytes() for p in
                                       np.split(place.astype(np.uint16), cut)], pa.binary()),
                    "value": pa.array([p.tobytes() for p in np.split(values, cut)],
                                      pa.binary()),
                    "label": batch.column(2)[first:last],
                })
    ratings = ratings.where("grade is not null").select(
        id_col, F.col("grade").cast("int").alias("label"))
    grades = [r[0] for r in ratings.select("label").distinct().limit(MOST_GRADES + 1).collect()]
    if not grades:
        return fit(np.zeros((0, WIDTH), np.float32), np.zeros(0, int))
    if len(grades) > MOST_GRADES:
        raise ValueError(f"more than {MOST_GRADES} different grades: "
                         f"{ratings.select('label').distinct().count()}")
    per_grade = max(1, min(per_grade, SAMPLE // len(grades)))
    sample = labelled_sample(docs, ratings, sorted(grades), per_grade, id_col).select(
        F.col(id_col).cast("bigint"), "text", "label")
    found = sample.mapInArrow(
        rows, "doc_id bigint, place binary, value binary, label int").collect()
    found.sort(key=lambda r: (r["doc_id"], r["label"], r["place"]))
    x = np.zeros((len(found), WIDTH), np.float32)
    for k, row in enumerate(found):
        x[k, np.frombuffer(row["place"], np.uint16)] = np.frombuffer(row["value"], np.float16)
    return fit(x, np.array([r["label"] for r in found], int))


def grade(docs: DataFrame, model: OrdinalModel, least: int, id_col: str = "doc_id") -> DataFrame:
    """One row per document: expected grade, `tail` = P(grade >= least), likeliest grade."""
    values = np.array(model.grades, float)
    at = sum(g < least for g in model.grades)  # P(grade >= least) = P(above the one before)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            expected, tail, likely = [], [], []
            for first, last in words.runs(offsets):
                x = features(data[offsets[first]:offsets[last]],
                             offsets[first:last + 1] - offsets[first])
                above = model.above(x)
                above = np.concatenate([np.ones((len(x), 1)), above, np.zeros((len(x), 1))], 1)
                expected.append((above[:, :-1] - above[:, 1:]) @ values)
                tail.append(above[:, at])
                likely.append(values[np.argmax(above[:, :-1] - above[:, 1:], axis=1)])
            none = [np.zeros(0)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "expected_grade": pa.array(np.concatenate(expected or none)),
                "tail": pa.array(np.concatenate(tail or none)),
                "grade": pa.array(np.concatenate(likely or none).astype(np.int32)),
            })
    return docs.select(F.col(id_col).cast("bigint"), "text").mapInArrow(score, SCORE_SCHEMA)


def selected(docs: DataFrame, model: OrdinalModel, least: int, tail: float) -> DataFrame:
    """The documents with P(grade >= least) of at least `tail`, all columns as they are."""
    at = sum(g < least for g in model.grades)
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(place))
            good = [np.zeros(0, bool)]
            for first, last in words.runs(offsets):
                x = features(data[offsets[first]:offsets[last]],
                             offsets[first:last + 1] - offsets[first])
                above = np.concatenate([np.ones((len(x), 1)), model.above(x),
                                        np.zeros((len(x), 1))], 1)
                good.append(above[:, at] >= tail)
            yield batch.filter(pa.array(np.concatenate(good)))
    return docs.mapInArrow(keep, docs.schema)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from the labels: 0 poor, 1 sound text with abuse, 2 sound."""
    return labels.select("doc_id", F.expr(
        "case when quality = 0 then 0 when quality = 1 and toxic = 1 then 1 "
        "when quality = 1 then 2 end").alias("grade"))


#: documents are selected when the probability of a grade of at least 1 reaches this
LEAST_GRADE, LEAST_TAIL = 1, 0.5


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, ratings_of(labels))
    return grade(docs, model, LEAST_GRADE).withColumn("selected", F.col("tail") >= LEAST_TAIL)
