"""Bounded samples of labelled documents for the operators that fit a model."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, divisor: int):
    """crc32 of the id as text, modulo `divisor`; the folds of the contracts."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % divisor


def labelled_sample(docs: DataFrame, labels: DataFrame, classes: Iterable[int],
                    per_class: int, id_col: str = "doc_id") -> DataFrame:
    """Documents (id, text, label) with at most `per_class` labels of each class.

    The labels are taken in the order of a hash of the id, so the sample is the same every time.
    It has at most `per_class` rows a class whatever the input's size, and is therefore
    broadcast to the documents; their texts are not shuffled.  A repeated id counts once.
    """
    known = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max("label").alias("label"))
    parts = [
        known.where(F.col("label") == c).orderBy(F.xxhash64(id_col), id_col).limit(per_class)
        for c in classes
    ]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    return docs.select(id_col, "text").join(F.broadcast(chosen), id_col)
