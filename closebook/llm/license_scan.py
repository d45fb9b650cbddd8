"""License scan by conditional compression.

Candidate blocks are the words around license cues.  A block is compressed by zstandard alone and
with each template as a raw dictionary.  Each template that makes it smaller is confirmed by its
wording: block and template are aligned word by word, and a template is found if the differences
are at most `DIFFERENCES` of its words.  The one with the fewest differences, then the largest
reduction, is taken, and what stands before and after its words is searched in the same way.

Texts without a cue are recognised by a regular expression in the scan and cost no Python.

Edge cases: a null or empty text has no block; equal reductions rank by template name; a text
that repeats a notice has one match for each time; empty tables give an empty result; only id
and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed values: wordings of public license notices
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, "
           "are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
           "software and associated documentation files",
}
CUE = r"(?i)licen[cs]|permission is|redistribut|copyright|all rights reserved"
#: words around a cue that belong to its block
AROUND = 30
DIFFERENCES = 0.1

_WORD = re.compile(r"[^\s]+")
_NORMAL = re.compile(r"[^\w.-]+|[.]$", re.ASCII)
MATCHES = "array<struct<start:int,end:int,template:string,reduction:double,differences:int>>"


def blocks(text: str) -> list[tuple[int, int]]:
    """Stretches (start, end) of words around cues; stretches that touch are one."""
    out: list[tuple[int, int]] = []
    spans = [m.span() for m in _WORD.finditer(text)]
    starts = [a for a, _ in spans]
    for cue in re.finditer(CUE, text):
        at = max(0, bisect_right(starts, cue.start()) - 1)
        first, last = max(0, at - AROUND), min(len(spans) - 1, at + AROUND)
        if out and spans[first][0] <= out[-1][1]:
            out[-1] = (out[-1][0], spans[last][1])
        else:
            out.append((spans[first][0], spans[last][1]))
    return out


def _words(text: str) -> list[str]:
    return [x for w in _WORD.findall(text.lower()) if (x := _NORMAL.sub("", w))]


def differences(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """Words to change, add or drop to find the template in the block, and where it is found.

    The closest run of matching pieces counts; a word that also stands elsewhere is left out.
    """
    pieces = [m for m in SequenceMatcher(None, block, template, autojunk=False)
              .get_matching_blocks() if m.size]
    best = (len(template), 0, 0)
    for k, first in enumerate(pieces):
        common = 0
        for last in pieces[k:]:
            common += last.size
            end = last.a + last.size
            best = min(best, (max(len(template) - common, end - first.a - common), first.a, end))
    return best


class Scanner:
    """Compressors of the templates, made once for each task."""

    def __init__(self, templates: Mapping[str, str]) -> None:
        self.alone = zstandard.ZstdCompressor(level=6)
        self.templates = [
            (name, _words(text), zstandard.ZstdCompressor(
                level=6, dict_data=zstandard.ZstdCompressionDict(
                    text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)))
            for name, text in sorted(templates.items())
        ]

    def matches(self, text: str) -> list[dict]:
        found, parts = [], blocks(text)
        while parts:
            start, end = parts.pop()
            own = [(w, start + m.start(), start + m.end()) for m in _WORD.finditer(text[start:end])
                   if (w := _NORMAL.sub("", m[0].lower()))]
            data = text[start:end].encode()
            size = len(self.alone.compress(data))
            checked = []
            for name, wording, compressor in self.templates:
                ratio = len(compressor.compress(data)) / size
                if ratio < 1:
                    n, first, last = differences(wording, [w for w, _, _ in own])
                    if first < last and n <= DIFFERENCES * len(wording):
                        checked.append((n, ratio, name, first, last))
            if checked:
                n, ratio, name, first, last = min(checked)
                found.append({"start": start, "end": end, "template": name,
                              "reduction": 1 - ratio, "differences": n})
                parts += [(a, b) for a, b in ((start, own[first][1]), (own[last - 1][2], end))
                          if a < b and _words(text[a:b])]
        return sorted(found, key=lambda m: (m["start"], m["end"]))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: `doc_id`, `n_blocks`, `matches`."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                               ("template", pa.string()), ("reduction", pa.float64()),
                               ("differences", pa.int32())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "n_blocks": pa.array([len(blocks(t)) if t else 0 for t in texts], pa.int32()),
                "matches": pa.array([scanner.matches(t) if t else [] for t in texts], kind),
            })
    cued = docs.select(F.col("doc_id").cast("bigint"),
                       F.when(F.col("text").rlike(CUE), F.col("text")).alias("text"))
    return cued.mapInArrow(rows, f"doc_id bigint, n_blocks int, matches {MATCHES}")


def op4(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_blocks",
        F.expr("array_join(array_sort(array_distinct(matches.template)), ',')").alias("licenses"),
        F.expr("aggregate(matches, 0, (n, m) -> n + m.differences)").alias("differences"),
        F.expr("round(array_max(matches.reduction), 6)").alias("reduction"),
    )
