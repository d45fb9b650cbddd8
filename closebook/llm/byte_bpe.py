"""Byte-level BPE with a given rank file: ids of texts, and the bytes of ids.

`encode` splits texts by the tokenizer's pattern and merges the bytes of each match by rank, with
the tiktoken library and without special tokens; `decode` joins the bytes of the ids.  Both are
passes over Arrow batches without a shuffle.  The rank file is a path that every executor can
open; each Python worker reads it once.

A long text is encoded part by part, so the library's working memory follows the part, not the
text.  Parts end only where a match ends in the whole text too: behind a character that is no
white space and before white space, or between a letter or digit and punctuation.  No match of the
pattern holds both sides of such a place, and none looks behind itself.  Long runs of white space,
which the library's matcher cannot take, are cut out: by the pattern, such a run is one match,
less its last character when anything follows.

Edge cases: a null or empty text has no ids and decodes to no bytes; rows are encoded one by
one, so repeated and null ids stay apart; an empty table gives an empty table; columns besides id
and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: texts of more code points are encoded in parts of about so many
PART = 1 << 15
#: runs of white space of at least this length are cut out of long texts
LONG_RUN = 1 << 10
#: batches hold texts of about so many bytes, or one longer text
BATCH_BYTES = 1 << 22

#: fixed values: white space as the pattern's \s has it (the Unicode property White_Space)
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(f"[{_SPACE}]{{{LONG_RUN},}}")
#: places where a match ends whatever stands further left or right
_SAFE = re.compile(
    f"(?<=[^{_SPACE}])(?=[{_SPACE}])"
    "|(?<=[0-9A-Za-z\u4e00-\u9fa5])(?=[!-/:-@\\[-`{-~\u3001\u3002\uff0c])")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())}


@cache
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path),
                             special_tokens={})


def _cuts(text: str, first: int, last: int) -> Iterator[str]:
    """text[first:last] in parts that end at safe places."""
    while last - first > PART:
        found = _SAFE.search(text, first + PART, last)
        if found is None:
            break
        yield text[first:found.start()]
        first = found.start()
    if first < last:
        yield text[first:last]


def parts(text: str) -> Iterator[tuple[str, bool]]:
    """Parts of a text in order, and whether a part is one match of the pattern."""
    if len(text) <= PART:
        if text:
            yield text, False
        return
    first = 0
    for run in _RUN.finditer(text):
        yield from ((part, False) for part in _cuts(text, first, run.start()))
        first = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start():first], True
    yield from ((part, False) for part in _cuts(text, first, len(text)))


def encode_text(tokens: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a whole text."""
    own = [
        np.array(tokens._encode_single_piece(part) if match else tokens.encode_ordinary(part),
                 np.int32)
        for part, match in parts(text)
    ]
    return np.concatenate(own) if own else np.zeros(0, np.int32)


def _groups(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `limit` in sum, always whole rows."""
    first, total, k = 0, 0, -1
    for k, size in enumerate(sizes):
        if total and total + size > limit:
            yield first, k
            first, total = k, 0
        total += size
    if k >= 0:
        yield first, k + 1


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """`id_col`, `ids` (array of int) of every row's whole text."""
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def encoded(batches):
        tokens = encoding(rank_file, pattern)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for first, last in _groups(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                ids = [encode_text(tokens, text.as_py()) for text in texts[first:last]]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[first:last],
                    pa.ListArray.from_arrays(ends, np.concatenate(ids))], [id_col, "ids"])

    return source.mapInArrow(encoded, T.StructType([
        source.schema[0], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """`rows` with `decoded`, the bytes of its ids; null ids have none.

    Raw bytes, since the ids of a part of a text may end within a character.  An id that the rank
    file does not have is an error.  `decoded` must not be a column of `rows`.
    """
    at = rows.columns.index(ids_col)

    def decoded(batches):
        tokens = encoding(rank_file, pattern)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_pylist()
            for first, last in _groups(sizes, BATCH_BYTES // 4):
                part = batch.slice(first, last - first)
                texts = [tokens.decode_bytes(ids.as_py() or []) for ids in part.column(at)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary())],
                    [*batch.schema.names, "decoded"])

    return rows.mapInArrow(decoded, T.StructType([
        *rows.schema.fields, T.StructField("decoded", T.BinaryType())]))


def op12(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rank_file, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), rank_file, pattern)
    return decode(ids, rank_file, pattern).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
