from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from closebook.llm import byte_bpe
from tests.conftest import SMALL

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def merged(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """The merges of one match, lowest rank first, leftmost of equals first."""
    own = [piece[k:k + 1] for k in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(own, own[1:], strict=False))
                 if a + b in ranks]
        if not pairs:
            return [ranks[token] for token in own]
        _, k = min(pairs)
        own[k:k + 2] = [own[k] + own[k + 1]]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_query_equals_another_library_on_the_whole_table(spark):
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = {}
    for doc in docs:
        ids = other.encode(doc["text"] or "", add_special_tokens=False).ids
        want[doc["doc_id"]] = (len(ids), sha(" ".join(map(str, ids)).encode()),
                               sha((doc["text"] or "").encode()))
    got = byte_bpe.op12(spark, SMALL).collect()
    assert len(got) == len(docs)
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
            for r in got} == want


def test_merges_by_rank():
    ranks, tokens = byte_bpe.read_ranks(RANKS), byte_bpe.encoding(RANKS, PATTERN)
    for text in ("It's 1997's  end,\n\n we'll see… naïve 漢字 <|endoftext|>", "a" * 50, " \t x"):
        want = [i for m in regex.findall(PATTERN, text) for i in merged(ranks, m.encode())]
        assert byte_bpe.encode_text(tokens, text).tolist() == want


@pytest.mark.parametrize("seed", range(30))
def test_parts_change_nothing(monkeypatch, seed):
    draw = random.Random(seed)
    monkeypatch.setattr(byte_bpe, "PART", 40)
    monkeypatch.setattr(byte_bpe, "_RUN", byte_bpe.re.compile(f"[{byte_bpe._SPACE}]{{5,}}"))
    alphabet = ["a", "B", "7", " ", "  ", "\n", "\t", "　", "\x85", "\x1c", "'s", "'", "!",
                "é", "漢", "。", " " * 7, "\n" * 9, "don't", "x" * 60, "漢" * 50, "́", "🙂"]
    text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(400)))
    text += draw.choice(["", " " * 20, "\n"])
    tokens = byte_bpe.encoding(RANKS, PATTERN)
    got = list(byte_bpe.parts(text))
    assert "".join(part for part, _ in got) == text
    assert byte_bpe.encode_text(tokens, text).tolist() == tokens.encode_ordinary(text)


@pytest.mark.parametrize("text", [
    " " * 3_000_000, "x" + " \n" * 1_000_000 + "y", "a" * 1_000_000, "漢" * 300_000,
    "word " * 400_000, "!" * 500_000])
def test_very_long_texts_round_trip(text):
    tokens = byte_bpe.encoding(RANKS, PATTERN)
    assert tokens.decode_bytes(byte_bpe.encode_text(tokens, text).tolist()) == text.encode()


def test_edges(spark):
    rows = [(1, None, 5, "k"), (2, "", 5, None), (3, "a b", None, "k"), (3, "a b", 1, "k"),
            (None, "z" * 5, 1, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids bigint, decoded string")
    ids = byte_bpe.encode(docs, RANKS, PATTERN)
    got = byte_bpe.decode(ids, RANKS, PATTERN).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in got) == [
        (0, "zzzzz"), (1, ""), (2, ""), (3, "a b"), (3, "a b")]
    assert {len(r["ids"]) for r in got if r["doc_id"] in (1, 2)} == {0}
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0), RANKS, PATTERN), RANKS,
                           PATTERN).count() == 0
