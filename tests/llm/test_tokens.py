"""Byte-level BPE and token counts against the public tokenizer libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm import bpe, token_counts
from rasterloom.llm.common import vocabulary

RANKS, JSON = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json"


def odd_texts():
    drawn = random.Random(1)
    points = [(0x20, 0x7F), (0x20, 0x250), (0x250, 0xD7FF), (0x10000, 0x10FFFF), (32, 33), (10, 11), (39, 40), (97, 98)]
    return [
        *("".join(chr(drawn.randrange(*drawn.choice(points))) for _ in range(drawn.randrange(200))) for _ in range(150)),
        "", "a" * 5000, " " * 3000 + "x", "don't I'll WE'RE'S 'sa", "ab" * 2000, "1" * 1000, "aaa bbb\n\n  \n c", "=-" * 900,
        "<|endoftext|>a<|endoftext|><|endoftext|>b <|endoftext|", "Ᲊᲊ \U00010d40", "\x1c\x1d x\x85y　z",
    ]


@pytest.fixture(scope="module")
def merges():
    return bpe.from_ranks(vocabulary(RANKS))


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(RANKS), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_block_equals_library(merges, library):
    texts = odd_texts()
    assert [x.tolist() for x in bpe.encode_block(texts, merges)] == [library.encode_ordinary(t) for t in texts]


def test_words_alone_equal_replay(merges):
    words = [w.encode() for t in odd_texts()[:60] for w in t.split() if w]
    ids, counts = bpe.replay(words, merges)
    cuts = np.cumsum(counts)[:-1]
    assert [x.tolist() for x in np.split(ids, cuts)] == [merges.alone(w) for w in words]


def test_lower_rank_after_a_merge():
    """Joining b and c makes a pair that is due before the rest of the word's merges of b and c."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"abcbc"]
    pairs = {(ord("a"), 257): (0, 256), (ord("b"), ord("c")): (1, 257), (256, 257): (2, 258)}
    model = bpe.Merges(tokens, pairs, whole=False)
    model.joined = {0: 256, 1: 257, 2: 258}
    for word in (b"abcbc", b"bcabcabc", b"abcabcbcbc"):
        ids, _ = bpe.replay([word], model)
        assert ids.tolist() == model.alone(word)


def test_spark_rows(spark, library):
    texts = [None, "", "Hello  world's\n", "é" * 50, "x y " * 40_000, "Hello  world's\n"]
    rows = [(i % 5, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("?") for c in ("id", "ids", "n_tokens")})
    got = {(r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in bpe.encode_decode(docs, vocabulary(RANKS)).collect()}
    want = {
        (i, len(ids := library.encode_ordinary(t or "")), np.array(ids, "<u4").tobytes(), (t or "").encode()) for i, t in rows
    }
    assert got == want
    assert bpe.encode_decode(docs, vocabulary(RANKS)).count() == 6
    assert bpe.encode_decode(docs.where("false"), vocabulary(RANKS)).collect() == []


def test_counts_equal_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path(JSON))
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "doc_id long, text string")
    docs = docs.withColumn("n_tokens", F.lit(1)).withColumn("id", F.lit(2))
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)] + [0]
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, vocabulary(JSON)).collect()}
    assert [got[i].n_tokens for i in range(len(want))] == want
    assert [got[i].n_bytes for i in range(len(texts))] == [len(t.encode()) for t in texts]
    assert all(r.over_limit == (r.n_tokens > 512) for r in got.values())
    assert token_counts.count_tokens(docs.where("false"), vocabulary(JSON)).collect() == []


def test_whole_tokens_are_proven():
    """Not every vocabulary string is reached by the merges from its own bytes."""
    model, special = bpe.from_json(vocabulary(JSON))
    whole = token_counts.proven(model)
    library = Tokenizer.from_file(public_tokenizers.path(JSON))
    texts = [t.decode() for t in model.tokens[::50] if t and t.decode(errors="ignore").encode() == t]
    for text, one in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert (text in whole) <= (len(one.ids) == 1)
    assert special == ["<|endoftext|>"] and len(whole) > 45_000


def test_digests(spark, tmp_path):
    from rasterloom.llm import queries

    spark.createDataFrame([(1, "a b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = queries.op7_bpe(spark, str(tmp_path)).first()
    assert row.decoded_sha256 == hashlib.sha256(b"a b").hexdigest() and row.n_tokens == 2
