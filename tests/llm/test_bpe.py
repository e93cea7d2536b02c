"""Byte-level BPE against the public library."""

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.llm import bpe
from tripmill.llm.queries import RANK_FILE, REGISTERED

with open(RANK_FILE, "rb") as file:
    CONTENT = file.read()
VOCAB = bpe.vocabulary(CONTENT)
SPLIT = regex.compile(public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCAB.ranks, special_tokens={}
)


def ids_of(texts):
    ids, bounds = bpe.encode_texts(VOCAB, SPLIT, texts)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=6))
def test_any_text(texts):
    assert ids_of(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcnot é", max_size=400), max_size=4))
def test_repetitive_text(texts):
    assert ids_of(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["", "=" * 50_000, "a" * 100_000, "ab" * 30_000 + "c", " " * 9_999 + "x"])
def test_long_pretokens(text):
    assert ids_of([text]) == [LIBRARY.encode_ordinary(text)]


def test_rank_queue_pops_lowest_first_and_keeps_buckets():
    import numpy as np

    queue = bpe.RankQueue(50_000)
    queue.push(np.array([5, 6, 7]), np.array([49_999, 3, 3]))
    queue.push(np.array([8]), np.array([4096]))
    popped = []
    while (found := queue.pop()) is not None:
        popped.append((found[0], sorted(found[1].tolist())))
        if len(popped) == 1:
            queue.push(np.array([9]), np.array([0]))
    assert popped == [(3, [6, 7]), (0, [9]), (4096, [8]), (49_999, [5])]


def test_vocabulary_whose_merge_comes_before_its_parts():
    # "abc" outranks "ab", so a merge can make a pair that goes before the rest of its bucket.
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"ab": 400, b"abcab": 350, b"ca": 401}
    library = tiktoken.Encoding("odd", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    texts = ["abcabcabab", "ababc" * 40, "cabab" * 33, "abab abc abcabc"]
    ids, bounds = bpe.encode_texts(bpe.Vocabulary(ranks), regex.compile(r"\S+"), texts)
    found = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == [library.encode_ordinary(t) for t in texts]


def test_columns_with_null_empty_and_clashing_names(spark):
    rows = [(1, None, "x"), (1, "", "y"), (2, "a b", "z"), (2, "a b", "z"), (None, "é\x00", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    codec = bpe.Codec(spark, RANK_FILE, public_tokenizers.PATTERN)
    coded = docs.select("*", codec.encode(F.col("text")).alias("e"))
    back = coded.select("*", codec.decode(F.col("e")).alias("d")).collect()
    for row in back:
        assert row["e"] == LIBRARY.encode_ordinary(row["text"] or "")
        assert bytes(row["d"]) == (row["text"] or "").encode()
    assert docs.limit(0).select(codec.round_trip(F.col("text"))).collect() == []


def test_query(spark, sf):
    import hashlib

    rows = {r["doc_id"]: r for r in REGISTERED["op1_byte_bpe"](spark, sf).collect()}
    for doc in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = LIBRARY.encode_ordinary(doc["text"] or "")
        row = rows.pop(doc["doc_id"])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((doc["text"] or "").encode()).hexdigest()
    assert not rows
