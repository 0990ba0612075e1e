"""Byte-level BPE against the tokenizer library, and decoding of any ids."""

import collections
import hashlib
import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from leafwave.llm import bpe  # noqa: E402
from leafwave.llm.queries import QUERIES  # noqa: E402

PATH = P.path("byte_bpe_50k.tiktoken")
OWN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = OWN.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    got = QUERIES["op11_byte_bpe"](spark, sf)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("bounds", [bpe.Blocks(), bpe.Blocks(text_bytes=40), bpe.Blocks(words=3), bpe.Blocks(text_bytes=1, words=1)])
def test_odd_texts_in_blocks_of_any_size(spark, bounds):
    texts = [
        None, "", " ", "\n\n  x", "a  b", "I'll it's", "naïve Ωmega 日本語 \U0001f600", "x" * 20_000, "word " * 5_000, "<|endoftext|>", "tab\there\r\n", "  x", "123456 7", "\x00\x1c'S",
    ]
    rows = [(i if i != 3 else None, t, "x", 7) for i, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids string, block int").repartition(3).persist()
    got = collections.Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in bpe.encode(docs, PATH, P.PATTERN, bounds).collect())
    assert got == collections.Counter((i, tuple(OWN.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in rows)
    assert bpe.encode(docs.limit(0), PATH, P.PATTERN).collect() == []


def test_input_that_changes_between_readings_is_an_error(spark):
    def fresh(batches):
        for b in batches:
            yield b.assign(text=[os.urandom(9).hex() for _ in b.doc_id])

    docs = spark.range(50).select(F.col("id").alias("doc_id")).mapInPandas(fresh, "doc_id long, text string")
    with pytest.raises(Exception, match="changed between two readings"):
        bpe.encode(docs, PATH, P.PATTERN).collect()


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_words_one_by_one_give_the_ids_of_the_text(text):
    import regex

    assert [i for w in regex.findall(P.PATTERN, text) for i in OWN.encode_ordinary(w)] == OWN.encode_ordinary(text)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_numbers_packed_come_back(numbers):
    assert bpe.unpack(bpe.pack(numbers)).tolist() == numbers


def test_decoding_any_ids(spark):
    texts = ["Hello world", "", "日本", "\U0001f600 a\n"]
    rows = [(i % 3, OWN.encode_ordinary(t), "x") for i, t in enumerate(texts)] * 2
    rows += [(7, None, "x"), (8, [15496, 999_999], "x"), (9, [15496, None], "x"), (None, [995] * 3_000, "x"), (5, [129], "x")]
    df = spark.createDataFrame(rows, "k int, codes array<int>, place string")
    got = bpe.decode(df, PATH, ids="codes", to="b")
    assert got.columns == ["k", "codes", "place", "b"]
    token = {i: t for t, i in bpe.ranks(PATH).items()}
    want = [(k, c, p, None if c is None or not set(c) <= token.keys() else b"".join(token[i] for i in c)) for k, c, p in rows]
    assert sorted(map(str, want)) == sorted(str((r["k"], r["codes"], r["place"], None if r["b"] is None else bytes(r["b"]))) for r in got.collect())
    assert bpe.decode(df.limit(0), PATH, ids="codes").collect() == []
