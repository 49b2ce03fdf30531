import base64

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomgraph.llm import mixture
from loomgraph.llm.bpe import PairIndexBpe, default_path, encode


@pytest.fixture(scope="module")
def bpe():
    with open(default_path(), encoding="utf-8") as f:
        return PairIndexBpe(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_known_hard_texts(bpe, reference):
    texts = ["", " ", "<|endoftext|>", "a" * 20_000, " " * 999 + "x", "\r\n\t é", "ab" * 3000 + "é" * 2000, "日本語テキスト", "👍🏽 ok", "it's I'LL 1234567"]
    assert bpe.encode_batch(texts) == [reference.encode_ordinary(t) for t in texts]
    assert bpe.encode_batch([None, ""]) == [[], []]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_equals_reference(bpe, reference, texts):
    assert bpe.encode_batch(texts) == [reference.encode_ordinary(t) for t in texts]


def test_round_trip_of_documents(spark, sf, reference):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit("clash").alias("ids"))
    for r in encode(docs).collect():
        assert r.ids == (reference.encode_ordinary(r.text) if r.text else [])
    assert encode(docs.limit(0)).count() == 0
    assert encode(docs, count_only=True).filter("ids IS NULL").count() == 0


DOCS = "doc_id bigint, text string, source string, copy_no string"


def test_mixture(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 7 + 1), "big" if i % 3 else "small", "x") for i in range(900)] + [(1000, None, "big", "x"), (1001, "t", None, "x"), (1002, "t", "alien", "x")], DOCS)
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 2), ("none", 0.1, 3), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    m = mixture.mixture(docs, targets)
    assert m.columns == ["doc_id", "text", "source", "copy_no"]
    per = {(r.source): r for r in m.groupBy("source").agg(F.max("copy_no").alias("most")).collect()}
    assert set(per) == {"big", "small"} and per["big"].most == 1 and per["small"].most <= 2
    assert m.groupBy("doc_id", "copy_no").count().filter("count > 1").count() == 0
    shares = {r.source: r for r in mixture.mixture_shares(docs, targets).collect()}
    assert abs(shares["small"].actual_share - 0.5) < 0.03 and shares["none"].mixed_tokens == 0
    assert sorted(map(tuple, m.collect())) == sorted(map(tuple, mixture.mixture(docs, targets).collect()))
    assert mixture.mixture(docs.limit(0), targets).count() == 0 and mixture.mixture(docs, targets.limit(0)).count() == 0
    capped = {r.source: r.rate for r in mixture.rates(mixture.token_counts(docs), targets, 10**9).collect()}
    assert capped["big"] == 1.0 and capped["small"] == 2.0


def test_exact_multiples_have_no_chance(spark):
    docs = spark.createDataFrame([(i, "a b", "s", "x") for i in range(50)], DOCS)
    targets = spark.createDataFrame([("s", 1.0, 3)], "source string, target_share double, max_repeats int")
    assert mixture.mixture(docs, targets).count() == 150
