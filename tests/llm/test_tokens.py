"""Encoding and counting against the tokenizers' own libraries."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest

from siltstone.llm import bpe, token_counts
from tests.llm.cases import ODD_TEXTS, odd_docs, rows

MODEL, RANKS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken")


def test_counts_equal_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = odd_docs(spark)
    want = sorted(((r.doc_id, len((r.text or "").encode()), n := len(model.encode(r.text or "")), n > 20) for r in docs.collect()), key=repr)
    assert rows(token_counts.count_tokens(docs, MODEL, 20), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_slices_and_forgetting_change_no_count(monkeypatch):
    text = "ab  cd\n\nef gh " * 500
    want = token_counts.PieceCounter(MODEL).count(text)
    monkeypatch.setattr(token_counts, "SLICE", 7)
    monkeypatch.setattr(token_counts, "REMEMBERED", 2)
    assert token_counts.PieceCounter(MODEL).count(text) == want


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none, MODEL).count() == 0
    assert bpe.digest(bpe.encode(none, RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0


def library():
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize(("chunk", "overlap"), [(65536, 1024), (40, 12), (11, 5)])
def test_digests_equal_the_library(spark, chunk, overlap):
    own, docs = library(), odd_docs(spark)

    def want(text):
        ids = own.encode_ordinary(text or "")
        return len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    got = bpe.digest(bpe.encode(docs, RANKS, P.PATTERN, chunk, overlap), RANKS, P.PATTERN)
    once = bpe.digest_texts(docs, RANKS, P.PATTERN, chunk, overlap)
    assert sorted(once.collect(), key=repr) == sorted(got.collect(), key=repr)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(((r.doc_id, *want(r.text)) for r in docs.collect()), key=repr)


def test_decode_gives_the_bytes(spark):
    docs = spark.createDataFrame(list(enumerate(t for t in ODD_TEXTS if t)), "doc_id long, text string")
    got = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN, 40, 12), RANKS, P.PATTERN).orderBy("doc_id", "chunk_no").collect()
    joined = {}
    for r in got:
        joined[r.doc_id] = joined.get(r.doc_id, b"") + bytes(r.bytes)
    assert {k: v.decode() for k, v in joined.items()} == {r.doc_id: r.text for r in docs.collect()}
