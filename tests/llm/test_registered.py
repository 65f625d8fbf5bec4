"""The thirteen registered queries on the smallest tables, against SQL, the tokenizers' libraries, or plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest

from siltstone.llm.entry import ORACLES, QUERIES
from siltstone.llm.running import ORDER
from tests.llm.test_tokens import library
from tests.llm.test_vectors import brute_nearest
from tests.test_queries import normal

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()


def run(spark, name):
    return QUERIES[name](spark, str(SF)).toPandas()


def test_there_are_thirteen():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name]).df()
    assert normal(run(spark, name)[list(want.columns)]) == normal(want)


def test_op1_rows_and_range(spark, docs):
    got = run(spark, "op1_quality_classifier")
    assert sorted(got.doc_id) == sorted(i for i, *_ in docs) and got.quality.between(0, 1).all()
    gold = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    known = got[got.doc_id.isin(list(gold))]
    wrong = sum(bool(r) == bool(gold[i]) for i, r in zip(known.doc_id, known.rejected))
    assert wrong <= 0.03 * len(known)


def test_op4_equals_the_library(spark, docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run(spark, "op4_token_counts").itertuples()}
    n = {i: len(model.encode(t or "")) for i, t, _ in docs}
    assert got == {i: (len((t or "").encode()), n[i], n[i] > 4096) for i, t, _ in docs}


def test_op5_law(spark, docs):
    got = run(spark, "op5_sharding")
    assert {r.doc_id: (r.size, r.text_crc32) for r in got.itertuples()} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in docs}
    counts = got.groupby("shard").size()
    assert counts.max() - counts.min() <= 1 and all(sorted(own.slot) == list(range(len(own))) for _, own in got.groupby("shard"))


def test_op6_equals_the_library(spark, docs):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op6_byte_bpe").itertuples()}
    ids = {i: library().encode_ordinary(t or "") for i, t, _ in docs}
    assert got == {i: (len(ids[i]), hashlib.sha256(np.asarray(ids[i], "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in docs}


def test_op7_held_out_rows_are_right(spark, docs):
    got = run(spark, "op7_language_id").set_index("doc_id")
    assert len(got) == len(docs)
    held = [(i, g) for i, t, g in docs if zlib.crc32(str(i).encode()) % 4 == 2 and g is not None and t and any(map(str.isalpha, t))]
    assert all(got.held_out[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in docs)
    assert len(held) > 20 and np.mean([got.lang_pred[i] == g for i, g in held]) >= 0.95


def test_op8_equals_brute_force(spark):
    data = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    got = run(spark, "op8_nearest_neighbours")
    assert sorted(((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got.itertuples()), key=repr) == brute_nearest(data, 10, lambda a: a % 100 == 0)


def test_op10_counts_and_base(spark, docs):
    got = run(spark, "op10_lm_scoring").set_index("doc_id")
    tokens = {i: [*(w for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))), None] for i, t, _ in docs}
    train = Counter(w for i, own in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in own)
    n, v = sum(train.values()), len(train)
    for i, own in tokens.items():
        r = got.loc[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(train[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r.score < 0 and ORDER == 5
