"""The pipeline against a plain version of what its stages promise."""

import hashlib
import random

import numpy as np
import public_tokenizers as P

import corpus_pipeline
from siltstone.llm import mixing
from tests.llm.test_classifiers import SYLLABLES, prose
from tests.llm.test_minhash import brute
from tests.llm.test_tokens import library

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents():
    rng = random.Random(9)
    rows = []
    for i in range(240):
        lang = sorted(SYLLABLES)[i % 3]
        text = prose(rng, lang, rng.choice([15, 40, 120]))
        if i % 10 == 4:
            text = " ".join(w + rng.choice(["$$$", "%%%"]) for w in text.split())
        rows.append((i, text, lang, f"s{i % 4}" if i % 2 else None, len(text)))
    clean = [r for r in rows if r[0] % 10 != 4]
    copies = [(1000 + i, t + (" end" if i % 2 and len(t.split()) > 60 else ""), g, s, n) for i, (_, t, g, s, n) in enumerate(clean[:40])]
    odd = [(2000, None, "xa", "s1", None), (2001, "", "xb", "s1", 0), (2002, "1234 5678", "xa", None, 9), (2003, "日本語のテキスト" * 9, None, "s2", 72)]
    return rows + copies + odd + [clean[0]]


def test_stages(spark, tmp_path):
    docs = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    df, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "quality classifier", "MinHash near-dedup", "source mixing", "byte-level BPE"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, df, str(tmp_path))
        assert k == 4 or df.columns == COLUMNS
        df.write.parquet(str(tmp_path / f"out{k}"))
        df = spark.read.parquet(str(tmp_path / f"out{k}"))
        seen[name] = df.toPandas()
    texts = {i: t for i, t, *_ in docs}
    assert sorted(seen["language ID"].doc_id) == sorted(i for i, *_ in docs if i < 2000)
    good = [i for i, *_ in docs if i < 2000 and not (i < 1000 and i % 10 == 4)]
    assert sorted(seen["quality classifier"].doc_id) == sorted(good)
    kept = sorted(i for i, _, _, own in brute(sorted((i, texts[i]) for i in set(good)), 5) if own)
    assert sorted(seen["MinHash near-dedup"].doc_id) == kept and len(kept) < len(set(good))
    own = spark.createDataFrame([r for r in {r[0]: r for r in docs}.values() if r[0] in kept], schema)
    want = {r.doc_id: r.repeats for r in mixing.mix(own).collect() if r.repeats}
    assert seen["source mixing"].doc_id.value_counts().to_dict() == want
    ids = {i: library().encode_ordinary(texts[i]) for i in want}
    row = lambda i: (i, len(ids[i]), hashlib.sha256(np.asarray(ids[i], "<u4").tobytes()).hexdigest(), hashlib.sha256(texts[i].encode()).hexdigest())
    last = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(seen["byte-level BPE"][last].itertuples(index=False, name=None)) == sorted(row(i) for i, n in want.items() for _ in range(n))
    assert sorted(corpus_pipeline.run(spark, str(tmp_path)).select(*last).toPandas().itertuples(index=False, name=None)) == sorted(row(i) for i, n in want.items() for _ in range(n))


def test_nothing_in(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
