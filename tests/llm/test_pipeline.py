"""Stages of the pipeline against plain loops over the smallest tables."""

import re
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from tests.llm.test_minhash import brute

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="driver tables are not here")


def test_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append({r.doc_id: r.text for r in docs.collect()} if k < 4 else docs.collect())
    clean, exact, near, mixed, encoded = kept
    first = {}
    for i in sorted(clean):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", clean[i] or ""), i)
    assert set(exact) == set(first.values())
    assert set(near) == {i for i, (_, c) in brute(sorted(exact.items())).items() if i == c}
    assert mixed == near
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: r.ids for r in encoded} == {i: library.encode(t or "") for i, t in mixed.items()}


def test_queries_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
