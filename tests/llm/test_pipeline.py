"""The pipeline's stages on a small table, each against a direct version."""

import hashlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline

from .conftest import DOCS, odd_documents, words
from .test_join import direct as direct_groups
from .test_models import base
from .test_native import direct as direct_spans

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = odd_documents()
    rows += [(2000 + i, " ".join([*words(300 + i, 90), f"mail{i}@host.example.com", *words(600 + i, 20)]), ["en", "fr"][i % 2], ["s1", "s2"][i % 2], None) for i in range(40)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    return str(path), rows


def test_stages(spark, table, tmp_path):
    path, rows = table
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "PII", "mixing sources to target weights", "BPE encoding and decoding"]
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, path)
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        out.append(docs.collect())
        if i < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    judged, single, clean, mixed, tokens = out

    passed = [r for r in rows if (b := base(r[1]))[0] >= 50 and 100 * b[4] <= 50 * b[0]]
    assert {(r.doc_id, r.text) for r in judged} <= {r[:2] for r in passed}
    assert {r[0] for r in passed if r[0] and r[0] >= 2000} <= {r.doc_id for r in judged}  # clean ones stay

    texts = {}
    for r in judged:
        if r.doc_id is not None:
            texts[r.doc_id] = min(texts.get(r.doc_id, r.text), r.text)
    groups = direct_groups(texts, 5, 80, 100)
    expected = sorted((i, t) for i, t in texts.items() if groups[i][1] == i)
    assert sorted((r.doc_id, r.text) for r in single if r.doc_id is not None) == expected
    assert [r.text for r in single if r.doc_id is None] == [r.text for r in judged if r.doc_id is None]

    assert len(clean) == len(single)
    for r in clean:
        assert direct_spans(r.text) == [] and r.n_chars == len(r.text)
    assert sum("[EMAIL]" in r.text for r in clean) == 40
    assert sorted(mixed, key=str) == sorted(clean, key=str)

    library = tokenizers.Tokenizer.from_str(corpus_pipeline.bpe.tokenizer_json())
    ids = {r.doc_id: r for r in tokens}
    for r in mixed:
        x = library.encode(r.text, add_special_tokens=False).ids
        assert ids[r.doc_id].ids == x and ids[r.doc_id].n_tokens == len(x)
        assert ids[r.doc_id].ids_sha256 == hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()

    ran = {(r.doc_id, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, path).collect()}
    assert ran == {(r.doc_id, r.ids_sha256, r.decoded_sha256) for r in tokens}


def test_tokens_follow_the_mix(spark):
    rows = [(i, " ".join(words(i, 3 + i % 40)), "en", ["s1", "s2", "s1", "s3", None][i % 5], None) for i in range(1500)]
    docs = corpus_pipeline.written(spark.createDataFrame(rows, DOCS).repartition(3))
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        mixed = corpus_pipeline.written(corpus_pipeline.mixed_sources(spark, docs, ""))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        got = corpus_pipeline.encoded(spark, mixed, "").collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(mixed.inputFiles()) > 1
    order = [r.doc_id for r in corpus_pipeline.mixing.interleave(docs).orderBy("mix_slot", "mix_row").collect()]
    assert [r.doc_id for r in sorted(got, key=lambda r: r.mix_position)] == order
    assert sorted(r.mix_position for r in got) == list(range(1500))


def test_empty_documents(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
