"""The pipeline, stage by stage: each one's result from its own input, against plain Python."""

import struct
import sys
import zlib
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fareloom.llm import mixing
from fareloom.session import materialize

sys.path.insert(0, str(Path(__file__).parent))
import plain  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What goes into each stage, and the last one's result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame([(9001, None, "en", "src1", 0), (9002, "123 ... 456", "en", "src1", 11), (9003, "щы жэ юя йц гш", "en", None, 14)], docs.schema)
    docs, out = materialize(docs.unionByName(junk), "input"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = materialize(stage(spark, docs, SF), name)
    return [*out, docs]


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_clean_documents_pass_the_language_stage(steps):
    assert {i for i, _ in rows(steps[0])} - {i for i, _ in rows(steps[1])} == {9001, 9002, 9003}


def test_one_of_each_group_stays(steps):
    assert sorted(i for i, _ in rows(steps[2])) == sorted(i for i, _, _, ok in plain.near_duplicates(rows(steps[1]), 80) if ok)


def test_benchmark_passages_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, _ in plain.leaks(rows(steps[2]), items, 80)}
    assert leaked and {i for i, _ in rows(steps[2])} - {i for i, _ in rows(steps[3])} == leaked


def test_the_mixture_has_all_rows_in_its_order(steps):
    assert all(steps[k].columns == steps[0].columns for k in range(5))
    assert Counter(map(tuple, steps[4].collect())) == Counter(map(tuple, steps[3].collect()))
    want = [r.doc_id for r in mixing.mixing_table(steps[3]).orderBy("position").collect()]
    got = [r.doc_id for r in steps[5].orderBy("start").collect()]
    assert got == want


def test_token_files_hold_the_texts(steps):
    text = dict(rows(steps[4]))
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for r in steps[5].orderBy("start").collect():
        ids = [*tokenizer.encode(text.pop(r.doc_id), add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert not text


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, docs.collect()))
