"""Empty tables for every operator and stage, and predictions recomputed from plain sets."""

import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fareloom.llm import language, near_dup, toxicity
from fareloom.llm.decontaminate import contaminated
from fareloom.llm.lines import dedup_lines
from fareloom.llm.shards import assign_shards
from fareloom.llm.suffixes import repeated_passages

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("operator", [
    language.identify, assign_shards, repeated_passages, dedup_lines, near_dup.near_duplicates, near_dup.one_of_each,
], ids=lambda f: f.__name__)
def test_an_empty_table_gives_no_rows(docs, operator):
    assert operator(docs.limit(0)).collect() == []


def test_empty_tables_on_either_side(spark, docs):
    bench, labels = spark.read.parquet(f"{SF}/benchmark.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    assert contaminated(docs.limit(0), bench).collect() == [] and contaminated(docs, bench.limit(0)).collect() == []
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
    assert {r.predicted for r in toxicity.toxicity(docs, labels.limit(0)).collect()} <= {0, 1}


@pytest.mark.parametrize("stage", range(5))
def test_stages_of_the_pipeline_take_an_empty_table(spark, docs, stage):
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, docs.limit(0), SF)
    assert out.collect() == [] and (stage == 4 or out.columns == docs.columns)


def words_of(text):
    return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()


def grams_of(text):
    """The n-grams of a text: letters of a word with a space on either side, but no space alone in the middle."""
    out = Counter()
    for w in words_of(text):
        padded = f" {w} "
        for n in language.ORDERS:
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return out


def test_languages_are_those_of_plain_sets(spark, docs):
    rows = docs.collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows}
    seen, texts = defaultdict(Counter), Counter()
    for r in rows:
        if r.lang and r.text is not None and not held[r.doc_id]:
            texts[r.lang] += 1
            seen[r.lang].update(set(grams_of(r.text)))
    known = {s: {g for g, n in c.items() if n >= max(language.LEAST, language.SHARE * texts[s])} for s, c in seen.items()}
    got = {r.doc_id: r for r in entry.queries()["op1_bitmask_language_id"](spark, SF).collect()}
    clear = 0
    for r in rows:
        mine = grams_of(r.text)
        assert got[r.doc_id].held_out == held[r.doc_id] and (got[r.doc_id].lang_pred == "und") == (not mine)
        shares = sorted(((sum(n for g, n in mine.items() if g in k) / max(mine.total(), 1), s) for s, k in known.items()), reverse=True)
        if mine and shares[0][0] - shares[1][0] > 0.02:  # beyond what false positives of the filters may turn
            clear += 1
            assert got[r.doc_id].lang_pred == shares[0][1] and abs(got[r.doc_id].score - shares[0][0]) < 0.02
    assert clear > 0.9 * len(rows)


def test_toxicity_scores_are_the_mean_of_plain_classifiers(spark, docs):
    """The model is learned again from the same rows; every score then follows from the words of a text alone."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in docs.select("doc_id").collect()}
    keep = spark.createDataFrame([(i,) for i, out in held.items() if not out], "doc_id bigint")
    model = toxicity.train(docs.join(keep, "doc_id", "left_semi"), labels.join(keep, "doc_id", "left_semi"))
    got = {r.doc_id: r for r in entry.queries()["op3_pu_toxicity"](spark, SF).collect()}
    for r in docs.collect():
        g = model["bias"] + sum(model["weights"].get(w, 0.0) for w in toxicity.words(r.text))
        want = 1 / (1 + np.exp(-np.clip(g, -60, 60)))
        assert got[r.doc_id].held_out == held[r.doc_id]
        assert abs(got[r.doc_id].score - want) < 1e-6 and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)
