"""From raw documents to token files: language, near-duplicates, benchmark passages, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is written as
Parquet and read again as the next one's docs. All but the last return the columns of docs.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import language, mixing, near_dup, token_files
from fareloom.llm.decontaminate import contaminated
from fareloom.session import materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: A text goes if no language has this share of its n-grams, or it has no letter.
LEAST_KNOWN = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach. Without any label all go."""
    return language.accepted(docs, language.train(docs), LEAST_KNOWN)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return near_dup.one_of_each(docs, size=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is 0.8 or more like a benchmark item."""
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=80)
    found = materialize(found.select("text_key", F.col("doc_id").alias("found_id")).distinct(), "contaminated")
    same = (F.xxhash64(docs["doc_id"], docs["text"]) == found["text_key"]) & docs["doc_id"].eqNullSafe(found["found_id"])
    return docs.join(found, same, "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mixture in which a source of n documents weighs n ** 0.5."""
    return mixing.in_mixed_order(docs, power=0.5)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mixture, read back: doc_id, start, n_tokens, ids_crc32."""
    placed, order = token_files.in_file_order(docs)
    return token_files.token_table(placed, TOKENIZER, end_id=0, order=order)


STAGES = [
    ("language_id", known_language),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("pfair_mixing", mixture),
    ("token_files", token_ids),
]

#: SQL has no tokenizer and learns no filters; tests/llm/test_pipeline.py checks each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
