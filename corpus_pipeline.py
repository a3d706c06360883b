"""A corpus from raw documents: language, near copies, benchmark passages, source weights, token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written before the next one reads it.
All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.llm import decontaminate, language, mixing, ngram_join, token_files
from leafmill.llm.arrow import packed
from leafmill.llm.queries import MAX_REPEATS, TARGET_ENTROPY, tokenizer_definition
from leafmill.session import materialize, scratch_path

#: A document is rejected if no language is known for it, or the best is hardly better than the next.
LEAST_SCORE = 0.01

#: SQL cannot express language identification by learnt automata, nor the tokenizer.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learnt from the labelled ones; the rest go. Labels stay as they are."""
    samples = language.labelled_samples(docs.where(~language.held_out()))
    rows, back = packed(docs, "text")  # no column of the documents is overwritten
    judged = language.identify(rows, samples, text="_text")
    return judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*back)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.8 on five-word shingles join."""
    return ngram_join.drop_near_copies(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark windows."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of its source takes it."""
    return mixing.mix_sources(docs, target_entropy=TARGET_ENTROPY, max_repeats=MAX_REPEATS, details=False)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, read from the files of token ids."""
    path = scratch_path(spark, "corpus-tokens")
    token_files.write_token_files(docs, path, tokenizer_definition())
    return token_files.read_documents(spark, path, with_ids=False)


STAGES = [
    ("language", known_language),
    ("near_copies", no_near_copies),
    ("benchmark", no_benchmark),
    ("mixing", mixed),
    ("token_files", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
