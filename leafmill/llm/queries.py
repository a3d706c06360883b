"""The queries of this subpackage: each applies its operator to whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize, scratch_path
from . import (
    ball_kmeans, conversations, decontaminate, imatch, language, mixing, ngram_join, relative_lz, sharding, simhash, surrogates, token_files,
    url_filter,
)
from .url_filter import ALLOW, BLOCK, Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

URL_RULES = [
    Rule(BLOCK, "net"), Rule(ALLOW, "example.net", "/en/"), Rule(BLOCK, "example.com", "/de/"), Rule(ALLOW, "org", "/fr/"),
    Rule(BLOCK, glob="*.cheap-pills.**"), Rule(BLOCK, glob="*.spam-farm.**"),
]
#: The pipeline's mixture and that of the query. The sources of the given tables have an entropy of 0.996 to 0.9997 of the
#: largest possible, so only a target above that bends their shares.
TARGET_ENTROPY, MAX_REPEATS = 0.95, 4.0
QUERY_ENTROPY = 0.9999
SURROGATE_KEY = b"a key of the user's own"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def tokenizer_definition(path: str | None = None) -> str:
    """The content of the tokenizer file; tasks get it with their code, so executors need no copy."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(token_files.TOKENIZER)
    with open(path, encoding="utf-8") as file:
        return file.read()


@query
def op1_temperature_mixing(spark, sf_dir):
    """Each document as often as the mixture takes it: ``doc_id, source, n_tokens, weight, block, epoch, mix_at``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    counted = materialize(docs.select("doc_id", "source", mixing.word_count("text").alias("n_tokens")), "mix-counts")
    return mixing.mix_sources(counted, target_entropy=QUERY_ENTROPY, max_repeats=MAX_REPEATS, tokens="n_tokens")


@query
def op2_imatch_fingerprints(spark, sf_dir):
    return imatch.fingerprint_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op3_url_automaton(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES, drop=("url",))


@query
def op4_wavelet_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents", "doc_id", "text"), path, tokenizer_definition())
    return token_files.read_documents(spark, path, with_ids=False)


@query
def op5_parity_sketch_join(spark, sf_dir):
    return ngram_join.near_components(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op6_relative_lz_dedup(spark, sf_dir):
    made = relative_lz.drop_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op7_minimax_shards(spark, sf_dir):
    made = sharding.minimax_shards(table(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op8_cross_parsing_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    samples = language.labelled_samples(docs.where(~language.held_out()))
    rows = docs.select("doc_id", language.held_out().alias("held_out"), "text")
    return language.identify(rows, samples, drop=("text",))


@query
def op9_surrogates(spark, sf_dir):
    """``doc_id``, the text with surrogates, and how many entities of each kind were replaced."""
    return surrogates.replace_entities(table(spark, sf_dir, "documents", "doc_id", "text"), SURROGATE_KEY)


@query
def op10_benchmark_decontamination(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    marked = decontaminate.mark_contamination(docs, items, drop=("text",))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        decontaminate.items_sha256(F.col("item_ids")).alias("items_sha256"), "contaminated",
    )


@query
def op11_bit_sliced_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op12_ball_kmeans_codes(spark, sf_dir):
    coded, book = ball_kmeans.vector_codes(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return ball_kmeans.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(ball_kmeans.codebooks_sha256(book)).alias("codebooks_sha256")
    )


@query
def op13_conversation_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversations.repair_reports(conversations.damaged(turns))
