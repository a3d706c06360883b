"""The queries with workers that cannot import this package, and what the operators owe to their tables."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import language, mixing, ngram_join

REPO = Path(__file__).resolve().parent.parent.parent
SF_DIR = "/root/testdata/sf0.001"
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as contract
from leafmill.session import get_session
spark = get_session("elsewhere", "local[4]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"}})
def importable(batches):
    import importlib.util
    yield from batches
    assert importlib.util.find_spec("leafmill") is None
spark.range(1).mapInArrow(importable, "id long").collect()
for name, query in contract.queries().items():
    if name.startswith("op") and name[2].isdigit() or name == "pipeline":
        print(name, query(spark, {sf!r}).count(), flush=True)
"""


def test_all_run_on_workers_without_the_package(tmp_path):
    code = SCRIPT.format(repo=str(REPO), sf=SF_DIR)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith(("op", "pipeline")))
    assert len(counts) == 14 and all(int(n) > 0 for n in counts.values())


def test_exponent_one_gives_every_row_back(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.pmod(F.col("id") * 7, F.lit(13))).alias("source"), (F.col("id") % 37 + 1).alias("n"))
    made = mixing.mix_sources(docs, target_entropy=0.0, tokens="n")
    assert sorted((r.doc_id, r.epoch) for r in made.collect()) == [(i, 0) for i in range(2000)]


@pytest.mark.parametrize("target", [0.7, 0.9, 0.999])
def test_exponent_is_the_largest_that_reaches_the_entropy(spark, target):
    import math

    tokens = {"a": 5000, "b": 900, "c": 400, "d": 60, "e": 7}
    rows = [(f"{s}{i}", s, 1) for s, n in tokens.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id string, source string, n bigint")
    made = mixing.mix_sources(docs, target_entropy=target, max_repeats=None, tokens="n")
    weights = {r.source: r.weight for r in made.select("source", "weight").distinct().collect()}
    total = sum(tokens.values())

    def mixture(a):
        powers = {s: (n / total) ** a for s, n in tokens.items()}
        return {s: p / sum(powers.values()) for s, p in powers.items()}

    entropy = lambda w: -sum(p * math.log(p) for p in w.values() if p) / math.log(len(w))
    plain = max((a / 10_000 for a in range(10_001) if entropy(mixture(a / 10_000)) >= target), default=0.0)
    assert all(abs(weights[s] - w) < 1e-3 for s, w in mixture(plain).items())
    taken = {r.source: r["count"] for r in made.groupBy("source").count().collect()}
    for s, n in tokens.items():  # to within a block, of which a small source has one for each row
        assert abs(taken.get(s, 0) - weights[s] * total) <= 1 + max(1, 3 * n / mixing.BLOCKS) * 4


def test_a_tiny_source_is_not_taken_without_end(spark):
    docs = spark.createDataFrame([("x", "tiny", 1), *[(f"y{i}", "big", 1000) for i in range(200)]], "doc_id string, source string, n bigint")
    assert mixing.mix_sources(docs, target_entropy=1.0, tokens="n").where("source = 'tiny'").count() <= 16


def test_language_stage_keeps_the_values_of_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumns({c: F.concat(F.lit("mine "), "doc_id") for c in ("score", "lang_pred", "_row")})
    made = corpus_pipeline.known_language(spark, docs, SF_DIR)
    assert made.schema == docs.schema
    assert made.exceptAll(docs).isEmpty() and made.count() > 100
    assert language.UNKNOWN == "und"


def test_long_sets_in_one_group_are_told_apart(spark):
    """Long texts that share a passage but nothing else stay apart; near copies among them are linked."""
    import random

    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for i in range(24):
        words = [f"w{rng.randrange(10**6)}" for _ in range(1500)]
        rows.append((2 * i, passage + " " + " ".join(words)))
        words[700] = "changed"
        rows.append((2 * i + 1, passage + " " + " ".join(words)))
    made = ngram_join.near_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r.doc_id, r.component_id) for r in made.collect()} == {(i, i - i % 2) for i in range(48)}
