"""Inputs with the shape of the intermediate texts, derived by Spark from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


# Letters and what stands for them in a script without blanks; the blank goes too.
LETTERS = "abcdefghijklmnopqrstuvwxyz "
SCRIPTS = [
    ("han", LETTERS, "一丁七万丈三上下不与丑专且世丘丙业丛东丝丢两严丧个中串"),
    ("thai", LETTERS, "กขคงจฉชซญฎฏฐฑฒณดตถทธนบปผฝพฟ"),
]


def documents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """``doc_id, name, text`` and any other columns asked for."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", *extra)
    return docs.withColumn("name", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line stands for a page."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("_pos", "markdown"))
    return rows.select("doc_id", (F.col("_pos") + 1).cast("bigint").alias("page_no"), "markdown")


def cpt_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    body = F.replace("text", F.lit("\n"), F.lit("\n## "))
    return docs.select("doc_id", F.concat(F.lit("## "), body, F.lit(' "end"\\')).alias("completion"))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns followed by an assistant turn. Turns count up by one, so the next turn is an equi-join
    on unique keys, which no long conversation can skew."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    replied = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(replied, ["conv_id", "turn"])


TURNS_PER_COMPLETION = 20


def qa_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Qn:``/``An:`` texts of up to 20 turns of a conversation: ``conv_id, part, completion``."""
    pair = F.struct("turn", F.replace("question", F.lit("\n"), F.lit(" ")).alias("q"), F.col("answer").alias("a"))
    grouped = (
        turn_pairs(spark, sf_dir)
        .withColumn("part", F.expr(f"turn div {TURNS_PER_COMPLETION}"))
        .groupBy("conv_id", "part")
        .agg(F.sort_array(F.collect_list(pair)).alias("pairs"))
    )

    def block(p, i):
        n = (i + 1).cast("string")
        return F.concat(F.lit("Q"), n, F.lit(": "), p["q"], F.lit("\nA"), n, F.lit(": "), p["a"])

    return grouped.select("conv_id", "part", F.array_join(F.transform("pairs", block), "\n").alias("completion"))


def synth_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headed, headed in lower case without number, and not headed."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    digit = (F.col("doc_id") % 10).cast("string")
    numbered = F.replace("text", F.lit("\n"), F.concat(F.lit("\n=== SYNTHETIC CONTENT "), digit, F.lit(" ===\n")))
    completion = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("intro\n=== SYNTHETIC CONTENT 1 ===\n"), numbered))
        .when(F.col("doc_id") % 3 == 1, F.concat(
            F.lit("====synthetic content===="), F.replace("text", F.lit("\n"), F.lit("====synthetic content====")),
        ))
        .otherwise(F.replace("text", F.lit("\n"), F.lit("\n\n")))
    )
    return docs.select("doc_id", completion.alias("completion"))


# Valid in both engines: backslashes and quotes are written with chr().
EQUATION_SQL = """
SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'not json' WHEN p_partkey % 13 = 0 THEN '[]'
  WHEN p_partkey % 7 = 0 THEN obj ELSE '[' || obj || ',' || obj || ']' END AS completion
FROM (SELECT p_partkey, '{"equation":"  P_{' || CAST(p_partkey AS STRING) || '} = ' || repeat(chr(92), 4) || 'frac{a}{b}   c "'
 || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ',"description":"The ' || p_name || '"' END
 || CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN ',"symbols":{"z":{"description":"Price","unit":"m^{2} s^{-1}"}}'
      WHEN 2 THEN ',"symbols":{"z":{"description":"Size"},"a":{"description":"Brand","unit":"Dimensionless"},"m":{"unit":"kg"}}'
      ELSE ',"symbols":{"z":{"description":"Zeta","unit":"m^{3}"},"a":{"description":"Alpha","unit":""}}' END
 || CASE WHEN p_partkey % 2 = 0 THEN ',"conditions":["Low ' || p_type || '","Steady"]' ELSE '' END
 || CASE WHEN p_partkey % 3 = 0 THEN ',"source":"' || p_brand || '"' ELSE '' END || '}' AS obj FROM {part}) s
"""


def equation_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand")
    name = f"part_{uuid.uuid4().hex}"
    part.createOrReplaceTempView(name)
    made = spark.sql(EQUATION_SQL.replace("{part}", name))
    spark.catalog.dropTempView(name)
    return made


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "n_chars")
    suffix = F.element_at(F.array(*map(F.lit, [".txt", ".JSON", ".jsonl", ".pdf", ".zip"])), (F.col("doc_id") % 5 + 1).cast("int"))
    length = F.when(F.col("doc_id") % 4 == 0, F.col("n_chars") % 1024).otherwise(F.col("n_chars") * 2048 + 1)
    path = F.concat(F.lit("data/"), "source", F.lit("/"), F.col("doc_id").cast("string"), suffix)
    return docs.select(F.col("source").alias("category"), path.alias("path"), length.alias("length"))
