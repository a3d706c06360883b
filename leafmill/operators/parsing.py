"""Completions to pieces: sections, question-answer pairs, synthetic pieces, equation entries.

All are per-row expressions followed by one ``posexplode``: no shuffle. Each result keeps the other
columns of its input and adds ``pos``, the place of the piece in its completion, from 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import answers, json_text as js
from .rows import compute_once, explode_once


def _exploded(df: DataFrame, completion: str, array: str, output: str) -> DataFrame:
    kept = [c for c in df.columns if c not in (completion, array)]
    return explode_once(df, F.col(array), output, keep=kept)


def cpt_sections(df: DataFrame, completion: str = "completion", min_chars: int = answers.MIN_SECTION) -> DataFrame:
    """Sections between ``##`` markers as one-line texts of at least ``min_chars`` characters."""
    return _exploded(
        df.withColumn("_parts", answers.section_texts(F.col(completion), min_chars=min_chars)),
        completion, "_parts", "text",
    )


def qa_pairs(
    df: DataFrame, completion: str = "completion", multi_digit: bool = False, full_answer: bool = False
) -> DataFrame:
    """``question`` and ``answer`` of each block.

    By default one digit numbers a block and only an answer's first line counts; ``multi_digit`` and
    ``full_answer`` lift that.
    """
    blocks = _exploded(
        df.withColumn("_blocks", answers.qa_blocks(F.col(completion), multi_digit)), completion, "_blocks", "_block"
    )
    pairs = compute_once(blocks, {
        "question": answers.qa_question(F.col("_block"), multi_digit),
        "answer": answers.qa_answer(F.col("_block"), multi_digit, full_answer),
    })
    return pairs.where(F.col("question").isNotNull() & F.col("answer").isNotNull()).drop("_block")


def synth_pieces(
    df: DataFrame,
    completion: str = "completion",
    min_chars: int = answers.MIN_PIECE,
    min_paragraph: int = answers.MIN_PARAGRAPH,
) -> DataFrame:
    """Pieces under their headers; a completion that gives none is cut at blank lines instead."""
    text = F.col(completion)
    headed = df.withColumn("_headed", answers.headed_pieces(text, min_chars))
    pieces = headed.withColumn(
        "_pieces",
        F.when(F.size("_headed") > 0, F.col("_headed")).otherwise(answers.long_paragraphs(text, min_paragraph)),
    )
    return _exploded(pieces.drop("_headed"), completion, "_pieces", "text")


def parsed_equations(df: DataFrame, completion: str = "completion") -> DataFrame:
    """Every entry of every completion with a ``reason`` that is null for the good ones.

    ``entry`` is the entry's text and ``fields`` its members. A completion that is no JSON gives one row
    with reason ``invalid_json``; ``null`` and scalars give ``no_entries``; an element that is no object
    gives ``not_an_object``. Empty arrays and objects give no row.
    """
    kept = [c for c in df.columns if c != completion]
    text = F.col(completion)
    parsed = compute_once(df, {"_value": js.strict_value(text)})
    value = F.col("_value")
    entries = (
        F.when(js.starts_with(text, "{") & value.isNotNull(), F.when(value == "{}", F.array().cast("array<string>")).otherwise(F.array(value)))
        .when(js.starts_with(text, "[") & value.isNotNull(), js.text_array(value))
        .otherwise(F.array(F.lit(None).cast("string")))
    )
    container = (js.starts_with(text, "{") | js.starts_with(text, "[")) & value.isNotNull()
    scalar = value.isNotNull() | (F.btrim(text, F.lit(" \t\n\r")) == "null")
    # What is wrong with the completion as a whole; null if it holds entries.
    whole = F.when(container, None).when(scalar, "no_entries").otherwise("invalid_json")
    rows = explode_once(parsed.withColumn("_whole", whole), entries, "entry", keep=[*kept, "_whole"])
    entry = F.col("entry")
    typed = compute_once(rows, {"fields": F.when(js.starts_with(entry, "{"), js.text_map(entry))})
    reason = F.coalesce("_whole", F.when(F.col("fields").isNull(), "not_an_object"))
    return typed.select(*kept, "pos", "entry", "fields", reason.alias("reason"))


def entry_fields(entries: DataFrame) -> DataFrame:
    """``fields``, the members of each good ``entry``, read from its text, which holds all of them."""
    return compute_once(entries, {"fields": js.text_map(F.col("entry"))})


def equation_entries(df: DataFrame, completion: str = "completion") -> DataFrame:
    """The good entries: ``pos, entry, fields``."""
    return parsed_equations(df, completion).where("reason is null").drop("reason")


def equation_rejects(df: DataFrame, completion: str = "completion") -> DataFrame:
    """What ``equation_entries`` leaves out, with the reason: the quarantine."""
    return parsed_equations(df, completion).where("reason is not null").drop("fields")


def strip_fences(df: DataFrame, completion: str = "completion") -> DataFrame:
    """Opt-in: take the inside of a fenced code block that is the whole completion."""
    fence = r"(?s)\A\s*```[a-zA-Z]*\n(.*?)\n?```\s*\z"
    inner = F.regexp_extract(completion, fence, 1)
    return df.withColumn(completion, F.when(F.rlike(F.col(completion), F.lit(fence)), inner).otherwise(F.col(completion)))


def equation_json_docs(df: DataFrame, completion: str = "completion", output: str = "json") -> DataFrame:
    """One JSON text per completion that parses to something non-empty: the per-document form.

    The array stays inside its row, so nothing is collected again.
    """
    kept = [c for c in df.columns if c != completion]
    valued = compute_once(df, {output: js.strict_value(F.col(completion))}).select(*kept, output)
    return valued.where(js.truthy(F.col(output)) & F.left(F.col(output), F.lit(1)).isin("[", "{"))
