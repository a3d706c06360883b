"""The three record shapes of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRETRAINING = "text STRING"
FINETUNING = "messages ARRAY<STRUCT<role: STRING, content: STRING>>"
INSTRUCTION = "input STRING, response STRING"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def to_pretraining(content: Column) -> Column:
    return F.struct(content.alias("text"))


def to_finetuning(question: Column, answer: Column) -> Column:
    return F.struct(F.array(message("user", question), message("assistant", answer)).alias("messages"))


def to_instruction(question: Column, answer: Column) -> Column:
    return F.struct(question.alias("input"), answer.alias("response"))


def as_json(record: Column) -> Column:
    """One JSONL line; a null field is written as ``null``, not left out."""
    return F.to_json(record, {"ignoreNullFields": "false"})
