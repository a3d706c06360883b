"""Equation entries to symbols and to the three datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import equation_text as et, records
from ..functions.records import as_json
from .rows import compute_once, explode_once

TYPED = ["equation", "description", "explanation", "symbols_json", "symbols", "conditions", "source"]


def typed_entries(entries: DataFrame, fields: str = "fields") -> DataFrame:
    """Replace the field map by typed columns; absent keys get their defaults, explicit nulls stay null."""
    kept = [c for c in entries.columns if c not in (fields, "entry")]
    value = lambda key: F.col(fields)[key]
    present = lambda key, default: F.when(F.map_contains_key(fields, key), value(key)).otherwise(F.lit(default))
    parsed = compute_once(entries, {
        "symbols": et.symbol_array(value("symbols")), "conditions": et.condition_array(value("conditions")),
    })
    return parsed.select(
        *kept,
        value("equation").alias("equation"),
        present("description", et.NO_DESCRIPTION).alias("description"),
        present("description", et.NO_EXPLANATION).alias("explanation"),
        value("symbols").alias("symbols_json"),
        "symbols",
        "conditions",
        value("source").alias("source"),
    )


def share_explanation(entries: DataFrame) -> DataFrame:
    """Typed entries as they are stored: ``explanation`` is null where ``explained`` says that it is the description, the
    same text in most entries. ``own_explanation`` undoes it."""
    same = F.col("explanation").eqNullSafe(F.col("description"))
    return entries.withColumns({"explained": same, "explanation": F.when(~same, F.col("explanation"))})


def own_explanation(stored: DataFrame) -> DataFrame:
    """What ``share_explanation`` was given."""
    explanation = F.when(F.col("explained"), F.col("description")).otherwise(F.col("explanation"))
    return stored.withColumn("explanation", explanation).drop("explained")


def _kept(entries: DataFrame) -> list[str]:
    return [c for c in entries.columns if c not in TYPED]


def symbol_info(entries: DataFrame) -> DataFrame:
    """One row per symbol of each typed entry: ``symbol_pos, symbol, description, unit``."""
    rows = explode_once(entries, F.col("symbols"), "_s", "symbol_pos", keep=_kept(entries))
    return rows.select(*_kept(entries), "symbol_pos", "_s.symbol", "_s.description", "_s.unit")


def equation_pretraining(entries: DataFrame) -> DataFrame:
    """The pre-training ``text`` of each typed entry that can have one."""
    return entries.where(et.pretraining_reject().isNull()).select(*_kept(entries), et.pretraining_text().alias("text"))


def equation_finetuning(entries: DataFrame) -> DataFrame:
    """``question`` and ``answer`` of each typed entry that can have them."""
    return entries.where(et.finetuning_reject().isNull()).select(
        *_kept(entries), et.finetuning_question().alias("question"), et.finetuning_answer().alias("answer"),
    )


def equation_instruction(entries: DataFrame) -> DataFrame:
    """``input`` and ``response`` of each typed entry."""
    return entries.select(*_kept(entries), et.instruction_input().alias("input"), F.col("explanation").alias("response"))


def render_rejects(entries: DataFrame) -> DataFrame:
    """Entries that lack a pre-training text or a fine-tuning pair, with the reasons: the quarantine."""
    return entries.withColumns({
        "pretraining_reason": et.pretraining_reject(), "finetuning_reason": et.finetuning_reject(),
    }).where(F.col("finetuning_reason").isNotNull()).select(
        *_kept(entries), "equation", "pretraining_reason", "finetuning_reason",
    )


def equation_datasets(entries: DataFrame, include_conversations: bool = True) -> DataFrame:
    """All datasets in one pass over the typed entries: ``dataset`` and the record's ``json``."""
    made = [
        ("pretraining", et.pretraining_reject().isNull(), records.to_pretraining(et.pretraining_text())),
        ("finetuning", et.finetuning_reject().isNull(),
         records.to_finetuning(et.finetuning_question(), et.finetuning_answer())),
    ]
    if include_conversations:
        made.append(("conversation", F.lit(True), records.to_instruction(et.instruction_input(), F.col("explanation"))))
    rows = F.array(*[
        F.when(ok, F.struct(F.lit(name).alias("dataset"), as_json(record).alias("json"))) for name, ok, record in made
    ])
    exploded = explode_once(entries, rows, "_r", "_n", keep=_kept(entries)).where("_r is not null")
    return exploded.select(*_kept(entries), "_r.dataset", "_r.json")
