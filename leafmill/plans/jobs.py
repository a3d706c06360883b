"""The corpus-building jobs: operators chained over a working folder.

Every job writes its requests once and stores the answers slice by slice before it parses them, because calls cost
money and must not be repeated by recomputation (``answers.AnswerStore``). A job that is run again asks only for what
is not stored yet; ``resume=False`` asks for everything again and replaces the stored answers of its task.

A document is known by its ``key`` if it has one (``read_text_docs`` gives the path below the folder), else by its
name. What a job cannot use is kept with the reason in a table of rejects.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.records import as_json, to_finetuning
from ..operators.assemble import assemble_pages, combine_documents, page_chunks, page_positions
from ..operators.chunking import (
    MAX_CHUNK_TOKENS, MAX_OUTPUT_TOKENS, MAX_REQUEST_TOKENS, fixed_batches, token_budget,
)
from ..operators.completion import Completer
from ..operators.equations import equation_datasets, own_explanation, render_rejects, share_explanation, typed_entries
from ..operators.merging import batch_verdicts
from ..operators.parsing import cpt_sections, entry_fields, equation_json_docs, parsed_equations, qa_pairs, synth_pieces
from ..operators.reports import content_digest, dataset_stats
from ..operators.requests import Task, chat_requests, prompt_requests, synth_prompts
from ..operators.rows import compute_once
from ..session import path_exists, shuffles_freed
from ..sources.lines import merged_lines, write_lines, written_records
from ..sources.readers import read_lines
from ..sources.writers import write_json_text, write_jsonl
from .answers import PARQUET_OPTIONS, AnswerStore, with_key

log = logging.getLogger(__name__)

STEPS = ("assemble", "rag", "equations", "synth", "qa", "gen_cpt", "gen_ft")


@dataclass(frozen=True)
class Workspace:
    """Where the jobs keep their tables, and how they ask for completions."""

    spark: SparkSession
    root: str
    make_fn: Callable[[], Completer]
    prompts: dict[str, str]
    model: str = "default"
    max_attempts: int = 1
    calls_per_task: int = 1
    buckets: int = 16
    slices: int = 4
    compression: str = "none"  # of line files: as Spark names it, or zstd
    validators: dict[str, Callable[[str], bool]] = field(default_factory=dict)
    tasks: dict[str, Task] = field(init=False)

    def __post_init__(self) -> None:
        limits = {"synthetic": MAX_OUTPUT_TOKENS}
        object.__setattr__(self, "tasks", {
            name: Task(name, prompt, self.model, max_tokens=limits.get(name)) for name, prompt in self.prompts.items()
        })

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Replace a keyed table of this workspace and read it back, so nothing downstream parses again."""
        df.write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(self.path(f"tables/{name}"))
        return self.spark.read.schema(df.schema).parquet(self.path(f"tables/{name}"))

    def answers(self, task: str) -> AnswerStore:
        return AnswerStore(self.spark, self.path(f"answers/{task}"), self.buckets, self.slices)

    def completions(self, task: str) -> DataFrame:
        """Stored answers of a task that succeeded; none before the first run."""
        return self.answers(task).good()

    def texts(self, task: str) -> DataFrame:
        return self.completions(task).select("key", "name", F.col("completion").alias("text"))

    def ask(self, requests: DataFrame, task: str, resume: bool, **options) -> AnswerStore:
        """Store the missing answers of a task, with its validator if there is one."""
        store = self.answers(task)
        store.ask(
            requests, self.make_fn, resume, max_attempts=self.max_attempts, validate=self.validators.get(task),
            calls_per_task=self.calls_per_task, **options,
        )
        return store


def ask_documents(
    ws: Workspace, docs: DataFrame, task: str, done: Callable[[DataFrame], DataFrame] = lambda good: good, resume: bool = True
) -> None:
    """Ask one task about the documents (``key, name, text``) that have no good answer, whatever its prompt was."""
    ws.ask(chat_requests(with_key(docs, ["name", "text"]), [ws.tasks[task]]), task, resume, done=done)


def ask_current(ws: Workspace, requests: DataFrame, task: str, resume: bool = True) -> DataFrame:
    """Answers to exactly these requests: ``key, name, completion``.

    A stored answer counts only if its prompt is the same, so a changed text is asked about again and
    the answer to its old form is left out. A first run has no other answers to leave out.
    """
    first = not resume or not ws.answers(task).asked()
    store = ws.ask(requests, task, resume, per_prompt=True)
    return (store.good() if first else store.answers_to_requests()).select("key", "name", "completion")


def job_rag_cpt(ws: Workspace, docs: DataFrame, resume: bool = True) -> DataFrame:
    """A RAG and a CPT text per document, each only if missing; gives the CPT sections."""
    for task in ("rag", "cpt"):
        ask_documents(ws, docs, task, resume=resume)
    sections = ws.keep(cpt_sections(ws.completions("cpt").select("key", "name", "completion")), "cpt_sections")
    write_jsonl(sections, ws.path("cpt_text"), ["text"], order_by=["key", "pos"], compression=ws.compression)
    return sections


def job_equations(ws: Workspace, docs: DataFrame, resume: bool = True, include_conversations: bool = True) -> DataFrame:
    """Equation entries of each text and the datasets rendered from them.

    A document counts as done once an answer parsed to something; others are asked again. Every answer is parsed
    once, into the table ``equation_parsed``; what is no entry is in ``equation_rejects``, and an entry without
    a text of some dataset in ``render_rejects``, both with the reason. A text is stored once in each table: the
    members of an entry are read from its text, and an explanation that is the description is only marked as such.
    """
    ask_documents(ws, docs, "equations", done=equation_json_docs, resume=resume)
    answers = ws.completions("equations").select("key", "name", "completion")
    parsed = ws.keep(parsed_equations(answers).drop("fields"), "equation_parsed")
    ws.keep(parsed.where("reason is not null"), "equation_rejects")
    entries = entry_fields(parsed.where("reason is null").drop("reason"))
    typed = own_explanation(ws.keep(share_explanation(typed_entries(entries)), "equation_entries"))
    ws.keep(render_rejects(typed), "render_rejects")
    rendered = ws.keep(equation_datasets(typed, include_conversations), "equation_records")
    write_json_text(rendered, ws.path("formatted_equations"), "json", ("dataset",), ws.compression)
    return rendered


def job_qa(ws: Workspace, docs: DataFrame, resume: bool = True) -> DataFrame:
    """Question-answer records of each text, with a verdict per document in the table ``qa_verdicts``."""
    keyed = with_key(docs, ["name", "text"])
    pairs = qa_pairs(ask_current(ws, chat_requests(keyed, [ws.tasks["qa"]]), "qa", resume))
    messages = to_finetuning(F.col("question"), F.col("answer"))["messages"].alias("messages")
    made = ws.keep(pairs.select("key", "name", "pos", messages), "qa_records")
    write_jsonl(made, ws.path("qa_pairs"), ["messages"], order_by=["key", "pos"], compression=ws.compression)
    ws.keep(batch_verdicts(ws.answers("qa").requests(), made, "key"), "qa_verdicts")
    return made


def job_synthetic(
    ws: Workspace,
    docs: DataFrame,
    chunk_tokens: int = MAX_CHUNK_TOKENS,
    batch_size: int = 1,
    max_request: int = MAX_REQUEST_TOKENS,
    max_output: int = MAX_OUTPUT_TOKENS,
    resume: bool = True,
) -> DataFrame:
    """Synthetic pieces from the token chunks of the texts, as far as their prompts fit the budget.

    Prompts over it are not asked; they stay in the table of requests and are listed in ``over_budget_rejects``.
    """
    batches = fixed_batches(
        with_key(docs, ["name", "text"]), batch_size, ["key"], ["name", "text"], chunk_tokens)
    prompts = compute_once(synth_prompts(batches, ws.prompts["synthetic"]), {"prompt": F.col("prompt")})
    counted = token_budget(prompts, "prompt", max_request, max_output)
    batch = F.col("batch_idx").cast("string")
    requests = prompt_requests(counted.select(batch.alias("key"), batch.alias("name"), "n_tokens", "over_budget", "prompt"), ws.tasks["synthetic"])
    answers = ask_current(ws, requests, "synthetic", resume)
    ws.keep(ws.answers("synthetic").over_budget().select(
        F.col("key").cast("bigint").alias("batch_idx"), "n_tokens", F.lit("over_budget").alias("reason")), "over_budget_rejects")
    numbered = answers.select(F.col("key").cast("bigint").alias("batch_idx"), "completion")
    pieces = ws.keep(synth_pieces(numbered), "synthetic_pieces")
    write_jsonl(pieces, ws.path("synthetic_data"), ["text"], order_by=["batch_idx", "pos"], compression=ws.compression)
    return pieces


def _merge_files(ws: Workspace, folders: Sequence[str], new: str, merged: str, existing: str | None, strict: bool) -> DataFrame:
    """The new lines as ``new`` and, if there is an existing corpus, that and the new lines as ``merged``."""
    parts = [ws.path(f) if path_exists(ws.spark, ws.path(f)) else None for f in folders]
    write_lines(merged_lines(ws.spark, parts, strict), ws.path(new), ws.compression)
    if existing is None:
        return written_records(ws.spark, ws.path(new))
    write_lines(merged_lines(ws.spark, [existing, *parts], strict), ws.path(merged), ws.compression)
    return written_records(ws.spark, ws.path(merged))


def build_cpt(ws: Workspace, existing: str | None = None, strict: bool = False) -> DataFrame:
    """The pre-training corpus from whatever the earlier jobs left: the folder ``new_pretraining`` and, after the lines
    of an existing corpus, ``merged_cpt``. Gives the lines of the last one. No line is parsed and written anew."""
    folders = ["formatted_equations/dataset=pretraining", "synthetic_data", "cpt_text"]
    return _merge_files(ws, folders, "new_pretraining", "merged_cpt", existing, strict)


def build_ft(ws: Workspace, existing: str | None = None, strict: bool = False) -> DataFrame:
    """The fine-tuning corpus, in the same way: ``new_finetuning`` and ``merged_finetuning``."""
    return _merge_files(ws, ["formatted_equations/dataset=finetuning", "qa_pairs"], "new_finetuning", "merged_finetuning", existing, strict)


def workspace_stats(ws: Workspace) -> DataFrame:
    """Lines per output data set; null for one that is absent."""
    folders = {
        "equations_ft": ws.path("formatted_equations/dataset=finetuning"),
        "equations_cpt": ws.path("formatted_equations/dataset=pretraining"),
        "qa_pairs": ws.path("qa_pairs"),
        "synthetic": ws.path("synthetic_data"),
    }
    return dataset_stats(read_lines(ws.spark, folders), list(folders))


def workspace_digests(ws: Workspace) -> DataFrame:
    """``output, n_rows, digest`` of every table and corpus that is there, each without regard to order."""
    tables = {
        "page_texts": ["name", "text"], "cpt_sections": ["key", "pos", "text"], "equation_records": ["key", "pos", "dataset", "json"],
        "synthetic_pieces": ["batch_idx", "pos", "text"], "qa_records": ["key", "pos", "json"],
    }
    made = ws.spark.createDataFrame([], "output string, n_rows bigint, digest bigint")
    for name, columns in tables.items():
        if path_exists(ws.spark, ws.path(f"tables/{name}")):
            rows = ws.spark.read.parquet(ws.path(f"tables/{name}"))
            if name == "qa_records":
                rows = rows.withColumn("json", as_json(F.struct("messages")))
            made = made.unionAll(content_digest(rows, *columns).select(F.lit(name).alias("output"), "n_rows", "digest"))
    for name in ("new_pretraining", "merged_cpt", "new_finetuning", "merged_finetuning"):
        if path_exists(ws.spark, ws.path(f"{name}/kind=records")):
            digest = content_digest(written_records(ws.spark, ws.path(name)), "line")
            made = made.unionAll(digest.select(F.lit(name).alias("output"), "n_rows", "digest"))
    return made


def job_all(
    ws: Workspace,
    pages: DataFrame | None = None,
    steps: Sequence[str] = STEPS,
    pages_per_chunk: int = 10,
    existing_cpt: str | None = None,
    existing_ft: str | None = None,
    **synthetic,
) -> tuple[DataFrame, dict[str, str]]:
    """The selected steps in order and the counts at the end, with the state of each step.

    Steps hand over tables in the workspace, so a subset works on what is there, and a step that fails
    is noted and does not stop the rest. ``combine`` (the page texts put together, in parts) runs only if
    it is named. Shuffle files go with the query that made them.
    """

    def assemble() -> None:
        chunks = assemble_pages(page_chunks(page_positions(pages), pages_per_chunk))
        ws.keep(chunks.select(F.col("chunk_name").alias("name"), "text"), "page_texts")

    def combine() -> None:
        texts = ws.spark.read.parquet(ws.path("tables/page_texts")).withColumn("corpus", F.lit("all"))
        ws.keep(combine_documents(texts, "corpus", "name"), "combined_text")

    actions = {
        "assemble": assemble,
        "combine": combine,
        "rag": lambda: job_rag_cpt(ws, ws.spark.read.parquet(ws.path("tables/page_texts"))),
        "equations": lambda: job_equations(ws, ws.texts("rag")),
        "synth": lambda: job_synthetic(ws, ws.texts("rag"), **synthetic),
        "qa": lambda: job_qa(ws, ws.texts("rag")),
        "gen_cpt": lambda: build_cpt(ws, existing_cpt),
        "gen_ft": lambda: build_ft(ws, existing_ft),
    }
    unknown = set(steps) - set(actions)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    states = {}
    for step, action in actions.items():
        if step not in steps:
            continue
        try:
            with shuffles_freed(ws.spark):
                action()
            states[step] = "done"
        except Exception as failure:
            log.error("step %s failed: %s", step, failure)
            states[step] = f"error: {failure}"
    return workspace_stats(ws), states
