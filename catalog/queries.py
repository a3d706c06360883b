"""One query per operator and job. Each takes (spark, sf_dir), reads whole tables and gives flat columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.functions import json_text as js, records
from leafmill.functions.latex import format_units, latex_normalize
from leafmill.operators import assemble, chunking, completion, equations, merging, parsing, reports
from leafmill.operators.incremental import pending_only
from leafmill.operators.requests import Task, chat_requests, synth_prompts
from leafmill.plans import jobs
from leafmill.session import scratch_path
from leafmill.sources import lines, readers, writers
from leafmill.streaming.ingest import ingest_new, read_ingested

from . import stubs, views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROMPTS = {name: f"Prompt for {name}." for name in ("rag", "cpt", "qa", "equations", "synthetic")}
TEMPLATE = "Rewrite these sources.\n"
FOLDERS, DOCS_PER_FILE = 16, 100
COMPRESSION, JOB_COMPRESSION = "gzip", "zstd"  # of line files that are a step of a query, and of those in a workspace


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def big(column: str | F.Column) -> F.Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


# Sources

def _write_text_files(docs: DataFrame, path: str, bad_folders: str = "false") -> None:
    """Files of 100 documents each, a document per paragraph, in 16 folders. A file in one of ``bad_folders`` begins with
    a byte that is not UTF-8."""
    folder = (F.col("doc_id") % FOLDERS).alias("folder")
    chunk = F.expr(f"doc_id div {FOLDERS * DOCS_PER_FILE}").alias("chunk")
    files = docs.groupBy(folder, chunk).agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("docs"))
    text = F.array_join(F.transform("docs", lambda d: d["text"]), "\n")
    bad = F.concat(F.unhex(F.lit("FF")).cast("string"), text)
    files.select("folder", F.when(F.expr(bad_folders), bad).otherwise(text).alias("value")).write.partitionBy("folder").option(
        "maxRecordsPerFile", 1).text(path)


def _folder_and_name(df: DataFrame) -> DataFrame:
    """A key without its last part, and whether that is the file's name."""
    folder = F.regexp_replace("key", "/[^/]*$", "")
    return df.withColumns({"key_folder": folder, "key_ends_in_name": F.col("key") == F.concat(folder, F.lit("/"), "name")})


@query
def read_text_docs(spark, sf_dir):
    """Files of equal names lie in several folders; their keys tell them apart."""
    path = scratch_path(spark, "texts")
    _write_text_files(views.documents(spark, sf_dir), path)
    return _folder_and_name(readers.read_text_docs(spark, path)).select("key_folder", "key_ends_in_name", big("folder").alias("folder"), "text")


@query
def text_rejects(spark, sf_dir):
    path = scratch_path(spark, "texts")
    _write_text_files(views.documents(spark, sf_dir), path, "folder % 5 = 2")
    return _folder_and_name(readers.text_rejects(spark, path)).select("key_folder", "key_ends_in_name", "reason")


@query
def read_equation_json(spark, sf_dir):
    """An array of entries per file; every fifth file is cut off and gives nothing."""
    path = scratch_path(spark, "equations")
    entries = parsing.equation_entries(views.equation_responses(spark, sf_dir))
    files = (
        entries.select(F.expr("p_partkey div 50").alias("bucket"), F.struct("p_partkey", "pos", "entry").alias("e"))
        .groupBy("bucket").agg(F.sort_array(F.collect_list("e")).alias("es"))
        .select("bucket", F.concat(
            F.lit("["), F.array_join(F.transform("es", lambda e: e["entry"]), ","),
            F.when(F.col("bucket") % 5 == 4, F.lit("")).otherwise(F.lit("]")),
        ).alias("value"))
    )
    files.write.partitionBy("bucket").text(path)
    read = readers.read_equation_json(spark, path, suffix=".txt")
    return read.select(
        big("bucket").alias("bucket"), "pos", F.col("fields")["equation"].alias("equation"), F.col("fields")["description"].alias("description"))


@query
def read_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    writers.write_jsonl(views.documents(spark, sf_dir), path, ["text"])
    return readers.read_jsonl(spark, path, records.PRETRAINING)


# Assembly

@query
def page_chunks(spark, sf_dir):
    chunks = assemble.page_chunks(views.doc_pages(spark, sf_dir))
    return chunks.select(
        "doc_id", "chunk_no", "chunk_name", "n_pages",
        F.element_at("pages", 1)["page_no"].alias("first_page"), F.element_at("pages", -1)["page_no"].alias("last_page"),
    )


@query
def page_counts(spark, sf_dir):
    return assemble.page_counts(views.doc_pages(spark, sf_dir))


@query
def page_positions(spark, sf_dir):
    """Page numbers with gaps, made dense."""
    gaps = views.doc_pages(spark, sf_dir).withColumn("page_no", F.col("page_no") * 7 - F.col("page_no") % 3)
    return assemble.page_positions(gaps)


@query
def assemble_pages(spark, sf_dir):
    chunks = assemble.page_chunks(views.doc_pages(spark, sf_dir))
    return assemble.assemble_pages(chunks).select("doc_id", "chunk_no", "text")


@query
def combine_documents(spark, sf_dir):
    return assemble.combine_documents(views.documents(spark, sf_dir, "source"), "source", "doc_id", docs_per_part=25)


@query
def combine_documents_by_name(spark, sf_dir):
    return assemble.combine_documents(views.documents(spark, sf_dir, "source"), "source", "name", docs_per_part=25)


@query
def combine_documents_by_bytes(spark, sf_dir):
    """Parts of at most 6000 bytes, or of one longer document."""
    return assemble.combine_documents(views.documents(spark, sf_dir, "source"), "source", "doc_id", docs_per_part=25, max_bytes=6000)


# Tokens, chunks, batches

def _script_texts(spark, sf_dir):
    """Each text in Han and in Thai characters, and some as one run of 100 000 characters without a blank."""
    docs = views.table(spark, sf_dir, "documents", "doc_id", "text")
    scripts = [(name, F.translate("text", letters, signs)) for name, letters, signs in views.SCRIPTS]
    made = [F.struct(F.lit(n).alias("name"), t.alias("text")) for n, t in scripts]
    short = F.substring("text", 1, 200)
    run = F.left(F.repeat(F.concat(F.translate(short, " \n", "__"), F.lit("-")), F.expr("100000 div (length(substring(text, 1, 200)) + 1) + 1")), F.lit(100_000))
    some = F.when(F.col("doc_id") % 50 == 0, F.struct(F.lit("run").alias("name"), run.alias("text")))
    return docs.select("doc_id", F.explode(F.array(*made, some)).alias("t")).where("t is not null").select("doc_id", "t.name", "t.text")


@query
def token_units(spark, sf_dir):
    """Chunks of texts without blanks; no token has more than 32 characters."""
    chunks = chunking.token_chunks(_script_texts(spark, sf_dir), max_tokens=50)
    return chunks.select("doc_id", "name", "chunk_no", "n_chunks", big(F.length("text")).alias("n_chars"), F.md5("text").alias("md5"))


@query
def token_count(spark, sf_dir):
    return chunking.with_token_count(views.documents(spark, sf_dir)).select("doc_id", "n_tokens")


@query
def token_chunks(spark, sf_dir):
    return chunking.token_chunks(views.documents(spark, sf_dir), max_tokens=50)


@query
def fixed_batches(spark, sf_dir):
    docs = views.documents(spark, sf_dir).select("doc_id", "name", F.length("text").cast("bigint").alias("n"))
    batches = chunking.fixed_batches(docs, 3, ["doc_id"], ["doc_id", "name", "n"])
    rows = batches.select("batch_idx", big(F.size("items")).alias("n_items"), F.explode("items").alias("i"))
    return rows.select("batch_idx", "n_items", "i.idx", "i.doc_id", "i.name", "i.n")


def _synth_prompts(spark, sf_dir):
    batches = chunking.fixed_batches(
        views.documents(spark, sf_dir), 3, ["doc_id"], ["name", "text"], chunk_tokens=400)
    return synth_prompts(batches, TEMPLATE)


@query
def token_budget(spark, sf_dir):
    counted = chunking.token_budget(_synth_prompts(spark, sf_dir), max_request=1500, max_output=500)
    return counted.select("batch_idx", "n_tokens", "over_budget")


# Requests and completions

@query
def chat_requests_all(spark, sf_dir):
    tasks = [Task(name, PROMPTS[name]) for name in ("rag", "cpt", "qa", "equations")]
    requests = chat_requests(views.documents(spark, sf_dir), tasks)
    return requests.select(
        "doc_id", "task", "model", "temperature", F.col("messages")[0]["role"].alias("role_0"),
        F.col("messages")[0]["content"].alias("content_0"), F.col("messages")[1]["role"].alias("role_1"),
        F.col("messages")[1]["content"].alias("content_1"),
    )


QUERIES["chat_requests"] = QUERIES.pop("chat_requests_all")
QUERIES["synth_prompts"] = _synth_prompts


def _rag_requests(spark, sf_dir):
    return chat_requests(views.documents(spark, sf_dir).drop("name"), [Task("rag", PROMPTS["rag"])])


@query
def complete(spark, sf_dir):
    answers = completion.complete(_rag_requests(spark, sf_dir), stubs.sometimes_empty)
    return answers.select("doc_id", "task", "status", "completion", "error")


@query
def complete_validated(spark, sf_dir):
    answers = completion.complete_validated(
        _rag_requests(spark, sf_dir), stubs.flaky, stubs.is_good, max_attempts=2
    )
    return answers.select("doc_id", "status", big("attempts").alias("attempts"), "completion", "error")


@query
def retry_failed(spark, sf_dir):
    answers = completion.retry_failed(_rag_requests(spark, sf_dir), stubs.recovering)
    return answers.select("doc_id", "status", big("attempts").alias("attempts"), "completion")


@query
def pending_only_tasks(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents", "doc_id", "n_chars")
    work = docs.withColumn("task", F.explode(F.array(F.lit("rag"), F.lit("cpt"))))
    task = F.when(F.col("quality") == 1, F.lit("rag")).otherwise(F.lit("cpt"))
    done = views.table(spark, sf_dir, "labels", "doc_id", "quality").withColumn("task", task)
    return pending_only(work, done, ["doc_id", "task"])


QUERIES["pending_only"] = QUERIES.pop("pending_only_tasks")


def _age(spark, folder: str) -> None:
    """Make a file of a folder look a month old."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listFiles(path, True)
    while found.hasNext():
        status = found.next()
        if status.getPath().getName().endswith(".txt"):
            files.setTimes(status.getPath(), status.getModificationTime() - 30 * 86_400_000, -1)
            return


@query
def ingest_new_files(spark, sf_dir):
    """Two drops of text files, one of the second with an old time; the second run adds the files of the second drop."""
    root = scratch_path(spark, "ingest")
    docs = views.documents(spark, sf_dir)
    for drop in (0, 1):
        _write_text_files(docs.where(F.col("doc_id") % FOLDERS % 2 == drop), f"{root}/landing/drop={drop}")
        _age(spark, f"{root}/landing/drop={drop}")
        ingest_new(
            spark, f"{root}/landing", f"{root}/out", f"{root}/ledger",
            lambda batch: batch.select(
                F.regexp_replace("key", "/[^/]*$", "").alias("folder"), F.explode(F.split("text", "\n")).alias("line")).where("line != ''"),
        )
    return read_ingested(spark, f"{root}/out", f"{root}/ledger").select("folder", "line")


QUERIES["ingest_new"] = QUERIES.pop("ingest_new_files")


@query
def validate_records(spark, sf_dir):
    """Batches of two conversations; a pair with a short answer counts as one without messages."""
    responses = views.qa_responses(spark, sf_dir)
    made = parsing.qa_pairs(responses).select(
        F.expr("conv_id div 2").alias("batch"),
        F.when(F.length("answer") >= 40, records.to_finetuning(F.col("question"), F.col("answer"))["messages"]).alias("messages"),
    )
    batches = views.table(spark, sf_dir, "conversations", "conv_id").select(F.expr("conv_id div 2").alias("batch"))
    return merging.batch_verdicts(batches, made, "batch")


@query
def validate_equations(spark, sf_dir):
    """Batches of three parts; one is valid if any of its completions gave equations."""
    batch = F.expr("p_partkey div 3").alias("batch")
    processed = parsing.equation_json_docs(views.equation_responses(spark, sf_dir)).select(batch)
    return merging.batch_verdicts(views.table(spark, sf_dir, "part", "p_partkey").select(batch), processed, "batch", F.lit(True))


# Parsing

@query
def cpt_sections(spark, sf_dir):
    return parsing.cpt_sections(views.cpt_responses(spark, sf_dir))


@query
def qa_pairs(spark, sf_dir):
    return parsing.qa_pairs(views.qa_responses(spark, sf_dir))


@query
def synth_pieces(spark, sf_dir):
    return parsing.synth_pieces(views.synth_responses(spark, sf_dir))


def _entries(spark, sf_dir):
    return parsing.equation_entries(views.equation_responses(spark, sf_dir))


def _typed(spark, sf_dir):
    return equations.typed_entries(_entries(spark, sf_dir))


@query
def equation_entries(spark, sf_dir):
    value = lambda key: F.col("fields")[key].alias(key)
    return _entries(spark, sf_dir).select(
        "p_partkey", "pos", big(F.size("fields")).alias("n_fields"), value("equation"), value("description"), value("source"),
    )


@query
def equation_rejects(spark, sf_dir):
    return parsing.equation_rejects(views.equation_responses(spark, sf_dir)).select("p_partkey", "reason")


# Equations

@query
def latex_normalize_all(spark, sf_dir):
    return _entries(spark, sf_dir).select("p_partkey", "pos", latex_normalize(F.col("fields")["equation"]).alias("latex"))


@query
def format_units_all(spark, sf_dir):
    symbols = js.text_map(F.col("fields")["symbols"])
    rows = _entries(spark, sf_dir).select("p_partkey", "pos", F.explode(symbols).alias("symbol", "info"))
    return rows.select("p_partkey", "pos", "symbol", format_units(js.text_map(F.col("info"))["unit"]).alias("unit"))


QUERIES["latex_normalize"] = QUERIES.pop("latex_normalize_all")
QUERIES["format_units"] = QUERIES.pop("format_units_all")


@query
def symbol_info(spark, sf_dir):
    return equations.symbol_info(_typed(spark, sf_dir))


@query
def equation_pretraining(spark, sf_dir):
    return equations.equation_pretraining(_typed(spark, sf_dir))


@query
def equation_finetuning(spark, sf_dir):
    return equations.equation_finetuning(_typed(spark, sf_dir))


@query
def equation_instruction(spark, sf_dir):
    return equations.equation_instruction(_typed(spark, sf_dir))


@query
def equation_datasets(spark, sf_dir):
    made = equations.equation_datasets(_typed(spark, sf_dir))
    return made.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.length("json")).cast("bigint").alias("n_chars")
    )


# Records, merges, sinks, reports

@query
def to_pretraining(spark, sf_dir):
    return views.documents(spark, sf_dir).select("doc_id", records.as_json(records.to_pretraining(F.col("text"))).alias("json"))


def _pair_json(spark, sf_dir, shape):
    pairs = views.turn_pairs(spark, sf_dir)
    return pairs.select("conv_id", "turn", records.as_json(shape(F.col("question"), F.col("answer"))).alias("json"))


@query
def to_finetuning(spark, sf_dir):
    return _pair_json(spark, sf_dir, records.to_finetuning)


@query
def to_instruction(spark, sf_dir):
    return _pair_json(spark, sf_dir, records.to_instruction)


@query
def merge_records(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents", "text")
    return merging.merge_records([docs, views.table(spark, sf_dir, "conversations", "text"), docs], ["text"])


@query
def cpt_corpus(spark, sf_dir):
    return merging.cpt_corpus(
        equation_pretraining(spark, sf_dir), synth_pieces(spark, sf_dir), cpt_sections(spark, sf_dir),
        existing=views.table(spark, sf_dir, "documents", "text"),
    )


def _messages(pairs):
    return pairs.select(records.to_finetuning(F.col("question"), F.col("answer"))["messages"].alias("messages"))


def _flat(made, *keys):
    content = lambda i: F.col("messages")[i]["content"]
    return made.select(*keys, content(0).alias("question"), content(1).alias("answer"))


@query
def ft_corpus(spark, sf_dir):
    corpus = merging.ft_corpus(
        _messages(equation_finetuning(spark, sf_dir)), _messages(qa_pairs(spark, sf_dir)),
        existing=_messages(views.turn_pairs(spark, sf_dir)),
    )
    return _flat(corpus, "source_ord")


def _existing_lines(spark, sf_dir, record) -> str:
    """A corpus of line files as they come: records with keys of their own, odd ones, and lines that hold none."""
    path = scratch_path(spark, "existing")
    docs = views.table(spark, sf_dir, "documents", "doc_id", "text")
    json = records.as_json(record(F.col("text")))
    extra = F.concat(F.expr("substring(json, 1, length(json) - 1)"), F.lit(', "id" : '), F.col("doc_id").cast("string"), F.lit(" }"))
    line = (
        F.when(F.col("doc_id") % 13 == 5, F.expr("substring(json, 1, 9)"))
        .when(F.col("doc_id") % 11 == 5, F.concat(F.lit('{"note":'), F.col("doc_id").cast("string"), F.lit("}")))
        .when(F.col("doc_id") % 17 == 5, F.concat(F.lit("["), "json", F.lit("]")))
        .when(F.col("doc_id") % 3 == 0, extra).otherwise(F.col("json"))
    )
    docs.withColumn("json", json).select(line.alias("value")).write.option("compression", COMPRESSION).text(path)
    return path


def _written_corpora(spark, existing: str, new: list[str]):
    """The lines of the new-only and of the merged corpus, with those kept apart."""
    made = None
    for which, sources in (("new", new), ("merged", [existing, *new])):
        path = scratch_path(spark, which)
        lines.write_lines(lines.merged_lines(spark, sources), path, COMPRESSION)
        kept = lines.written_records(spark, path).select(F.lit(which).alias("corpus"), F.lit(None).cast("string").alias("reason"), "line")
        apart = lines.written_rejects(spark, path).select(F.lit(which).alias("corpus"), "reason", "line")
        made = kept.unionAll(apart) if made is None else made.unionAll(kept).unionAll(apart)
    return made


@query
def cpt_corpus_files(spark, sf_dir):
    """Line files merged with each line as it is."""
    new = [scratch_path(spark, "new") for _ in range(3)]
    for made, path in zip((equation_pretraining, synth_pieces, cpt_sections), new):
        writers.write_jsonl(made(spark, sf_dir), path, ["text"], compression=COMPRESSION)
    return _written_corpora(spark, _existing_lines(spark, sf_dir, records.to_pretraining), new)


@query
def ft_corpus_files(spark, sf_dir):
    new = [scratch_path(spark, "new") for _ in range(2)]
    for made, path in zip((equation_finetuning, qa_pairs), new):
        writers.write_jsonl(_messages(made(spark, sf_dir)), path, ["messages"], compression=COMPRESSION)
    return _written_corpora(spark, _existing_lines(spark, sf_dir, lambda text: records.to_finetuning(text, F.lit("yes"))), new)


@query
def jsonl_rejects(spark, sf_dir):
    return lines.jsonl_rejects(spark, _existing_lines(spark, sf_dir, records.to_pretraining)).select("reason", "line")


@query
def write_jsonl(spark, sf_dir):
    path = scratch_path(spark, "records")
    pairs = views.turn_pairs(spark, sf_dir)
    made = pairs.select("conv_id", "turn", records.to_finetuning(F.col("question"), F.col("answer"))["messages"].alias("messages"))
    writers.write_jsonl(made, path, ["messages"], order_by=["conv_id", "turn"])
    return _flat(readers.read_jsonl(spark, path, records.FINETUNING))


@query
def equation_json_docs(spark, sf_dir):
    return parsing.equation_json_docs(views.equation_responses(spark, sf_dir))


@query
def write_text_docs(spark, sf_dir):
    path = scratch_path(spark, "outputs")
    tasks = [Task(name, PROMPTS[name]) for name in ("rag", "cpt")]
    requests = chat_requests(views.documents(spark, sf_dir).drop("doc_id"), tasks)
    answers = completion.complete(requests, stubs.echo, keep=["name", "task"])
    writers.write_text_docs(answers.select("name", "task", F.col("completion").alias("text")), path)
    return spark.read.schema("name string, text string, task string").parquet(path)


@query
def dataset_stats(spark, sf_dir):
    lines = views.table(spark, sf_dir, "documents", "lang", "text").select(
        F.col("lang").alias("dataset"), F.explode(F.split("text", "\n")).alias("value")
    )
    return reports.dataset_stats(lines, ["en", "de", "fr", "es", "absent"])


@query
def output_manifest(spark, sf_dir):
    return reports.output_manifest(views.file_listing(spark, sf_dir))


@query
def backup_manifest(spark, sf_dir):
    return reports.output_manifest(views.file_listing(spark, sf_dir), reports.BACKUP_SUFFIXES)


# Jobs

def _workspace(spark):
    return jobs.Workspace(spark, scratch_path(spark, "job"), stubs.corpus_writer, PROMPTS, buckets=8, slices=2, compression=JOB_COMPRESSION)


def _named(spark, sf_dir):
    return views.documents(spark, sf_dir).select("name", "text")


@query
def job_rag_cpt(spark, sf_dir):
    return jobs.job_rag_cpt(_workspace(spark), _named(spark, sf_dir)).drop("key")


@query
def job_equations(spark, sf_dir):
    return jobs.job_equations(_workspace(spark), _named(spark, sf_dir)).drop("key")


@query
def job_qa(spark, sf_dir):
    return _flat(jobs.job_qa(_workspace(spark), _named(spark, sf_dir)), "name", "pos")


@query
def job_synthetic(spark, sf_dir):
    return jobs.job_synthetic(_workspace(spark), _named(spark, sf_dir), chunk_tokens=400)


@query
def over_budget_rejects(spark, sf_dir):
    ws = _workspace(spark)
    jobs.job_synthetic(ws, _named(spark, sf_dir), chunk_tokens=400, max_request=600, max_output=300)
    return spark.read.parquet(ws.path("tables/over_budget_rejects"))


def _odd_entries(spark, sf_dir):
    """Entries of which some lack what a text or a pair needs."""
    docs = views.table(spark, sf_dir, "documents", "doc_id", "text")
    equation = F.when(F.col("doc_id") % 5 == 1, F.lit('{"description":"none"}')).when(
        F.col("doc_id") % 5 == 2, F.lit('{"equation":"x","description":null}')).when(
        F.col("doc_id") % 5 == 3, F.lit('{"equation":"x","symbols":{"a":null}}')).otherwise(F.lit('{"equation":"x","description":"y"}'))
    return equations.typed_entries(parsing.equation_entries(docs.select("doc_id", equation.alias("completion"))))


@query
def render_rejects(spark, sf_dir):
    return equations.render_rejects(_odd_entries(spark, sf_dir)).select("doc_id", "pos", "equation", "pretraining_reason", "finetuning_reason")


@query
def job_all(spark, sf_dir):
    """Lines per data set, the state of each step, and the content of each output. Page numbers have gaps."""
    gaps = views.doc_pages(spark, sf_dir).withColumn("page_no", F.col("page_no") * 7 - F.col("page_no") % 3)
    ws = _workspace(spark)
    stats, states = jobs.job_all(ws, gaps)
    none = F.lit(None).cast("bigint")
    rows = stats.select(F.lit("lines").alias("kind"), F.col("dataset").alias("name"), F.col("n_lines").alias("n"), none.alias("digest"), F.lit(None).cast("string").alias("state"))
    steps = spark.createDataFrame(list(states.items()), "name string, state string")
    rows = rows.unionAll(steps.select(F.lit("step"), "name", none, none, "state"))
    return rows.unionAll(jobs.workspace_digests(ws).select(F.lit("output"), "output", "n_rows", "digest", F.lit(None).cast("string")))
