import dataclasses
import json
import time

import pytest
from pyspark.sql import functions as F

from catalog import stubs
from leafmill.plans import jobs
from leafmill.sources import lines, readers

PROMPTS = {name: f"{name} prompt" for name in ("rag", "cpt", "qa", "equations", "synthetic")}


@pytest.fixture
def workspace(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def make(fn=None):
        def factory():
            inner = fn or stubs.corpus_writer()

            def counted(request, attempt):
                calls.add(1)
                return inner(request, attempt)
            return counted
        return jobs.Workspace(spark, str(tmp_path / "ws"), factory, PROMPTS)

    make.calls = calls
    return make


def docs(spark, *names):
    return spark.createDataFrame([(n, f"{n} line one {'x' * 120}\nline two {'y' * 120}") for n in names], "name string, text string")


def test_rag_cpt_asks_only_for_what_is_missing(spark, workspace):
    ws = workspace()
    assert jobs.job_rag_cpt(ws, docs(spark, "a", "b")).count() == 4
    assert workspace.calls.value == 4
    assert jobs.job_rag_cpt(ws, docs(spark, "a", "b")).count() == 4
    assert workspace.calls.value == 4
    assert jobs.job_rag_cpt(ws, docs(spark, "a", "b", "c")).count() == 6
    assert workspace.calls.value == 6
    assert jobs.job_rag_cpt(ws, docs(spark, "a", "b", "c"), resume=False).count() == 6
    assert workspace.calls.value == 12


def test_failed_documents_are_asked_again(spark, workspace):
    good = stubs.corpus_writer()

    def failing(request, attempt):
        if "b line" in request["messages"][1]["content"]:
            raise RuntimeError("down")
        return good(request, attempt)

    assert jobs.job_rag_cpt(workspace(failing), docs(spark, "a", "b")).select("name").distinct().count() == 1
    assert jobs.job_rag_cpt(workspace(), docs(spark, "a", "b")).select("name").distinct().count() == 2
    assert workspace.calls.value == 6


def test_equations_ask_again_where_nothing_was_found(spark, workspace):
    empty = lambda request, attempt: "[]" if request["messages"][1]["content"].startswith("b") else stub(request, attempt)
    stub = stubs.corpus_writer()
    made = jobs.job_equations(workspace(empty), docs(spark, "a", "b"))
    assert sorted((r.name, r.dataset) for r in made.collect()) == [("a", "conversation"), ("a", "finetuning"), ("a", "pretraining")]
    again = jobs.job_equations(workspace(), docs(spark, "a", "b"))
    assert again.count() == 6
    assert workspace.calls.value == 3
    jobs.job_equations(workspace(), docs(spark, "a", "b"))
    assert workspace.calls.value == 3


def test_over_long_prompts_are_not_asked(spark, workspace):
    jobs.job_synthetic(workspace(), docs(spark, "a", "b"), chunk_tokens=4, max_request=30, max_output=1)
    total = workspace.calls.value
    assert total > 0
    jobs.job_synthetic(workspace(), docs(spark, "a", "b"), chunk_tokens=4, max_request=2, max_output=1)
    assert workspace.calls.value == total


def test_a_second_run_asks_nothing_and_a_changed_text_is_asked_again(spark, workspace):
    ws, old = workspace(), docs(spark, "a", "b")
    changed = old.replace({old.orderBy("name").first().text: "a other " + "w" * 120}, subset=["text"])
    for job in (jobs.job_qa, jobs.job_synthetic):
        before = workspace.calls.value
        first = sorted(map(str, job(ws, old).collect()))
        asked = workspace.calls.value - before
        assert asked == 2
        assert sorted(map(str, job(ws, old).collect())) == first and workspace.calls.value == before + asked
        assert sorted(map(str, job(ws, changed).collect())) != first
        assert workspace.calls.value == before + asked + 1
        assert sorted(map(str, job(ws, old).collect())) == first
        assert sorted(map(str, job(ws, old, resume=False).collect())) == first
        assert workspace.calls.value == before + 2 * asked + 1


def test_qa_verdicts(spark, workspace):
    ws = workspace(lambda request, attempt: "no pairs" if request["messages"][1]["content"].startswith("b") else "Q1: q\nA1: a")
    assert jobs.job_qa(ws, docs(spark, "a", "b")).count() == 1
    verdicts = spark.read.parquet(ws.path("tables/qa_verdicts")).collect()
    assert {r.key: r.valid for r in verdicts} == {"a": True, "b": False}


def test_a_validator_makes_a_task_try_again(spark, workspace):
    flaky = lambda request, attempt: "Q1: q\nA1: a" if attempt == 2 else "nothing"
    ws = dataclasses.replace(workspace(flaky), max_attempts=2, validators={"qa": lambda answer: "A1:" in answer})
    assert jobs.job_qa(ws, docs(spark, "a", "b")).count() == 2
    assert workspace.calls.value == 4


def test_all_steps_and_a_failing_one(spark, workspace, tmp_path):
    pages = spark.createDataFrame([("d", n, f"page {n} " + "z" * 120) for n in range(1, 13)], "doc_id string, page_no bigint, markdown string")
    old = tmp_path / "old"
    old.mkdir()
    existing = ['{"text": "old record"}', '{"id": 7,  "text": "kept \\u00e9", "tags": ["a"]}', '{"note": 1}']
    (old / "a.json").write_text("\n".join([*existing, '{"text": "cut']))
    stats, states = jobs.job_all(workspace(), pages, existing_cpt=str(old))
    assert set(states.values()) == {"done"} and list(states) == list(jobs.STEPS)
    counts = {r.dataset: r.n_lines for r in stats.collect()}
    assert counts["equations_ft"] == counts["equations_cpt"] == counts["synthetic"] == 2
    read = lambda name, kind="records": [
        l for f in sorted((tmp_path / "ws" / name / f"kind={kind}").glob("*.txt")) for l in f.read_text().splitlines()]
    new, merged = read("new_pretraining"), read("merged_cpt")
    assert merged[:3] == existing and merged[3:] == new
    (reject,) = map(json.loads, read("merged_cpt", "rejects"))
    assert (reject["line"], reject["reason"], reject["source_ord"], reject["key"]) == ('{"text": "cut', "invalid_json", 0, "a.json")
    assert len(read("new_finetuning")) == counts["equations_ft"] + counts["qa_pairs"]
    assert not (tmp_path / "ws" / "merged_finetuning").exists()
    assert jobs.job_all(workspace(), steps=["combine"])[1] == {"combine": "done"}
    combined = spark.read.parquet(str(tmp_path / "ws/tables/combined_text")).first().text
    assert combined.startswith("# d_part_1\n\n\n# Page 1\npage 1 ") and "\n\n# d_part_2\n" in combined
    with pytest.raises(ValueError):
        jobs.job_all(workspace(), pages, steps=["nothing"])


def test_a_failing_step_does_not_stop_the_rest(spark, workspace):
    stats, states = jobs.job_all(workspace(), None, steps=["rag", "equations", "gen_cpt"])
    assert states["rag"].startswith("error") and states["equations"] == "done"
    assert {r.dataset: r.n_lines for r in stats.collect()}["qa_pairs"] is None


def test_entries_in_are_records_and_rejects(spark, workspace):
    """Every entry of every answer is in a data set or, with its reason, in a table of rejects."""
    answers = {"a": '[{"equation": "x", "description": "d"}, 5, {"description": "no equation"}]', "b": "not json",
               "c": '[{"equation": "y", "description": "d", "symbols": {"s": null}}]'}
    ws = workspace(lambda request, attempt: answers[request["messages"][1]["content"][0]])
    made = jobs.job_equations(ws, docs(spark, "a", "b", "c"))
    table = lambda name: spark.read.parquet(ws.path(f"tables/{name}"))
    assert {(r.key, r.pos, r.reason) for r in table("equation_rejects").collect()} == {("a", 1, "not_an_object"), ("b", 0, "invalid_json")}
    entries, rejects = table("equation_entries").count(), table("render_rejects")
    assert entries == 3
    for dataset, reason in (("pretraining", "pretraining_reason"), ("finetuning", "finetuning_reason")):
        assert made.where(F.col("dataset") == dataset).count() + rejects.where(F.col(reason).isNotNull()).count() == entries
    jobs.job_synthetic(ws, docs(spark, "a", "b"), chunk_tokens=4, max_request=2, max_output=1)
    over, asked = table("over_budget_rejects"), ws.answers("synthetic")
    assert over.count() == asked.requests().count() > 0 and asked.stored().count() == 0
    assert {r.reason for r in over.collect()} == {"over_budget"}


def test_pages_with_gaps_make_one_chunk(spark, workspace):
    pages = spark.createDataFrame([("d", n, f"page {n}") for n in (5, 9, 10, 11, 12, 40)], "doc_id string, page_no bigint, markdown string")
    ws = workspace()
    assert jobs.job_all(ws, pages, steps=["assemble"])[1] == {"assemble": "done"}
    (row,) = spark.read.parquet(ws.path("tables/page_texts")).collect()
    assert row.name == "d_part_1" and [l for l in row.text.splitlines() if l.startswith("page")] == [f"page {n}" for n in (5, 9, 10, 11, 12, 40)]


def test_a_broken_step_changes_a_digest(spark, workspace):
    ws = workspace()
    pages = spark.createDataFrame([("d", n, f"page {n} " + "z" * 120) for n in range(1, 4)], "doc_id string, page_no bigint, markdown string")
    jobs.job_all(ws, pages)
    before = {r.output: (r.n_rows, r.digest) for r in jobs.workspace_digests(ws).collect()}
    assert len(before) == 7
    ws.keep(spark.read.parquet(ws.path("tables/cpt_sections")).replace({"d_part_1": "other"}, subset=["key"]), "other")
    spark.read.parquet(ws.path("tables/other")).write.mode("overwrite").parquet(ws.path("tables/cpt_sections"))
    after = {r.output: (r.n_rows, r.digest) for r in jobs.workspace_digests(ws).collect()}
    assert {k for k in before if before[k] != after[k]} == {"cpt_sections"}


def test_tables_and_line_files_are_compressed(spark, workspace, tmp_path):
    """Uncompressed line files and lightly compressed tables took twice the disk; what they hold is the same."""
    plain, packed = workspace(), dataclasses.replace(workspace(), root=str(tmp_path / "packed"), compression="gzip")
    pages = spark.createDataFrame([("d", n, f"page {n} " + "z" * 120) for n in range(1, 13)], "doc_id string, page_no bigint, markdown string")
    digests = []
    for ws in (plain, packed):
        stats, states = jobs.job_all(ws, pages)
        assert set(states.values()) == {"done"}
        digests.append((sorted(map(str, stats.collect())), sorted(map(str, jobs.workspace_digests(ws).collect()))))
    assert digests[0] == digests[1]
    files = [str(p.relative_to(tmp_path / "packed")) for p in (tmp_path / "packed").rglob("part-*")]
    tables = [f for f in files if f.endswith(".parquet")]
    assert {f.split("/")[0] for f in tables} == {"answers", "tables"} and all(f.endswith(".zstd.parquet") for f in tables)
    assert len(files) > len(tables) and all(f.endswith(".gz") for f in files if f not in tables)


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (blocks.apply(i).getName() for i in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark, workspace):
    """They used to stay until the driver collected its garbage: those of all steps at once."""
    before = shuffle_files(spark)
    pages = spark.createDataFrame([("d", n, f"page {n} " + "z" * 120) for n in range(1, 31)], "doc_id string, page_no bigint, markdown string")
    assert set(jobs.job_all(workspace(), pages)[1].values()) == {"done"}
    left = shuffle_files(spark) - before
    for _ in range(50):  # they are deleted in the background
        if not left:
            break
        time.sleep(0.1)
        left = shuffle_files(spark) - before
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_text_is_stored_once_in_a_table_of_equations(spark, workspace):
    answers = {"a": '[{"equation": "x", "description": "same"}, {"equation": "y"}, {"equation": "z", "description": null}, 5]', "b": "not json"}
    ws = workspace(lambda request, attempt: answers[request["messages"][1]["content"][0]])
    made = jobs.job_equations(ws, docs(spark, "a", "b"))
    table = lambda name: spark.read.parquet(ws.path(f"tables/{name}"))
    assert "fields" not in table("equation_parsed").columns and table("equation_parsed").count() == 5
    assert {(r.pos, r.entry) for r in table("equation_rejects").where("key = 'a'").collect()} == {(3, "5")}
    stored = {r.pos: (r.description, r.explanation, r.explained) for r in table("equation_entries").collect()}
    assert stored == {0: ("same", None, True), 1: ("No description available.", "No explanation provided.", False), 2: (None, None, True)}
    records = {(r.pos, r.dataset): json.loads(r.json) for r in made.collect()}
    assert [records[n, "conversation"]["response"] for n in range(3)] == ["same", "No explanation provided.", None]


def test_line_files_in_zstd(spark, workspace, tmp_path):
    """A name for a codec that Spark has, but has no short name for; every reader of the library knows its files."""
    pages = spark.createDataFrame([("d", n, f"page {n} é " + "z" * 120) for n in range(1, 13)], "doc_id string, page_no bigint, markdown string")
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "a.json").write_text('{"text": "old"}\n{"cut')
    found = []
    for ws in (workspace(), dataclasses.replace(workspace(), root=str(tmp_path / "packed"), compression="zstd")):
        stats, states = jobs.job_all(ws, pages, existing_cpt=str(tmp_path / "old"))
        assert set(states.values()) == {"done"}
        rejects = lines.written_rejects(spark, ws.path("merged_cpt")).collect()
        found.append((sorted(map(str, stats.collect())), sorted(map(str, jobs.workspace_digests(ws).collect())), list(map(str, rejects)),
                      sorted(map(str, readers.read_jsonl(spark, ws.path("synthetic_data"), "text string").collect()))))
    assert found[0] == found[1] and len(found[0][2]) == 1
    files = [p for p in (tmp_path / "packed").rglob("part-*") if not p.name.endswith(".parquet")]
    assert len(files) > 4 and all(p.name.endswith(".zstd") and p.read_bytes()[:4] == b"\x28\xb5\x2f\xfd" for p in files)
    assert not [p for p in files if "staged" in str(p)]
