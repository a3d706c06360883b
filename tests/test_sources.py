import base64
import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from leafmill.functions import records
from leafmill.sources import lines, readers, writers
from leafmill.streaming import ingest


def test_text_docs(spark, tmp_path):
    (tmp_path / "b.txt").write_bytes("é\r\nline\rend".encode())
    (tmp_path / "a b%+.txt").write_bytes(b"first")
    (tmp_path / "bad.txt").write_bytes(b"\xff\xfe")
    (tmp_path / "other.md").write_bytes(b"no")
    got = readers.read_text_docs(spark, str(tmp_path)).orderBy("name").collect()
    assert [(r.key, r.name, r.text) for r in got] == [("a b%+.txt", "a b%+.txt", "first"), ("b.txt", "b.txt", "é\nline\nend")]
    assert [tuple(r) for r in readers.text_rejects(spark, str(tmp_path)).collect()] == [("bad.txt", "bad.txt", "not_utf8")]
    with pytest.raises(Exception, match="not UTF8: bad.txt"):
        readers.read_text_docs(spark, str(tmp_path), on_error="fail").collect()
    with pytest.raises(ValueError):
        readers.read_text_docs(spark, str(tmp_path), on_error="ignore")


def test_keys_of_equal_names_in_two_folders(spark, tmp_path):
    for part in ("1", "2"):
        (tmp_path / f"part={part}").mkdir()
        (tmp_path / f"part={part}" / "cafe\u0301 1.txt").write_text(part)
    got = readers.read_text_docs(spark, str(tmp_path) + "/").orderBy("key").collect()
    assert [(r.key, r.part, r.text) for r in got] == [("part=1/caf\u00e9 1.txt", 1, "1"), ("part=2/caf\u00e9 1.txt", 2, "2")]


def test_equation_json(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"equation": "A"}, {"equation": "B"}], indent=2))
    (tmp_path / "b.json").write_text('{"equation": "C"}')
    (tmp_path / "c.json").write_text("[broken")
    got = readers.read_equation_json(spark, str(tmp_path)).orderBy("name", "pos").collect()
    assert [(r.name, r.pos, r.fields["equation"]) for r in got] == [("a.json", 0, "A"), ("a.json", 1, "B"), ("b.json", 0, "C")]


def test_jsonl_round_trip_and_rejects(spark, tmp_path):
    values = ['quote " back \\ é 😀', "line\nbreak", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, text string").repartition(2)
    path = str(tmp_path / "out")
    writers.write_jsonl(df, path, ["text"], order_by=["k"])
    assert {r.text for r in readers.read_jsonl(spark, path, records.PRETRAINING).collect()} == set(values)
    lines = [line for f in sorted((tmp_path / "out").glob("*.json")) for line in f.read_text().splitlines()]
    assert sorted(json.loads(line)["text"] for line in lines) == sorted(values)
    assert any("é 😀" in line for line in lines)
    (tmp_path / "out" / "x.json").write_text('{"text": "good"}\n{"text": bad}\n')
    assert readers.read_jsonl(spark, path, records.PRETRAINING, rejects=True).count() == 1
    assert readers.read_jsonl(spark, path, records.PRETRAINING).count() == 4


def test_jsonl_overwrites_and_limits_files(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (30, 10):
        writers.write_jsonl(spark.range(n).coalesce(1), path, ["id"], order_by=["id"], max_records_per_file=4)
    files = sorted((tmp_path / "out").glob("*.json"))
    assert [len(f.read_text().splitlines()) for f in files] == [4, 4, 2]
    assert [json.loads(line)["id"] for f in files for line in f.read_text().splitlines()] == list(range(10))


def test_text_docs_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "docs")
    make = lambda task, text: spark.createDataFrame([("d", text, task)], "name string, text string, task string")
    writers.write_text_docs(make("rag", "1"), path)
    writers.write_text_docs(make("cpt", "2"), path)
    writers.write_text_docs(make("rag", "3"), path)
    read = lambda: sorted((r.task, r.text) for r in spark.read.parquet(path).collect())
    assert read() == [("cpt", "2"), ("rag", "1"), ("rag", "3")]
    writers.write_text_docs(make("rag", "4"), path, replace=True)
    assert read() == [("cpt", "2"), ("rag", "4")]
    scan = spark.read.parquet(path).where("task = 'rag'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(task" in scan


@pytest.fixture
def landing(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    places = (str(folder), str(tmp_path / "out"), str(tmp_path / "ledger"))

    class Landing:
        path = folder
        run = staticmethod(lambda **options: ingest.ingest_new(
            spark, *places, lambda batch: batch.withColumn("n", F.length("text")), **options))
        read = staticmethod(lambda: sorted((r.key, r.name, r.n) for r in ingest.read_ingested(spark, *places[1:]).collect()))
        ledger = staticmethod(lambda: sorted((r.key, r.length, r.reason, r.batch_id) for r in ingest.read_ledger(spark, places[2]).collect()))

    return Landing


def test_ingest_new_takes_each_file_once(landing):
    (landing.path / "a.txt").write_text("one")
    assert landing.run() == 1
    assert landing.read() == [("a.txt", "a.txt", 3)]
    (landing.path / "b.txt").write_text("three\r\n")
    assert landing.run() == 1
    assert landing.read() == [("a.txt", "a.txt", 3), ("b.txt", "b.txt", 6)]
    assert landing.run() == 0
    assert landing.read() == [("a.txt", "a.txt", 3), ("b.txt", "b.txt", 6)]
    assert landing.ledger() == [("a.txt", 3, None, 0), ("b.txt", 7, None, 1)]


def test_ingest_new_takes_old_odd_and_equal_names(landing):
    (landing.path / "a.txt").write_text("one")
    assert landing.run() == 1
    for folder in ("x", "y"):
        (landing.path / folder).mkdir()
        (landing.path / folder / "a.txt").write_text("again")
    long_ago = time.time() - 30 * 86400
    os.utime(landing.path / "x" / "a.txt", (long_ago, long_ago))
    (landing.path / "odd [1]*{2} %41+e\u0301.txt").write_text("odd")
    (landing.path / "bad.txt").write_bytes(b"\xff\xfe")
    assert landing.run() == 1
    assert landing.read() == [
        ("a.txt", "a.txt", 3), ("odd [1]*{2} %41+\u00e9.txt", "odd [1]*{2} %41+e\u0301.txt", 3), ("x/a.txt", "a.txt", 5), ("y/a.txt", "a.txt", 5)]
    assert ("bad.txt", 2, "not_utf8", 1) in landing.ledger()
    assert landing.run() == 0


def test_ingest_new_repeats_nothing_after_a_lost_commit(landing, monkeypatch):
    for i in range(5):
        (landing.path / f"{i}.txt").write_text("x" * (i + 1))

    def lost(*args):
        raise RuntimeError("driver lost")

    commit = ingest._commit
    monkeypatch.setattr(ingest, "_commit", lambda spark, ledger, batch_id, n: lost() if batch_id == 1 else commit(spark, ledger, batch_id, n))
    with pytest.raises(RuntimeError):
        landing.run(max_files_per_batch=2)
    assert [r[0] for r in landing.read()] == ["0.txt", "1.txt"]
    monkeypatch.setattr(ingest, "_commit", commit)
    (landing.path / "00.txt").write_text("new")
    assert landing.run(max_files_per_batch=2) == 2
    assert [r[0] for r in landing.read()] == ["0.txt", "00.txt", "1.txt", "2.txt", "3.txt", "4.txt"]
    assert landing.run() == 0


def test_ingest_new_can_take_changed_files_again(landing):
    (landing.path / "a.txt").write_text("one")
    landing.run()
    (landing.path / "a.txt").write_text("changed")
    assert landing.run() == 0
    assert landing.run(identity=("key", "length", "modified")) == 1
    assert landing.read() == [("a.txt", "a.txt", 3), ("a.txt", "a.txt", 7)]


def test_lines_are_merged_byte_for_byte_in_their_order(spark, tmp_path):
    """Two inputs, a file without a last line feed, a file of several splits, and lines that hold no record."""
    good = [f'{{"n": {i},   "text": "line {i} {"x" * (i % 50)} é"}}' for i in range(4000)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "2.jsonl").write_text("\n".join(good))
    (tmp_path / "a" / "1.jsonl").write_bytes(b'{"b": 1}\r\n\n{"text": "cut\n[1]\nnull\n{"\xff": 1}\n{"z":2}')
    (tmp_path / "b.jsonl").write_text('{"last": "no feed"}')
    conf = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        made = lines.merged_lines(spark, [str(tmp_path / "b.jsonl"), None, str(tmp_path / "a")])
        assert made.select("start").distinct().count() > 5
        lines.write_lines(made, str(tmp_path / "out"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    files = sorted((tmp_path / "out" / "kind=records").glob("*.txt"))
    written = b"".join(f.read_bytes() for f in files)
    assert len(files) > 1
    assert written == b'{"last": "no feed"}\n{"b": 1}\r\n{"z":2}\n' + ("\n".join(good) + "\n").encode()
    apart = sorted(lines.written_rejects(spark, str(tmp_path / "out")).collect(), key=lambda r: r.seq)
    assert [(r.reason, r.line, r.line_base64) for r in apart] == [
        ("blank", "", None), ("invalid_json", '{"text": "cut', None), ("not_an_object", "[1]", None), ("not_an_object", "null", None),
        ("not_utf8", None, base64.b64encode(b'{"\xff": 1}').decode())]
    assert {(r.source_ord, r.key) for r in apart} == {(2, "1.jsonl")}
    with pytest.raises(ValueError):
        lines.merged_lines(spark, [None, str(tmp_path / "a")], strict=True)
    with pytest.raises(ValueError):
        lines.merged_lines(spark, [None])


def test_lines_stay_in_the_tasks_that_read_them(spark, tmp_path):
    """One shuffle partition would hold all lines; written split by split, no task has more than its splits, still in order."""
    for name, n in (("2", 3000), ("10", 20), ("é", 1)):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.jsonl").write_text("\n".join(f'{{"f": "{name}", "n": {i}}}' for i in range(n)))
    (tmp_path / "out" / "kind=records").mkdir(parents=True)
    (tmp_path / "out" / "kind=records" / "part-old.txt").write_text("old\n")
    conf = {"spark.sql.files.maxPartitionBytes": "10000", "spark.sql.shuffle.partitions": "1"}
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        lines.write_lines(lines.merged_lines(spark, [str(tmp_path / "in")]), str(tmp_path / "out"), "gzip")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    files = sorted((tmp_path / "out" / "kind=records").glob("*.gz"))
    assert len(files) > 5 and sorted(p.name for p in tmp_path.iterdir()) == ["in", "out"]
    written = [json.loads(line) for f in files for line in gzip.open(f, "rt", encoding="utf-8")]
    assert [(r["f"], r["n"]) for r in written] == [(name, i) for name, n in (("10", 20), ("2", 3000), ("é", 1)) for i in range(n)]
    assert lines.written_records(spark, str(tmp_path / "out")).count() == 3021
