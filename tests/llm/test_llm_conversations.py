"""Conversation repair against trying every string of edits."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from leafmill.llm import conversations as cv

SF_DIR = "/root/testdata/sf0.001"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def brute(rows):
    """rows: (initial, dead, late). The least (cost, audit) over all strings of edits, by trying them all."""
    best = [(10**9, "")]

    def go(i, roles, cost, audit, put_in):
        if cost > best[0][0] or not re.match(r"(s?(ua)*u?)?\Z", roles):
            return
        if put_in < 2:
            for r in "ua":
                go(i, roles + r, cost + 2, audit + "I", put_in + 1)
        if i == len(rows):
            if LEGAL.match(roles):
                best[0] = min(best[0], (cost, audit))
            return
        initial, dead, late = rows[i]
        go(i + 1, roles, cost + 3, audit + "D", 0)
        if not dead:
            go(i + 1, roles + initial, cost + late, audit + "K", 0)
            for r in "ua":
                go(i + 1, roles + r, cost + 2 + late, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best[0]


def sign(initial, dead, late):
    return "d" if dead else initial.upper() if late else initial


@cache
def random_rows():
    rng = random.Random(5)
    out = []
    for n in [0, 1, 1, 2, 2, 3, 3, 3] + [4] * 20 + [5] * 25 + [6] * 15:
        out.append(tuple((rng.choice("suaxuaua"), rng.random() < 0.15, int(rng.random() < 0.2)) for _ in range(n)))
    return out


def test_audits_equal_brute_force():
    signatures = ["".join(sign(*r) for r in rows) for rows in random_rows()]
    assert list(cv.audits(iter(signatures))) == [brute(rows) for rows in random_rows()]
    ordered = sorted(signatures, key=lambda s: s[::-1])
    assert dict(zip(ordered, cv.audits(iter(ordered)))) == dict(zip(signatures, cv.audits(iter(signatures))))


def test_nodes_are_built_once(monkeypatch):
    signatures = sorted({"".join(sign(*r) for r in rows) for rows in random_rows()}, key=lambda s: s[::-1])
    built, before = [], cv.Node.before.__func__
    monkeypatch.setattr(cv.Node, "before", classmethod(lambda cls, *a: built.append(1) or before(cls, *a)))
    list(cv.audits(iter(signatures)))
    assert len(built) == len({s[i:] for s in signatures for i in range(len(s))})


def test_long_signature():
    signature = "s" + "ua" * 50_000 + "dU"
    ((cost, audit),) = cv.audits(iter([signature]))
    assert (cost, audit) == (6, "K" * 100_001 + "DD")  # as dear as DKI, and before it


def plain(turns):
    """All columns of the query for a list of (conv_id, turn, role, text)."""
    shown = lambda x: " " if x is None else str(x)
    convs = {}
    for conv, turn, role, text in turns:
        rows = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], digest(r)))
        seen, faults, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            dead = not body or (role, text) in seen
            late = not dead and body[-1] not in ".!?"
            counts[0] += not body
            counts[1] += bool(body) and dead
            counts[2] += late
            seen.add((role, text))
            faults.append((role[:1] if role[:1] in tuple("sua") else "x", dead, int(late)))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        numbers = [r[0] for r in rows if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = brute(faults)
        made, i, roles = [], 0, ""
        for edit in audit:
            wants = "assistant" if roles.endswith("u") else "user"
            role, text = (wants, "") if edit == "I" else rows[i][1:]
            i += edit != "I"
            if edit == "D":
                continue
            made.append(f"{wants if edit == 'R' else role}:{text}")
            roles += made[-1][:1]
        assert LEGAL.match(roles)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_turns():
    rng, turns = random.Random(9), []
    roles = ["user", "assistant", "system", "tool", "", None, "User", "assistant", "user"]
    texts = ["Hi.", "Hi", "", None, " \t", "Yes!", "no ", "What? ", "日本.", "x" * 40 + "1.", "x" * 40 + "2."]
    for conv in [*range(60), None]:
        for _ in range(rng.randrange(1, 6)):
            turns.append((conv, rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts)))
    return turns + turns[:9] + [(1000 + i, i % 3, "user", "same.") for i in range(30)]


def test_reports_equal_plain(spark):
    turns = odd_turns()
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").select(
        "*", *[F.lit("mine").alias(c) for c in ("dropped", "signature", "cost", "head", "n", "first")]).repartition(3)
    made = cv.repair_reports(cv.damaged(df))
    assert sorted(map(tuple, made.collect()), key=str) == plain(turns)
    assert cv.repair_reports(cv.damaged(df.limit(0))).count() == 0


def test_query_equals_plain(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    from leafmill.llm.queries import QUERIES

    assert sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, SF_DIR).collect()), key=str) == plain(turns)


def test_repaired_turns_are_legal_and_keep_their_texts(spark):
    turns = [t for t in odd_turns() if t[0] is not None]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("position", F.lit("mine"))
    convs = {}
    for row in sorted(cv.repaired_turns(df).collect()):
        assert row.position == len(convs.setdefault(row.conv_id, []))
        convs[row.conv_id].append(row)
    given = {(c, " " if t is None else t) for c, _, _, t in turns}
    for conv, rows in convs.items():
        assert LEGAL.match("".join(r.role[:1] for r in rows))
        assert all((conv, r.text) in given for r in rows if r.edit != "I")


def test_one_long_conversation(spark):
    """A conversation far longer than others, with one text throughout."""
    long = spark.range(20_000).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("again.").alias("text"))
    (row,) = cv.repair_reports(long.withColumn("dropped", F.lit(False))).collect()
    assert (row.duplicate, row.illegal, row.cost) == (19_999, 19_999, 3 * 19_999 + 2)
    assert row.audit.count("D") == 19_999


@pytest.mark.parametrize("text, fault", [("a.", "o"), ("a. \n", "o"), ("a", "t"), (" ", "b"), ("", "b"), ("a. ", "t"), ("!", "o")])
def test_faults(spark, text, fault):
    df = spark.createDataFrame([(1, 0, "user", text, False)], "conv_id bigint, turn bigint, role string, text string, dropped boolean")
    assert cv._facts(df).first().fault == fault
