"""Conversation repair: the cheapest edits that make a conversation's roles ``(s?(ua)+)?``, from a shared automaton.

Every row of a conversation becomes one sign: the initial of its role and its fault. A conversation is then a word
over a dozen signs, its signature, and equal signatures are repaired alike. The edits of a row depend only on what
follows and on the state of the grammar, so signatures share their ends: an automaton that is minimal from the end
has one node for each distinct rest. For every node and grammar state the least cost-to-go and the best audit
are found once, from the next node. The best audits of a node are kept as ranks and pointers, not as texts.

Signatures are made distinct, dealt by ranges of their reversed texts and sorted so. In that order two neighbours
share the longest end they share with anyone, so a task keeps the nodes of one signature and builds each node once.

Rows are taken by turn (nulls first); rows of one turn by role, then by the first 32 characters of the text, then by
the hash of role and text. Null ids, roles and texts count as one space; null
ids are one conversation. A role that does not begin with s, u or a fits nowhere in the grammar, the empty one
too. Rows that repeat are duplicates. An empty table gives no row; other columns are not carried along. Texts are
moved whole and once; a conversation's own rows pass through one task as a stream, since its audit and
the hash of its repaired text are single values, but only its signature, one byte a row, is held there.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .counted import with_facts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Fixed value: x20 and x09 to x0D.
SPACES = " \t\n\x0b\x0c\r"

#: Grammar states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The role that an inserted or changed row takes in each state, and the state after it.
TAKES = ["user", "user", "assistant", "user"]
THEN = [USER, USER, ASSISTANT, USER]
#: Sign of a row that has to go, whatever its role.
GONE = "d"


class Node:
    """What is left of a signature: for each grammar state the cost-to-go, the rank of its best audit among the
    four, and the first edit of that audit with the state after it and whether it stays at this node."""

    __slots__ = ("cost", "rank", "pick")

    def __init__(self, cost: list[int], keys: list[tuple], pick: list[tuple | None]) -> None:
        self.cost, self.pick = cost, pick
        places = {key: i for i, key in enumerate(sorted(set(keys)))}
        self.rank = [places[key] for key in keys]

    @classmethod
    def end(cls) -> Node:
        far = 1 << 60
        return cls._with_inserts([0, far, far, 0], [(), ("~",), ("~",), ()], [None] * 4)

    @classmethod
    def before(cls, sign: str, after: Node) -> Node:
        late = TRUNCATED if sign.isupper() else 0
        initial, cost, keys, pick = sign.lower(), [], [], []
        for state in STATES:
            ways = [(DELETE + after.cost[state], "D", after.rank[state], state)]
            if initial != GONE:
                kept, changed = FOLLOWS.get((state, initial)), THEN[state]
                if kept is not None:
                    ways.append((KEEP + late + after.cost[kept], "K", after.rank[kept], kept))
                ways.append((REROLE + late + after.cost[changed], "R", after.rank[changed], changed))
            least, edit, rank, to = min(ways)
            cost.append(least)
            keys.append((edit, rank))
            pick.append((edit, to, False))
        return cls._with_inserts(cost, keys, pick)

    @classmethod
    def _with_inserts(cls, cost: list[int], keys: list[tuple], pick: list[tuple | None]) -> Node:
        """Rows put in here. An audit that starts with them is their letters and the one that follows."""
        for _ in STATES:
            for state in STATES:
                way = (INSERT + cost[THEN[state]], ("I", *keys[THEN[state]]))
                if way < (cost[state], keys[state]):
                    cost[state], keys[state] = way
                    pick[state] = ("I", THEN[state], True)
        return cls(cost, keys, pick)


def audits(signatures: Iterator[str]) -> Iterator[tuple[int, str]]:
    """The least cost and the best audit of each signature. In the order of the reversed signatures, every node is
    built once; in any other order the results are the same."""
    nodes, last = [Node.end()], ""  # nodes[i] stands for the last i signs
    for signature in signatures:
        turned = signature[::-1]
        shared = 0
        for a, b in zip(turned, last):
            if a != b:
                break
            shared += 1
        del nodes[shared + 1 :]
        for sign in turned[shared:]:
            nodes.append(Node.before(sign, nodes[-1]))
        last = turned
        at, state, edits = len(nodes) - 1, START, []
        while (pick := nodes[at].pick[state]) is not None:
            edits.append(pick[0])
            state = pick[1]
            at -= not pick[2]
        yield nodes[-1].cost[START], "".join(edits)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each():
        for batch in batches:
            yield from batch.column(0).to_pylist()

    held, again = [], []

    def taken():
        for signature in each():
            again.append(signature)
            yield signature

    def flush():
        made = pa.RecordBatch.from_arrays(
            [pa.array(again, pa.string()), pa.array([c for c, _ in held], pa.int64()), pa.array([a for _, a in held], pa.string())],
            ["signature", "cost", "audit"],
        )
        held.clear(), again.clear()
        return made

    size = 0
    for cost, audit in audits(taken()):
        held.append((cost, audit))
        size += 2 * len(audit) + 64
        if size > 1 << 23:
            yield flush()
            size = 0
    if held:
        yield flush()


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after damage by the checksum of ``conv_id:turn``; a dropped row stays with
    ``dropped`` set, so that its conversation is still known."""
    kind = F.crc32(F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn"))).cast("binary")) % 20
    role, text = _text(F.col("role")), _text(F.col("text"))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _digest() -> Column:
    return F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)


def _opening() -> Column:
    return F.substring("text", 1, 32)


def _facts(rows: DataFrame) -> DataFrame:
    """Each row without its text: ``conv_id, turn, dropped, initial, fault, digest``, and what orders the rows of a turn."""
    ending = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(ending == "", "b").when(~F.right(ending, F.lit(1)).isin(".", "!", "?"), "t").otherwise("o")
    initial = F.left("role", F.lit(1))
    return rows.select(
        "conv_id", "turn", "dropped", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        fault.alias("fault"), _digest().alias("digest"), "role", _opening().alias("opening"),
    )


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of the sorted rows."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"]
    kinds = [pa.int64()] * 6 + [pa.string()]
    made: list[tuple] = []
    size = 0
    begun, conv, before, initial, least, greatest, turns, counts, signs = False, None, None, None, None, None, 0, [0] * 4, bytearray()

    def close() -> None:
        gaps = greatest - least + 1 - turns if turns else 0
        made.append((conv, gaps, *counts, signs.decode()))

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names)
        made.clear()
        return batch

    for batch in batches:
        for key, turn, dropped, sign, fault, digest, seen in zip(*[batch.column(i).to_pylist() for i in range(7)]):
            if not begun or key != conv:
                if begun:
                    close()
                    size += len(signs) + 64
                    if size > 1 << 23:
                        yield flush()
                        size = 0
                begun, conv, before, initial, least, greatest, turns, counts, signs = True, key, None, None, None, None, 0, [0] * 4, bytearray()
            if dropped:
                continue
            if turn is not None and turn != greatest:
                least, greatest, turns = turn if least is None else least, turn, turns + 1
            # The row before is the same one if there are equal rows of one turn.
            repeated = seen or before == (turn, digest)
            dead = fault == "b" or repeated
            counts[0] += fault == "b"
            counts[1] += fault != "b" and repeated
            counts[2] += fault == "t" and not repeated
            counts[3] += initial is not None and initial + sign not in ("su", "ua", "au")
            signs += (GONE if dead else sign.upper() if fault == "t" else sign).encode()
            before, initial = (turn, digest), sign
    if begun:
        close()
    if made:
        yield flush()


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def reports(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of each conversation of ``rows``
    (``conv_id, turn, role, text, dropped``, none null but the first two)."""
    facts = materialize(_facts(rows), "conversation-facts")
    first = facts.where(~F.col("dropped")).groupBy("conv_id", "digest").agg(
        F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n"))
    alive = facts.where(~F.col("dropped"))
    marked = with_facts(alive, materialize(first, "first-turns"), ["conv_id", "digest"], "n", ["first"])
    later = F.coalesce(F.col("turn") > F.col("first.turn"), F.col("turn").isNotNull() & F.col("first.turn").isNull())
    columns = ["conv_id", "turn", "dropped", "initial", "fault", "digest"]
    marked = marked.select(*columns, later.alias("seen"), "role", "opening").unionAll(
        facts.where("dropped").select(*columns, F.lit(False).alias("seen"), "role", "opening"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "opening", "digest"]
    streamed = marked.repartition("conv_id").sortWithinPartitions(*order).drop("role", "opening").mapInArrow(
        _signatures, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, signature string")
    streamed = materialize(streamed, "signatures")
    distinct = materialize(streamed.groupBy("signature").agg(F.count(F.lit(1)).alias("n")), "distinct-signatures")
    turned = F.reverse("signature")
    dealt = distinct.repartitionByRange(turned).sortWithinPartitions(turned).select("signature")
    found = dealt.mapInArrow(_audits, "signature string, cost bigint, audit string").join(distinct, "signature")
    made = with_facts(streamed, materialize(found, "audits"), ["signature"], "n", ["cost", "audit"])
    return made.select("conv_id", *REPORT)


class Walk:
    """Follows the audit of a conversation: ``rows`` gives (edit, role, text) of the rows that stay or come in."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = TAKES[self.state]
            self.at, self.state = self.at + 1, THEN[self.state]
            yield "I", role, ""

    def take(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = FOLLOWS[self.state, role[:1]]
            yield edit, role, text
        elif edit == "R":
            role, self.state = TAKES[self.state], THEN[self.state]
            yield edit, role, text


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, tuple | None]]:
    """(report, None) at the start of each conversation, then (None, row) for each repaired row."""
    walk = None
    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        heads, roles, texts = (columns[names.index(c)] for c in ("head", "role", "text"))
        for i, is_row in enumerate(heads):
            if not is_row:
                if walk is not None:
                    for row in walk.inserted():
                        yield None, row
                report = {c: columns[names.index(c)][i] for c in ("conv_id", *REPORT)}
                walk = Walk(report["audit"])
                yield report, None
            else:
                for row in walk.take(roles[i], texts[i]):
                    yield None, row
    if walk is not None:
        for row in walk.inserted():
            yield None, row


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made, report, digest, any_ = [], None, None, False

    def batch():
        columns = [pa.array([r[c] for r in made], pa.string() if c in ("audit", "repaired_sha256") else pa.int64())
                   for c in ("conv_id", *REPORT, "repaired_sha256")]
        made.clear()
        return pa.RecordBatch.from_arrays(columns, ["conv_id", *REPORT, "repaired_sha256"])

    size = 0
    for head, row in _walked(batches):
        if head is not None:
            if report is not None:
                made.append({**report, "repaired_sha256": digest.hexdigest()})
                size += len(report["audit"]) + 200
                if size > 1 << 23:
                    yield batch()
                    size = 0
            report, digest, any_ = head, hashlib.sha256(), False
        else:
            digest.update(f"{chr(10) if any_ else ''}{row[1]}:{row[2]}".encode())
            any_ = True
    if report is not None:
        made.append({**report, "repaired_sha256": digest.hexdigest()})
    if made:
        yield batch()


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made, conv, at = [], None, 0
    names, kinds = ["conv_id", "position", "edit", "role", "text"], [pa.int64(), pa.int64(), *[pa.string()] * 3]

    def batch():
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names)
        made.clear()
        return out

    size = 0
    for head, row in _walked(batches):
        if head is not None:
            conv, at = head["conv_id"], 0
            continue
        made.append((conv, at, *row))
        at += 1
        size += len(row[2]) + 64
        if size > 1 << 23:
            yield batch()
            size = 0
    if made:
        yield batch()


def _with_reports(rows: DataFrame) -> DataFrame:
    """The report of each conversation, then its rows in order."""
    report = materialize(reports(rows), "reports")
    heads = report.select("conv_id", *REPORT, F.lit(False).alias("head"), F.lit(None).cast("bigint").alias("turn"),
                          F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    empty = [F.lit(None).cast(report.schema[c].dataType).alias(c) for c in REPORT]
    tail = rows.where(~F.col("dropped")).select("conv_id", *empty, F.lit(True).alias("head"), "turn", "role", "text")
    order = ["conv_id", "head", F.col("turn").asc_nulls_first(), "role", _opening(), _digest()]
    return heads.unionAll(tail).repartition("conv_id").sortWithinPartitions(*order).drop("turn")


def _plain(turns: DataFrame) -> DataFrame:
    return turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        _text(F.col("role")).alias("role"), _text(F.col("text")).alias("text"), F.lit(False).alias("dropped"))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, position, edit, role, text``: the repaired rows of each conversation. ``edit`` is K (kept),
    R (role changed) or I (put in)."""
    return _with_reports(_plain(turns)).mapInArrow(_turns, "conv_id bigint, position bigint, edit string, role string, text string")


def repair_reports(rows: DataFrame) -> DataFrame:
    """The report of each conversation with ``repaired_sha256``, the hash of its repaired ``role:text`` lines.

    ``rows`` has ``conv_id, turn, role, text, dropped`` as ``damaged`` gives them.
    """
    made = ", ".join(f"{c} {'string' if c in ('audit', 'repaired_sha256') else 'bigint'}" for c in ("conv_id", *REPORT, "repaired_sha256"))
    return _with_reports(rows).mapInArrow(_digests, made)
