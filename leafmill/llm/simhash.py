"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared in bit planes.

A bit of a fingerprint is set if more than half of a text's shingle hashes have it. Two fingerprints link if at
most ``RADIUS`` bits differ. Cut into RADIUS + 2 runs of bits, two of them agree in at least two runs, so
fingerprints meet by every choice of two runs. A group of more than ``LIMIT`` is not compared: its members meet
anew by two of the runs that its own free bits are cut into, which again loses no pair. Fingerprints are distinct
and each step halves the free bits, so groups are bounded after three steps, whatever the data are.

A group is compared in bit planes: plane p holds bit p of 64 fingerprints in one word. One fingerprint is held
against 64 others at a time; bitwise counters with carry-save addition add up the differing bits of all 64, and a
block is abandoned as soon as every count in it is over the radius. What a group sends on is a spanning forest of
its links, not its pairs.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .arrow import utf8
from .counted import with_facts
from .ngram_join import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Distinct fingerprints of a group that are compared with each other.
LIMIT = 2048
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20
#: Blocks of 64 comparisons that are held at a time.
BLOCKS = 1 << 15
#: Fingerprints taken together, apart from a group that goes on.
ROWS = 1 << 14

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Each byte with its bits spread over eight bytes, so that 255 of them add up without a carry between bits.
_SPREAD = np.array([sum((b >> k & 1) << (8 * k) for k in range(8)) for b in range(256)], np.uint64)
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``PIECE`` bytes, A-Z lower-cased."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].translate(_FOLD).split()
        at = end


def shingle_hashes(text: bytes | None, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, repeats included; of a text with fewer words, one of its whole sequence."""
    held: list[bytes] = []
    whole = False
    for words in _words(text or b""):
        held += words
        if len(held) < size:
            continue
        joined = b" ".join(held)
        lengths = np.fromiter(map(len, held), np.int64, len(held))
        ends = np.cumsum(lengths + 1) - 1
        hash_of, starts = xxhash.xxh64_intdigest, (ends - lengths).tolist()
        yield np.array([hash_of(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())], np.uint64)
        held, whole = held[len(held) - size + 1 :], True
    if held and not whole:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes | None) -> int:
    """The bits that more than half of the shingle hashes have; zero for a text without words. Unsigned."""
    set_, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text):
        lanes = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
        lanes = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        set_ += lanes.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * set_ > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.fromiter((fingerprint(t) for t in utf8(batch.column(1))), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["doc_id", "node"])


def _finer(agree: int) -> list[int]:
    """The bits that have to agree at the next step, one mask for each choice of two runs of the free bits."""
    free = [b for b in range(64) if not agree >> b & 1]
    step = len(free) // (RADIUS + 2)
    runs = [sum(1 << b for b in free[i * step : (i + 1) * step]) for i in range(RADIUS + 2)]
    return [agree | a | b for a, b in combinations(runs, 2)]


def _planes(nodes: np.ndarray) -> np.ndarray:
    """Word w of plane p: bit p of the nodes from 64 w on."""
    padded = np.zeros(-(-len(nodes) // 64) * 64, np.uint64)
    padded[: len(nodes)] = nodes
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _lanes(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words with the bits from ``first`` to before ``end`` set; both may lie outside the word."""
    low = np.clip(first, 0, 63).astype(np.uint64)
    high = np.clip(64 - end, 0, 63).astype(np.uint64)
    return (_ONES << low) & (_ONES >> high)


def near_pairs(nodes: np.ndarray, ends: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y), x < y < ends[x], of nodes at most ``radius`` bits apart. ``ends`` never falls."""
    planes = _planes(nodes)
    step = max(64 // (RADIUS + 2), 1)
    order = [run * step + i for i in range(step) for run in range(64 // step)]  # runs in turn: some of them agree
    x = np.flatnonzero(ends > np.arange(len(nodes)) + 1)
    first, last = (x + 1) // 64, (ends[x] - 1) // 64
    many = last - first + 1
    for a, b in _slices(many, BLOCKS):
        rows = np.repeat(x[a:b], many[a:b])
        offset = np.arange(len(rows)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
        word = np.repeat(first[a:b], many[a:b]) + offset
        alive = _lanes(rows + 1 - 64 * word, ends[rows] - 64 * word)
        over = radius + 1
        counters = [np.zeros(len(rows), np.uint64) for _ in range(over.bit_length())]
        for done, p in enumerate(order):
            carry = planes[p][word] ^ (np.uint64(0) - (nodes[rows] >> np.uint64(p) & np.uint64(1)))
            passed = _ONES
            for k, counter in enumerate(counters):  # carry-save: each counter word adds one bit to 64 counts
                counters[k], carry = counter ^ carry, counter & carry
                passed = passed & (counters[k] if over >> k & 1 else ~counters[k])
            alive &= ~passed
            if done % 8 == 7:
                left = np.flatnonzero(alive)
                if 2 * len(left) < len(alive):
                    rows, word, alive, counters = rows[left], word[left], alive[left], [c[left] for c in counters]
        for i in range(0, len(rows), 1 << 12):
            found, lane = np.nonzero(np.unpackbits(alive[i : i + (1 << 12)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            if len(found):
                yield rows[i + found], 64 * word[i + found] + lane


def _slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of places whose sizes add up to about ``limit``."""
    sums, at = np.cumsum(sizes), 0
    while at < len(sizes):
        end = int(np.searchsorted(sums, (sums[at - 1] if at else 0) + limit, side="right"))
        yield at, max(end, at + 1)
        at = max(end, at + 1)


def _unite(least: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give each node the least place that it reaches, the links (a, b) added."""
    while True:
        x, y = least[a], least[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (least[least] != least).any():
            least[:] = least[least]


def _forest(nodes: np.ndarray, changes: np.ndarray) -> pa.RecordBatch:
    ends = np.repeat(np.concatenate((changes, [len(nodes)])), np.diff(np.concatenate(([0], changes, [len(nodes)]))))
    least = np.arange(len(nodes))
    for x, y in near_pairs(nodes, ends):
        _unite(least, x, y)
    linked = np.flatnonzero(least != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[least[linked]].view(np.int64)), pa.array(nodes[linked].view(np.int64))], ["a", "b"]
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each group (agree, part); the rows come group by group."""
    held, rows = [], 0
    for batch in batches:
        held.append([batch.column(k).to_numpy() for k in range(3)])
        rows += batch.num_rows
        if rows < ROWS:
            continue
        node, agree, part = (np.concatenate(c) for c in zip(*held))
        changes = np.flatnonzero((agree[1:] != agree[:-1]) | (part[1:] != part[:-1])) + 1
        cut = int(changes[-1]) if len(changes) else 0  # the last group may go on
        if cut:
            yield _forest(node[:cut].view(np.uint64), changes[:-1])
        held, rows = [[c[cut:] for c in (node, agree, part)]], rows - cut
    if rows:
        node, agree, part = (np.concatenate(c) for c in zip(*held))
        yield _forest(node.view(np.uint64), np.flatnonzero((agree[1:] != agree[:-1]) | (part[1:] != part[:-1])) + 1)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that join the distinct fingerprints ``node`` as all pairs within the radius would."""
    agree, masks, links = F.lit(0).cast("bigint"), [0], None
    open_ = nodes.select("node", agree.alias("agree"))
    for step in range(3):
        next_masks = {m: _finer(m) for m in masks}
        choices = F.create_map(*[
            c for m, finer in next_masks.items() for c in (F.lit(_signed(m)).cast("bigint"), F.array(*[F.lit(_signed(f)).cast("bigint") for f in finer]))
        ])
        met = open_.select("node", F.explode(choices[F.col("agree")]).alias("agree"))
        met = met.withColumn("part", F.col("node").bitwiseAND(F.col("agree")))
        masks = [f for finer in next_masks.values() for f in finer]
        large = None
        if step < 2:
            large = met.groupBy("agree", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LIMIT).drop("n")
            large = materialize(large, "large-groups")
            if large.isEmpty():
                large = None
        small = met if large is None else met.join(large, ["agree", "part"], "left_anti")
        grouped = small.repartition("agree", "part").sortWithinPartitions("agree", "part")
        found = grouped.select("node", "agree", "part").mapInArrow(_compare, "a bigint, b bigint")
        links = found if links is None else links.unionAll(found)
        if large is None:
            break
        open_ = materialize(met.join(large, ["agree", "part"], "left_semi").select("node", "agree").distinct(), "met-again")
    return materialize(links, "links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row; the smallest document id names a component.

    A null or empty text has the fingerprint zero and links like any other. Rows of equal texts and repeated rows
    have equal fingerprints and are linked. Texts are read whole, ``PIECE`` bytes at a time. A component of null
    ids only has a null name; null ids count as no id beside others. An empty table gives no row. Other columns
    are not carried along, whatever their names.
    """
    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(chosen.mapInArrow(_fingerprints, "doc_id bigint, node bigint"), "simhashes")
    nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least_id"))
    nodes = materialize(nodes, "simhash-nodes")
    labels = components(near_links(nodes))
    labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = materialize(labelled, "labelled")
    names = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    named = with_facts(labelled, materialize(names, "names"), ["label"], "nodes", ["component_id"])
    made = with_facts(rows, materialize(named.select("node", "n", "component_id"), "named"), ["node"], "n", ["component_id"])
    return made.select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` names their component, with all columns; of rows that repeat such an id, all stay."""
    kept = near_duplicates(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    kept = materialize(kept, "kept")
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]), "left_semi")
