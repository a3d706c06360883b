"""N-gram Jaccard self-join by parity sketches: sets of word shingles, linked from a similarity up.

Every distinct set gets a sketch: each shingle toggles one bit of a very wide bit string, so the Hamming
distance of two sketches is at most the symmetric difference of the sets. Sets of sizes a <= b reach the
similarity t = 4/5 only if that difference is at most (a + b) / 9. The bit string is cut into segments whose
number fits a band of sizes; a difference of d touches at most d segments, so all others agree (pigeonhole).
A segment is kept as the XOR of a hash of its toggled bits. Sets meet on the segments in which they agree;
a folded sketch of 1024 bits drops most of the wrong pairs, one as wide as its set needs drops those of long
texts, and the sets themselves decide.

A set of size a needs a difference up to a // 4 (the largest partner has 5/4 of its size, and 9/36 = 1/4).
It sends its first segments, as many as hold a // 4 + SPARE that are not empty: whichever of two linked sets
sends fewer, at least SPARE of the sent, not empty segments agree. A segment value that more than ``HOT``
sets send says little; a set that sends fewer than SPARE such values can leave them out and still meets
every partner. Sets that send more keep theirs.

Two documents that share a passage agree in many segments, so most values are sent by the very same sets as
another value. Such groups become one: the key of a group is a hash of its sets. Where that hash is the same for
other sets, the groups are compared together, which loses nothing.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .arrow import WHITE_SPACE, Splitter, groups, mix, release, signed, tidy, utf8

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
SPARE = 4
HOT = 256
LIKE = 1.25  # a linked set has at most so many times the shingles of the other
BAND = 1.5  # from band to band; not below LIKE, so that partners are at most one band apart
FOLDED = 16  # 64-bit words of the folded sketch
#: Rows of one segment value that are compared with each other at a time; larger groups are split into blocks.
BLOCK = 1024
NARROW = 8  # 64-bit words of the sketch that goes with them
#: Shingles from which on that sketch says too little: of two unrelated sets it shows some 250 differing bits, and
#: the bound reaches that. Longer sets bring the sketch as wide as they need.
LONG_SET = 700
#: Partners, the least ones, that a set is compared with in the first round; all others are left to the second.
FIRST_PARTNERS = 3
#: Sets that a broadcast of their keys may hold (8 bytes each); more are joined by a shuffle.
BROADCAST_KEYS = 4_000_000


def shingle_sets(texts: list[bytes | None], splitter: Splitter, size: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text; of a shorter text, one of its whole sequence."""
    out = []
    for first, end in groups(texts):
        words = splitter.words(texts[first:end])
        hashes, starts = words.windows(size)
        bounds = np.searchsorted(starts, words.bounds)
        for i in range(end - first):
            own = hashes[bounds[i] : bounds[i + 1]]
            a, b = int(words.bounds[i]), int(words.bounds[i + 1])
            if not len(own) and b > a:
                lower = b" ".join(words.buffer[a:b].lower() for a, b in zip(words.starts[a:b], words.ends[a:b]))
                own = np.array([xxhash.xxh64_intdigest(lower, seed=1)], np.uint64)
            out.append(np.unique(own))
    return out


def set_id(own: np.ndarray) -> int:
    """A 64-bit id of a set: equal sets have equal ids."""
    return xxhash.xxh64_intdigest(own.tobytes(), seed=2)


def _band(n: int) -> int:
    band = int(np.log(n) / np.log(BAND))
    while BAND ** (band + 1) <= n:
        band += 1
    while BAND**band > n:
        band -= 1
    return band


def _segments(band: int) -> int:
    """Segments for the sets of a band and their partners from the next: sizes under LIKE * BAND ** (band + 1)."""
    need = int(LIKE * BAND ** (band + 1)) // 4 + SPARE
    return need + need // 10 + 2


def segment_keys(own: np.ndarray) -> np.ndarray:
    """What a set sends: for its own band and, if small enough for partners there, the band below. The lowest bit of
    a key tells the two apart."""
    n, keys, top = len(own), [], _band(len(own))
    for band in (top, top - 1):
        if band < 0 or band < top and n >= LIKE * BAND**top:
            continue
        m, sent = _segments(band), n // 4 + SPARE
        segment = ((own >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        order = np.argsort(segment, kind="stable")
        segment, values = segment[order], mix(own[order] + np.uint64(band))
        starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        value, place = np.bitwise_xor.reduceat(values, starts), segment[starts]
        if len(value) >= sent:
            value, place = value[:sent], place[:sent]
        else:  # too many empty ones: then they count as values too
            full = np.zeros(m, np.uint64)
            full[place.astype(np.int64)] = value
            value, place = full, np.arange(m, dtype=np.uint64)
        made = mix(value + mix(place * np.uint64(1 << 20) + np.uint64(band)))
        keys.append(made & np.uint64(0xFFFFFFFFFFFFFFFE) | np.uint64(band & 1))
    return np.concatenate(keys)


def folded_sketch(own: np.ndarray) -> np.ndarray:
    toggles = np.bincount((own & np.uint64(64 * FOLDED - 1)).astype(np.int64), minlength=64 * FOLDED) & 1
    return np.packbits(toggles.astype(np.uint8)).view(np.int64)


def wide_sketch(own: np.ndarray) -> bytes | None:
    """A sketch of at least two bits per shingle; none where the folded one is as wide."""
    bits = 1 << (2 * len(own) - 1).bit_length()
    if bits <= 64 * FOLDED:
        return None
    toggles = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(toggles.astype(np.uint8)).tobytes()


def wide_distance(a: bytes | None, b: bytes | None) -> int:
    """The Hamming distance of two wide sketches, the wider one folded to the width of the other."""
    if a is None or b is None:
        return 0
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _forest(x: np.ndarray, y: np.ndarray, own: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The places of those pairs (x, y) that join two trees of labels; ``own`` is the label of a row. Updates ``parent``."""
    a, b = parent[own[x]], parent[own[y]]
    apart = np.flatnonzero(a != b)
    if not len(apart):
        return apart
    _, first = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)))[:, apart], axis=1, return_index=True)
    chosen = []
    for k in apart[first].tolist():
        u, v = int(a[k]), int(b[k])
        while parent[u] != u:
            u = int(parent[u])
        while parent[v] != v:
            v = int(parent[v])
        if u != v:
            parent[max(u, v)] = min(u, v)
            chosen.append(k)
    while (parent[parent] != parent).any():
        parent[:] = parent[parent]
    return np.array(chosen, np.int64)


def _forest_in_groups(batches):
    """Of the near pairs of ``_near_in_groups`` a spanning forest of the labels, never more pairs than rows, and the
    key of each group of which a near pair was left out."""
    yield from _near_in_groups(batches, forest=True)


def _near_in_groups(batches, forest: bool = False):
    """Pairs (a, b) of one group, of different labels, whose sketches are near. The rows come group by group:
    key, i, j, own (block of the row), node, label, n, then the words of the sketch and the wide one of long sets."""
    def compare(c):
        group = np.concatenate(([0], np.cumsum(np.any([x[1:] != x[:-1] for x in c[:3]], axis=0))))
        longest = int(np.bincount(group).max())
        key, i, j, own, node, label, n = c[:7]
        words, wide, found, left = np.stack(c[7:-1], axis=1).view(np.uint64), c[-1], [], [np.empty(0, np.int64)]
        own_label = np.unique(label, return_inverse=True)[1]
        parent = np.arange(int(own_label.max()) + 1)
        for step in range(1, longest):
            x = np.flatnonzero((group[step:] == group[:-step]) & (label[step:] != label[:-step]))
            y = x + step
            # Only like sizes can be similar; rows of one block are compared where the block meets itself.
            fits = (5 * np.minimum(n[x], n[y]) >= 4 * np.maximum(n[x], n[y])) & ((i[x] == j[x]) | (own[x] != own[y]))
            x, y = x[fits], y[fits]
            near = 9 * np.bitwise_count(words[x] ^ words[y]).sum(axis=1, dtype=np.int64) <= n[x] + n[y]
            x, y = x[near], y[near]
            long_ = np.flatnonzero(np.minimum(n[x], n[y]) > LONG_SET)
            if len(long_):
                limit = (n[x] + n[y]).tolist()
                far = [k for k in long_.tolist() if 9 * wide_distance(wide[x[k]], wide[y[k]]) > limit[k]]
                x, y = np.delete(x, far), np.delete(y, far)
            if forest:
                joins = _forest(x, y, own_label, parent)
                left.append(np.unique(key[np.delete(x, joins)]))
                x, y = x[joins], y[joins]
            if len(x):
                found.append(np.stack((np.minimum(node[x], node[y]), np.maximum(node[x], node[y])), axis=1))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
        keys = np.unique(np.concatenate(left))
        filled = [pa.concat_arrays([pa.array(pairs[:, k]), pa.nulls(len(keys), LONG)]) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*filled, pa.concat_arrays([pa.nulls(len(pairs), LONG), pa.array(keys)])], ["a", "b", "key"])

    held, rows = [], 0
    for batch in batches:
        held.append([batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)])
        rows += batch.num_rows
        if rows < 16 * BLOCK:
            continue
        columns = [np.concatenate(x) for x in zip(*held)]
        changes = np.flatnonzero(np.any([x[1:] != x[:-1] for x in columns[:3]], axis=0))
        cut = int(changes[-1]) + 1 if len(changes) else 0  # the last group may go on in the next batch
        if cut:
            yield compare([x[:cut] for x in columns])
        held, rows = [[x[cut:] for x in columns]], rows - cut
    if rows:
        yield compare([np.concatenate(x) for x in zip(*held)])


def _make_rows(names: list[str], kinds: list[pa.DataType], text: str, size: int, row):
    def run(batches):
        release()
        splitter, seen = Splitter(WHITE_SPACE, fold=True), set()
        for batch in batches:
            sets = shingle_sets(utf8(batch.column(text)), splitter, size)
            ids = batch.column(0).to_pylist()
            rows = [r for i, own in zip(ids, sets) if (r := row(i, own, seen)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * len(kinds), kinds)], names)

    return tidy(run)


def _node(own: np.ndarray) -> int | None:
    return int(np.uint64(set_id(own)).view(np.int64)) if len(own) else None


def _new(seen: set, node: int) -> bool:
    """Whether the task has not sent this set yet; what it forgets is sent again, which does no harm."""
    if node in seen:
        return False
    if len(seen) > 1_000_000:
        seen.clear()
    seen.add(node)
    return True


def _doc_row(i, own, seen):
    return (i, len(own), _node(own), folded_sketch(own), wide_sketch(own)) if len(own) else (i, 0, None, None, None)


def _key_row(i, own, seen):
    node = _node(own)
    return (node, signed(segment_keys(own))) if node is not None and _new(seen, node) else None


def _set_row(i, own, seen):
    node = _node(own)
    return (node, signed(own)) if node is not None and _new(seen, node) else None


LONG, LONGS = pa.int64(), pa.list_(pa.int64())


def _pick(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` with a key in the stored table ``keys``: by broadcast if those are few, else by a shuffle."""
    return df.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, on, "left_semi")


def _verified(texts: DataFrame, sketches: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """The pairs of sets (a, b) that are similar: first by folded sketch, then by the sets themselves."""
    def of(side, table, *values):
        return table.select(F.col("node").alias(side), *[F.col(v).alias(f"{v}_{side}") for v in values])

    folded = [f"s{i}" for i in range(FOLDED)]
    apart = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in folded), F.lit(0))
    near = pairs.join(of("a", sketches, "n", *folded), "a").join(of("b", sketches, "n", *folded), "b")
    near = materialize(near.where(9 * apart <= F.col("n_a") + F.col("n_b")).select("a", "b", "n_a", "n_b"), "near")

    @F.pandas_udf("bigint")
    def wide_apart(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([wide_distance(x, y) for x, y in zip(a, b)], dtype="int64")

    near = near.join(of("a", sketches, "wide"), "a").join(of("b", sketches, "wide"), "b")
    near = near.where(9 * wide_apart("wide_a", "wide_b") <= F.col("n_a") + F.col("n_b")).select("a", "b", "n_a", "n_b")
    near = materialize(near, "nearer")
    nodes = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    ids = materialize(sketches.join(nodes, "node", "left_semi").select("doc_id"), "near-docs")
    run = _make_rows(["node", "own"], [LONG, LONGS], "text", size, _set_row)
    # A set may be there twice, from two tasks: its links are then, too, which changes nothing.
    sets = materialize(_pick(texts, ids, "doc_id").mapInArrow(run, "node bigint, own array<bigint>"), "near-sets")
    # Few sets are the first of a pair, often of many: the others travel to them, once for each pair.
    pairs = F.broadcast(near) if near.count() <= BROADCAST_KEYS // 4 else near
    firsts = _pick(of("a", sets, "own"), materialize(near.select("a").distinct(), "firsts"), "a")
    both = of("b", sets, "own").join(pairs, "b").join(firsts, "a")
    common = F.size(F.array_intersect("own_a", "own_b"))
    return materialize(both.where(100 * common >= 80 * (F.col("n_a") + F.col("n_b") - common)).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each node of the links (a, b) reaches.

    Each round gives every node the least label around it and replaces the links by those between labels
    (min-label contraction), so long chains take few rounds. Rounds are tables in the shared folder.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()
    labels = None
    while True:
        edges = materialize(edges, "edges")
        if edges.isEmpty():
            break
        ways = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to"))
        least = materialize(least, "least")
        if labels is None:
            labels = least.withColumnRenamed("to", "label")
        else:
            step = least.select(F.col("node").alias("label"), "to")
            labels = labels.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            labels = materialize(labels, "labels")
        to = lambda side: least.select(F.col("node").alias(side), F.col("to").alias(f"to_{side}"))
        edges = edges.join(to("a"), "a").join(to("b"), "b").select(
            F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")
        ).where("a != b").distinct()
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("a").alias("label"))


def similar_sets(docs: DataFrame, size: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents with their sets (``doc_id, n_shingles, node``) and all links that join the components of sets.

    First every set is compared with the least ones that it shares a segment value with. Then, wherever one value still
    holds sets of several components, the sketches of these sets are compared across components inside the tasks,
    block by block: in a first pass each task sends on a spanning forest of what looks near, which joins large groups
    of near copies with few pairs; in the last pass every near pair not yet tested, of those groups alone of which the
    first left out a pair. Pairs inside one component change nothing, and components only grow.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    run = _make_rows(["doc_id", "n", "node", "s", "wide"], [LONG, LONG, LONG, LONGS, pa.binary()], "text", size, _doc_row)
    made = "doc_id bigint, n bigint, node bigint, s array<bigint>, wide binary"
    rows = texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, made)
    folded = [F.col("s")[i].alias(f"s{i}") for i in range(FOLDED)]
    rows = materialize(rows.select("doc_id", F.col("n").alias("n_shingles"), "node", "wide", *folded), "sketches")

    run = _make_rows(["node", "keys"], [LONG, LONGS], "text", size, _key_row)
    keys = texts.mapInArrow(run, "node bigint, keys array<bigint>").select(F.explode("keys").alias("key"), "node")
    same = Window.partitionBy("key")
    shared = keys.withColumns({
        "least": F.min("node").over(same), "most": F.max("node").over(same), "n": F.count(F.lit(1)).over(same),
        "sets": F.bit_xor(F.xxhash64("node")).over(same), "again": F.bit_xor(F.xxhash64("node", F.lit(1))).over(same),
    })
    # Values sent by the very same sets are one group; those of many sets keep their own key and its lowest bit.
    group = F.when(F.col("n") <= HOT, F.xxhash64("least", "most", "n", "sets", "again")).otherwise(F.col("key"))
    shared = materialize(shared.where("least != most").select(group.alias("key"), "node", "n").distinct(), "shared")
    by_band = F.col("key").bitwiseAND(F.lit(1)).alias("band")
    keeps = shared.where(F.col("n") > HOT).groupBy("node", by_band).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= SPARE)
    hot = shared.where(F.col("n") > HOT).withColumn("band", by_band).join(keeps, ["node", "band"], "left_semi")
    shared = materialize(shared.where(F.col("n") <= HOT).select("key", "node").unionAll(hot.select("key", "node")), "met")

    first = rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("wide").alias("wide"), *[F.first(f"s{i}").alias(f"s{i}") for i in range(FOLDED)]
    )
    met = shared.select("node").distinct()
    sketches = materialize(first.join(met, "node", "left_semi"), "met-sketches")
    least = shared.groupBy("key").agg(F.min("node").alias("a"))
    pairs = shared.join(least, "key").where("node != a").groupBy(F.col("node").alias("b")).agg(F.collect_set("a").alias("a"))
    pairs = pairs.select(F.explode(F.slice(F.sort_array("a"), 1, FIRST_PARTNERS)).alias("a"), "b")
    links = _verified(texts, sketches, pairs, size)

    narrow = [F.col(f"s{i}").bitwiseXOR(F.col(f"s{i + NARROW}")).alias(f"f{i}") for i in range(NARROW)]
    wide = F.when(F.col("n") > LONG_SET, F.col("wide")).alias("wide")
    compared = sketches.select("node", "n", *narrow, wide)
    tested = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "tested")
    for compare in (_forest_in_groups, _near_in_groups):
        labelled = shared.join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("c")).where("x != y")
        open_rows = materialize(labelled.join(mixed.select("key", "c"), "key"), "open")
        blocks = F.ceil(F.col("c") / BLOCK)
        dealt = open_rows.withColumn("own", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        dealt = dealt.join(compared, "node").select(
            "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label", "n", *[f"f{i}" for i in range(NARROW)], "wide"
        )
        grouped = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        found = materialize(grouped.mapInArrow(tidy(compare), "a bigint, b bigint, key bigint"), "found")
        crossing = found.where("key is null").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")
        crossing = materialize(crossing, "crossing")
        shared = shared.join(found.where("key is not null").select("key").distinct(), "key", "left_semi")
        links = materialize(links.unionAll(_verified(texts, sketches, crossing, size)), "all-links")
        tested = tested.unionAll(crossing)
    return rows, links


def near_components(docs: DataFrame, size: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row; the component is named by its smallest document id.

    A null or empty text has no shingles and is its own component, as is every row that links with nothing;
    rows of equal sets are linked, repeated rows too. A component of null ids only has a null name. Null ids
    count as no id beside others. Other columns are not carried along.
    """
    rows, links = similar_sets(docs, size, doc_id, text)
    labels = components(links)
    named = rows.select("doc_id", "n_shingles", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = materialize(named, "named")
    names = named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    joined = named.join(names, "label", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of each component: its smallest id stays. All columns are kept; documents without words
    are copies of nothing and stay. Of rows that repeat an id that stays, all stay. Texts are not moved: the ids that
    go travel to them, unless these are more than a broadcast may hold."""
    stays = F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays")
    gone = near_components(docs, size).groupBy("doc_id").agg(stays).where("not stays")
    gone = materialize(gone.select(F.col("doc_id").alias("_gone_id")), "gone")
    if not gone.where("_gone_id is null").isEmpty():
        docs = docs.where(F.col("doc_id").cast("bigint").isNotNull())
    ids = F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone
    return docs.join(ids, docs["doc_id"] == gone["_gone_id"], "left_anti")
