"""Product codes of vectors, their codebooks learnt by Ball k-means in whole numbers.

Vectors are cut into parts, and every part position has a codebook. An entry and the parts that it has now are a
ball. Its radius bounds how far its parts lie, so only entries within twice the radius (its neighbours) can take a
part from it. Inside, a part nearer than half the way to the first neighbour is in the stable core and stays; the
half distances to the neighbours cut the rest into rings, and a part of the m-th ring is compared with the m
nearest neighbours alone. A ball that has not moved, and whose neighbours have not, is not looked at at all.
All comparisons are of squared whole numbers, so the outcome is that of comparing every part with every entry.

Vectors are packed once into blocks and stored in buckets of the block number. A round reads them with the codes
of the round before, which alone are moved (one byte a part), and sends on what changes: the codes and, for each
entry, the sums of the parts that came or left. The driver holds the codebooks, whose size does not depend on the data.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize, scratch_path
from .counted import with_facts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Bytes of the vectors of a block; a block is one row.
BLOCK_BYTES = 1 << 19
#: Components beyond this are refused: their squared distances would not fit 64 bits.
MOST = 1 << 24


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


class Balls:
    """The codebooks (part, entry, component) with what each entry's ball allows to skip."""

    def __init__(self, book: np.ndarray, reach: np.ndarray, moved: np.ndarray) -> None:
        apart = book[:, :, None, :] - book[:, None, :, :]
        distance = (apart * apart).sum(axis=3)
        k = book.shape[1]
        distance[:, range(k), range(k)] = np.iinfo(np.int64).max  # no entry is its own neighbour
        near = distance <= 4 * reach[:, :, None]
        self.book = book
        self.still = ~moved & ~(near & moved[:, None, :]).any(axis=2)
        distance = np.where(near, distance, np.iinfo(np.int64).max)
        self.order = np.argsort(distance, axis=2, kind="stable")
        self.rings = np.take_along_axis(distance, self.order, axis=2)

    def assign(self, part: int, x: np.ndarray, code: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the parts that were looked at, their new codes and squared distances. ``whole`` looks at all."""
        book = self.book[part]
        at = np.arange(len(x)) if whole else np.flatnonzero(~self.still[part][code])
        x, old = x[at], code[at]
        best, found = self._distance(x, book[old]), old.astype(np.int64)
        ring = (self.rings[part][old] <= 4 * best[:, None]).sum(axis=1)
        if whole:
            ring[self.still[part][old]] = 0
        own = best.copy()
        for rank in range(int(ring.max(initial=0))):
            open_ = np.flatnonzero(ring > rank)
            entry = self.order[part][old[open_], rank]
            distance = self._distance(x[open_], book[entry])
            better = (distance < best[open_]) | ((distance == best[open_]) & (entry < found[open_]))
            best[open_[better]], found[open_[better]] = distance[better], entry[better]
        assert (best <= own).all()
        return at, found, best

    @staticmethod
    def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        apart = x - y
        return np.einsum("ij,ij->i", apart, apart)


def _pack(dimension: int, label: pa.DataType):
    """Blocks of kept vectors: whole-number components, ids and labels in the same order."""
    rows = max(BLOCK_BYTES // (4 * dimension), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(table: pa.Table) -> pa.RecordBatch:
            values = table.column("vector").combine_chunks()
            flat = np.floor(values.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
            if (np.abs(flat) > MOST).any():
                raise ValueError(f"a component is beyond {MOST // SCALE}")
            lists = [pa.array([table.column(c).to_pylist()], pa.list_(t)) for c, t in (("vec_id", pa.int64()), ("label", label))]
            data = pa.array([flat.astype("<i4").tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([*lists, data], ["ids", "labels", "data"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < rows:
                continue
            table = pa.Table.from_batches(held)
            while table.num_rows >= rows:
                yield block(table.slice(0, rows))
                table = table.slice(rows)
            held = table.to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return run


def _round(balls: Balls, dimension: int):
    """``block, codes`` and, as one list, how the sums and counts of the entries change and how far their parts lie."""
    parts, k, width = balls.book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for block, data, codes in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                x = np.frombuffer(data, "<i4").astype(np.int64).reshape(-1, dimension)
                old = None if codes is None else np.frombuffer(codes, np.uint8).reshape(parts, -1)
                new = np.zeros((parts, len(x)), np.uint8) if old is None else old.copy()
                change = np.zeros((parts, k, width + 2), np.int64)  # sums, count, distance
                for p in range(parts):
                    own = x[:, p * width : (p + 1) * width]
                    at, found, distance = balls.assign(p, own, new[p], whole=old is None)
                    gone = at if old is None else at[found != old[p][at]]
                    if old is not None:
                        np.subtract.at(change[p, :, :width], old[p][gone], own[gone])
                        np.subtract.at(change[p, :, width], old[p][gone], 1)
                    new[p][at] = found
                    np.add.at(change[p, :, :width], new[p][gone], own[gone])
                    np.add.at(change[p, :, width], new[p][gone], 1)
                    np.maximum.at(change[p, :, width + 1], found, distance)
                out.append((block, new.tobytes(), change.ravel()))
            columns = list(zip(*out)) or [(), (), ()]
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["block", "codes", "change"])

    return run


def _last(balls: Balls, dimension: int, label: pa.DataType):
    """``vec_id, label, code, error`` of each vector."""
    parts, _, width = balls.book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, data, codes in zip(*[batch.column(i) for i in range(4)]):
                x = np.frombuffer(data.as_py(), "<i4").astype(np.int64).reshape(-1, dimension)
                code = np.frombuffer(codes.as_py(), np.uint8).reshape(parts, -1).copy()
                error = np.zeros(len(x), np.int64)
                for p in range(parts):
                    _, code[p], distance = balls.assign(p, x[:, p * width : (p + 1) * width], code[p], whole=True)
                    error += distance
                text = np.ascontiguousarray(code.T).tobytes().hex()
                step = 2 * parts
                columns = [
                    pa.array(ids.as_py(), pa.int64()), pa.array(labels.as_py(), label),
                    pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()), pa.array(error),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return run


def _root_up(x: int) -> int:
    return isqrt(x - 1) + 1 if x > 0 else 0


def vector_codes(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of each kept vector, and the codebooks (part, entry, component).

    Rows whose vector is null or holds a null or a non-finite component are dropped, and so are vectors without
    the length of the first kept one (the least id), which has to be a multiple of ``parts``. The first codebook is
    that of the ``entries`` least ids, nulls first; equal ids go by their vectors; with fewer rows there are fewer
    entries. Repeated rows count as often as they are there. Equal distances go to the lower index. An empty table
    gives no row and no entries. Components beyond 4096 are an error: their sums would not be exact. Other columns,
    whatever their names, are not carried along.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[label].dataType
    chosen = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    ).where(usable(F.col("vector")) & (F.size("vector") > 0))
    first = [row["vector"] for row in chosen.orderBy("vec_id", "vector").select("vector").limit(1).collect()]
    made = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("label", kind), T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    ])
    if not first:
        return spark.createDataFrame([], made), np.empty((parts, 0, 0), np.int64)
    dimension = len(first[0])
    if dimension % parts:
        raise ValueError(f"vectors of {dimension} components cannot be cut into {parts} equal parts")
    chosen = chosen.where(F.size("vector") == dimension)
    seeds = [row["vector"] for row in chosen.orderBy("vec_id", "vector").select("vector").limit(entries).collect()]
    book = np.floor(np.array(seeds) * SCALE).astype(np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2)
    width, k = dimension // parts, len(seeds)

    blocks = chosen.mapInArrow(
        _pack(dimension, _arrow(kind)),
        T.StructType([
            T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(kind)), T.StructField("data", T.BinaryType()),
        ]),
    ).withColumn("block", F.monotonically_increasing_id())
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"leafmill_vectors_{uuid.uuid4().hex}"
    stored = blocks.repartition(buckets, "block").write.option("path", scratch_path(spark, "vector-blocks"))
    stored.bucketBy(buckets, "block").saveAsTable(name)  # the codes come to the vectors, not the other way round
    try:
        blocks, codes = spark.table(name), None
        sums = np.zeros((parts, k, width + 1), object)
        reach = np.full((parts, k), 1 << 60, np.int64)
        moved = np.ones((parts, k), bool)
        for _ in range(rounds):
            balls = Balls(book, reach, moved)
            data = blocks.select("block", "data")
            data = data.withColumn("codes", F.lit(None).cast("binary")) if codes is None else data.join(codes.select("block", "codes"), "block")
            codes = materialize(data.select("block", "data", "codes").mapInArrow(_round(balls, dimension), "block bigint, codes binary, change array<bigint>"), "codes")
            change, far = _totals(codes, (parts, k, width + 2))
            sums = sums + change
            book, reach, moved = _moved(balls, book, sums, np.where(balls.still, np.maximum(reach, far), far))
        balls = Balls(book, reach, moved)
        data = blocks.join(codes.select("block", "codes"), "block") if codes is not None else blocks.withColumn(
            "codes", F.lit(None).cast("binary"))
        last = data.select("ids", "labels", "data", "codes").mapInArrow(_last(balls, dimension, _arrow(kind)), made)
        return materialize(last, "vector-codes"), book
    finally:
        spark.sql(f"DROP TABLE {name}")


def _totals(codes: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Changes of the sums and counts over all blocks, and the greatest distances: one row for each number of the codebook."""
    width = shape[2]
    each = codes.select(F.posexplode("change").alias("pos", "x"))
    rows = each.groupBy("pos").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("total"), F.max("x").alias("most")).collect()
    change, far = np.zeros(shape, object), np.zeros(shape[:2], np.int64)
    for row in rows:
        p, e, i = np.unravel_index(row["pos"], shape)
        if i == width - 1:
            far[p, e] = row["most"]
        else:
            change[p, e, i] = int(row["total"])
    return change[:, :, : width - 1], far


def _moved(balls: Balls, book: np.ndarray, sums: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The next codebooks, how far (squared) the parts of each entry may lie from it, and which entries moved."""
    new, reach = book.copy(), far.copy()
    for p, e in np.ndindex(*far.shape):
        *total, count = sums[p, e]
        if count:
            new[p, e] = [t // count for t in total]
        shift = int(((new[p, e] - book[p, e]) ** 2).sum())
        reach[p, e] = min((_root_up(int(far[p, e])) + _root_up(shift)) ** 2, 1 << 60) if shift else far[p, e]
    return new, reach, (new != book).any(axis=2)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def codebooks_sha256(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows with the same label, nulls together. ``coded`` is a stored table."""
    of_label = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    return with_facts(coded, of_label, ["label"], "n", ["label_error"])
