"""Token-id files: a wavelet matrix per shard.

A shard holds the ids of consecutive documents. Its bits are stored plane by plane from the highest one; each
plane stably puts the ids with a 0 before those with a 1, and a directory counts the ones before every block
of 512 bits. From one compressed file a reader gets the id at a position, the number of occurrences of an id
before a position, and the position of its k-th occurrence, without the ids themselves being stored.

A shard is a file of one row, so it can be read from any store that Spark reads.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .arrow import tidy, trim
from .tokenize import worker_tokens

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD_TOKENS = 1 << 22
BLOCK = 512
#: Ids that are moved from plane to plane at a time, a multiple of 8; arrays of this size stay in a processor's cache.
MOVED = 1 << 17
#: Bytes of text that are encoded at a time, or one text: more of them share their words, at some 25 bytes of memory each.
ENCODED = 1 << 20
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
SHARD = (
    "part int, seq int, n_tokens bigint, doc_ids array<bigint>, sizes array<bigint>, "
    "width int, planes array<binary>, ranks array<binary>"
)


def _kind(width: int) -> type:
    """The narrowest numbers that hold ids of so many bits."""
    return np.uint16 if width <= 16 else np.uint32


class WaveletMatrix:
    """Access, rank and select over the bit planes of a sequence of ids."""

    def __init__(self, n: int, planes: list[bytes], ranks: list[bytes]) -> None:
        self.n, self.planes = n, [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, np.uint32) for r in ranks]
        self.zeros = [n - (int(r[-1]) if len(r) else 0) for r in self.ranks]

    @staticmethod
    def build(ids: np.ndarray, width: int) -> tuple[list[bytes], list[bytes]]:
        now = ids.astype(_kind(width), copy=False)
        planes, ranks = [], []
        for b in range(width - 1, -1, -1):
            bit, packed, clear, set_ = now.dtype.type(1 << b), [], [], []
            for first in range(0, len(now), MOVED):
                some = now[first : first + MOVED]
                ones = (some & bit) != 0
                packed.append(np.packbits(ones))
                set_.append(some.compress(ones))
                clear.append(some.compress(np.logical_not(ones, out=ones)))
            plane = np.concatenate(packed) if packed else np.empty(0, np.uint8)
            counts = np.bitwise_count(plane).astype(np.uint32)
            sums = np.add.reduceat(counts, np.arange(0, len(counts), BLOCK // 8)) if len(counts) else counts
            planes.append(plane.tobytes())
            ranks.append(np.concatenate(([0], np.cumsum(sums))).astype(np.uint32).tobytes())
            now = np.concatenate((*clear, *set_)) if packed else now
        return planes, ranks

    def ids(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        kind = _kind(len(self.planes))
        now = np.zeros(self.n, kind)
        for b, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1])):
            now[zeros:] |= kind(1 << b)
            above, low, high = np.empty(self.n, kind), 0, zeros
            for first in range(0, self.n, MOVED):
                some = above[first : first + MOVED]
                ones = np.unpackbits(plane[first >> 3 : first + MOVED >> 3], count=len(some)).view(bool)
                set_ = np.flatnonzero(ones)
                some[set_] = now[high : high + len(set_)]
                clear = np.flatnonzero(np.logical_not(ones, out=ones))
                some[clear] = now[low : low + len(clear)]
                low, high = low + len(clear), high + len(set_)
            now = above
        return now

    def _ones(self, level: int, end: int) -> int:
        """Ones of a plane before ``end``: the directory's count and the rest of one block."""
        block, rest = divmod(end, BLOCK)
        at = block * BLOCK // 8
        tail = np.unpackbits(self.planes[level][at : at + BLOCK // 8])[:rest]
        return int(self.ranks[level][block]) + int(tail.sum())

    def _bit(self, level: int, i: int) -> int:
        return self.planes[level][i >> 3] >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = int(self._bit(level, i)), self._ones(level, i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` before ``end`` lie below the last plane."""
        first = 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, first), self._ones(level, end)
            if token >> (len(self.zeros) - 1 - level) & 1:
                first, end = zeros + a, zeros + b
            else:
                first, end = first - a, end - b
        return first, end

    def rank(self, token: int, end: int | None = None) -> int:
        """Occurrences of ``token`` before position ``end``."""
        if token < 0 or token >> len(self.zeros):
            return 0
        first, last = self._range(token, self.n if end is None else end)
        return last - first

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) 0 or 1 of a plane."""
        low, high = 0, len(self.ranks[level]) - 1
        count = lambda block: int(self.ranks[level][block]) if bit else block * BLOCK - int(self.ranks[level][block])
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if count(middle) <= k else (low, middle)
        at = low * BLOCK // 8
        bits = np.unpackbits(self.planes[level][at : at + BLOCK // 8])
        return low * BLOCK + int(np.flatnonzero(bits == bit)[k - count(low)])

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``."""
        first, last = self._range(token, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        at = first + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - level) & 1
            at = self._select_bit(level, bit, at - self.zeros[level] if bit else at)
        return at


def _encoder(text: str, definition: str, pieces: bool, width: int, end_id: int, shard_tokens: int):
    schema = pa.schema([
        ("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())), ("width", pa.int32()), ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
    ])

    def run(batches):
        tokens, part = worker_tokens(definition, pieces), TaskContext.get().partitionId()
        ids, doc_ids, sizes, held, seq = [], [], [], 0, 0

        def shard():
            whole = np.concatenate(ids)
            ids.clear()
            planes, ranks = WaveletMatrix.build(whole, width)
            row = {"part": part, "seq": seq, "n_tokens": held, "doc_ids": doc_ids, "sizes": sizes, "width": width, "planes": planes, "ranks": ranks}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            own_ids, column = batch.column("doc_id").to_pylist(), batch.column(text)
            held_bytes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(held_bytes // ENCODED)) + 1).tolist(), len(own_ids)]
            for first, last in zip(cuts, cuts[1:]):
                made, counts = tokens.encode(column.slice(first, last - first).to_pylist(), end_id)
                made, at = made.astype(_kind(width)), 0
                for doc_id, count in zip(own_ids[first:last], counts.tolist()):
                    ids.append(made[at : at + count])
                    doc_ids.append(doc_id)
                    sizes.append(count)
                    at, held = at + count, held + count
                    if held >= shard_tokens:
                        yield shard()
                        trim()
                        ids, doc_ids, sizes, held, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield shard()

    return tidy(run)


def write_token_files(
    docs: DataFrame, path: str, definition: str, pieces: bool = True, vocabulary: int = 49_408, end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS, doc_id: str = "doc_id", text: str = "text", parts: int | None = None,
) -> None:
    """Write the ids of all documents, in ascending order of (id, text), as shards of about ``shard_tokens``.

    ``definition`` is the content of a tokenizer file; ``vocabulary`` bounds its ids. Documents are put in
    order by ranges of ids, a task cuts its range into shards, and no shard crosses two ranges. A null or
    empty text has the end id only; null ids come first; repeated rows are written each. Other columns are
    not written. A table without rows gives a folder without shards.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = max(1, (max(vocabulary, end_id + 1) - 1).bit_length())
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    placed = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    shards = placed.mapInArrow(_encoder("text", definition, pieces, width, end_id, shard_tokens), SHARD)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, seq, start``: the number of ids before each shard. Ranges are few; shards add up within theirs."""
    shards = spark.read.schema(SHARD).parquet(path).select("part", "seq", "n_tokens")
    before = lambda *by: Window.partitionBy(*by).orderBy("seq" if by else "part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ranges = ranges.select("part", F.coalesce(F.sum("n").over(before()), F.lit(0)).alias("range_start"))
    own = F.coalesce(F.sum("n_tokens").over(before("part")), F.lit(0))
    return shards.withColumn("own", own).join(ranges, "part").select("part", "seq", (F.col("own") + F.col("range_start")).alias("start"))


def _reader(row):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield row(batch.slice(i, 1).to_pylist()[0])

    return tidy(run)


def _documents(with_ids: bool):
    def row(shard):
        ids = WaveletMatrix(shard["n_tokens"], shard["planes"], shard["ranks"]).ids()
        sizes = np.array(shard["sizes"], np.int64)
        ends = np.cumsum(sizes)
        n = len(sizes)
        crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        columns = [
            pa.array([shard["part"]] * n, pa.int32()), pa.array([shard["seq"]] * n, pa.int32()), pa.array(shard["doc_ids"], pa.int64()),
            pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64()),
        ]
        names = ["part", "seq", "doc_id", "own_start", "n_tokens", "ids_crc32"]
        if with_ids:
            offsets = pa.array(np.append(0, ends).astype(np.int32))
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    return row


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids`` of each document, from the files."""
    made = "part int, seq int, doc_id bigint, own_start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    read = spark.read.schema(SHARD).parquet(path).mapInArrow(_reader(_documents(with_ids)), made)
    start = (F.col("start") + F.col("own_start")).alias("start")
    rest = ["n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return read.join(shard_starts(spark, path), ["part", "seq"]).select("doc_id", start, *rest)


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``token, n``: occurrences of some ids in all shards, by rank on the planes."""
    def row(shard):
        matrix = WaveletMatrix(shard["n_tokens"], shard["planes"], shard["ranks"])
        return pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([matrix.rank(t) for t in tokens], pa.int64())], ["token", "n"])

    read = spark.read.schema(SHARD).parquet(path).mapInArrow(_reader(row), "token bigint, n bigint")
    return read.groupBy("token").agg(F.sum("n").alias("n"))


def find_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``token, position``: every occurrence of some ids, by select on the planes; positions count over all files."""
    def row(shard):
        matrix = WaveletMatrix(shard["n_tokens"], shard["planes"], shard["ranks"])
        found = [(shard["part"], shard["seq"], t, matrix.select(t, k)) for t in tokens for k in range(matrix.rank(t))]
        columns = list(zip(*found)) or [(), (), (), ()]
        kinds = pa.int32(), pa.int32(), pa.int64(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "seq", "token", "own"])

    read = spark.read.schema(SHARD).parquet(path).mapInArrow(_reader(row), "part int, seq int, token bigint, own bigint")
    return read.join(shard_starts(spark, path), ["part", "seq"]).select("token", (F.col("start") + F.col("own")).alias("position"))


def tokens_at(path: str, positions: DataFrame) -> DataFrame:
    """``position, token`` of each row of ``positions`` (``position``), by access on the planes of its shard."""
    spark = positions.sparkSession
    shards = spark.read.schema(SHARD).parquet(path).join(shard_starts(spark, path), ["part", "seq"])
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens"))
    spans = shards.select("part", "seq", "start", "n_tokens")
    asked = positions.select("position").join(spans, inside).groupBy("part", "seq").agg(F.collect_list("position").alias("asked"))

    def row(shard):
        matrix = WaveletMatrix(shard["n_tokens"], shard["planes"], shard["ranks"])
        made = [matrix.access(p - shard["start"]) for p in shard["asked"]]
        return pa.RecordBatch.from_arrays([pa.array(shard["asked"], pa.int64()), pa.array(made, pa.int64())], ["position", "token"])

    return shards.join(asked, ["part", "seq"]).mapInArrow(_reader(row), "position bigint, token bigint")
