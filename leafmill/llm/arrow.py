"""Helpers for code that runs over Arrow batches inside Spark tasks: columns, words and their hashes."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

# The worker-side functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes hashed at a time: the arrays made on the way take some 40 bytes each.
PIECE = 1 << 19
#: Fixed value: the ASCII white space that separates words, x20 and x09 to x0D.
WHITE_SPACE = bytes([32, *range(9, 14)])


def fields(ddl: str) -> list[T.StructField]:
    return T._parse_datatype_string(ddl).fields


def append_columns(df: DataFrame, ddl: str, make: Callable[[], Callable], drop: Sequence[str] = (), clean: bool = False) -> DataFrame:
    """``df`` with the columns of ``ddl``, made batch by batch; columns of the same names are replaced.

    ``make`` runs once per task and gives a function from a record batch to one list or array per new
    column. ``drop`` names columns that the function reads and the result does not keep. With ``clean`` the worker
    gives back the memory that a task took when the task ends.
    """
    new = fields(ddl)
    gone = {f.name.lower() for f in new} | {c.lower() for c in drop}
    keep = [c for c in df.columns if c.lower() not in gone]
    places = [df.columns.index(c) for c in keep]
    schema = T.StructType([df.schema.fields[i] for i in places] + new)
    arrow = [_arrow(f.dataType) for f in new]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            made = [pa.array(v, type=t) for v, t in zip(fn(batch), arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in places] + made, names=names)

    return df.mapInArrow(tidy(run) if clean else run, schema)


def packed(docs: DataFrame, text: str) -> tuple[DataFrame, list[Column]]:
    """``_row`` with all columns but the text, and ``_text``, so that no new column meets one of the table's; and
    the columns that give the rows back."""
    is_text = [c.lower() == text.lower() for c in docs.columns]
    rest = [F.col(f"`{c}`") for c, own in zip(docs.columns, is_text) if not own]
    back = [(F.col("_text") if own else F.col(f"_row.`{c}`")).alias(c) for c, own in zip(docs.columns, is_text)]
    return docs.select(F.struct(*rest or [F.lit(0)]).alias("_row"), F.col(f"`{text}`").alias("_text")), back


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def broadcast_parts(spark, value: object):
    """A broadcast of an object's plain parts. The object's class is known to tasks by their code alone, which a
    broadcast does not carry: workers without this package could not read it. ``from_parts`` makes the object again."""
    return spark.sparkContext.broadcast(vars(value))


def from_parts(kind: type, held) -> object:
    value = object.__new__(kind)
    vars(value).update(held.value)
    if getattr(held, "_path", None):  # the worker would keep the parts beyond the task; the next task reads them again
        vars(held).pop("_value", None)
    return value


def tidy(run: Callable) -> Callable:
    """The same over a task's batches; when it ends, its worker, which may then idle for long, gives back its memory."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def release() -> None:
    """Give back what this Python worker holds beyond its tasks, but for a loaded tokenizer."""
    import gc

    tokens = getattr(sys.modules.get("_leafmill_tokens"), "tokens", None)
    if tokens is not None:
        tokens.forget()
    gc.collect()
    trim()


def trim() -> None:
    """Give back freed memory that the allocators keep."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of a column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(i: int) -> int:
    """The i-th of some odd multipliers without linear relations between them."""
    return int(mix(np.array([i + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]) | 1


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` consecutive words; none if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += _ODD[i] * hashes[i : i + n] if i < len(_ODD) else mix_constant(i) * hashes[i : i + n]
    return mix(total + np.uint64(size))


def mix_constant(i: int) -> np.uint64:
    return np.uint64(_odd(i))


_ODD = [mix_constant(i) for i in range(32)]


class Words:
    """The words of some texts, as arrays over all of them: ``hashes``, ``starts`` and ``ends`` in ``buffer``,
    and ``bounds``, where text i has the words from bounds[i] to bounds[i + 1]."""

    def __init__(self, buffer: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> None:
        self.buffer, self.hashes, self.starts, self.ends, self.bounds = buffer, hashes, starts, ends, bounds

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words inside one text, and the first word of each."""
        made = windows(self.hashes, size)
        text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        first = np.flatnonzero(text[: len(made)] == text[size - 1 :][: len(made)])
        return made[first], first

    def run(self, first: int, size: int) -> bytes:
        """The bytes from one word to the end of the run."""
        return self.buffer[self.starts[first] : self.ends[first + size - 1]]


class Splitter:
    """Cuts texts (UTF-8) at separator bytes and hashes the words, all in array operations.

    A word's hash is a polynomial over its bytes, taken from running sums over the whole buffer and brought
    to the word's own start by the inverse power, then mixed with its length. ``fold`` takes A-Z as a-z.
    Line feed has to be a separator; it joins the texts.
    """

    def __init__(self, separators: bytes, fold: bool = False) -> None:
        byte = np.arange(256)
        self.value = mix(byte.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
        if fold:
            self.value[65:91] = self.value[97:123]
        self.separates = np.isin(byte, np.frombuffer(separators, np.uint8))
        self.value[self.separates] = 0
        self._powers(PIECE)

    def _powers(self, n: int) -> None:
        base = _odd(77)
        self.power, self.inverse = (np.full(n + 1, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        for table in (self.power, self.inverse):
            table[0] = 1
            np.cumprod(table, out=table)

    def _piece(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(codes) >= len(self.power):
            self._powers(len(codes))
        inside = np.concatenate(([False], ~self.separates[codes], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.value[codes] * self.power[: len(codes)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * self.inverse[starts]
        return mix(hashes + (ends - starts).astype(np.uint64) * mix_constant(99)), starts, ends

    def words(self, texts: Sequence[bytes | None]) -> Words:
        buffer = b"\n".join(t or b"" for t in texts) + b"\n"
        codes, at, parts = np.frombuffer(buffer, np.uint8), 0, []
        while at < len(codes):  # pieces end at a separator, so no word is cut
            end = at + PIECE
            while end < len(codes):
                cuts = np.flatnonzero(self.separates[codes[end - PIECE if end > at + PIECE else at : end]])
                if len(cuts):
                    end = (end - PIECE if end > at + PIECE else at) + int(cuts[-1]) + 1
                    break
                end += PIECE
            hashes, starts, ends = self._piece(codes[at:end])
            parts.append((hashes, starts + at, ends + at))
            at = end
        hashes, starts, ends = (np.concatenate(x) for x in zip(*parts))
        sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
        bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
        return Words(buffer, hashes, starts, ends, bounds)


def groups(texts: Sequence[bytes | None], limit: int = 4 * PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes in total."""
    first = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t or b"") > limit:
            yield first, i
            first, held = i, 0
        held += len(t or b"")
    if first < len(texts):
        yield first, len(texts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
