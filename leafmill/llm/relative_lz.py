"""Substring de-duplication by relative Lempel-Ziv parsing against the blocks of all earlier documents.

Each block of documents is indexed by the hashes of its windows of ``size`` words, each with the place where it
stands first: the smallest document id, and the position there. A document is parsed greedily from its first word.
A factor starts at a word whose window stands in an earlier document, and copies words from there as long as the
next window stands at the next position of that document. Where no window goes on, the factor ends; the ``size`` - 1
windows that cross its end are checked too, and one that stands anywhere earlier starts the next factor, which goes
on where the last one ended. Words in no factor are literals. A factor together with those checks is at least
``size`` words long, so the factors' words are the duplicate spans, and factors and literals give the text back.

The index is spread over tasks by window hash. A block is reduced before it is sent: of the documents that
share a window in it, only the first asks the index about it, as the others are repeats whatever the rest
holds; so a window that a third of all documents share sends a row per block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .arrow import PIECE, WHITE_SPACE, Splitter, groups, mix, signed, utf8

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
BLOCK_BYTES = 12 * PIECE
_LAST = np.iinfo(np.int64).max


def _planes(x: np.ndarray) -> bytes:
    """Little-endian bytes by significance: high bytes that are all zero compress to nothing."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(data: memoryview, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _pack(*arrays: np.ndarray) -> bytes:
    parts = [_planes(a) for a in arrays]
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)


def _unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    view, at = memoryview(data), 8 * len(kinds)
    out = []
    for kind, size in zip(kinds, np.frombuffer(view[:at], np.int64).tolist()):
        out.append(_unplanes(view[at : at + size], kind))
        at += size
    return out


def _row_keys(ids: np.ndarray, texts: list[bytes | None]) -> np.ndarray:
    """A key for each different (document id, text): repeated rows share theirs, and their result."""
    own = np.fromiter((xxhash.xxh64_intdigest(t or b"") for t in texts), np.uint64, len(texts))
    return mix(own + mix(ids.view(np.uint64)))


def _ids(column: pa.Array) -> np.ndarray:
    """Document ids; a null one comes after all others."""
    return column.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def _repeats(hashes: np.ndarray, docs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by hash and place; in that order, whether an entry's document is not the first of its hash, and
    the entry that is."""
    order = np.lexsort((at, docs, hashes))
    sorted_hashes, sorted_docs = hashes[order], docs[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_hashes[1:] != sorted_hashes[:-1])))
    sizes = np.diff(np.append(starts, len(order)))
    first = np.repeat(order[starts], sizes)
    return order, sorted_docs > docs[first], first


def _by_part(keys: np.ndarray, at: np.ndarray, docs: np.ndarray, places: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """Found repeats and where they stand first, packed by the part that the documents' rows go to.

    They go by document and position. Along a copied passage the differences hardly change and compress well.
    """
    part = (keys % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((at, keys, part))
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.unique(part).tolist():
        own = order[ends[p] : ends[p + 1]]
        shift = places[own].astype(np.int64) - at[own]
        steps = (np.diff(x, prepend=x.dtype.type(0)) for x in (keys[own], at[own].astype(np.int64), docs[own], shift))
        yield p, _pack(*steps)


def _found(blob: bytes) -> list[np.ndarray]:
    """Keys, positions, and the documents and positions where the windows stand first."""
    keys, at, docs, shift = (np.cumsum(x, dtype=x.dtype) for x in _unpack(blob, np.uint64, np.int64, np.int64, np.int64))
    return [keys, at, docs, at + shift]


def _indexer(doc_id: str, text: str, size: int, parts: int):
    def run(batches):
        splitter = Splitter(WHITE_SPACE)
        for batch in batches:
            all_ids, all_texts = _ids(batch.column(doc_id)), utf8(batch.column(text))
            for first, end in groups(all_texts, BLOCK_BYTES):
                ids, texts = all_ids[first:end], all_texts[first:end]
                words = splitter.words(texts)
                hashes, starts = words.windows(size)
                if not len(hashes):
                    continue
                keys = _row_keys(ids, texts)
                owner = np.searchsorted(words.bounds, starts, "right") - 1
                at = (starts - words.bounds[owner]).astype(np.uint32)
                order, again, first_in = _repeats(hashes, ids[owner], at)
                own, source = order[again], first_in[again]
                found = _by_part(keys[owner[own]], at[own], ids[owner[source]], at[source], parts)
                rows = [(p, False, blob) for p, blob in found]
                asks = order[~again]
                hashes, owner, at = hashes[asks], owner[asks].astype(np.uint32), at[asks]
                ends = np.searchsorted(hashes, _limits(parts))
                for p in range(parts):
                    a, b = int(ends[p]), int(ends[p + 1]) if p + 1 < parts else len(hashes)
                    if a < b:
                        docs, local = np.unique(owner[a:b], return_inverse=True)
                        gaps = np.diff(hashes[a:b], prepend=np.uint64(0))
                        rows.append((p, True, _pack(gaps, local.astype(np.uint32), at[a:b], ids[docs], keys[docs])))
                yield _batch(rows)

    return run


def _limits(parts: int) -> np.ndarray:
    """The first hash of each part of the index."""
    return np.array([(p << 64) // parts for p in range(parts)], np.uint64)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    part, ask, blob = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(ask, pa.bool_()), pa.array(blob, pa.binary())], ["part", "ask", "blob"]
    )


def _answerer(parts: int):
    """Answers the questions of a part of the index, of which a task has one, and passes on the rest."""

    def run(batches):
        held = []
        for batch in batches:
            passed = []
            for ask, part, blob in zip(*(batch.column(c).to_pylist() for c in ("ask", "to", "blob"))):
                if ask:
                    held.append(blob)
                else:
                    passed.append((part, False, blob))
            yield _batch(passed)
        if held:
            columns = []
            for blob in held:
                gaps, local, at, ids, keys = _unpack(blob, np.uint64, np.uint32, np.uint32, np.int64, np.uint64)
                columns.append((np.cumsum(gaps), ids[local], keys[local], at))
            held.clear()
            hashes, ids, keys, at = (np.concatenate(x) for x in zip(*columns))
            columns.clear()
            order, again, first = _repeats(hashes, ids, at)
            own, source = order[again], first[again]
            yield _batch([(p, False, blob) for p, blob in _by_part(keys[own], at[own], ids[source], at[source], parts)])

    return run


def _packer(doc_id: str, text: str, parts: int):
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = utf8(batch.column(text))
            keys = _row_keys(_ids(batch.column(doc_id)), texts)
            part = (keys % np.uint64(parts)).astype(np.int32)
            blobs = [squeeze.compress(t or b"") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), batch.column(doc_id).cast(pa.int64()), pa.array(signed(keys)), pa.array(blobs, pa.binary())],
                ["part", "doc_id", "key", "blob"],
            )

    return run


def factors_of(at: np.ndarray, docs: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """The greedy parse of a text: rows of first word, end, source document and first word there, without the literals.

    ``at`` are the sorted positions of the windows that stand earlier, at ``places`` in ``docs``. Windows that go on
    at one source are one copy; a copy that starts within the last factor, at a window across its end, gives the
    words after that end, if there are any.
    """
    if not len(at):
        return np.empty((0, 4), np.int64)
    goes_on = (np.diff(at) == 1) & (np.diff(docs) == 0) & (np.diff(places) == 1)
    firsts = np.flatnonzero(np.concatenate(([True], ~goes_on)))
    lasts = np.append(firsts[1:], len(at)) - 1
    ends = at[lasts] + size
    starts = np.maximum(at[firsts], np.concatenate(([0], ends[:-1])))  # ends only grow
    made = np.stack((starts, ends, docs[firsts], places[firsts] + starts - at[firsts]), 1)
    return made[starts < ends]


def spans_of(factors: np.ndarray) -> list[list[int]]:
    """[first, end) of the runs of words that lie in factors."""
    if not len(factors):
        return []
    breaks = np.flatnonzero(factors[1:, 0] > factors[:-1, 1]) + 1
    first, last = np.concatenate(([0], breaks)), np.append(breaks, len(factors)) - 1
    return np.stack((factors[first, 0], factors[last, 1]), 1).tolist()


def _parser(size: int):
    def run(batches):
        found, ready = [], None
        squeeze = zstandard.ZstdDecompressor()
        for batch in batches:
            out = [], [], [], [], [], []
            for doc_id, key, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "blob"))):
                if key is None:
                    found.append(blob)
                    continue
                if ready is None:
                    columns = [np.concatenate(x) for x in zip(*map(_found, found))] if found else _found(_pack(*[np.empty(0, np.int64)] * 4))
                    found = None
                    order = np.lexsort((columns[1], columns[0]))
                    ready = [c[order] for c in columns]
                    columns = order = None
                own = np.uint64(key & 0xFFFFFFFFFFFFFFFF)
                a, b = np.searchsorted(ready[0], own), np.searchsorted(ready[0], own, "right")
                at, docs, places = (x[a:b] for x in ready[1:])
                once = np.flatnonzero(np.diff(at, prepend=-1))  # repeated rows send the same answers
                factors = factors_of(at[once], docs[once], places[once], size)
                spans = spans_of(factors)
                words = squeeze.decompress(blob).split() if blob else []
                kept, done = [], 0
                for first, end in spans:
                    kept += words[done:first]
                    done = end
                kept += words[done:]
                row = doc_id, len(words), len(words) - len(kept), spans, factors.tolist(), b" ".join(kept).decode()
                for column, x in zip(out, row):
                    column.append(x)
            pairs = pa.list_(pa.list_(pa.int64()))
            kinds = pa.int64(), pa.int64(), pa.int64(), pairs, pairs, pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], _RESULT)

    return run


_RESULT = ["doc_id", "n_words", "n_removed", "spans", "factors", "text"]


def drop_repeats(docs: DataFrame, size: int = WINDOW, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, factors, text`` of each row: the words left after the duplicate spans are cut.

    A window of ``size`` words is repeated if it also starts in a document with a smaller id, whatever is cut
    there. Words are runs of anything but ASCII white space; the kept ones are joined by one space. A null or
    empty text has no words. Rows of one id are never earlier than each other, so exact repeats of a row stay;
    a null id comes after all others. Other columns are not carried along. A very long text is one document like
    any other; its windows are spread over the index, its parse takes some 40 bytes a repeated window in one task.

    ``factors`` lists [first word, end, source doc_id, first word there]: the words are those of the source, a
    document with a smaller id. Where rows of one id have different texts, the source is one of them. Windows are
    compared by 64-bit hashes, and a factor of n words rests on n - ``size`` + 1 of them.

    ``parts`` bounds what a task holds: give about a part for each 16 MB of text (default: the number of
    shuffle partitions). Texts are shuffled once, compressed; the index sends about 9 bytes per window.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sent = rows.mapInArrow(_indexer("doc_id", "text", size, parts), "part int, ask boolean, blob binary")
    # Answers found inside a block have their final part; they ride along spread over the index tasks.
    sent = sent.withColumn("to", F.col("part"))
    answers = sent.repartitionById(parts, "part").mapInArrow(_answerer(parts), "part int, ask boolean, blob binary")
    texts = rows.mapInArrow(_packer("doc_id", "text", parts), "part int, doc_id bigint, key bigint, blob binary")
    both = answers.select("part", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("key"), "blob")
    placed = both.unionAll(texts).repartitionById(parts, "part").sortWithinPartitions(F.col("key").isNotNull())
    return placed.mapInArrow(_parser(size), "doc_id bigint, n_words bigint, n_removed bigint, spans array<array<bigint>>, factors array<array<bigint>>, text string")
