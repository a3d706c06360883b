"""Benchmark decontamination: a broadcast hash set of item n-grams, scanned over the windows of documents.

Words are runs of letters and digits after lower-casing A-Z; every byte from 0x80 up belongs to a word.
A window is ``n`` consecutive words of an item; an item of fewer words, but not none, is one window.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .arrow import Splitter, Words, append_columns, broadcast_parts, free_name, from_parts, groups, packed, release, utf8, windows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
#: Words of items that one broadcast holds, at some 40 bytes each; more items are scanned for in further blocks.
BLOCK_WORDS = 2_000_000

#: Fixed value: the ASCII bytes that are neither letters nor digits.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b in SEPARATORS else b for b in range(256))


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(_LOWER).split() if text else []


class WindowSet:
    """The windows of a block of items by length: sorted hashes, the items that hold each, and a filter."""

    def __init__(self, items: list[tuple[str, list[bytes]]], n: int) -> None:
        self.names = [name for name, _ in items]
        self.words = [words for _, words in items]
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        split = Splitter(SEPARATORS, fold=True).words([b" ".join(words) for words in self.words])
        for i, words in enumerate(self.words):
            size = min(n, len(words))
            w = windows(split.hashes[split.bounds[i] : split.bounds[i + 1]], size)
            found.setdefault(size, []).append((w, np.full(len(w), i), np.arange(len(w))))
        self.sizes = {}
        for size, parts in found.items():
            h, item, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            h, item, at = h[order], item[order], at[order]
            bits = max(16, len(h).bit_length() + 4)
            seen = np.zeros(1 << bits, bool)
            seen[h >> np.uint64(64 - bits)] = True
            self.sizes[size] = (h, item, at, seen, np.uint64(64 - bits))

    def scan(self, words: Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words lie inside an occurrence of a window; by text, the items with occurring windows."""
        hit, names = np.zeros(len(words.hashes), bool), {}
        for size, (known, item, at, seen, shift) in self.sizes.items():
            own, first = words.windows(size)
            likely = np.flatnonzero(seen[own >> shift])
            low, high = np.searchsorted(known, own[likely]), np.searchsorted(known, own[likely], "right")
            for i, a, b in zip(first[likely].tolist(), low.tolist(), high.tolist()):
                if a == b:
                    continue
                here = normal_words(words.run(i, size))
                for k in range(a, b):  # the words themselves decide
                    if self.words[item[k]][at[k] : at[k] + size] == here:
                        hit[i : i + size] = True
                        text = int(np.searchsorted(words.bounds, i, "right")) - 1
                        names.setdefault(text, set()).add(self.names[item[k]])
        return hit, names


def item_blocks(items: DataFrame, n: int, block_words: int, item_id: str, text: str) -> Iterator[WindowSet]:
    """The items in blocks that each fit a broadcast; rows come to the driver one partition at a time."""
    block, held = [], 0
    for name, value in items.select(F.col(item_id).cast("string"), text).toLocalIterator():
        words = normal_words(value.encode() if value else None)
        if name is None or not words:
            continue
        block.append((name, words))
        held += len(words)
        if held >= block_words:
            yield WindowSet(block, n)
            block, held = [], 0
    if block:
        yield WindowSet(block, n)


def mark_contamination(
    docs: DataFrame, items: DataFrame, n: int = WINDOW, block_words: int = BLOCK_WORDS,
    text: str = "text", item_id: str = "item_id", item_text: str = "text", share: int = 20, drop: tuple[str, ...] = (),
) -> DataFrame:
    """Documents with ``n_words``, ``n_hit``, ``item_ids`` (sorted as texts), ``hit_runs`` and ``contaminated``.

    ``hit_runs`` lists [first, end) word positions. A document is contaminated if at least one in ``share``
    of its words is hit. Items come as broadcasts of at most ``block_words`` words and one long item; further
    blocks are further passes in the same tasks, so no shuffle and no limit on the items. Rows come out as
    they came in, repeated ones too: a null or empty text has no words and is clean, a null item id or item
    text gives no window, repeated items count once. Columns of the new names are replaced.
    """
    held_words, held_bits, held_items = (free_name(docs, c) for c in ("_hit_words", "_hit_bits", "_hit_items"))
    state = f"{held_words} bigint, {held_bits} binary, {held_items} array<string>"
    df = docs.withColumns({held_bits: F.lit(None).cast("binary"), held_items: F.lit(None).cast("array<string>")})

    def judged(totals, bits, names):
        out = totals, [], [], [], []
        for total, packed_bits, own in zip(totals, bits, names):
            runs, hits = [], 0
            if packed_bits:
                hit = np.unpackbits(np.frombuffer(packed_bits, np.uint8), count=total)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0])).astype(np.int8)))
                runs, hits = edges.reshape(-1, 2).tolist(), int(hit.sum())
            for column, x in zip(out[1:], (hits, own or [], runs, hits > 0 and share * hits >= total)):
                column.append(x)
        return out

    def scanning(held, last):
        def make():
            release()
            known, splitter = from_parts(WindowSet, held), Splitter(SEPARATORS, fold=True)

            def fn(batch):
                texts = utf8(batch.column(text))
                totals = [0] * len(texts)
                bits, names = batch.column(held_bits).to_pylist(), batch.column(held_items).to_pylist()
                for first, end in groups(texts):
                    words = splitter.words(texts[first:end])
                    totals[first:end] = np.diff(words.bounds).tolist()
                    hit, found = known.scan(words)
                    for i, own in found.items():
                        packed = np.packbits(hit[words.bounds[i] : words.bounds[i + 1]])
                        i += first
                        bits[i] = (packed | np.frombuffer(bits[i], np.uint8) if bits[i] else packed).tobytes()
                        names[i] = sorted({*(names[i] or ()), *own})
                return judged(totals, bits, names) if last else (totals, bits, names)

            return fn

        return make

    made = "n_words bigint, n_hit bigint, item_ids array<string>, hit_runs array<array<int>>, contaminated boolean"
    blocks = item_blocks(items, n, block_words, item_id, item_text)
    block = next(blocks, WindowSet([], n))
    while block is not None:
        following = next(blocks, None)
        scan = scanning(broadcast_parts(docs.sparkSession, block), following is None)
        gone = (held_words, held_bits, held_items, *drop) if following is None else ()
        df = append_columns(df, made if following is None else state, scan, gone, clean=True)
        block = following
    return df


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    rows, back = packed(docs, options.pop("text", "text"))
    return mark_contamination(rows, items, text="_text", **options).where(~F.col("contaminated")).select(*back)


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with the hit words taken out of the text, and what lies between two of them in a run."""
    marked = mark_contamination(docs, items, text=text, **options)

    def make():
        import re

        word = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

        def fn(batch):
            kept = []
            for value, runs in zip(utf8(batch.column(text)), batch.column("hit_runs").to_pylist()):
                if runs:
                    places = [m.span() for m in word.finditer(value)]
                    for first, end in reversed(runs):
                        value = value[: places[first][0]] + value[places[end - 1][1] :]
                kept.append(None if value is None else value.decode())
            return (kept,)

        return fn

    return append_columns(marked, f"`{text}` string", make)


def items_sha256(item_ids):
    """The digest of the sorted item ids, comma-joined."""
    return F.sha2(F.array_join(item_ids, ","), 256)


def brute_force(docs: list[tuple], items: list[tuple], n: int = WINDOW) -> list[tuple]:
    """What ``mark_contamination`` has to find, by plain comparison of word tuples: for tests."""
    own = {}
    for item_id, value in items:
        words = normal_words(value.encode() if value else None)
        if words and item_id is not None:
            size = min(n, len(words))
            own.setdefault(str(item_id), set()).update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for doc_id, value in docs:
        words, hit, names = normal_words(value.encode() if value else None), set(), set()
        for name, grams in own.items():
            for size in {len(g) for g in grams}:
                for i in range(len(words) - size + 1):
                    if tuple(words[i : i + size]) in grams:
                        hit.update(range(i, i + size))
                        names.add(name)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out
