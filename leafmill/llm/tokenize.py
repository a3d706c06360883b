"""Token ids of whole texts by a public tokenizer file, with the pieces already met looked up."""

from __future__ import annotations

import gc
import os
import re
import sys
import types
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pieces that a task remembers, at some 300 bytes each; beyond it starts anew.
CACHED = 300_000
#: Pieces that are learnt in one call.
LEARNT = 1 << 14

# Texts of these characters only are lower-cased letter by letter and need no composing; they are cut by
# the tokenizer file's own split pattern, stated here for them. Special tokens are excluded.
_PLAIN = re.compile(r"(?!.*<\|)[ \n!-~À-ÖØ-öø-ÿ]*", re.DOTALL)
# Fixed value: the split pattern of the tokenizer file; letters are tried first, as most pieces are words. The line
# feed is no piece; it closes each word here.
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^ \na-zß-öø-ÿ0-9]+|\n")


def _runs(flat: np.ndarray, bounds: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``codes`` names, one after the other, and where each ends; run i lies from bounds[i] to
    bounds[i + 1]."""
    starts = bounds[codes]
    sizes = bounds[codes + 1] - starts
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return flat[at], ends


class PieceTokens:
    """Token ids of texts, the same as encoding each whole text with the tokenizer.

    For ``word_bpe_49k.json`` a token never reaches across the pieces that its pattern cuts, so the pieces of
    a text are encoded by the tokenizer's model once and remembered, up to a bound. Texts with characters that
    this reading does not cover, or with a special token, are encoded as a whole; so is every text with
    ``pieces=False``, which suits any tokenizer file. ``numbers`` has the pieces met, from 1 on; piece i has the ids of
    ``flat`` from ``bounds[i]`` to ``bounds[i + 1]``, and 0 is the line feed, without ids.
    """

    def __init__(self, definition: str, pieces: bool = True) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.pieces = pieces
        self.bytes = {}
        if pieces:
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
            self.bytes = {ord(c): "".join(p for p, _ in cut(c)) for c in letters}
            self.lines = Tokenizer(self.model)  # the same model, on pieces as they are, one a line
            self.lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            mark, ids = getattr(self.model, "end_of_word_suffix", None), self.lines.get_vocab()
            self.closes = np.zeros(max(ids.values(), default=0) + 1, bool)  # ids that a piece ends with, and only those
            self.closes[[i for t, i in ids.items() if mark and t.endswith(mark)]] = True
        self.forget()

    def forget(self) -> None:
        """Drops the pieces met so far; the tokenizer stays."""
        self.numbers = defaultdict(count(1).__next__, {"\n": 0})  # a piece gets its number when first met
        self.flat, self.bounds = np.empty(0, np.uint32), np.zeros(2, np.int64)

    @property
    def codes(self) -> dict[str, int]:
        """The pieces met so far and their numbers."""
        return {p: i for p, i in self.numbers.items() if i}

    def encode(self, texts: list[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other (32 bit), and how many each has; ``end`` closes each."""
        collecting = gc.isenabled()
        gc.disable()  # a hundred thousand small objects are made that hold no cycles; looking for some took a third of the time
        try:
            return self._encode(texts, np.array([] if end is None else [end], np.uint32))
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str | None], closing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if len(self.numbers) > CACHED:
            self.forget()
        lowered, others, extra = [], [], []
        for i, text in enumerate(texts):
            plain = not text or self.pieces and _PLAIN.fullmatch(text)
            lowered.append((text or "").lower() if plain else "")
            if not plain:
                others.append(i)
                extra.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
        flat, bounds, words, of_text = self._words(lowered)

        # A text of its own and the closing id count as further words, put behind those of their text.
        n, known = len(texts), len(bounds) - 1
        extra.append(closing)
        flat = np.concatenate((flat, *extra))
        bounds = np.concatenate((bounds, bounds[-1] + np.cumsum([len(e) for e in extra])))
        owner = np.concatenate((np.array(others, np.int64), np.arange(n)))
        order = np.argsort(owner, kind="stable")
        code = np.concatenate((known + np.arange(len(others)), np.full(n, known + len(others))))
        words = np.insert(words, of_text[1:][owner[order]], code[order])
        ids, ends = _runs(flat, bounds, words)
        last = of_text[1:] + np.cumsum(np.bincount(owner, minlength=n)) - 1
        return ids, np.diff(ends[last], prepend=0)

    def _words(self, lowered: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of the distinct words of plain texts with the bounds of each word, and the texts' words as numbers of
        these with the bounds of each text. Words lie between blanks, which no piece holds; only distinct ones are cut."""
        lists = pc.ascii_split_whitespace(pa.array(lowered, pa.large_string()))
        words = lists.flatten().dictionary_encode()
        distinct = pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary)
        pieces = _PIECE.findall(pc.binary_join(distinct, pa.scalar("\n", pa.large_string()))[0].as_py() + "\n")
        known = len(self.numbers)
        codes = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))
        self._learn(list(islice(self.numbers, known, None)))
        flat, ends = _runs(self.flat, self.bounds, codes)
        return flat, np.append(0, ends[codes == 0]), words.indices.to_numpy().astype(np.int64), lists.offsets.to_numpy()

    def _learn(self, new: list[str]) -> None:
        """Takes the ids of new pieces into the arrays."""
        for first in range(0, len(new), LEARNT):
            some = [p if p.isascii() else p.translate(self.bytes) for p in new[first : first + LEARNT]]
            ids = np.array(self.lines.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some):  # a file whose ids do not tell where a piece ends
                each = [[t.id for t in self.model.tokenize(p)] for p in some]
                ids, ends = np.array([i for made in each for i in made], np.uint32), np.cumsum([len(made) for made in each])
            self.flat, self.bounds = np.concatenate((self.flat, ids)), np.concatenate((self.bounds, len(self.flat) + ends))


def worker_tokens(definition: str, pieces: bool) -> PieceTokens:
    """The tokens of this Python worker. The tokenizer is loaded once a worker, as the library keeps some 6 MB of every
    one that was used; what a task has learnt goes with the task (``arrow.tidy``), as idle workers may be many."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    held = sys.modules.setdefault("_leafmill_tokens", types.ModuleType("_leafmill_tokens"))
    key = f"{hash(definition)}-{pieces}"
    if getattr(held, "key", None) != key:
        held.tokens, held.key = PieceTokens(definition, pieces), key
    return held.tokens
