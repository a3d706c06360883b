"""Language identification by cross-parsing entropy.

Per language a suffix automaton of a bounded sample of labelled text tells how far a text can be read on
inside the sample. A text is parsed into phrases, each the longest match from where the last one ended; the
language that needs the fewest phrases, normalised by the length of its sample, wins.
"""

from __future__ import annotations

import re
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .arrow import append_columns, broadcast_parts, from_parts, groups, release

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The bounded sample of labelled rows: documents per language, characters taken of each, characters in all.
SAMPLE_DOCS, DOC_CHARS, SAMPLE_CHARS = 96, 512, 24_000
#: Symbols parsed in one go. Texts are cut into stretches of so many, all of which are parsed.
STRETCH = 512
#: Bytes of text that are parsed together; the arrays made on the way take some ten times as much.
GROUP_BYTES = 1 << 21
UNKNOWN = "und"

# A-Z as a-z, and a blank for every other ASCII byte that is no letter.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")


def symbols(text: str) -> bytes:
    """Lower-case letters of a text in UTF-8; anything else in ASCII becomes one blank."""
    return b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads exactly the substrings of ``data``; 0 is its start."""
    moves: list[dict[int, int]] = [{}]
    links, lengths, last = [-1], [0], 0
    for c in data:
        state = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = state
            p = links[p]
        if p != -1:
            q = moves[p][c]
            if lengths[q] == lengths[p] + 1:
                links[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = links[p]
                links[q] = links[state] = clone
        last = state
    return moves


class CrossParser:
    """Automata of all languages as tables, stepped over many stretches of text at once."""

    def __init__(self, samples: dict[str, bytes]) -> None:
        self.languages = sorted(samples)
        known = sorted(set(b"".join(samples.values())))
        self.width = len(known) + 2  # then the symbol outside all samples and the filling after a text's end
        self.symbol = np.full(256, len(known), np.int32)
        self.symbol[known] = np.arange(len(known))
        self.symbol[0] = len(known) + 1
        self.tables = [self._table(suffix_automaton(samples[x])) for x in self.languages]
        self.weights = np.array([np.log2(max(2, len(samples[x]))) for x in self.languages])

    def _table(self, moves: list[dict[int, int]]) -> np.ndarray:
        """The next state's row; where a match ends, the complement of the row that a new phrase starts in."""
        table = np.full((len(moves), self.width), -1, np.int32)
        for c, to in moves[0].items():
            table[:, self.symbol[c]] = ~(to * self.width)
        for state, own in enumerate(moves):
            for c, to in own.items():
                table[state, self.symbol[c]] = to * self.width
        table[:, -1] = np.arange(len(moves)) * self.width
        return table.ravel()

    def costs(self, texts: list[str]) -> np.ndarray:
        """Bits a symbol that each language needs for each text."""
        data = [symbols(t) for t in texts]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        stretches = -(-sizes // STRETCH)
        filled = b"".join(d.ljust(n * STRETCH, b"\0") for d, n in zip(data, stretches.tolist()))
        columns = np.ascontiguousarray(self.symbol[np.frombuffer(filled, np.uint8)].reshape(-1, STRETCH).T)
        text = np.repeat(np.arange(len(data)), stretches)
        out = np.empty((len(self.languages), len(data)))
        for k, table in enumerate(self.tables):
            at = np.zeros(columns.shape[1], np.int32)
            phrases = np.ones(columns.shape[1], np.int32)
            for column in columns:
                at = table[at + column]
                ended = at >> 31
                phrases -= ended
                at ^= ended
            out[k] = np.bincount(text, phrases, len(data)) * self.weights[k] / sizes
        return out


def labelled_samples(docs: DataFrame, docs_per_language: int = SAMPLE_DOCS, doc_chars: int = DOC_CHARS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """A sample of the rows (``text, lang``) per language: the first by hash of the text, cut in length.

    Ranking keeps the best rows per task before it shuffles, so a language may hold most rows.
    """
    rows = docs.where("lang is not null and text is not null").select("lang", F.substring("text", 1, doc_chars).alias("text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    best = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= docs_per_language)
    samples: dict[str, bytes] = {}
    for lang, text, _ in sorted(best.collect(), key=lambda r: (r["lang"], r["rank"])):
        held = samples.get(lang, b"")
        if has_letter(text) and len(held) < chars:
            samples[lang] = (held + symbols(text))[:chars]
    return samples


def identify(docs: DataFrame, samples: dict[str, bytes], text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, from whole texts alone.

    ``score`` is the share of its cost by which the runner-up is worse than the winner, 0 to 1; with one
    language only it is 1. A null text, or one without a letter, is ``und`` with score 0, and so is every
    text without samples. Ties go to the language that sorts first. Existing columns of these names are replaced.
    The samples are small by their documented bounds and are broadcast as automata.
    """
    held = broadcast_parts(docs.sparkSession, CrossParser(samples)) if samples else None

    def make():
        release()
        parser = None if held is None else from_parts(CrossParser, held)

        def fn(batch):
            texts = batch.column(text).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            spoken = [i for i, t in enumerate(texts) if parser is not None and has_letter(t)]
            sized = [texts[i].encode() for i in spoken]
            for first, end in groups(sized, GROUP_BYTES):
                own = spoken[first:end]
                costs = parser.costs([texts[i] for i in own])
                best = costs.argmin(0)
                ordered = np.sort(costs, 0)
                score = 1 - ordered[0] / ordered[1] if len(ordered) > 1 else np.ones(len(own))
                for i, k, s in zip(own, best.tolist(), score.tolist()):
                    langs[i], scores[i] = parser.languages[k], min(1.0, max(0.0, s))
            return langs, scores

        return fn

    return append_columns(docs, "lang_pred string, score double", make, drop, clean=True)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
