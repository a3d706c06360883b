"""URL filters: many glob rules at once by a bit-parallel automaton.

Each rule is a pattern over the canonical form ``.host/path`` of a URL, with ``*`` for any run without a
slash and ``**`` for any run. The symbols of all patterns are packed into the bits of a row of 64-bit words;
one Shift-And step per byte of the URL moves all of them, for all URLs of a batch in the same array operation.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from .arrow import append_columns

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALLOW, BLOCK = "allow", "block"
_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path starts with ``path``; or, with ``glob``,
    for canonical URLs that match it as a whole. Named rules decide, the longest first; nameless ones judge
    what no named rule fits."""

    verdict: str
    host: str = ""
    path: str = "/"
    glob: str | None = None

    @property
    def name(self) -> str | None:
        return None if self.glob else self.host + self.path

    @property
    def pattern(self) -> str:
        return self.glob or f"*.{self.host}{self.path}**"


def host_and_path(url: str | None) -> tuple[str, str]:
    found = _URL.search(url) if url else None
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


class ShiftAnd:
    """Patterns as bit masks. A pattern has a bit for its start and one per literal byte; the bit of a
    position before a star stays set while the star may take the byte."""

    def __init__(self, patterns: list[str]) -> None:
        literal: list[int] = []  # the byte that leads into each bit, -1 for the start of a pattern
        stays: list[bytes] = []  # per bit, what may be skipped there: nothing, all but a slash, anything
        self.final: list[int] = []
        for pattern in patterns:
            literal.append(-1)
            stays.append(b"")
            for part in re.findall(rb"\*\*|\*|[^*]", pattern.encode(), re.DOTALL):
                if part in (b"*", b"**"):
                    stays[-1] = max(stays[-1], part)
                else:
                    literal.append(part[0])
                    stays.append(b"")
            self.final.append(len(literal) - 1)
        n = len(literal)
        self.n_words = max(1, -(-n // 64))
        self.enter = self._masks(lambda c: [i for i in range(n) if literal[i] == c])
        self.stay = self._masks(lambda c: [i for i in range(n) if stays[i] == b"**" or stays[i] == b"*" and c != 47])
        self.start = self._pack([i for i in range(n) if literal[i] < 0])

    def _pack(self, bits: list[int]) -> np.ndarray:
        row = np.zeros(self.n_words, np.uint64)
        for i in bits:
            row[i >> 6] |= np.uint64(1 << (i & 63))
        return row

    def _masks(self, bits_of) -> np.ndarray:
        return np.stack([self._pack(bits_of(c)) for c in range(256)])

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """Which pattern matches which whole text. Texts leave the front of the batch as they end."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        codes, ordered = np.frombuffer(b"".join(texts), np.uint8), -sizes[order]
        state = np.repeat(self.start[None, :], len(texts), 0)
        for at in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(ordered, -at))  # those longer than ``at``
            now, c = state[:n], codes[starts[:n] + at]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = moved & self.enter[c] | now & self.stay[c]
        out = np.empty((len(texts), len(self.final)), bool)
        for k, bit in enumerate(self.final):
            out[order, k] = state[:, bit >> 6] >> np.uint64(bit & 63) & np.uint64(1)
        return out


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = ALLOW, url: str = "url", drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows with ``host, path, rule, verdict``, without a shuffle.

    A URL that is null or has no ``://`` has an empty host and path, and no rule fits it. Of the named rules
    that fit, the longest decides, of equals the first; else the first nameless one that matches; else
    ``default``. Columns of the new names are replaced. Rules are part of the program, so they travel with it.
    """
    named = sorted((r for r in rules if r.name), key=lambda r: -len(r.name))
    ordered = [*named, *(r for r in rules if not r.name)]

    def make():
        automaton = ShiftAnd([r.pattern for r in ordered])

        def fn(batch):
            parts = [host_and_path(u) for u in batch.column(url).to_pylist()]
            canonical = [f".{host}{path}".encode() for host, path in parts]
            fits = automaton.matches(canonical)
            best = np.where(fits.any(1), fits.argmax(1), -1).tolist() if ordered else [-1] * len(parts)
            rule = [ordered[k].name if k >= 0 else None for k in best]
            verdict = [ordered[k].verdict if k >= 0 else default for k in best]
            return [h for h, _ in parts], [p for _, p in parts], rule, verdict

        return fn

    return append_columns(pages, "host string, path string, rule string, verdict string", make, drop)
