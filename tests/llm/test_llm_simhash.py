"""Bit-sliced SimHash against a plain comparison of every pair."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from leafmill.llm import simhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, size=3):
    words = SPACED.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    runs = [words[i : i + size] for i in range(len(words) - size + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(run).encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=2):
    prints = {i: f for i, f in rows}
    least = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if a < b and (prints[a] ^ prints[b]).bit_count() <= radius and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    return least


def text_of(rng, n):
    return " ".join(rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(n))


def texts():
    rng = random.Random(1)
    out = [None, "", " \t\n", "One", "one", "one  two", "one two", " a b", "é ü 日本語 " * 9, "x " * 5000]
    for _ in range(12):
        base = text_of(rng, rng.choice([3, 4, 20, 150, 600]))
        words = base.split()
        words[rng.randrange(len(words))] = "changed"
        out += [base, base.upper(), base.replace(" ", "\n\t"), " ".join(words), base + " end"]
    return out


def test_fingerprints_and_components(spark):
    values = texts()
    rows = list(enumerate(values)) + [(20, values[20])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", *[F.lit("mine").alias(c) for c in ("node", "label", "n", "component_id", "fingerprint")]).repartition(3)
    made = simhash.near_duplicates(docs).collect()
    prints = {i: plain_fingerprint(t) for i, t in rows}
    least = plain_components(prints.items())
    assert sorted(map(tuple, made)) == sorted((i, f"{prints[i]:016x}", least[i]) for i, _ in rows)
    kept = simhash.drop_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in least if least[i] == i}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_null_ids_and_only_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (None, "e f g h i")], "doc_id bigint, text string")
    made = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert made == {(None, 7), (7, 7), (None, None)}


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(2)
    text = text_of(rng, 20_000)
    whole = simhash.fingerprint(text.encode())
    assert whole == plain_fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 100)
    assert simhash.fingerprint(text.encode()) == whole
    assert simhash.fingerprint(b"y" * 1_000_000) == plain_fingerprint("y" * 1_000_000)


@pytest.mark.parametrize("seed", range(4))
def test_near_pairs_are_all_pairs_within_the_radius(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    n = [3, 70, 300, 700][seed]
    nodes = base[rng.integers(0, 6, n)].copy()
    for _ in range(3):
        nodes ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    bounds = np.unique(np.concatenate(([n], rng.integers(1, n, 5))))
    ends = bounds[np.searchsorted(bounds, np.arange(n), side="right")]
    found = {(int(a), int(b)) for x, y in simhash.near_pairs(nodes, ends) for a, b in zip(x, y)}
    expected = {(a, b) for a in range(n) for b in range(a + 1, int(ends[a])) if (int(nodes[a]) ^ int(nodes[b])).bit_count() <= 2}
    assert found == expected


def test_large_groups_meet_again(spark, monkeypatch):
    """With a low limit every step is taken; no link is lost."""
    monkeypatch.setattr(simhash, "LIMIT", 8)
    rng = random.Random(3)
    prints = set()
    for base in [rng.getrandbits(64) for _ in range(5)]:
        for _ in range(60):
            near = base
            for _ in range(rng.randrange(5)):
                near ^= 1 << rng.randrange(64)
            prints.add(near)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "node bigint"))
    least = plain_components([(s, p) for s, p in zip(signed, prints)])
    joined, before = {s: s for s in signed}, None
    pairs = [tuple(r) for r in links.collect()]
    while before != joined:
        before = dict(joined)
        for a, b in pairs:
            joined[a] = joined[b] = min(joined[a], joined[b])
    groups = lambda labels: sorted(sorted(s for s in signed if labels[s] == l) for l in set(labels.values()))
    assert groups(joined) == groups(least)
