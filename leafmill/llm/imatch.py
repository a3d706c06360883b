"""Document fingerprints by I-Match with randomised lexicons.

The lexicon has the terms whose inverse document frequency lies in a band: neither too common to tell
documents apart nor so rare that they are slips. Each of several random subsets of it gives one hash of the
distinct lexicon terms of a document. Subsets of falling rates serve short and long documents: a part of a
document that is changed leaves those hashes as they were whose subsets it has no term of.

Terms are runs of letters and digits, A-Z as a-z, by their 64-bit hashes. Hashes of distinct terms are mixed
and added, which is a hash of the sorted list of terms whatever the order they were met in.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .arrow import Splitter, groups, mix, signed, utf8
from .decontaminate import SEPARATORS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A lexicon term occurs in at least and at most these shares of the documents. The first bounds the lexicon,
#: whatever the number of documents: to the mean number of distinct terms of a document times 1000.
LEAST, MOST = 0.001, 0.1
#: The share of the lexicon in each subset.
RATES = (1 / 8,) * 4 + (1 / 32,) * 8 + (1 / 128,) * 12 + (1 / 512,) * 8


def _distinct(words, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (document, term) pairs of some words, in order."""
    order = np.lexsort((words, doc))
    d, w = doc[order], words[order]
    new = np.concatenate(([True], (d[1:] != d[:-1]) | (w[1:] != w[:-1]))) if len(d) else np.empty(0, bool)
    return d[new], w[new]


def _counting(text: str):
    def run(batches):
        splitter, held, size = Splitter(SEPARATORS, fold=True), [], 0

        def counted():
            terms, counts = (np.concatenate(x) for x in zip(*held))
            terms, place = np.unique(terms, return_inverse=True)
            return terms, np.bincount(place, counts, len(terms)).astype(np.int64)

        def rows(terms, counts):
            return pa.RecordBatch.from_arrays([pa.array(signed(terms)), pa.array(counts)], ["term", "n"])

        for batch in batches:
            texts = utf8(batch.column(text))
            for first, end in groups(texts):
                words = splitter.words(texts[first:end])
                doc = np.repeat(np.arange(end - first), np.diff(words.bounds))
                terms, counts = np.unique(_distinct(words.hashes, doc)[1], return_counts=True)
                held.append((terms, counts))
                size += len(terms)
                if size > 1_000_000:
                    held[:] = [counted()]
                    size = len(held[0][0])
                    if size > 500_000:
                        yield rows(*held.pop())
                        size = 0
        if held:
            yield rows(*counted())

    return run


def build_lexicon(docs: DataFrame, text: str = "text", least: float = LEAST, most: float = MOST) -> np.ndarray:
    """The hashes of all terms in the band, from all documents, sorted."""
    counts = docs.select(F.col(text).alias("text")).mapInArrow(_counting("text"), "term bigint, n bigint")
    n = docs.count()
    band = counts.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n").between(least * n, most * n))
    terms = np.array([r[0] for r in band.select("term").toLocalIterator()], np.int64)
    return np.sort(terms.view(np.uint64))


class Fingerprints:
    def __init__(self, lexicon: np.ndarray, rates: tuple[float, ...] = RATES) -> None:
        self.lexicon = lexicon
        self.member = np.empty((len(rates), len(lexicon)), bool)
        for j, rate in enumerate(rates):
            self.member[j] = mix(lexicon ^ mix(np.array([j + 1], np.uint64))) < np.uint64(int(rate * 2**64))
        self.splitter = Splitter(SEPARATORS, fold=True)

    def of(self, texts: list[bytes]) -> np.ndarray:
        """A row of 32-bit hashes per text, one per subset, 0 where it has no term of the subset. A text
        without any has a hash of the whole text in all places."""
        words = self.splitter.words(texts)
        doc = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
        out = np.zeros((len(texts), len(self.member)), np.uint32)
        if len(self.lexicon) and len(words.hashes):
            at = np.minimum(np.searchsorted(self.lexicon, words.hashes), len(self.lexicon) - 1)
            known = self.lexicon[at] == words.hashes
            doc, at = _distinct(at[known], doc[known])
            for j, member in enumerate(self.member):
                chosen = member[at]
                d, values = doc[chosen], mix(self.lexicon[at[chosen]] + np.uint64(j))
                if len(d):
                    starts = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
                    sums = mix(np.add.reduceat(values, starts)) >> np.uint64(32)
                    out[d[starts], j] = np.maximum(sums, 1).astype(np.uint32)
        for i in np.flatnonzero(~out.any(1)).tolist():
            out[i] = max(1, xxhash.xxh32_intdigest(texts[i]))
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of the subsets with a term in either text whose hashes agree."""
    return ((a == b) & (a != 0)).sum(1) / np.maximum(1, ((a != 0) | (b != 0)).sum(1))


def _hex(prints: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in prints]


def edited(text: str, following: str) -> str:
    """The text with its second half (rounded down) replaced by as many characters of the next, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _comparing(held):
    def run(batches):
        prints = Fingerprints(held.value)
        last = None

        def rows(pairs):
            """Pairs of a row and the text after it; the first text's print serves as the one before's next."""
            for first, end in groups([t.encode() for _, t, _ in pairs]):
                own = pairs[first:end]
                texts = [t for _, t, _ in own]
                changed = [edited(t, f) for _, t, f in own]
                raw = [c.encode() for c in changed]
                made = prints.of([t.encode() for t in texts] + raw + [own[-1][2].encode()])
                n = len(own)
                this, other, after = made[:n], made[n : 2 * n], np.concatenate((made[1:n], made[2 * n :]))
                columns = [
                    pa.array([i for i, _, _ in own], pa.int64()), pa.array(list(map(len, texts)), pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in raw]), pa.array(_hex(this)), pa.array(_hex(other)),
                    pa.array(likeness(this, other)), pa.array(likeness(this, after)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        closed = False
        for batch in batches:
            pairs = []
            for doc_id, text, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "tail"))):
                if closed:
                    break
                if last is not None:
                    pairs.append((*last, text or ""))
                last, closed = (doc_id, text or ""), tail
            yield from rows(pairs)

    return run


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """``part, tail, doc_id, text``: the rows in ranges of ids, each range closed by the row that follows it.

    Ranges come from approximate quantiles of the ids, the row that opens one is sent to the range before
    too, and the very first row closes the last range. Only ids are read to find out which those are.
    """
    ids = docs.select(F.col("doc_id"))
    at = [i / parts for i in range(1, parts)]
    bounds = ids.agg(F.percentile_approx("doc_id", at, 10_000)).first()[0] if at else []
    bounds = sorted(set(bounds or []))
    bucket = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("doc_id"))) if bounds else F.lit(0)
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(bucket)
    lead = ids.groupBy(bucket.alias("bucket")).agg(F.min("doc_id").alias("id"), F.max(F.col("doc_id").isNull()).alias("any_null"))
    lead = {b: None if null else i for b, i, null in lead.collect()}
    full = sorted(lead)
    before = {b: full[k - 1] for k, b in enumerate(full)}
    pick = lambda values, kind: F.element_at(F.array(*[F.lit(values.get(b)).cast(kind) for b in range(len(bounds) + 1)]), F.col("part") + 1)
    own = F.struct(F.col("part"), F.lit(False).alias("tail"))
    again = F.struct(pick(before, "int").alias("part"), F.lit(True).alias("tail"))
    sent = F.when(F.col("doc_id").eqNullSafe(pick(lead, "bigint")), F.array(own, again)).otherwise(F.array(own))
    rows = docs.withColumn("part", bucket.cast("int")).select(F.explode(sent).alias("to"), "doc_id", "text")
    return rows.select("to.part", "to.tail", "doc_id", "text").repartitionById(parts, "part").sortWithinPartitions("tail", "doc_id", "text")


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of each whole text and of its edited form, and how alike they and the next text's are.

    The next document is the one after it by (id, text), after the last the first; a null text counts as
    empty, null ids come first, repeated rows follow each other. An only row is its own next. Fingerprints are
    hex, 8 digits per subset. Other columns are not carried along. Texts are shuffled once.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(build_lexicon(rows))
    made = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return with_next(rows, parts).select("doc_id", "text", "tail").mapInArrow(_comparing(held), made)
