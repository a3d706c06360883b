"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent and normalised. The exponent is bisected until the
weights have a target entropy or no source is repeated more than a limit. The weights are then realised as a
budget of tokens per source: the source's documents lie in blocks by hash, every epoch takes the blocks in a
new order, and the last epoch stops at the block that would exceed the budget.

Only built-in functions: counts combine before their shuffle, windows see the blocks of one source and epoch,
of which there are at most ``BLOCKS``, and documents meet the schedule by (source, block).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

BLOCKS = 1024
#: Exponents tried in one pass over the sources; each round narrows the range by one more than that.
TRIED, ROUNDS = 31, 6
#: Rows of the schedule that a broadcast may hold, at some 100 bytes; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000


def word_count(text: str | Column) -> Column:
    """Runs of anything but white space."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def _measures(sources: DataFrame, exponents: list[float], budget_share: float) -> list[tuple[float, float, float]]:
    """Normaliser, entropy and largest repetition of the mixture of each exponent, in one aggregate."""
    p, out = F.col("share"), []
    for a in exponents:
        out += [F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.ln(p)), F.max(F.pow(p, F.lit(a - 1)))]
    row = sources.agg(*out).first()
    made = []
    for i, a in enumerate(exponents):
        z, weighted, most = row[3 * i : 3 * i + 3]
        made.append((z, math.log(z) - a * weighted / z, budget_share * most / z))
    return made


def find_exponent(sources: DataFrame, n_sources: int, budget_share: float, target_entropy: float | None, max_repeats: float | None) -> float:
    """The exponent in [0, 1], to 6 places. ``sources`` has ``share``, all above 0.

    Entropy falls and repetition falls as the exponent grows. For ``target_entropy``, a share of the largest
    possible one, it is the largest exponent that still has it; for ``max_repeats``, the smallest that keeps to
    it; with both the limit goes first. What no exponent reaches gives the nearest end, 0 or 1.
    """
    wanted = (target_entropy or 0) * math.log(n_sources)

    def bisect(enough) -> float:
        """The smallest exponent for which ``enough`` holds, which then holds for all larger ones."""
        low, high = 0.0, 1.0
        if enough(_measures(sources, [0.0], budget_share)[0]):
            return 0.0
        for _ in range(ROUNDS):
            tried = [low + (high - low) * (i + 1) / (TRIED + 1) for i in range(TRIED)]
            holds = [enough(m) for m in _measures(sources, tried, budget_share)]
            k = holds.index(True) if True in holds else TRIED
            low, high = (tried[k - 1] if k else low), (tried[k] if k < TRIED else high)
        return high

    exponent = 0.0
    if target_entropy is not None:
        exponent = bisect(lambda m: m[1] <= wanted)
    if max_repeats is not None:
        exponent = max(exponent, bisect(lambda m: m[2] <= max_repeats))
    return min(1.0, -(-round(exponent * 1e6, 3) // 1) / 1e6)


def schedule(docs: DataFrame, budget: int | None, target_entropy: float | None, max_repeats: float | None, seed: int) -> DataFrame | None:
    """``source, block, weight, epoch, at`` for each block that is taken; None if there are no tokens.

    ``docs`` has ``source, block, n_tokens``. ``at`` is the place in [0, 1) in the source's share of the mixture.
    """
    blocks = materialize(docs.groupBy("source", "block").agg(F.sum("n_tokens").alias("n")).where("n > 0"), "mix-blocks")
    total = blocks.agg(F.sum("n")).first()[0]
    if not total:
        return None
    budget = total if budget is None else budget
    sources = blocks.groupBy("source").agg(F.sum("n").alias("tokens")).withColumn("share", F.col("tokens") / F.lit(total))
    sources = materialize(sources, "mix-sources")
    exponent = find_exponent(sources, sources.count(), budget / total, target_entropy, max_repeats)
    z = _measures(sources, [exponent], budget / total)[0][0]
    weight = F.pow("share", F.lit(exponent)) / F.lit(z)
    # Rounded, so that exponent 1 with the table's own tokens as budget takes every source exactly once.
    quotas = sources.withColumn("weight", weight).withColumn("quota", F.round(F.col("weight") * budget).cast("bigint"))
    quotas = quotas.withColumn("weight", F.round("weight", 12))
    # One row per source, epoch and block: the last epoch is the one that the quota does not fill.
    epochs = quotas.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("quota div tokens"))))
    same = epochs["source"].eqNullSafe(blocks["source"])
    taken = epochs.join(blocks, same).select(epochs["source"], "tokens", "weight", "quota", "epoch", "block", "n")
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64("block", "epoch", F.lit(seed)), "block")
    taken = taken.withColumn("end", F.col("epoch") * F.col("tokens") + F.sum("n").over(order))
    taken = taken.where("end <= quota")
    return taken.select("source", "block", "weight", "epoch", ((F.col("end") - F.col("n")) / F.col("quota")).alias("at"))


#: How often a source may be repeated where the caller sets no limit: a source of a few words is not taken a million times.
MOST_REPEATS = 16.0


def mix_sources(
    docs: DataFrame, budget: int | None = None, target_entropy: float | None = None, max_repeats: float | None = MOST_REPEATS,
    source: str = "source", key: str = "doc_id", tokens: str | Column | None = None, seed: int = 0, details: bool = True,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, with ``weight, block, epoch, mix_at``.

    ``budget`` is in tokens, by default those of the table; ``tokens`` counts those of a row, by default the
    words of ``text``. Ordering by ``mix_at`` interleaves the sources so that any stretch has the target
    weights. A source's share of the budget is kept to within a block, of which it has ``BLOCKS`` by hash of
    ``key``, and not exceeded; with exponent 1 and no other budget every row comes once. Sources repeat at most
    ``max_repeats`` times, which comes before the entropy; a budget so large that no exponent keeps to it is kept. A null source is a source; one without tokens is never taken; rows without tokens come
    with their block; repeated rows are rows of their own. With ``details=False`` only the columns of ``docs``
    come out, else existing columns of the new names are replaced. No tokens or an empty table give no row.
    """
    new = ["weight", "block", "epoch", "mix_at"]
    count = word_count("text") if tokens is None else F.col(tokens) if isinstance(tokens, str) else tokens
    block = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(BLOCKS)).cast("int")
    keep = [c for c in docs.columns if not details or c.lower() not in new]
    plan = schedule(docs.select(F.col(source).alias("source"), block.alias("block"), count.alias("n_tokens")), budget, target_entropy, max_repeats, seed)
    if plan is None:
        plan = docs.sparkSession.createDataFrame([], "source string, block int, weight double, epoch bigint, at double")
    plan = materialize(plan.groupBy("source", "block").agg(F.first("weight").alias("w"), F.collect_list(F.struct("epoch", "at")).alias("turns")), "mix-schedule")
    plan = plan.select(F.col("source").alias("_mix_source"), F.col("block").alias("_mix_block"), "w", "turns")
    rows = docs.select(F.struct(*keep).alias("_row"), F.col(source).alias("_source"), block.alias("_block"))
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan
    joined = rows.join(plan, F.col("_source").eqNullSafe(F.col("_mix_source")) & (F.col("_block") == F.col("_mix_block")))
    made = joined.select("_row", F.col("w").alias("weight"), F.col("_block").alias("block"), F.explode("turns").alias("_turn"))
    if not details:
        return made.select("_row.*")
    return made.select("_row.*", "weight", "block", F.col("_turn.epoch").alias("epoch"), F.col("_turn.at").alias("mix_at"))
