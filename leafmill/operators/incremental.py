"""Skip what is already done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import materialize


def pending_only(
    work: DataFrame,
    done: DataFrame,
    key: Sequence[str] = ("name", "task"),
    force: bool = False,
    keys_first: bool = False,
) -> DataFrame:
    """Rows of ``work`` whose key is not in ``done``; all of them with ``force``.

    No broadcast hint: the finished keys grow with the corpus, so Catalyst and AQE choose by size. The
    keys are made distinct first, which shares the join's shuffle and keeps repeated keys from piling up.

    ``keys_first`` compares the keys alone and stores the pending ones; their size is then known when the
    rows are picked. In a run that finds little to do they are few, Catalyst broadcasts them, and the
    texts of the finished rows are not shuffled. Keys must be unique in ``work`` and not null.
    """
    if force:
        return work
    finished = done.select(*key).distinct()
    if not keys_first:
        return work.join(finished, list(key), "left_anti")
    pending = materialize(work.select(*key).join(finished, list(key), "left_anti"), "pending")
    return work.join(pending, list(key), "left_semi")
