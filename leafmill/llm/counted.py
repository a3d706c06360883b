"""Facts about keys brought back to the rows of these keys, whatever share of the rows a key has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: A key with more than one part in ``SHARE`` of the rows is common; there are fewer than ``SHARE`` such keys.
SHARE = 1000


def with_facts(rows: DataFrame, facts: DataFrame, keys: Sequence[str], count: str, columns: Sequence[str]) -> DataFrame:
    """``rows`` with the ``columns`` of ``facts``, which has one row for each key and its number of rows ``count``.

    Common keys, fewer than ``SHARE`` in any table, are broadcast; the rows of all others are joined by a shuffle,
    so no task gets more than its share. Null keys match null keys. Both inputs have to be stored tables:
    they are read twice. Every row needs its key in ``facts``.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    named = facts.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *columns, F.col(count).alias("_rows_of_key"))
    common = named.where(F.col("_rows_of_key") * SHARE > total).drop("_rows_of_key")
    rare = named.where(F.col("_rows_of_key") * SHARE <= total).drop("_rows_of_key")

    def same(side: DataFrame) -> Column:
        matches = F.lit(True)
        for i, k in enumerate(keys):
            matches &= rows[k].eqNullSafe(side[f"_key_{i}"])
        return matches

    of_common = rows.join(F.broadcast(common), same(common))
    of_rare = rows.join(F.broadcast(common), same(common), "left_anti").join(rare, same(rare))
    wanted = [*rows.columns, *columns]
    return of_common.select(*wanted).unionAll(of_rare.select(*wanted))
