"""Row shapes that keep costly expressions from being evaluated more than once.

Catalyst moves filters below projections by repeating the projected expressions, and adds a
``size(...) > 0`` filter below an ``explode``; for a regular expression or a JSON parse that doubles the
work or worse. Both helpers put a ``Generate`` in between, whose output a filter cannot pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def explode_once(df: DataFrame, array: Column, output: str, pos: str = "pos", keep: Sequence[str] | None = None) -> DataFrame:
    """One row per element with its position from 0; a row with an empty or null array gives none."""
    keep = df.columns if keep is None else list(keep)
    rows = df.select(*keep, F.posexplode_outer(array).alias("_pos", output)).where("_pos is not null")
    return rows.select(*keep, F.col("_pos").cast("bigint").alias(pos), output)


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose results later filters and projections use without repeating them."""
    keep = [c for c in df.columns if c not in columns]
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.explode(F.array(packed)).alias("_once")).select(
        *keep, *[F.col("_once")[name].alias(name) for name in columns]
    )
