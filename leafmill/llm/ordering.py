"""Dense numbers and running sums of narrow rows without a single-task sort; repeated rows get numbers of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    index: str = "idx",
) -> DataFrame:
    """Add a dense index from 0 in the order of ``order_by``, counted within ``partition_by`` if given.

    Rows of equal keys come in any order. Rows are range-partitioned by (partition_by, order_by), so a hot group is
    spread over as many tasks as its rows fill; each task numbers its own rows, and the number of rows
    in the partitions before it is added.

    The placed rows are written to the shared folder: the counts and the index must see the same
    partitions, and whatever follows does not repeat the sort.
    """
    keys = [*partition_by, *order_by]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(
        placed.withColumns({
            "_part": F.spark_partition_id(),
            "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }),
        "numbered",
    )
    # One row per range partition: bounded by spark.sql.shuffle.partitions, so one task can sum it
    # and it can be broadcast whatever the size of the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
            "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
        )
    )
    if not partition_by:
        numbered = placed.join(starts, "_part").withColumn(index, F.col("_row") + F.col("_start"))
        return numbered.drop("_part", "_row", "_start")

    # First row of each group inside each range partition: at most groups + partitions rows, and never
    # more than one per partition for the same group, so a window by group is small for a hot one too.
    same_group = Window.partitionBy(*partition_by)
    shifts = (
        placed.groupBy("_part", *partition_by).agg(F.min("_row").alias("_first"))
        .join(starts, "_part")
        .withColumn("_shift", F.col("_start") - F.min(F.col("_start") + F.col("_first")).over(same_group))
        .select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(partition_by)], "_shift")
    )
    # By (partition, group): no key has more rows than one range partition. Null groups are kept.
    matches = F.col("_part") == F.col("_p")
    for i, column in enumerate(partition_by):
        matches &= placed[column].eqNullSafe(F.col(f"_g{i}"))
    return placed.join(shifts, matches).select(
        *[placed[c] for c in placed.columns if c not in ("_part", "_row")],
        (F.col("_row") + F.col("_shift")).alias(index),
    )


def running_sum(df: DataFrame, order_by: Sequence[str], value: str, output: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before, in the order of ``order_by``, without a single-task sort.

    The keys must be unique and the rows narrow: they are range-partitioned, written to the shared folder,
    summed within each range, and the sums of the ranges before are added, one row per range.
    """
    placed = df.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id())
    placed = materialize(placed, "placed")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(
        placed.groupBy("_part").agg(F.sum(value).alias("_n")).select(
            "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
        )
    )
    own = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0))).join(starts, "_part")
    return summed.withColumn(output, F.col("_own") + F.col("_start")).drop("_part", "_own", "_start")
