"""Skip-if-done over a landing folder, with a ledger of the files that have been taken."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.numbering import number_rows
from ..session import materialize, path_exists
from ..sources.paths import list_files_below
from ..sources.readers import flagged_text_docs

LEDGER = "key string, path string, length bigint, modified timestamp, reason string, batch_id bigint"


def committed_batches(spark: SparkSession, ledger: str) -> list[int]:
    """Numbers of the batches whose output and ledger rows are whole: one number for each commit."""
    folder = f"{ledger}/commits"
    if not path_exists(spark, folder):
        return []
    return sorted({row[0] for row in spark.read.schema("batch_id bigint").json(folder).collect()})


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row for each file taken: ``key, path, length, modified, reason, batch_id``. A reason says why it gave no text."""
    batches = committed_batches(spark, ledger)
    if not batches:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{ledger}/files").where(F.col("batch_id").isin(batches))


def read_ingested(spark: SparkSession, output: str, ledger: str) -> DataFrame:
    """The rows of the committed batches; those of a batch that was cut off do not count."""
    rows = spark.read.option("basePath", output).parquet(*[f"{output}/batch_id={b}" for b in committed_batches(spark, ledger)])
    return rows.drop("batch_id")


def _commit(spark: SparkSession, ledger: str, batch_id: int, n_files: int) -> None:
    """One small file, the last of a batch: from then on the batch is there."""
    row = spark.createDataFrame([(batch_id, n_files)], "batch_id bigint, n_files bigint")
    row.coalesce(1).write.mode("append").json(f"{ledger}/commits")


def ingest_new(
    spark: SparkSession,
    landing: str,
    output: str,
    ledger: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_batch: int = 10_000,
    identity: Sequence[str] = ("key",),
    suffix: str = ".txt",
) -> int:
    """Process the files below ``landing`` that the ledger does not have, and return the number of batches.

    A file is new by its key (its path below ``landing``) alone, whatever its age; with ``identity`` of ``key``,
    ``length`` and ``modified`` a changed file is new again. ``transform`` is any batch operator chain over
    ``key, name, text``. A batch writes its rows, then its ledger rows, then its commit; one that was cut off
    before is not in the ledger, so its files are taken again under the same number, which replaces what it left.
    A file that is not UTF-8 gives no row and a reason in the ledger. Only the paths of one batch are on the driver.
    One run at a time may write to a ledger.
    """
    listing = list_files_below(spark, landing, suffix)
    new = listing.join(read_ledger(spark, ledger).select(*identity).distinct(), list(identity), "left_anti").select(listing.columns)
    slices = number_rows(new, ["key"]).withColumn("slice", F.expr(f"idx div {int(max_files_per_batch)}")).drop("idx")
    slices = materialize(slices, "new-files")
    count = slices.agg(F.max("slice")).first()[0]
    first = max(committed_batches(spark, ledger), default=-1) + 1
    batches = 0 if count is None else count + 1
    for i in range(batches):
        batch_id = first + i
        files = [tuple(r) for r in slices.where(F.col("slice") == i).select("key", "path", "length", "modified").collect()]
        seen = Observation(f"ingest-{batch_id}")
        docs = flagged_text_docs(spark, landing, suffix, [f[1] for f in files]).select("key", "name", "text", "reason")
        docs = docs.observe(seen, F.collect_set(F.when(F.col("reason").isNotNull(), F.struct("key", "reason"))).alias("bad"))
        docs = docs.where("reason is null").drop("reason")
        rows = docs if transform is None else transform(docs)
        rows.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        bad = {r["key"]: r["reason"] for r in seen.get["bad"]}
        taken = spark.createDataFrame([(*f, bad.get(f[0])) for f in files], LEDGER.rsplit(",", 1)[0])
        taken.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/files/batch_id={batch_id}")
        _commit(spark, ledger, batch_id, len(files))
    return batches
