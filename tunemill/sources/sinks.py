"""Written tables: batches, metrics and parameters."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.functions.integers import whole_div
from tunemill.sources.tables import file_system_path

METRIC_COLUMNS = ["run_id", "rank", "epoch", "step", "global_step", "key", "value"]
# Buckets of runs: what is written again concerns the buckets of its runs only.
RUN_BUCKETS, RUN_BUCKET = 64, "run_bucket"
METRIC_KEY = ["run_id", "rank", "epoch", "global_step", "key"]
PARAM_COLUMNS = ["run_id", "source", "key", "value"]
PARAM_KEY = ["run_id", "source", "key"]


def write_batches(
    batches: DataFrame, path: str, steps_per_file: int = 4096, mode: str = "errorifexists"
) -> None:
    """Writes batches so that each rank finds its own files, in step order inside a file.

    With a column `epoch` a file holds steps of one epoch.
    """
    span = whole_div(F.col("step"), steps_per_file)
    epoch = ["epoch"] if "epoch" in batches.columns else []
    (
        batches.withColumn("_span", span)
        .repartition("rank", *epoch, "_span")
        .sortWithinPartitions("rank", *epoch, "step", "slot")
        .drop("_span")
        .write.mode(mode)
        .partitionBy("rank")
        .parquet(path)
    )


def read_batches(spark: SparkSession, path: str, rank: int | None = None) -> DataFrame:
    """All written batches, or one rank's; only that rank's files are then read."""
    batches = spark.read.parquet(path)
    return batches if rank is None else batches.where(F.col("rank") == rank)


def write_clustered(batches: DataFrame, table: str, path: str, buckets: int, batch: str = "batch_id") -> None:
    """Writes a table that is kept by batch: every batch whole in one of `buckets` files, in slot order.

    `table` names it in the session's catalog, `path` says where it lies. Choose `buckets` for files of some hundred megabytes.
    """
    (
        batches.repartition(buckets, batch)
        .sortWithinPartitions(batch, "slot")
        .write.mode("errorifexists")
        .bucketBy(buckets, batch)
        .sortBy(batch, "slot")
        .option("path", path)
        .saveAsTable(table)
    )


def read_clustered(spark: SparkSession, table: str) -> DataFrame:
    """A table of `write_clustered`. What works batch by batch, like `collate_batches`, needs no shuffle on it."""
    return spark.table(table)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Appends what the table at `path` doesn't hold yet, so writing rows again adds nothing.

    A row is named by run, rank, step and key; of rows with one name, one is kept. Files are kept by bucket of the run, and only
    the buckets of the runs in `metrics` are read.
    """
    _append(metrics.select(*METRIC_COLUMNS), path, METRIC_KEY)


def read_metrics(spark: SparkSession, path: str, runs: list[int] | None = None) -> DataFrame:
    """The metrics written at `path`, of all runs or of those listed; only their buckets are then read."""
    held = spark.read.parquet(path)
    if runs is not None:
        buckets = [_bucket(F.lit(run)) for run in runs]
        held = held.where(F.col(RUN_BUCKET).isin(buckets) & F.col("run_id").isin(runs))
    return held.select(*METRIC_COLUMNS)


def append_params(params: DataFrame, path: str) -> None:
    """Like `append_metrics`; a parameter is named by run, source and key."""
    _append(params.select(*PARAM_COLUMNS), path, PARAM_KEY)


def upsert_metrics(metrics: DataFrame, path: str) -> None:
    """Like `append_metrics`, but rows that are held already under the same name are replaced.

    Rewrites the buckets of the runs in `metrics`, each as a whole and all in one commit; the others aren't touched.
    """
    rows = _with_bucket(metrics.select(*METRIC_COLUMNS)).dropDuplicates(METRIC_KEY)
    files, target = file_system_path(rows.sparkSession, path)
    if not files.exists(target):
        rows.repartition(RUN_BUCKET).write.partitionBy(RUN_BUCKET).parquet(path)
        return
    others = _lacking(held_rows(rows, path), rows, METRIC_KEY)
    # A bucket goes to one task, which writes one file for it.
    whole = others.unionByName(rows).repartition(RUN_BUCKET)
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_BUCKET).parquet(path)


def _with_bucket(rows: DataFrame) -> DataFrame:
    return rows.withColumn(RUN_BUCKET, _bucket(F.col("run_id")))


def _bucket(run_id: Column) -> Column:
    # By text, so that an id is in one bucket whatever type of whole number it has.
    return F.pmod(F.xxhash64(run_id.cast("string")), F.lit(RUN_BUCKETS)).cast("int")


def held_rows(rows: DataFrame, path: str) -> DataFrame:
    """What the table at `path` holds in the buckets of `rows`; no other files are read."""
    # At most RUN_BUCKETS numbers.
    touched = [r[RUN_BUCKET] for r in rows.select(RUN_BUCKET).distinct().collect()]
    held = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return held.where(F.col(RUN_BUCKET).isin(touched))


def _lacking(rows: DataFrame, others: DataFrame, key: list[str]) -> DataFrame:
    same = reduce(and_, [rows[c].eqNullSafe(others[c]) for c in [RUN_BUCKET, *key]])
    return rows.join(others, same, "left_anti")


def missing_rows(rows: DataFrame, path: str, key: list[str]) -> DataFrame:
    """The rows, each name once, that the table at `path` lacks, with their bucket."""
    rows = _with_bucket(rows).dropDuplicates(key)
    return _lacking(rows, held_rows(rows, path), key)


def _append(rows: DataFrame, path: str, key: list[str]) -> None:
    files, target = file_system_path(rows.sparkSession, path)
    new = missing_rows(rows, path, key) if files.exists(target) else _with_bucket(rows).dropDuplicates(key)
    new.repartition(RUN_BUCKET).write.mode("append").partitionBy(RUN_BUCKET).parquet(path)


def explode_params(runs: DataFrame, config: Column, source: str) -> DataFrame:
    """One row per run and top-level key of a MAP<STRING, VARIANT>, values as text."""
    return (
        runs.select("run_id", F.lit(source).alias("source"), F.explode(config).alias("key", "value"))
        .withColumn("value", F.col("value").cast("string"))
    )
