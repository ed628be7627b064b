"""Loss curves, logging and the step plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.functions.integers import ceil_div, whole_div
from tunemill.functions.labels import scored_pairs
from tunemill.operators.batching import BATCH_SIZE, EPOCHS
from tunemill.operators.positions import running_total_before

# Fixed values of the workload.
LOGGING_STEPS = 10
SAVE_STEPS = 50
TRAIN_LOSS = "train_loss"

STEP_BITS = 16


def token_loss_mask(batches: DataFrame) -> DataFrame:
    """Adds `scored`, the (prev, next) pairs that count in the loss."""
    return batches.withColumn("scored", scored_pairs(F.col("input_ids"), F.col("labels")))


def bigram_train_loss(
    batches: DataFrame, vocab_size: Column | int, step: str = "step", bits: int = STEP_BITS
) -> DataFrame:
    """(step, train_loss, scored_tokens) of a bigram model that learns as it goes.

    The pairs of a step are scored with the counts of all earlier steps, add-one smoothed,
    and only then counted themselves.
    """
    vocab = vocab_size if isinstance(vocab_size, Column) else F.lit(vocab_size)
    # Ignored labels go before the rows are multiplied. Padding makes no pair that counts, so
    # rows needn't be padded.
    scored = scored_pairs(F.col("input_ids"), F.col("labels"))
    pairs = (
        batches.select(F.col(step).cast("bigint").alias("step"), F.inline(scored))
        # The joins below ask for values too. Asked for here, every use of the pairs begins
        # with the same plan, and Spark counts them once.
        .where(F.col("step").isNotNull() & F.col("prev").isNotNull() & F.col("next").isNotNull())
        .groupBy("step", "prev", "next")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    prev_counts = pairs.groupBy("step", "prev").agg(F.sum("n").alias("n"))
    pair_seen = running_total_before(pairs, ["prev", "next"], "step", "n", "seen", bits)
    prev_seen = running_total_before(prev_counts, ["prev"], "step", "n", "seen", bits)
    # -ln((pair + 1) / (prev + vocab)) is a sum of one part per pair and one per first token,
    # so the two meet only in the totals of a step.
    parts = pair_seen.select(
        "step", "n", (-F.col("n") * F.ln(F.col("seen") + 1)).alias("loss")
    ).union(
        prev_seen.withColumn("_vocab", vocab).select(
            "step", F.lit(0).cast("bigint"), F.col("n") * F.ln(F.col("seen") + F.col("_vocab"))
        )
    )
    return parts.groupBy("step").agg(
        (F.sum("loss") / F.sum("n")).alias("train_loss"), F.sum("n").alias("scored_tokens")
    )


def loss_record(losses: DataFrame, run_id: Column | int, rank: Column | int = 0, epoch: Column | int = 0) -> DataFrame:
    """Rows for the metrics table from (step, train_loss): the loss and the step, under their keys.

    Steps count from 0, global steps from 1.
    """
    def column(value: Column | int, kind: str) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast(kind)

    logged = F.array(
        F.struct(F.lit(TRAIN_LOSS).alias("key"), F.col("train_loss").cast("double").alias("value")),
        F.struct(F.lit("step").alias("key"), F.col("step").cast("double").alias("value")),
    )
    return losses.select(
        column(run_id, "bigint").alias("run_id"),
        column(rank, "int").alias("rank"),
        column(epoch, "int").alias("epoch"),
        F.col("step").cast("bigint").alias("step"),
        (F.col("step") + 1).cast("bigint").alias("global_step"),
        F.inline(logged),
    )


def logged_loss(
    metrics: DataFrame, logging_steps: int = LOGGING_STEPS, value: str = "value", key: str = TRAIN_LOSS
) -> DataFrame:
    """Mean loss since the last log, one row per run and stretch of `logging_steps` steps.

    Only the rows logged under `key` count. `steps` tells how many different steps the mean
    covers. A trainer logs only the full stretches; the rest of a run that ends in between is
    the row with fewer.
    """
    metrics = metrics.where(F.col("key") == key)
    stretch = whole_div(F.col("global_step") - 1, logging_steps)
    return (
        metrics.groupBy("run_id", ((stretch + 1) * logging_steps).alias("log_step"))
        .agg(F.avg(value).alias("loss"), F.count_distinct("global_step").alias("steps"))
    )


def checkpoint_steps(
    metrics: DataFrame, output_dir: str, save_steps: int = SAVE_STEPS
) -> DataFrame:
    """The steps of each run after which a checkpoint is saved, and where."""
    return (
        metrics.where(F.col("global_step") % save_steps == 0)
        .select("run_id", "global_step")
        .distinct()
        .withColumn(
            "checkpoint",
            F.concat(F.lit(f"{output_dir}/checkpoint-"), F.col("global_step").cast("string")),
        )
    )


def step_plan(
    runs: DataFrame,
    rows: DataFrame,
    batch_size: int = BATCH_SIZE,
    accumulation: int = 1,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Steps per epoch and in total of each run with `num_processes`, for the rows given.

    The manual loop reads all batches on every rank; the trainer deals them out.
    """
    n = rows.agg(F.count(F.lit(1))).scalar()
    dealt = whole_div(ceil_div(F.col("_batches"), F.col("num_processes").cast("bigint")), accumulation)
    return (
        runs.withColumn("_rows", n)
        .withColumn("_batches", ceil_div(F.col("_rows"), batch_size))
        .withColumn("manual_steps_per_epoch", F.col("_batches"))
        .withColumn("manual_total_steps", F.col("_batches") * epochs)
        .withColumn("trainer_steps_per_epoch", F.greatest(dealt, F.lit(1)))
        .withColumn("trainer_total_steps", F.col("trainer_steps_per_epoch") * epochs)
        .drop("_rows", "_batches")
    )
