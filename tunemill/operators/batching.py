"""Batches, ranks and epochs.

The assignment operators work on any table with a unique BIGINT `id`. Give them the narrow
(id, n_tokens) and join the token arrays once, at the end (`attach_tokens`): the wide rows
then cross the network a single time, however many steps the assignment takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunemill.functions.integers import ceil_div, whole_div
from tunemill.functions.labels import causal_labels, pad_right
from tunemill.functions.tokens import EOS_ID
from tunemill.operators.positions import with_cut_position, with_shuffled_position

# Fixed values of the workload.
BATCH_SIZE = 4
EPOCHS = 2
MEGABATCH_LIMIT = 50


def _cut(df: DataFrame, batch_size: int) -> DataFrame:
    seq = F.col("seq")
    return df.withColumn("batch_id", whole_div(seq, batch_size)).withColumn(
        "slot", (seq % batch_size).cast("int")
    )


def sequential_batches(df: DataFrame, batch_size: int = BATCH_SIZE, rows: str | None = None) -> DataFrame:
    """Adds `seq` (from 0, in id order), `batch_id` and `slot`; the last batch may be short.

    With `rows` a column of that name tells the number of all rows.
    """
    placed = with_cut_position(df, name="_row")
    kept = placed.withColumn("seq", F.col("_row") - 1).drop("_row")
    return _cut(kept.withColumnRenamed("_rows", rows) if rows else kept.drop("_rows"), batch_size)


def length_grouped_batches(
    df: DataFrame,
    batch_size: int = BATCH_SIZE,
    seed: int | str = 0,
    length: str = "n_tokens",
    epochs: int | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Adds `seq`, `batch_id` and `slot` so that rows of like length share a batch.

    The rows are shuffled by seed, cut into megabatches of up to 50 batches, and sorted
    inside each by falling length, ties in shuffled order. Then the longest row of all and
    the first row change places, so that the largest batch comes first.

    With `epochs` every row comes once per epoch (column `epoch`), each epoch in an order of its own; one plan
    places all of them. With `rows` a column of that name tells the number of rows of an epoch.
    """
    placed = with_shuffled_position(df, seed, name="_row", epochs=epochs)
    key = [] if epochs is None else ["epoch"]
    # A row per epoch.
    longest = placed.groupBy(*key).agg(F.min(F.struct((-F.col(length)).alias("minus_length"), "_row"))["_row"].alias("row"))
    longest = longest.agg(F.transform(F.sort_array(F.collect_list(F.struct(*key, "row"))), lambda e: e["row"])).scalar()

    batches = F.greatest(F.lit(1), F.least(whole_div(F.col("_rows"), 4 * batch_size), F.lit(MEGABATCH_LIMIT)))
    mega_size = F.col("_mega_size")
    sized = placed.withColumn("_mega_size", batches * batch_size).withColumn("_mega", whole_div(F.col("_row") - 1, mega_size))
    by_length = Window.partitionBy(*key, "_mega").orderBy(F.desc(length), F.asc("_row"))
    seq = F.col("_mega") * mega_size + F.row_number().over(by_length) - 1
    # The longest row heads its megabatch.
    longest_row = F.get(F.col("_longest"), F.col("epoch") if key else F.lit(0))
    longest_seq = whole_div(longest_row - 1, mega_size) * mega_size
    swapped = (
        F.when(F.col("_row") == longest_row, F.lit(0))
        .when(F.col("_seq") == 0, longest_seq)
        .otherwise(F.col("_seq"))
    )
    told = [F.col("_rows").alias(rows)] if rows else []
    return _cut(
        sized.withColumn("_seq", seq)
        .withColumn("_longest", longest)
        .select(*df.columns, *key, swapped.cast("bigint").alias("seq"), *told),
        batch_size,
    )


def shard_replicated(df: DataFrame, world_size: int) -> DataFrame:
    """Every rank reads all batches in the same order. Multiplies the rows by `world_size`."""
    ranks = F.sequence(F.lit(0), F.lit(world_size - 1))
    return df.withColumn("rank", F.explode(ranks)).withColumn("step", F.col("batch_id"))


def shard_batches(
    df: DataFrame, world_size: int, batch_size: int = BATCH_SIZE, rows: Column | None = None
) -> DataFrame:
    """Batch b goes to rank b % W as its step b div W, the same number of steps for all.

    Where the rows do not fill the last round of batches, it goes on with rows from the
    start, over again if need be. `rows` is their number (of one epoch, with a column `epoch`), where it is known
    without another look at `df`.
    """
    if rows is None:
        epochs = F.count_distinct("epoch") if "epoch" in df.columns else F.lit(1)
        rows = df.agg((F.count(F.lit(1)) / epochs).cast("bigint")).scalar()
    round_size = batch_size * world_size
    return (
        _cut(
            df.withColumn("_rows", rows)
            .withColumn("_last", ceil_div(F.col("_rows"), round_size) * round_size - 1)
            .withColumn("seq", F.explode(F.sequence(F.col("seq"), F.col("_last"), F.col("_rows"))))
            .drop("_rows", "_last"),
            batch_size,
        )
        .withColumn("rank", (F.col("batch_id") % world_size).cast("int"))
        .withColumn("step", whole_div(F.col("batch_id"), world_size))
    )


def epoch_replay(df: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Adds `epoch`: every row once per epoch."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def with_global_step(df: DataFrame, steps: Column | None = None) -> DataFrame:
    """Adds `global_step`, which does not start over with the epoch as `step` does.

    `steps` is the number of steps in an epoch, where it is known without reading `df`.
    """
    if steps is None:
        steps = df.agg(F.max("step") + 1).scalar()
    return (
        df.withColumn("_steps", steps)
        .withColumn("global_step", F.col("epoch") * F.col("_steps") + F.col("step"))
        .drop("_steps")
    )


def micro_to_optimizer_step(step: Column, accumulation: int) -> Column:
    """The optimizer step a micro-batch adds to."""
    return whole_div(step, accumulation)


def batch_max_length(df: DataFrame, length: str = "n_tokens") -> DataFrame:
    """Adds `batch_length`, the longest row of the batch; batches of an epoch are its own."""
    key = ["epoch", "batch_id"] if "epoch" in df.columns else ["batch_id"]
    return df.withColumn("batch_length", F.max(length).over(Window.partitionBy(*key)))


def attach_tokens(assigned: DataFrame, tokens: DataFrame) -> DataFrame:
    """Joins token arrays to an assignment of ids, the arrays' only shuffle."""
    return assigned.join(tokens.select("id", "input_ids", "attention_mask"), "id")


def pad_sequences(df: DataFrame, pad_id: int = EOS_ID) -> DataFrame:
    """Pads `input_ids` and `attention_mask` on the right to `batch_length`."""
    length = F.col("batch_length")
    return df.withColumn(
        "input_ids", pad_right(F.col("input_ids"), length, F.lit(pad_id))
    ).withColumn(
        "attention_mask", pad_right(F.col("attention_mask"), length, F.lit(0).cast("tinyint"))
    )


def collate(df: DataFrame, pad_id: int = EOS_ID) -> DataFrame:
    """Padded rows with next-token `labels`."""
    padded = pad_sequences(df, pad_id)
    return padded.withColumn("labels", causal_labels(F.col("input_ids"), pad_id))


def batch_stats(df: DataFrame, length: str = "n_tokens") -> DataFrame:
    """Rows, real tokens and padding of each batch."""
    n, longest = F.count(F.lit(1)), F.max(length).cast("bigint")
    return df.groupBy("batch_id").agg(
        n.alias("rows"),
        F.sum(length).alias("real_tokens"),
        (longest * n - F.sum(length)).alias("pad_tokens"),
    )
