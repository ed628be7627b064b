"""Instructions to training batches, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.operators.batching import (
    BATCH_SIZE,
    EPOCHS,
    attach_tokens,
    batch_max_length,
    collate,
    length_grouped_batches,
    sequential_batches,
    shard_batches,
)
from tunemill.operators.prompts import prompt_template
from tunemill.operators.tokenization import Vocabulary, build_vocab, tokenize
from tunemill.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back.

    Batching reads the lengths of all rows several times and the token arrays once. From a
    written table those reads are cheap, and no lost executor brings back the tokenization.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def prompt_tokens(
    instructions: DataFrame, vocabulary: Vocabulary | int, max_length: int | None = 512
) -> DataFrame:
    """Token rows of the prompts, by a vocabulary or by the prompts' own of a given size."""
    prompts = prompt_template(instructions)
    if isinstance(vocabulary, int):
        vocabulary = build_vocab(prompts, vocabulary)
    return tokenize(prompts, vocabulary, max_length=max_length)


def manual_batches(tokens: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Batches in id order, padded and labelled: what each rank of the manual loop reads."""
    assigned = sequential_batches(tokens.select("id", "n_tokens"), batch_size)
    return collate(attach_tokens(batch_max_length(assigned), tokens))


def trainer_batches(
    tokens: DataFrame, world_size: int, batch_size: int = BATCH_SIZE, seed: int | str = 0, epochs: int | None = None
) -> DataFrame:
    """Length-grouped batches dealt out to ranks, padded and labelled: what a trainer reads.

    With `epochs` those of several epochs, each in an order of its own (column `epoch`). The epochs are part of one
    plan: its shuffles are as many as for one epoch, and token arrays are joined to (epoch, id) once, at the end.
    """
    grouped = length_grouped_batches(tokens.select("id", "n_tokens"), batch_size, seed, epochs=epochs, rows="_rows")
    dealt = shard_batches(grouped, world_size, batch_size, F.col("_rows"))
    return collate(attach_tokens(batch_max_length(dealt), tokens))


def trainer_epochs(
    tokens: DataFrame,
    world_size: int,
    epochs: int = EPOCHS,
    batch_size: int = BATCH_SIZE,
    seed: int | str = 0,
) -> DataFrame:
    """`trainer_batches` of several epochs."""
    return trainer_batches(tokens, world_size, batch_size, seed, epochs)
