"""Column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# The text columns a model does not take, and the columns it does.
TEXT_COLUMNS = ["text", "category", "instruction", "context", "response"]
MODEL_COLUMNS = ["id", "input_ids", "attention_mask"]


def drop_columns(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Drops columns, all of which have to be there."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns to drop are not in the table: {absent}")
    return df.drop(*columns)


def keep_model_columns(df: DataFrame, columns: Sequence[str] = MODEL_COLUMNS) -> DataFrame:
    """Keeps only what the model takes."""
    return df.select(*columns)
