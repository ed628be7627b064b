"""Padding, labels and scored positions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a label that the loss does not count.
IGNORED_LABEL = -100


def pad_right(values: Column, length: Column, fill: Column) -> Column:
    """`values` followed by as many `fill` as it takes to reach `length`."""
    return F.concat(values, F.array_repeat(fill, length - F.size(values)))


def causal_labels(padded_ids: Column, pad_id: int) -> Column:
    """A copy of the padded ids with the padding ignored.

    The padding id is the end-of-text id, so a true end-of-text is ignored with it. The
    prompt part stays in: instruction and response both count.
    """
    return F.transform(
        padded_ids, lambda x: F.when(x == pad_id, F.lit(IGNORED_LABEL)).otherwise(x)
    )


def shifted_pairs(input_ids: Column, labels: Column) -> Column:
    """Structs (prev, next): each id with the label one place further on.

    The first label has no predecessor and the last id no successor.
    """
    pairs = F.greatest(F.size(input_ids) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(input_ids, F.lit(1), pairs).alias("prev"), F.slice(labels, F.lit(2), pairs).alias("next")
    )


def scored_pairs(input_ids: Column, labels: Column) -> Column:
    """The pairs the loss counts: those whose label is not ignored."""
    return F.filter(
        shifted_pairs(input_ids, labels), lambda pair: pair["next"] != IGNORED_LABEL
    )
