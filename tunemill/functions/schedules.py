"""Learning rates and step counts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the workload.
LEARNING_RATE = 2e-4
WARMUP_STEPS = 100


def warmup_lr(
    step: Column,
    max_lr: float = LEARNING_RATE,
    warmup_steps: int = WARMUP_STEPS,
    min_lr: float = 0.0,
) -> Column:
    """Linear rise from `min_lr` to `max_lr` over `warmup_steps`, then level. Steps from 0."""
    share = F.least(step / F.lit(float(warmup_steps)), F.lit(1.0))
    return F.lit(min_lr) + F.lit(max_lr - min_lr) * share


def constant_lr(learning_rate: float = LEARNING_RATE) -> Column:
    """The same rate at every step; a warm-up setting has no effect."""
    return F.lit(learning_rate)

