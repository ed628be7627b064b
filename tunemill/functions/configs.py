"""Expressions over engine configurations held as MAP<STRING, VARIANT>, and over run columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONFIG_TYPE = "map<string,variant>"

# The names of the two optimizers.
CPU_ADAM, FUSED_ADAM = "DeepSpeedCPUAdam", "FusedAdam"


def parse_config(text: Column) -> Column:
    """JSON text to a map of its top-level keys; nested sections stay one value.

    Text that is cut off or no JSON object is an error.
    """
    return F.from_json(text, CONFIG_TYPE, {"mode": "FAILFAST"})


def prefix_keys(config: Column, prefix: str = "ds_") -> Column:
    """Top-level keys with a prefix; values, nested ones too, stay as they are."""
    return F.transform_keys(config, lambda key, _: F.concat(F.lit(prefix), key))


def replace_section(config: Column, name: str, section: Column) -> Column:
    """`config` with the section `name` replaced as a whole, not merged."""
    others = F.map_filter(config, lambda key, _: key != name)
    return F.map_concat(others, F.create_map(F.lit(name), section))


def config_leaf(config: Column, section: str, path: str, as_type: str = "string") -> Column:
    """The value at `path` inside a top-level section; NULL where any part is missing."""
    return F.try_variant_get(F.element_at(config, section), path, as_type)


def offload_device(config: Column) -> Column:
    """Where the optimizer state is kept, NULL without offload."""
    return config_leaf(config, "zero_optimization", "$.offload_optimizer.device")


def optimizer_choice(device: Column) -> Column:
    """The CPU variant of Adam for state kept on the CPU, else the fused one."""
    return F.when(device == "cpu", CPU_ADAM).otherwise(FUSED_ADAM)


def run_name(name: Column, rank: Column) -> Column:
    """Rank 0 keeps the name, the other ranks add theirs."""
    return F.when(rank == 0, name).otherwise(F.concat(name, F.lit("_rank_"), rank.cast("string")))


def num_processes(gpus: Column, nodes: Column) -> Column:
    return gpus * nodes


def is_local(nodes: Column) -> Column:
    return nodes == 1


def global_batch_size(
    per_device: Column | int, accumulation: Column | int, processes: Column
) -> Column:
    return processes * per_device * accumulation


def multinode_parent(nodes: Column, parent: Column) -> Column:
    """Runs on a single node have no parent run."""
    return F.when(nodes > 1, parent)
