"""Runs, their configurations and their metrics."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.functions import configs as cf
from tunemill.functions.configs import config_leaf
from tunemill.sources.configs import TRAINER_VALUES, ZERO_STAGES, config_literal, config_variants
from tunemill.sources.sinks import explode_params
from tunemill.sources.tables import written

# Trainer keys and the engine keys that have to agree with them.
KEY_PAIRS = [
    ("per_device_train_batch_size", "train_micro_batch_size_per_gpu"),
    ("gradient_accumulation_steps", "gradient_accumulation_steps"),
    ("max_grad_norm", "gradient_clipping"),
    ("bf16", "bf16.enabled"),
    ("optim", "optimizer.type"),
    ("learning_rate", "optimizer.params.lr"),
    ("learning_rate", "scheduler.params.warmup_max_lr"),
    ("warmup_steps", "scheduler.params.warmup_num_steps"),
    ("lr_scheduler_type", "scheduler.type"),
    ("betas", "optimizer.params.betas"),
]
TRAINER, ENGINE = "hf", "ds_"
AUTO = "auto"


def rank0_metrics(metrics: DataFrame) -> DataFrame:
    """Only rank 0 logs its loss."""
    return metrics.where(F.col("rank") == 0)


def run_tree(runs: DataFrame) -> DataFrame:
    """Each run with its parent's name and rank, NULL for a run without parent.

    Where `nodes` is known, a run on a single node has no parent. A parent of very many runs is left
    to Spark, which splits such keys at run time.
    """
    if "nodes" in runs.columns:
        runs = runs.withColumn("parent_run_id", cf.multinode_parent(F.col("nodes"), F.col("parent_run_id")))
    parents = runs.select(
        F.col("run_id").alias("parent_run_id"),
        F.col("run_name").alias("parent_name"),
        F.col("rank").alias("parent_rank"),
    )
    return runs.join(parents, "parent_run_id", "left")


def expand_runs(launches: DataFrame) -> DataFrame:
    """One run per process of each launch: launch_id, rank, run_name, parent_run_id.

    `launches` has launch_id, gpus, nodes, run_name and parent_run_id.
    """
    ranks = F.sequence(F.lit(0), cf.num_processes(F.col("gpus"), F.col("nodes")) - 1)
    return launches.withColumn("rank", F.explode(ranks)).select(
        "launch_id",
        "rank",
        cf.run_name(F.col("run_name"), F.col("rank")).alias("run_name"),
        cf.multinode_parent(F.col("nodes"), F.col("parent_run_id")).alias("parent_run_id"),
    )


def resolve_batch_size(runs: DataFrame) -> DataFrame:
    """`runs` with the product of its factors as train_batch_size in `config`, also as `global_batch_size`.

    Rows per device and accumulation are read from the configuration, the number of processes from
    `gpus` and `nodes`. A factor that is missing or no whole number gives NULL and leaves `config`.
    """
    per_device, accumulation = (
        config_leaf(F.col("config"), key, "$", "bigint")
        for key in ("train_micro_batch_size_per_gpu", "gradient_accumulation_steps")
    )
    size = cf.global_batch_size(per_device, accumulation, cf.num_processes(F.col("gpus"), F.col("nodes")))
    resolved = cf.replace_section(F.col("config"), "train_batch_size", F.parse_json(F.col("global_batch_size").cast("string")))
    return runs.withColumn("global_batch_size", size).withColumn(
        "config", F.when(F.col("global_batch_size").isNotNull(), resolved).otherwise(F.col("config"))
    )


def logged_params(runs: DataFrame, output_dir: str, trainer: dict = TRAINER_VALUES) -> DataFrame:
    """(run_id, source, key, value): all arguments of the trainer and the engine's configuration."""
    own = F.create_map(
        F.lit("output_dir"), F.parse_json(F.lit(json.dumps(output_dir))),
        F.lit("run_name"), F.try_variant_get(F.parse_json(F.to_json(F.array("run_name"))), "$[0]", "variant"),
        F.lit("deepspeed"), F.parse_json(F.to_json("config")),
    )
    arguments = F.map_concat(config_literal(trainer), own)
    return explode_params(runs, arguments, TRAINER).union(
        explode_params(runs, cf.prefix_keys(F.col("config"), ENGINE), ENGINE)
    )


def select_variant(
    runs: DataFrame, base: dict | None = None, stages: dict[str, dict] = ZERO_STAGES
) -> DataFrame:
    """Adds each run's `config` by its `stage`; a stage without configuration is an error."""
    variants = config_variants(runs.sparkSession, base, stages)
    unknown = F.raise_error(
        F.concat(F.lit("no configuration for stage "), F.coalesce("stage", F.lit("NULL")))
    )
    # The variants are written out in the program, one row per stage.
    return (
        runs.join(F.broadcast(variants), "stage", "left")
        .withColumn("config", F.when(F.col("config").isNull(), unknown).otherwise(F.col("config")))
    )


def key_pairs(spark: SparkSession) -> DataFrame:
    """(trainer_key, engine_key), the fixed pairs as a table."""
    pairs = F.array(
        *[F.struct(F.lit(t).alias("trainer_key"), F.lit(e).alias("engine_key")) for t, e in KEY_PAIRS]
    )
    return spark.range(1).select(F.inline(pairs))


def engine_params(runs: DataFrame, config: Column) -> DataFrame:
    """The engine's side of the key pairs as (run_id, source, key, value) rows.

    Reaches into the sections of a MAP<STRING, VARIANT>; keys that are not set give no row.
    """
    leaves = []
    for key in dict.fromkeys(engine for _, engine in KEY_PAIRS):
        section, _, inner = key.partition(".")
        value = config_leaf(config, section, f"$.{inner}" if inner else "$")
        leaves.append(
            F.struct(F.lit(ENGINE).alias("source"), F.lit(key).alias("key"), value.alias("value"))
        )
    return runs.select("run_id", F.inline(F.array(*leaves))).where(F.col("value").isNotNull())


def config_leaves(runs: DataFrame, config: str = "config", source: str = ENGINE) -> DataFrame:
    """(run_id, source, key, value): every value of a MAP<STRING, VARIANT>, at whatever depth, under its path with dots.

    Sections are opened level by level until none is left, a level a written table. Lists and empty sections are
    values; a JSON null is a NULL value. A name that holds a dot is put in backquotes.
    """
    spark = runs.sparkSession

    def quoted(name: str) -> Column:
        return F.when(F.contains(name, F.lit(".")), F.concat(F.lit("`"), name, F.lit("`"))).otherwise(F.col(name))

    level = runs.select("run_id", F.explode(config).alias("name", "value")).select("run_id", quoted("name").alias("key"), "value")
    values = []
    while True:
        # A section's schema reads OBJECT<...>, that of an empty one OBJECT<>.
        shape = F.coalesce(F.schema_of_variant("value"), F.lit("VOID"))
        opened = written(level.withColumn("is_section", shape.startswith("OBJECT<") & (shape != "OBJECT<>")), "config_level")
        values.append(opened.where("NOT is_section").select("run_id", "key", F.col("value").cast("string").alias("value")))
        sections = opened.where("is_section")
        if sections.isEmpty():
            break
        inner = sections.alias("s").lateralJoin(spark.tvf.variant_explode(F.col("s.value").outer()).alias("i"))
        inner = inner.select("s.run_id", F.col("s.key").alias("above"), F.col("i.key").alias("name"), F.col("i.value").alias("value"))
        level = inner.select("run_id", F.concat("above", F.lit("."), quoted("name")).alias("key"), "value")
    found = reduce(DataFrame.union, values)
    return found.select("run_id", F.lit(source).alias("source"), "key", "value")


def config_conflicts(params: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Parameters on which trainer and engine disagree, one row per run and key pair.

    `params` is (run_id, source, key, value). Numbers are compared as numbers, lists and sections
    by their values, everything else without regard to case. "auto" on either side agrees with
    anything; a key missing on one side does not. A key that a side holds with several values
    is a conflict; they are shown with bars between. `pairs` is (trainer_key, engine_key), the fixed pairs by default;
    they are sent to all tasks.
    """
    pairs = key_pairs(params.sparkSession) if pairs is None else pairs.select("trainer_key", "engine_key").distinct()
    sides = pairs.select(F.lit(TRAINER).alias("source"), F.col("trainer_key").alias("key"), "*").union(
        pairs.select(F.lit(ENGINE).alias("source"), F.col("engine_key").alias("key"), "*")
    )

    def held(source: str) -> Column:
        return F.collect_set(F.when(F.col("source") == source, F.col("value")))

    def shown(values: str) -> Column:
        return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), " | "))

    # Dealt out before they are put together: sets begun where the rows are read would hold a task's whole input,
    # which a small file can blow up to, and make it no smaller.
    group = ["run_id", "trainer_key", "engine_key"]
    both = (
        # Pairs are names of settings and travel. Written parameters are so small on disk that Spark would send them instead, all to each task.
        params.join(F.broadcast(sides), ["source", "key"])
        .select(*group, "source", "value")
        .repartition(*group)
        .groupBy(*group)
        .agg(held(TRAINER).alias("_trainer"), held(ENGINE).alias("_engine"))
        .withColumn("trainer_value", shown("_trainer"))
        .withColumn("engine_value", shown("_engine"))
    )
    repeated = (F.size("_trainer") > 1) | (F.size("_engine") > 1)
    return both.where(repeated | ~_agree(F.col("trainer_value"), F.col("engine_value"))).drop("_trainer", "_engine")


def _agree(a: Column, b: Column) -> Column:
    number_a, number_b = a.try_cast("double"), b.try_cast("double")
    both_numbers = number_a.isNotNull() & number_b.isNotNull()
    is_auto = F.coalesce((a == AUTO) | (b == AUTO), F.lit(False))
    return (
        F.when(is_auto, F.lit(True))
        .when(both_numbers, number_a == number_b)
        .otherwise(_canonical(a).eqNullSafe(_canonical(b)))
    )


def _canonical(value: Column) -> Column:
    """Without the blanks and the order of keys that a JSON text may have; lower case."""
    return F.lower(F.coalesce(F.try_parse_json(value).cast("string"), value))
