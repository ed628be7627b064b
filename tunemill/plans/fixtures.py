"""The package's input tables, derived from a folder of general test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.functions.integers import whole_div
from tunemill.operators import tracking
from tunemill.operators.positions import with_id_position
from tunemill.sources.configs import TRAINER_VALUES, config_literal
from tunemill.sources.instructions import conform_instructions
from tunemill.sources.sinks import explode_params

STEPS_PER_EPOCH = 20
RUN_NAME = "tuning_run"
MODEL_HOME = "/models"

# A key pair that only the trainer's side of some runs agrees on, written with blanks.
BETAS = "[0.9, 0.999]"
OTHER_BETAS = "[0.9, 0.95]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn right after it; the system turn is the context.

    (conv_id, turn) is unique, so the follower is found by an equality join, which spreads a
    long conversation over all tasks. In the second join all turns of a conversation meet its
    system turn; a conversation that holds much of the table is split by Spark at run time.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction")
    )
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    system = turns.where(F.col("role") == "system").select(
        "conv_id", F.col("text").alias("context")
    )
    turn = F.col("turn")
    rows = (
        asked.join(answered, ["conv_id", "turn"])
        .join(system, "conv_id", "left")
        .select(
            turn_id().alias("id"),
            "instruction",
            "context",
            "response",
            F.when(turn <= 1, "opening").otherwise("followup").alias("category"),
            F.when((F.col("conv_id") + turn) % 10 == 0, "test").otherwise("train").alias("split"),
        )
    )
    return conform_instructions(rows)


def turn_id() -> Column:
    """One BIGINT per turn, unique for conversations of up to 2**32 turns."""
    return F.shiftleft(F.col("conv_id"), 32) + F.col("turn")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as logged values; a run's steps follow its events, whose ids rise with time."""
    logged = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("run_id"),
        (F.col("user_id") % 4).cast("int").alias("rank"),
        F.col("event_type").alias("key"),
        "value",
    )
    since = F.col("global_step") - 1
    return (
        with_id_position(logged, "event_id", ["run_id"], "global_step")
        .withColumn("epoch", whole_div(since, STEPS_PER_EPOCH).cast("int"))
        .withColumn("step", since % STEPS_PER_EPOCH)
        .drop("event_id")
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user, every fourth a parent; rank, layout and stage follow the id independently."""
    run = F.col("run_id")
    stages = F.array(*[F.lit(s) for s in ("stage_1", "stage_2", "stage_3", "stage_3_offload")])
    return (
        table(spark, sf_dir, "events")
        .select(F.col("user_id").alias("run_id"))
        .distinct()
        .select(
            run,
            F.when(run % 4 != 0, run - run % 4).alias("parent_run_id"),
            (run % 4).cast("int").alias("rank"),
            (run % 8 + 1).cast("int").alias("gpus"),
            (run % 3 + 1).cast("int").alias("nodes"),
            F.element_at(stages, (whole_div(run, 4) % 4 + 1).cast("int")).alias("stage"),
            F.lit(RUN_NAME).alias("run_name"),
        )
    )


def run_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides' parameters of every run.

    Some runs change the trainer's learning rate or its betas, some log a batch size twice.
    """
    chosen = tracking.select_variant(runs(spark, sf_dir))
    run = F.col("run_id")
    trainer = explode_params(chosen, config_literal(TRAINER_VALUES), tracking.TRAINER)
    betas = chosen.select(
        "run_id",
        F.lit(tracking.TRAINER).alias("source"),
        F.lit("betas").alias("key"),
        F.when(run % 3 == 0, OTHER_BETAS).otherwise(BETAS).alias("value"),
    )
    again = trainer.where((run % 11 == 0) & (F.col("key") == "per_device_train_batch_size")).withColumn("value", F.lit("8"))
    rate = (F.col("source") == tracking.TRAINER) & (F.col("key") == "learning_rate")
    value = F.when(rate & (run % 7 == 0), "auto").when(rate & (run % 5 == 0), "0.001").otherwise(F.col("value"))
    return (
        trainer.union(betas).union(again).withColumn("value", value)
        .union(tracking.engine_params(chosen, F.col("config")))
    )


def launches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run as a launch of its own."""
    return runs(spark, sf_dir).withColumnRenamed("run_id", "launch_id")


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lib, repo): each repository under a name of its own, every second one under another as well."""
    repo = F.col("repo")
    names = F.array(F.concat(F.lit("lib-"), repo), F.when(F.length(repo) % 2 == 0, F.concat(F.lit("also-"), repo)))
    return repo_files(spark, sf_dir).select("repo").distinct().select(F.explode(names).alias("lib"), "repo").where("lib IS NOT NULL")


def repo_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as files: the host is the repository, the rest the file name."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        F.regexp_extract(url, "^https?://([^/]+)/(.*)$", 1).alias("repo"),
        F.regexp_extract(url, "^https?://([^/]+)/(.*)$", 2).alias("name"),
        url.startswith("https:").alias("present"),
    )
