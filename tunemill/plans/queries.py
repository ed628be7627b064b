"""One query per operator, over the whole test tables.

Array results are shown as text, values joined by blanks.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.functions import configs as cf
from tunemill.functions import schedules
from tunemill.functions.integers import ceil_div
from tunemill.functions.labels import IGNORED_LABEL
from tunemill.functions.labels import causal_labels as causal
from tunemill.functions.tokens import EOS_ID
from tunemill.operators import batching, columns, subwords, tokenization, tracking, training, user_functions
from tunemill.operators import prompts as prompting
from tunemill.plans import fixtures as fx
from tunemill.plans import prepare
from tunemill.session import scratch_path
from tunemill.sources import configs, files, instructions, sinks

Query = Callable[[SparkSession, str], DataFrame]

VOCAB_SIZE = 8000
# So small that summaries are cut, and candidates counted again.
BOUNDED_SIZE = 300
WORLD_SIZE = 4
SEED = 7
ACCUMULATION = 2
OUTPUT_DIR = "/models/results"
# A public byte-level vocabulary, and the first id that it leaves free.
RANK_FILE, FREE_ID = "/opt/tokenizers/byte_bpe_50k.tiktoken", 50256

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shown(values: Column | str) -> Column:
    """An array as text."""
    column = F.col(values) if isinstance(values, str) else values
    return F.array_join(column.cast("array<string>"), " ")


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompting.prompt_template(fx.instructions(spark, sf_dir))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prompt_tokens(fx.instructions(spark, sf_dir), VOCAB_SIZE)


def stored_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.stored(tokens(spark, sf_dir), "tokens")


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_tokens(spark, sf_dir).select("id", "n_tokens")


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def document_tokens(
    spark: SparkSession, sf_dir: str, max_length: int | None, joined: bool = False
) -> DataFrame:
    texts = document_texts(spark, sf_dir)
    vocabulary = tokenization.build_vocab(texts, VOCAB_SIZE)
    return tokenization.tokenize(texts, vocabulary, max_length=max_length, joined=joined)


def dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches in id order, dealt out; `n_rows` tells the number of all rows."""
    ids = fx.instructions(spark, sf_dir).select("id")
    assigned = batching.sequential_batches(ids, rows="n_rows")
    return batching.shard_batches(assigned, WORLD_SIZE, rows=F.col("n_rows"))


def run_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with their configurations, batch sizes resolved."""
    return tracking.resolve_batch_size(tracking.select_variant(fx.runs(spark, sf_dir)))


def instructions_by_split(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the instructions, a directory for each split."""
    path = scratch_path(spark, "instructions")
    fx.instructions(spark, sf_dir).write.partitionBy("split").parquet(path)
    return path


# Sources and sinks


@query
def load_instructions(spark, sf_dir):
    return instructions.load_instructions(spark, instructions_by_split(spark, sf_dir), split="train")


@query
def cached_table(spark, sf_dir):
    path = scratch_path(spark, "instructions")

    def build():
        return fx.instructions(spark, sf_dir)

    instructions.cached_table(spark, path, build)
    return instructions.cached_table(spark, path, build)


@query
def content_cache(spark, sf_dir):
    source, folder = scratch_path(spark, "instructions"), scratch_path(spark, "builds")

    def cached():
        return instructions.content_cached(instructions.load_instructions(spark, source), folder)

    rows = fx.instructions(spark, sf_dir)
    rows.where("split = 'train'").write.parquet(source)
    first = cached()
    rows.where("split = 'test'").write.mode("append").parquet(source)
    # The source has changed since, the first build hasn't.
    return first.withColumn("build", F.lit(1)).union(cached().withColumn("build", F.lit(2)))


@query
def split_filter(spark, sf_dir):
    rows = instructions.load_instructions(spark, instructions_by_split(spark, sf_dir))
    return instructions.split_filter(rows, "test")


@query
def load_config(spark, sf_dir):
    path = scratch_path(spark, "engine")
    text = spark.range(1).select(F.lit(json.dumps(configs.engine_config())).alias("value"))
    text.coalesce(1).write.text(path)
    loaded = configs.load_config(spark, path).scalar()
    return sinks.explode_params(fx.runs(spark, sf_dir).withColumn("config", loaded), F.col("config"), "").drop("source")


@query
def file_manifest(spark, sf_dir):
    return files.file_manifest(fx.models(spark, sf_dir), fx.repo_files(spark, sf_dir), fx.MODEL_HOME)


@query
def list_files(spark, sf_dir):
    root = scratch_path(spark, "repositories")
    listed = fx.repo_files(spark, sf_dir).where("present").withColumn("shard", F.length("name") % 4)
    listed.select("repo", "shard", "name").repartition(8, "repo").write.partitionBy("repo", "shard").parquet(root)
    folder = F.regexp_extract("target_path", "repo=([^/]*)/shard=([0-9]*)/", 0)
    found = files.list_files(spark, root).groupBy(folder.alias("folder")).agg(F.min("length").alias("least"))
    return found.select("folder", (F.col("least") > 0).alias("has_bytes"))


@query
def pending_files(spark, sf_dir):
    listed = fx.repo_files(spark, sf_dir)
    models = fx.models(spark, sf_dir)
    present = files.file_manifest(models, listed.where("present"), fx.MODEL_HOME)
    return files.pending_files(files.file_manifest(models, listed, fx.MODEL_HOME), present)


@query
def write_batches(spark, sf_dir):
    path = scratch_path(spark, "batches")
    batches = prepare.trainer_batches(stored_tokens(spark, sf_dir), WORLD_SIZE, seed=SEED)
    sinks.write_batches(
        batches.select("rank", "step", "slot", "id", "input_ids", "attention_mask", "labels"), path
    )
    return sinks.read_batches(spark, path).select(
        "rank", "step", "slot", "id", shown("input_ids").alias("input_ids"), shown("labels").alias("labels")
    )


@query
def metrics_sink(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    logged = fx.metrics(spark, sf_dir)
    # The second write holds all rows of the first one, and adds what that left out.
    sinks.append_metrics(logged.where("global_step <= 5"), path)
    sinks.append_metrics(logged, path)
    return spark.read.parquet(path).select(*sinks.METRIC_COLUMNS)


@query
def metrics_upsert(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    logged = fx.metrics(spark, sf_dir)
    # First values that later turn out wrong; the second write replaces those of every other run.
    sinks.upsert_metrics(logged.withColumn("value", -F.col("value")), path)
    sinks.upsert_metrics(logged.where("run_id % 2 = 0"), path)
    return spark.read.parquet(path).select(*sinks.METRIC_COLUMNS)


@query
def params_sink(spark, sf_dir):
    path = scratch_path(spark, "run_params")
    logging = run_configs(spark, sf_dir).where(F.col("rank") == 0)
    params = tracking.logged_params(logging, OUTPUT_DIR)
    sinks.append_params(params.where(F.col("source") == tracking.TRAINER), path)
    sinks.append_params(params, path)
    return spark.read.parquet(path).select(*sinks.PARAM_COLUMNS)


# Prompts and tokens


@query
def prompt_template(spark, sf_dir):
    return prompts(spark, sf_dir).select("id", "text")


@query
def build_vocab(spark, sf_dir):
    return tokenization.build_vocab(document_texts(spark, sf_dir), VOCAB_SIZE).table


@query
def build_vocab_bounded(spark, sf_dir):
    return tokenization.build_vocab_bounded(document_texts(spark, sf_dir), BOUNDED_SIZE).table


@query
def tokenize(spark, sf_dir):
    return document_tokens(spark, sf_dir, None).select(
        "id", "n_tokens", shown("input_ids").alias("input_ids")
    )


@query
def tokenize_joined(spark, sf_dir):
    return document_tokens(spark, sf_dir, None, joined=True).select(
        "id", "n_tokens", shown("input_ids").alias("input_ids")
    )


@query
def truncate_tokens(spark, sf_dir):
    return document_tokens(spark, sf_dir, 512).select(
        "id", "n_tokens", shown("input_ids").alias("input_ids")
    )


@query
def attention_mask(spark, sf_dir):
    return document_tokens(spark, sf_dir, 512).select(
        "id", shown("attention_mask").alias("attention_mask")
    )


@query
def subword_tokenize(spark, sf_dir):
    coded = subwords.tokenize_subwords(prompts(spark, sf_dir), subwords.read_ranks(spark, RANK_FILE))
    return coded.select("id", "n_tokens", shown("input_ids").alias("input_ids"))


@query
def subword_decode(spark, sf_dir):
    ranks = subwords.read_ranks(spark, RANK_FILE)
    coded = subwords.tokenize_subwords(prompts(spark, sf_dir), ranks, max_length=None)
    return subwords.decode_subwords(coded.select("id", "input_ids"), ranks).select("id", "text")


@query
def drop_columns(spark, sf_dir):
    left = columns.drop_columns(tokens(spark, sf_dir)).drop("attention_mask")
    return left.withColumn("input_ids", shown("input_ids"))


@query
def keep_model_columns(spark, sf_dir):
    return columns.keep_model_columns(tokens(spark, sf_dir)).select(
        "id", shown("input_ids").alias("input_ids"), shown("attention_mask").alias("attention_mask")
    )


# Batches


@query
def sequential_batches(spark, sf_dir):
    return batching.sequential_batches(fx.instructions(spark, sf_dir).select("id"))


@query
def length_grouped_batches(spark, sf_dir):
    return batching.length_grouped_batches(lengths(spark, sf_dir), seed=SEED)


@query
def batch_max_length(spark, sf_dir):
    assigned = batching.sequential_batches(lengths(spark, sf_dir))
    return batching.batch_max_length(assigned).drop("seq")


@query
def pad_sequences(spark, sf_dir):
    rows = stored_tokens(spark, sf_dir)
    assigned = batching.sequential_batches(rows.select("id", "n_tokens"))
    padded = batching.pad_sequences(
        batching.attach_tokens(batching.batch_max_length(assigned), rows)
    )
    return padded.select(
        "batch_id",
        "slot",
        "id",
        shown("input_ids").alias("input_ids"),
        shown("attention_mask").alias("attention_mask"),
    )


@query
def causal_labels(spark, sf_dir):
    return prepare.manual_batches(stored_tokens(spark, sf_dir)).select(
        "batch_id", "slot", "id", shown("labels").alias("labels")
    )


@query
def batch_stats(spark, sf_dir):
    return batching.batch_stats(batching.length_grouped_batches(lengths(spark, sf_dir), seed=SEED))


@query
def shard_replicated(spark, sf_dir):
    assigned = batching.sequential_batches(fx.instructions(spark, sf_dir).select("id"))
    return batching.shard_replicated(assigned, WORLD_SIZE).select("rank", "step", "slot", "id")


@query
def shard_batches(spark, sf_dir):
    return dealt(spark, sf_dir).select("rank", "step", "slot", "id", "batch_id")


@query
def micro_to_optimizer_step(spark, sf_dir):
    optimizer_step = batching.micro_to_optimizer_step(F.col("step"), ACCUMULATION)
    return dealt(spark, sf_dir).select(
        "rank", "step", "slot", "id", optimizer_step.alias("optimizer_step")
    )


@query
def epoch_replay(spark, sf_dir):
    return batching.epoch_replay(dealt(spark, sf_dir)).select("epoch", "rank", "step", "slot", "id")


@query
def global_step(spark, sf_dir):
    steps = ceil_div(F.col("n_rows"), batching.BATCH_SIZE * WORLD_SIZE)
    replayed = batching.with_global_step(batching.epoch_replay(dealt(spark, sf_dir)), steps)
    return replayed.select("epoch", "rank", "step", "slot", "id", "global_step")


@query
def training_batches(spark, sf_dir):
    batches = prepare.trainer_batches(stored_tokens(spark, sf_dir), WORLD_SIZE, seed=SEED)
    return batches.select(
        "rank",
        "step",
        "slot",
        "id",
        shown("input_ids").alias("input_ids"),
        shown("attention_mask").alias("attention_mask"),
        shown("labels").alias("labels"),
    )


@query
def trainer_epochs(spark, sf_dir):
    batches = prepare.trainer_epochs(stored_tokens(spark, sf_dir), WORLD_SIZE, seed=SEED)
    return batches.select(
        "epoch", "rank", "step", "slot", "id", shown("input_ids").alias("input_ids"), shown("labels").alias("labels")
    )


# Loss, schedules and plans


@query
def token_loss_mask(spark, sf_dir):
    scored = training.token_loss_mask(prepare.manual_batches(stored_tokens(spark, sf_dir)))
    return scored.select(
        "batch_id", "slot", "id", F.size("scored").alias("n_scored"), shown("scored.next").alias("scored")
    )


def train_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_tokens(spark, sf_dir)
    batch_of = batching.sequential_batches(rows.select("id")).select("id", "batch_id")
    ids = batch_of.join(rows.select("id", "input_ids"), "id")
    labelled = ids.withColumn("labels", causal(F.col("input_ids"), EOS_ID))
    vocabulary = rows.select(F.explode("input_ids").alias("token")).agg(F.count_distinct("token")).scalar()
    return training.bigram_train_loss(labelled, vocabulary, step="batch_id")


@query
def bigram_train_loss(spark, sf_dir):
    return train_losses(spark, sf_dir).withColumn("train_loss", F.round("train_loss", 6))


@query
def logged_train_loss(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    sinks.append_metrics(training.loss_record(train_losses(spark, sf_dir), run_id=1), path)
    losses = training.logged_loss(spark.read.parquet(path))
    return losses.withColumn("loss", F.round("loss", 6))


@query
def lr_schedule(spark, sf_dir):
    lr = schedules.warmup_lr(F.col("global_step") - 1)
    return fx.metrics(spark, sf_dir).select("run_id", "global_step", F.round(lr, 10).alias("lr"))


@query
def lr_schedule_constant(spark, sf_dir):
    lr = schedules.constant_lr()
    return fx.metrics(spark, sf_dir).select("run_id", "global_step", lr.alias("lr"))


@query
def step_plan(spark, sf_dir):
    planned = layout(spark, sf_dir).select("run_id", "num_processes")
    return training.step_plan(planned, fx.instructions(spark, sf_dir), accumulation=ACCUMULATION)


@query
def logged_loss(spark, sf_dir):
    losses = training.logged_loss(fx.metrics(spark, sf_dir), key="purchase")
    return losses.withColumn("loss", F.round("loss", 6))


@query
def checkpoint_steps(spark, sf_dir):
    return training.checkpoint_steps(fx.metrics(spark, sf_dir), OUTPUT_DIR)


# Configurations and runs


@query
def prefix_config_keys(spark, sf_dir):
    prefixed = cf.prefix_keys(F.col("config"))
    return sinks.explode_params(run_configs(spark, sf_dir), prefixed, tracking.ENGINE).drop("source")


@query
def config_variants(spark, sf_dir):
    rows = run_configs(spark, sf_dir).select("run_id", "stage", F.explode("config").alias("key", "value"))
    return rows.withColumn("value", F.col("value").cast("string"))


@query
def select_variant(spark, sf_dir):
    section = F.element_at("config", "zero_optimization")
    return run_configs(spark, sf_dir).select(
        "run_id",
        "stage",
        F.try_variant_get(section, "$.stage", "int").alias("zero_stage"),
        F.try_variant_get(section, "$.reduce_bucket_size", "string").alias("reduce_bucket_size"),
    )


@query
def offload_device(spark, sf_dir):
    device = cf.offload_device(F.col("config"))
    return run_configs(spark, sf_dir).select("run_id", device.alias("device"))


@query
def optimizer_choice(spark, sf_dir):
    optimizer = cf.optimizer_choice(cf.offload_device(F.col("config")))
    return run_configs(spark, sf_dir).select("run_id", optimizer.alias("optimizer"))


@query
def run_name(spark, sf_dir):
    name = cf.run_name(F.col("run_name"), F.col("rank"))
    return fx.runs(spark, sf_dir).select("run_id", name.alias("run_name"))


@query
def layout(spark, sf_dir):
    return fx.runs(spark, sf_dir).select(
        "run_id",
        cf.num_processes(F.col("gpus"), F.col("nodes")).alias("num_processes"),
        cf.is_local(F.col("nodes")).alias("local"),
    )


@query
def global_batch_size(spark, sf_dir):
    in_config = cf.config_leaf(F.col("config"), "train_batch_size", "$", "int")
    return run_configs(spark, sf_dir).select(
        "run_id", F.col("global_batch_size").cast("int").alias("global_batch_size"), in_config.alias("in_config")
    )


@query
def parent_only_multinode(spark, sf_dir):
    parent = cf.multinode_parent(F.col("nodes"), F.col("parent_run_id"))
    return fx.runs(spark, sf_dir).select("run_id", parent.alias("parent_run_id"))


@query
def expand_runs(spark, sf_dir):
    return tracking.expand_runs(fx.launches(spark, sf_dir))


@query
def run_tree(spark, sf_dir):
    return tracking.run_tree(fx.runs(spark, sf_dir)).select(
        "run_id", "rank", "parent_run_id", "parent_name", "parent_rank"
    )


@query
def rank0_metrics(spark, sf_dir):
    return tracking.rank0_metrics(fx.metrics(spark, sf_dir)).select(
        "run_id", "rank", "key", "value", "global_step"
    )


@query
def config_conflicts(spark, sf_dir):
    return tracking.config_conflicts(fx.run_params(spark, sf_dir))


@query
def config_leaves(spark, sf_dir):
    return tracking.config_leaves(run_configs(spark, sf_dir)).drop("source")


@query
def deep_conflicts(spark, sf_dir):
    """Each run's configuration against the one that offloads, at every depth."""
    mine = run_configs(spark, sf_dir)
    other = tracking.select_variant(fx.runs(spark, sf_dir).withColumn("stage", F.lit("stage_3_offload")))
    params = tracking.config_leaves(mine).union(tracking.config_leaves(other, source=tracking.TRAINER))
    keys = params.select(F.col("key").alias("trainer_key"), F.col("key").alias("engine_key"))
    return tracking.config_conflicts(params, keys).drop("engine_key")


# User functions


@query
def map_rows(spark, sf_dir):
    def compose(row):
        import unicodedata

        text = row["response"]
        return {"composed": None if text is None else unicodedata.normalize("NFC", text)}

    rows = user_functions.map_rows(fx.instructions(spark, sf_dir), compose, "composed string")
    return rows.select("id", "context", "composed")


@query
def pluggable_tokenizer(spark, sf_dir):
    known = subwords.ranks_value(subwords.read_ranks(spark, RANK_FILE))
    encoded = user_functions.tokenize_with(prompts(spark, sf_dir), subwords.text_coder(known))
    rows = prepare.stored(encoded.select("id", "input_ids", "attention_mask", "n_tokens"), "tokens")
    assigned = batching.batch_max_length(batching.sequential_batches(rows.select("id", "n_tokens")))
    batches = batching.collate(batching.attach_tokens(assigned, rows), FREE_ID)
    return batches.select("batch_id", "slot", "id", shown("input_ids").alias("input_ids"), shown("labels").alias("labels"))


def clustered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches in id order, written as a table that is kept by batch."""
    rows = stored_tokens(spark, sf_dir)
    assigned = batching.sequential_batches(rows.select("id", "n_tokens"))
    attached = batching.attach_tokens(assigned, rows).select("batch_id", "slot", "id", "input_ids")
    path = scratch_path(spark, "clustered")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    sinks.write_clustered(attached, table, path, buckets=8)
    return sinks.read_clustered(spark, table)


@query
def pack_batches(spark, sf_dir):
    packed = user_functions.collate_batches(
        clustered_batches(spark, sf_dir),
        lambda batch: user_functions.packed_rows(batch, pad_id=EOS_ID),
        "batch_id bigint, pack int, input_ids array<int>, segments array<int>",
    )
    return packed.select("batch_id", "pack", shown("input_ids").alias("input_ids"), shown("segments").alias("segments"))


@query
def collate_batches(spark, sf_dir):
    pad_id, ignored = EOS_ID, IGNORED_LABEL

    def pad_and_label(batch):
        longest = batch["input_ids"].map(len).max()
        batch["input_ids"] = [list(ids) + [pad_id] * (longest - len(ids)) for ids in batch["input_ids"]]
        batch["labels"] = [[ignored if i == pad_id else i for i in ids] for ids in batch["input_ids"]]
        return batch

    collated = user_functions.collate_batches(
        clustered_batches(spark, sf_dir),
        pad_and_label,
        "batch_id bigint, slot int, id bigint, input_ids array<int>, labels array<int>",
    )
    return collated.select(
        "batch_id", "slot", "id", shown("input_ids").alias("input_ids"), shown("labels").alias("labels")
    )


@query
def run_on_ranks(spark, sf_dir):
    def count_rows(frame):
        import pandas as pd

        return pd.DataFrame(
            {
                "rank": [int(frame["rank"].iloc[0])],
                "rows": [len(frame)],
                "last_step": [int(frame["step"].iloc[-1])],
                "tokens": [int(frame["n_tokens"].sum())],
            }
        )

    assigned = batching.sequential_batches(lengths(spark, sf_dir))
    shards = batching.shard_batches(assigned, 2).select("rank", "step", "slot", "n_tokens")
    parts = user_functions.map_step_ranges(
        shards, count_rows, "rank int, rows bigint, last_step bigint, tokens bigint", steps=64
    )
    return parts.groupBy("rank").agg(
        F.sum("rows").alias("rows"), (F.max("last_step") + 1).alias("steps"), F.sum("tokens").alias("tokens")
    )
