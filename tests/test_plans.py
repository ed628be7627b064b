"""What the plans must and must not hold."""

import re

import pytest
from conftest import TESTDATA, plan_of
from pyspark.sql import functions as F

from tunemill.operators import batching, positions
from tunemill.plans import prepare
from tunemill.plans.queries import QUERIES
from tunemill.sources import sinks

SF_DIR = f"{TESTDATA}/sf0.001"
WITH_USER_CODE = {"map_rows", "pluggable_tokenizer", "subword_tokenize", "subword_decode", "collate_batches", "pack_batches", "list_files", "build_vocab_bounded", "run_on_ranks"}


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_join_and_no_python_in_the_native_path(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in WITH_USER_CODE:
        assert not re.search("Python|Pandas", plan)


def final_plan(df):
    """The lines of the plan as it was run: first plans and what was taken from elsewhere in it are left out."""
    df.collect()
    lines, skipped = [], None
    for line in plan_of(df).splitlines():
        text = re.search(r"[^ :+\-*()0-9]", line)
        column = text.start() if text else 0
        if skipped is not None and column >= skipped:
            continue
        skipped = column if "== Initial Plan ==" in line else None
        if skipped is None:
            lines.append(line)
    return lines


def counts(df):
    lines = final_plan(df)
    return {
        "hash": sum("- Exchange hashpartitioning" in line for line in lines),
        "single": sum("- Exchange SinglePartition" in line for line in lines),
        "scans": sum("FileScan" in line for line in lines),
    }


@pytest.fixture
def stored_rows(spark, tmp_path):
    spark.range(1000).select("id", F.col("id").cast("string").alias("payload")).write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


@pytest.fixture
def token_rows(spark, tmp_path):
    path = str(tmp_path / "tokens")
    ones = F.array_repeat(F.lit(1), (F.col("id") % 7 + 1).cast("int"))
    spark.range(300).select(
        "id", ones.alias("input_ids"), ones.alias("attention_mask"), (F.col("id") % 7 + 1).cast("int").alias("n_tokens")
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_positions_send_only_a_row_per_range_to_one_task(spark, conf, stored_rows):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for df in (batching.sequential_batches(stored_rows), positions.with_shuffled_position(stored_rows, 1)):
        lines = final_plan(df)
        inputs = [
            next(text for text in (later.strip(" :+-*()0123456789") for later in lines[i + 1 :]) if not text.startswith(("WholeStage", "Project")))
            for i, line in enumerate(lines)
            if "- Exchange SinglePartition" in line
        ]
        # Sizes of ranges, and a quantile sketch of each task.
        assert inputs and all(i.startswith(("HashAggregate(keys=[_range#", "ObjectHashAggregate(keys=[], functions=[partial_percentile")) for i in inputs)


def test_rows_are_shuffled_once_for_their_position(spark, conf, stored_rows):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for df in (positions.with_id_position(stored_rows), positions.with_cut_position(stored_rows)):
        lines = plan_of(df).splitlines()
        wide = [i for i, line in enumerate(lines) if "Exchange" in line and "payload" in lines[i + 1]]
        assert len(wide) == 1


def test_training_batches_take_few_shuffles(spark, conf, token_rows):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = counts(prepare.trainer_batches(token_rows, 4))
    assert found["hash"] <= 8 and found["scans"] <= 3


def test_epochs_add_no_shuffle(spark, conf, token_rows):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    two, four = (counts(prepare.trainer_epochs(token_rows, 4, epochs)) for epochs in (2, 4))
    assert two == four and two["hash"] <= 8 and two["scans"] <= 3


def test_a_mask_looks_nothing_up(spark):
    plan = plan_of(QUERIES["attention_mask"](spark, SF_DIR))
    assert "subquery" not in plan and "Exchange" not in plan


def test_token_arrays_are_shuffled_once(spark, conf, token_rows):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    tokens = token_rows
    assigned = batching.shard_batches(batching.length_grouped_batches(tokens.select("id", "n_tokens")), 4)
    plan = plan_of(batching.collate(batching.attach_tokens(batching.batch_max_length(assigned), tokens)))
    lines = plan.splitlines()
    wide = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "input_ids" in "".join(lines[i : i + 3])]
    assert len(wide) == 1
    scans = [line for line in lines if "FileScan" in line]
    assert sum("input_ids" in line.split("ReadSchema")[1] for line in scans) == 1


def test_scans_read_only_what_is_asked(spark):
    plan = plan_of(QUERIES["sequential_batches"](spark, SF_DIR))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and not any("text" in s for s in schemas)
    assert "EqualTo(role,user)" in plan and "EqualTo(role,assistant)" in plan


def test_batches_that_are_kept_together_are_collated_without_a_shuffle(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("collate_batches", "pack_batches"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "Exchange" not in plan and "Bucketed: true" in plan


def test_a_second_append_reads_its_runs_buckets_only(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    path = str(tmp_path / "metrics")
    columns = ["CAST(id % 200 AS BIGINT) AS run_id", "0 AS rank", "0 AS epoch", "id AS step", "id AS global_step", "'loss' AS key", "1D AS value"]
    rows = spark.range(2000).selectExpr(*columns)
    sinks.append_metrics(rows, path)
    again = rows.where("run_id IN (3, 4)")
    left = sinks.missing_rows(again, path, sinks.METRIC_KEY)
    buckets = {r[0] for r in sinks._with_bucket(again).select(sinks.RUN_BUCKET).distinct().collect()}
    assert left.count() == 0 and len(buckets) <= 2
    held = sinks.held_rows(sinks._with_bucket(again), path)
    read = {r[0] for r in held.select(F.input_file_name()).distinct().collect()}
    assert {f"{sinks.RUN_BUCKET}={b}" for b in buckets} == {f.split("/")[-2] for f in read}
    filters = re.search(r"PartitionFilters: \[([^\]]*)", plan_of(held)).group(1)
    assert sinks.RUN_BUCKET in filters
