import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from tunemill.functions.schedules import constant_lr, warmup_lr
from tunemill.operators import training


def batches_of(spark, rng, steps):
    rows = [
        (step, [rng.randrange(1, 9) for _ in range(6)], [rng.choice([-100, 1, 2, 3]) for _ in range(6)])
        for step in range(steps)
        for _ in range(2)
    ]
    return rows, spark.createDataFrame(rows, "step bigint, input_ids array<int>, labels array<int>")


@pytest.mark.parametrize("bits", [16, 2, 0])
def test_bigram_loss_by_hand(spark, bits):
    rows, df = batches_of(spark, random.Random(1), 25)
    pair_counts, prev_counts = collections.Counter(), collections.Counter()
    expected = {}
    for step in range(25):
        pairs = [
            (ids[i], labels[i + 1])
            for s, ids, labels in rows
            if s == step
            for i in range(5)
            if labels[i + 1] != -100
        ]
        losses = [-math.log((pair_counts[p] + 1) / (prev_counts[p[0]] + 10)) for p in pairs]
        if losses:
            expected[step] = (sum(losses) / len(losses), len(losses))
        pair_counts.update(pairs)
        prev_counts.update(p[0] for p in pairs)
    found = {r["step"]: r for r in training.bigram_train_loss(df, 10, bits=bits).collect()}
    assert found.keys() == expected.keys()
    for step, (loss, n) in expected.items():
        assert found[step]["train_loss"] == pytest.approx(loss, abs=1e-9)
        assert found[step]["scored_tokens"] == n


def test_loss_falls_on_repeated_text(spark):
    df = spark.range(20).select(
        F.col("id").alias("step"),
        F.array(*[F.lit(x) for x in (1, 2, 3, 4)]).alias("input_ids"),
        F.array(*[F.lit(x) for x in (1, 2, 3, 4)]).alias("labels"),
    )
    losses = [r["train_loss"] for r in training.bigram_train_loss(df, 10).orderBy("step").collect()]
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]


def test_scored_pairs(spark):
    df = spark.createDataFrame(
        [([1, 5, 6, 2], [1, 5, 6, -100]), ([1], [1]), ([1, 7], [-100, 7])],
        "input_ids array<int>, labels array<int>",
    )
    scored = [[tuple(p) for p in r["scored"]] for r in training.token_loss_mask(df).collect()]
    assert scored == [[(1, 5), (5, 6)], [], [(1, 7)]]


def test_logged_loss(spark):
    df = spark.range(1, 24).select(
        F.lit(1).alias("run_id"), F.col("id").alias("step"), (F.col("id") * 1.0).alias("train_loss")
    )
    df = training.loss_record(df.withColumn("step", F.col("step") - 1), run_id=1)
    # Another rank's rows of the same steps add no steps, the steps' own rows no loss.
    df = df.union(df.withColumn("rank", F.lit(1)))
    rows = {r["log_step"]: (r["loss"], r["steps"]) for r in training.logged_loss(df).collect()}
    assert rows == {10: (5.5, 10), 20: (15.5, 10), 30: (22.0, 3)}


def test_checkpoints(spark):
    df = spark.range(1, 120).select(F.lit(1).alias("run_id"), F.col("id").alias("global_step"))
    rows = training.checkpoint_steps(df.union(df), output_dir="/out").collect()
    assert {(r["global_step"], r["checkpoint"]) for r in rows} == {
        (50, "/out/checkpoint-50"),
        (100, "/out/checkpoint-100"),
    }
    assert len(rows) == 2


@pytest.mark.parametrize(
    ("n", "world", "accumulation", "manual", "trainer"),
    [(32, 2, 1, 8, 4), (33, 2, 1, 9, 5), (33, 2, 2, 9, 2), (3, 8, 4, 1, 1)],
)
def test_step_plan(spark, n, world, accumulation, manual, trainer):
    runs = spark.createDataFrame([(1, world)], "run_id int, num_processes int")
    plan = training.step_plan(runs, spark.range(n), accumulation=accumulation, epochs=2).first()
    assert (plan["manual_steps_per_epoch"], plan["manual_total_steps"]) == (manual, 2 * manual)
    assert (plan["trainer_steps_per_epoch"], plan["trainer_total_steps"]) == (trainer, 2 * trainer)


def test_learning_rates(spark):
    rows = spark.range(0, 201, 50).select(warmup_lr(F.col("id")).alias("w"), constant_lr().alias("c")).collect()
    assert [r["w"] for r in rows] == pytest.approx([0, 1e-4, 2e-4, 2e-4, 2e-4])
    assert {r["c"] for r in rows} == {2e-4}
    low = spark.range(1).select(warmup_lr(F.col("id") + 5, 1.0, 10, 0.5).alias("w")).first()["w"]
    assert low == pytest.approx(0.75)
