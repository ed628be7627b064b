import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tunemill.functions.tokens import EOS_ID
from tunemill.operators import batching


def rows_of(spark, lengths):
    return spark.createDataFrame(list(enumerate(lengths)), "id bigint, n_tokens int")


def order_of(df):
    return [r["id"] for r in sorted(df.collect(), key=lambda r: (r["batch_id"], r["slot"]))]


def grouped_by_hand(lengths, batch, seed):
    """The described order, step by step on plain lists."""
    ids = sorted(range(len(lengths)), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())
    size = batch * max(1, min(len(ids) // (batch * 4), 50))
    groups = [ids[i : i + size] for i in range(0, len(ids), size)]
    groups = [sorted(g, key=lambda i: -lengths[i]) for g in groups]
    heads = [lengths[g[0]] for g in groups]
    top = heads.index(max(heads))
    groups[0][0], groups[top][0] = groups[top][0], groups[0][0]
    return [i for g in groups for i in g]


@pytest.mark.parametrize("n", [1, 3, 4, 10, 33])
def test_sequential(spark, n):
    df = batching.sequential_batches(rows_of(spark, [1] * n))
    assert order_of(df) == list(range(n))
    assert {(r["id"], r["batch_id"], r["slot"]) for r in df.collect()} == {
        (i, i // 4, i % 4) for i in range(n)
    }


@pytest.mark.parametrize(
    "lengths",
    [
        [5],
        [3, 9, 2],
        list(range(15)),
        [7] * 50,
        random.Random(1).choices(range(1, 30), k=203),
        random.Random(2).choices(range(1, 3), k=1000),
        [1] * 400 + [99],
    ],
    ids=["one", "few", "below-a-megabatch", "equal", "ties", "many", "longest-last"],
)
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_length_grouped(spark, lengths, seed):
    df = batching.length_grouped_batches(rows_of(spark, lengths), 4, seed)
    order = order_of(df)
    assert order == grouped_by_hand(lengths, 4, seed)
    assert sorted(order) == list(range(len(lengths)))
    assert lengths[order[0]] == max(lengths)


def test_length_grouping_cuts_padding(spark):
    df = rows_of(spark, random.Random(3).choices(range(1, 512), k=2000))

    def padding(batches):
        return batching.batch_stats(batches).agg(F.sum("pad_tokens")).first()[0]

    assert padding(batching.length_grouped_batches(df)) < padding(batching.sequential_batches(df)) / 4


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_batches_do_not_depend_on_partitions(spark, conf, partitions):
    df = rows_of(spark, random.Random(4).choices(range(1, 99), k=150))
    before = order_of(batching.length_grouped_batches(df))
    conf("spark.sql.shuffle.partitions", partitions)
    assert order_of(batching.length_grouped_batches(df.repartition(3))) == before


@pytest.mark.parametrize(("n", "world"), [(32, 4), (33, 4), (30, 4), (5, 4), (1, 4), (7, 1), (3, 8)])
def test_shards_have_equal_counts_and_wrap_to_the_start(spark, n, world):
    sharded = batching.shard_batches(batching.sequential_batches(rows_of(spark, [1] * n)), world).collect()
    rounds = math.ceil(n / (4 * world))
    found = {(r["step"], r["rank"], r["slot"]): r["id"] for r in sharded}
    assert len(sharded) == len(found) == rounds * world * 4
    for v in range(rounds * world * 4):
        assert found[v // (4 * world), v // 4 % world, v % 4] == v % n


def test_replicated_ranks_read_the_same(spark):
    rows = batching.shard_replicated(batching.sequential_batches(rows_of(spark, [1] * 9)), 3).collect()
    per_rank = {k: sorted((r["step"], r["slot"], r["id"]) for r in rows if r["rank"] == k) for k in range(3)}
    assert per_rank[0] == per_rank[1] == per_rank[2] and len(per_rank[0]) == 9


def test_epochs_and_global_steps(spark):
    sharded = batching.shard_batches(batching.sequential_batches(rows_of(spark, [1] * 20)), 2)
    rows = batching.with_global_step(batching.epoch_replay(sharded, 3)).collect()
    assert len(rows) == 3 * sharded.count()
    assert {r["global_step"] for r in rows} == set(range(9))
    assert all(r["global_step"] == r["epoch"] * 3 + r["step"] for r in rows)


def test_micro_steps(spark):
    steps = spark.range(7).select(batching.micro_to_optimizer_step(F.col("id"), 3).alias("s")).collect()
    assert [r["s"] for r in steps] == [0, 0, 0, 1, 1, 1, 2]


def test_padding_and_labels(spark):
    tokens = spark.createDataFrame(
        [(0, [1, 5, EOS_ID]), (1, [1, 6]), (2, [1]), (3, [1, 7, 8, 9]), (4, [1, 7])],
        "id bigint, input_ids array<int>",
    ).withColumn("n_tokens", F.size("input_ids")).withColumn(
        "attention_mask", F.transform("input_ids", lambda _: F.lit(1).cast("tinyint"))
    )
    assigned = batching.sequential_batches(tokens.select("id", "n_tokens"))
    rows = {
        r["id"]: r
        for r in batching.collate(batching.attach_tokens(batching.batch_max_length(assigned), tokens)).collect()
    }
    assert rows[0]["input_ids"] == [1, 5, EOS_ID, EOS_ID]
    assert rows[0]["attention_mask"] == [1, 1, 1, 0]
    # The true end-of-text of row 0 is ignored like the padding.
    assert rows[0]["labels"] == [1, 5, -100, -100]
    assert rows[2]["labels"] == [1, -100, -100, -100]
    assert rows[3]["labels"] == [1, 7, 8, 9]
    assert rows[4]["input_ids"] == [1, 7]
    for r in rows.values():
        assert sum(r["attention_mask"]) == r["n_tokens"]
        assert [x == -100 for x in r["labels"]] == [x == EOS_ID for x in r["input_ids"]]


def test_batch_stats(spark):
    stats = batching.batch_stats(batching.sequential_batches(rows_of(spark, [3, 1, 2, 3, 5]))).collect()
    assert {tuple(r) for r in stats} == {(0, 4, 9, 3), (1, 1, 5, 0)}
