import random

import pytest

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tunemill.operators import positions
from tunemill.operators.positions import (
    running_total_before,
    with_cut_position,
    with_id_position,
    with_shuffled_position,
)

# An error inside a subquery or a first stage comes in a wrapping of its own.
RAISED = (PySparkException, Py4JJavaError)


def ids_of(kind, rng):
    if kind == "dense":
        return list(range(500))
    if kind == "sparse":
        return sorted({rng.randrange(-(2**63), 2**63) for _ in range(500)})
    # A third of the ids in one narrow range, the rest far apart.
    return sorted(set(range(7_000_000, 7_000_170)) | set(rng.sample(range(2**50), 330)))


@pytest.mark.parametrize("kind", ["dense", "sparse", "clustered"])
@pytest.mark.parametrize(("id_bits", "bits"), [(16, 24), (3, 4), (0, 1)])
def test_positions_are_the_sorted_order(spark, kind, id_bits, bits):
    rng = random.Random(5)
    ids = ids_of(kind, rng)
    shuffled = rng.sample(ids, len(ids))
    df = spark.createDataFrame([(i,) for i in shuffled], "id bigint")
    rows = with_id_position(df, id_bits=id_bits, bits=bits).collect()
    assert sorted((r["position"], r["id"]) for r in rows) == list(enumerate(ids, 1))


def test_positions_within_keys_of_very_different_size(spark):
    rng = random.Random(6)
    rows = [(i, 0 if rng.random() < 0.34 else rng.randrange(1, 40)) for i in rng.sample(range(10**6), 900)]
    df = spark.createDataFrame(rows, "id bigint, k int")
    found = with_id_position(df, keys=["k"], id_bits=8, bits=5).collect()
    for key in {k for _, k in rows}:
        expected = list(enumerate(sorted(i for i, k in rows if k == key), 1))
        assert sorted((r["position"], r["id"]) for r in found if r["k"] == key) == expected


def test_shuffled_positions_depend_on_seed_alone(spark, conf):
    df = spark.range(300)
    orders = []
    for partitions in ("1", "8", "64"):
        conf("spark.sql.shuffle.partitions", partitions)
        orders.append(sorted(with_shuffled_position(df, 3).collect()))
    assert orders[0] == orders[1] == orders[2]
    assert sorted(with_shuffled_position(df, 4).collect()) != orders[0]
    assert sorted(r["position"] for r in orders[0]) == list(range(1, 301))


def test_running_total_with_small_blocks(spark):
    rng = random.Random(7)
    rows = [(k, at, rng.randrange(5)) for k in "ab" for at in rng.sample(range(10_000), 200)]
    df = spark.createDataFrame(rows, "k string, at bigint, v int")
    for r in running_total_before(df, ["k"], "at", "v", "before", bits=6).collect():
        assert r["before"] == sum(v for k, at, v in rows if k == r["k"] and at < r["at"])


@pytest.mark.parametrize("rows", [[(None, 1)], [(1, None)]])
def test_null_orders_and_groups_nothing(spark, rows):
    df = spark.createDataFrame([*rows, (2, 2)], "id bigint, k bigint")
    with pytest.raises(RAISED, match="NULL in"):
        with_id_position(df, "id", ["k"]).collect()


@pytest.mark.parametrize("kind", ["dense", "sparse", "clustered", "one"])
def test_cut_positions_are_the_sorted_order(spark, kind):
    rng = random.Random(8)
    ids = [42] if kind == "one" else ids_of(kind, rng)
    df = spark.createDataFrame([(i, "x") for i in rng.sample(ids, len(ids))], "id bigint, position string")
    rows = with_cut_position(df).collect()
    assert sorted((r["position"], r["id"]) for r in rows) == list(enumerate(ids, 1))
    assert {r["_rows"] for r in rows} == {len(ids)}


def test_ranges_hold_nearly_equal_numbers_of_rows(spark):
    # Half of the ids in a narrow band, the others spread over 2^62.
    df = spark.range(200_000).selectExpr("IF(id % 2 = 0, id, id << 44) AS id")
    sizes = [r["count"] for r in positions._range_by_cuts(df, "id").groupBy("_range").count().collect()]
    assert len(sizes) > 3900 and max(sizes) <= 4 * 200_000 / positions.RANGES


def test_no_rows_and_null_ids(spark):
    empty = spark.createDataFrame([], "id bigint")
    assert with_cut_position(empty).count() == 0 and with_shuffled_position(empty, 1, epochs=2).count() == 0
    with pytest.raises(RAISED, match="NULL in id"):
        with_cut_position(spark.createDataFrame([(None,), (1,)], "id bigint")).collect()


def test_epochs_are_the_orders_of_their_seeds(spark):
    df = spark.range(500)
    both = with_shuffled_position(df, "s", epochs=3).collect()
    for epoch in range(3):
        alone = {(r["id"], r["position"], r["_rows"]) for r in with_shuffled_position(df, f"s:{epoch}").collect()}
        assert {(r["id"], r["position"], r["_rows"]) for r in both if r["epoch"] == epoch} == alone
