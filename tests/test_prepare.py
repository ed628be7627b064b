from pyspark.sql import functions as F

from tunemill.plans import prepare

ROWS = [(i, f"Question {i} " * (i % 7 + 1), "ctx" if i % 3 else None, "Answer " * (i % 5 + 1)) for i in range(50)]


def test_instructions_become_batches(spark):
    df = spark.createDataFrame(ROWS, "id bigint, instruction string, context string, response string")
    tokens = prepare.stored(prepare.prompt_tokens(df, 100), "tokens")
    rows = prepare.trainer_epochs(tokens, 2).collect()
    orders = []
    for epoch in range(2):
        mine = [r for r in rows if r["epoch"] == epoch]
        assert len(mine) == 56 and {r["id"] for r in mine} == set(range(50))
        per_rank = [sum(r["rank"] == rank for r in mine) for rank in range(2)]
        assert per_rank == [28, 28]
        orders.append([r["id"] for r in sorted(mine, key=lambda r: (r["step"], r["rank"], r["slot"]))])
        for batch in {r["batch_id"] for r in mine}:
            assert len({len(r["input_ids"]) for r in mine if r["batch_id"] == batch}) == 1
    assert orders[0] != orders[1]


def test_tokens_need_not_be_stored(spark):
    df = spark.createDataFrame(ROWS, "id bigint, instruction string, context string, response string")
    tokens = prepare.prompt_tokens(df, 100)
    lazy = prepare.trainer_batches(tokens, 2, seed=1)
    kept = prepare.trainer_batches(prepare.stored(tokens, "tokens"), 2, seed=1)
    assert lazy.select(*kept.columns).exceptAll(kept).count() == 0
    assert prepare.manual_batches(tokens).where(F.size("labels") != F.col("batch_length")).count() == 0


def test_epochs_of_one_plan_are_those_planned_apart(spark):
    df = spark.createDataFrame(ROWS, "id bigint, instruction string, context string, response string")
    tokens = prepare.stored(prepare.prompt_tokens(df, 100), "tokens")
    columns = ["rank", "step", "slot", "id", "batch_id", "input_ids", "labels"]
    together = prepare.trainer_epochs(tokens, 3, epochs=3, seed="x").collect()
    for epoch in range(3):
        apart = prepare.trainer_batches(tokens, 3, seed=f"x:{epoch}").select(*columns).collect()
        mine = [tuple(r[c] for c in columns) for r in together if r["epoch"] == epoch]
        assert sorted(mine, key=repr) == sorted(map(tuple, apart), key=repr)
