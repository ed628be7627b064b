import pytest
from pyspark.sql import functions as F

from tunemill.operators import batching, user_functions


def test_map_rows_merges_the_result(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, text string")
    rows = user_functions.map_rows(
        df, lambda r: {"text": f"{r['text']}!", "n": r["id"] + 1}, "text string, n bigint"
    ).collect()
    assert {tuple(r) for r in rows} == {(1, "a!", 2), (2, "None!", 3)}


def test_tokenizer_is_loaded_once_per_task(spark, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    df = spark.createDataFrame([(i, "ab" * i) for i in range(6)], "id bigint, text string").coalesce(1)

    def load():
        calls = []

        def encode(texts):
            calls.append(1)
            return [[len(t), len(calls)] for t in texts]

        return encode

    rows = user_functions.tokenize_with(df, load).orderBy("id").collect()
    assert [r["input_ids"] for r in rows] == [[0, 1], [2, 1], [4, 2], [6, 2], [8, 3], [10, 3]]
    cut = user_functions.tokenize_with(df, load, max_length=1).orderBy("id").collect()
    assert [r["input_ids"] for r in cut] == [[0], [2], [4], [6], [8], [10]]


def test_public_tokenizer_plugs_in(spark):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")

    def load():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    df = spark.createDataFrame([(1, "hello world"), (2, "")], "id bigint, text string")
    rows = user_functions.tokenize_with(df, load).orderBy("id").collect()
    assert len(rows[0]["input_ids"]) == 2 and rows[1]["input_ids"] == []


@pytest.mark.parametrize("transfer", ["1", "3", "1000"])
def test_collate_sees_whole_batches(spark, conf, transfer):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", transfer)
    df = batching.sequential_batches(spark.range(10))

    def sizes(batch):
        return batch.assign(n=len(batch))[["id", "n"]]

    rows = user_functions.collate_batches(df, sizes, "id bigint, n bigint").collect()
    assert {(r["id"], r["n"]) for r in rows} == {(i, 4 if i < 8 else 2) for i in range(10)}


def test_step_ranges_of_a_rank(spark):
    df = batching.shard_batches(batching.sequential_batches(spark.range(40)), 4)

    def trace(frame):
        import pandas as pd

        return pd.DataFrame({"rank": [int(frame["rank"].iloc[0])], "ids": [",".join(map(str, frame["id"]))]})

    rows = user_functions.map_step_ranges(df, trace, "rank int, ids string", steps=2).collect()
    order = [*range(40), *range(8)]
    expected = {
        (r, ",".join(str(order[v]) for v in range(48) if v // 4 % 4 == r and v // 32 == part)) for r in range(4) for part in range(2)
    }
    assert {tuple(r) for r in rows} == expected


def test_map_rows_keeps_values(spark):
    rows = [(2**53 + 1, float("nan"), None), (None, None, "x")]
    df = spark.createDataFrame(rows, "id bigint, v double, t string")
    found = user_functions.map_rows(df, lambda r: {"n": r["id"], "t": repr(r["t"])}, "n bigint, t string").collect()
    first, second = sorted(found, key=lambda r: r["t"], reverse=True)
    assert (first["id"], first["n"], first["t"]) == (2**53 + 1, 2**53 + 1, "None") and first["v"] != first["v"]
    assert (second["id"], second["n"], second["v"], second["t"]) == (None, None, None, "'x'")


def test_tokenizer_contract(spark):
    df = spark.createDataFrame([(1, None), (2, "a" * 600)], "id bigint, text string")
    rows = user_functions.tokenize_with(df, lambda: lambda texts: [list(t.encode()) for t in texts]).orderBy("id").collect()
    assert [(r["n_tokens"], len(r["input_ids"]), len(r["attention_mask"])) for r in rows] == [(0, 0, 0), (512, 512, 512)]


def test_rows_are_packed_by_first_fit():
    import pandas as pd

    batch = pd.DataFrame({"batch_id": [5] * 5, "input_ids": [[1] * 4, [2] * 6, [3] * 2, [4] * 5, [5]]})
    packs = user_functions.packed_rows(batch, pad_id=9)
    assert packs["input_ids"].tolist() == [[1] * 4 + [3] * 2, [2] * 6, [4] * 5 + [5]]
    assert packs["segments"].tolist() == [[0] * 4 + [1] * 2, [0] * 6, [0] * 5 + [1]]
    wide = user_functions.packed_rows(batch, capacity=8, pad_id=9)
    assert wide["input_ids"].tolist() == [[1] * 4 + [3] * 2 + [5] + [9], [2] * 6 + [9] * 2, [4] * 5 + [9] * 3]
    small = user_functions.packed_rows(batch, capacity=3)
    assert [len(ids) for ids in small["input_ids"]] == [6] * 4
    assert small["pack"].tolist() == [0, 1, 2, 3] and set(small["batch_id"]) == {5}
