from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tunemill.operators import batching
from tunemill.session import scratch_path
from tunemill.sources import files, instructions, sinks

SCHEMA = "id bigint, instruction string, response string, context string, category string, split string"
ROWS = [
    (1, "a", "b", None, "qa", "train"),
    (2, "c", "d", "e", "qa", "test"),
    (3, "f", "g", "", "open", "train"),
]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_load_formats(spark, table, tmp_path, file_format):
    path = str(tmp_path / "t")
    table.write.format(file_format).save(path)
    rows = instructions.load_instructions(spark, path, file_format=file_format, schema=SCHEMA)
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(ROWS, key=str)
    assert instructions.load_instructions(spark, path, "test", file_format, SCHEMA).count() == 1


def test_load_csv(spark, table, tmp_path):
    path = str(tmp_path / "t")
    table.write.option("header", True).csv(path)
    rows = instructions.load_instructions(spark, path, "train", "csv", SCHEMA, header=True)
    assert {r["id"] for r in rows.collect()} == {1, 3}


def test_split_directories_are_pruned(spark, table, tmp_path):
    path = str(tmp_path / "t")
    table.write.partitionBy("split").parquet(path)
    train = instructions.load_instructions(spark, path, "train")
    assert {r["id"] for r in train.collect()} == {1, 3}
    assert "PartitionFilters: [isnotnull(split" in plan_of(train)
    assert len(train.inputFiles()) >= 1


def test_optional_columns_and_required_columns(spark):
    df = spark.sql("SELECT 1 AS id, 'a' AS instruction, 'b' AS response, 5 AS extra")
    row = instructions.conform_instructions(df).first()
    assert (row["context"], row["category"], row["extra"]) == (None, None, 5)
    with pytest.raises(ValueError, match="response"):
        instructions.conform_instructions(df.drop("response"))
    with pytest.raises(ValueError, match="split"):
        instructions.split_filter(df)


def test_cached_table_is_built_once(spark, table):
    path = scratch_path(spark, "cache")
    built = []

    def build():
        built.append(1)
        return table

    for _ in range(2):
        assert instructions.cached_table(spark, path, build).count() == 3
    assert built == [1]


def test_cached_table_leaves_an_unfinished_folder_alone(spark, table, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "part").write_text("half")
    with pytest.raises(AnalysisException):
        instructions.cached_table(spark, str(tmp_path / "x"), lambda: table)
    assert (tmp_path / "x" / "part").read_text() == "half"


def test_manifest_and_pending_files(spark, tmp_path):
    (tmp_path / "repo" / "sub").mkdir(parents=True)
    (tmp_path / "repo" / "a.bin").write_bytes(b"12")
    (tmp_path / "repo" / "sub" / "b.bin").write_bytes(b"1234")
    present = files.list_files(spark, str(tmp_path))
    names = spark.createDataFrame(
        [("repo", "a.bin", 2), ("repo", "sub/b.bin", 9), ("repo", "c.bin", 1), ("repo", "c.bin", 1)],
        "repo string, name string, length bigint",
    )
    models = spark.createDataFrame([("repo", "repo")], "lib string, repo string")
    manifest = files.file_manifest(models, names, f"{tmp_path}/").withColumn(
        "length", F.when(F.col("name") == "sub/b.bin", 9).when(F.col("name") == "a.bin", 2).otherwise(1).cast("bigint")
    )
    assert [r["name"] for r in files.pending_files(manifest, present).collect()] == ["c.bin"]
    by_length = files.pending_files(manifest, present, match_length=True).collect()
    assert {r["name"] for r in by_length} == {"c.bin", "sub/b.bin"}


def test_written_batches_are_read_by_rank(spark, tmp_path):
    path = str(tmp_path / "batches")
    batches = spark.range(40).select(
        (F.col("id") % 4).cast("int").alias("rank"), (F.col("id") / 8).cast("bigint").alias("step"),
        (F.col("id") % 2).cast("int").alias("slot"), "id",
    )
    sinks.write_batches(batches, path, steps_per_file=2)
    assert sorted(map(tuple, sinks.read_batches(spark, path).select(*batches.columns).collect())) == sorted(
        map(tuple, batches.collect())
    )
    one = sinks.read_batches(spark, path, 3)
    assert one.count() == 10
    assert "PartitionFilters: [isnotnull(rank" in plan_of(one)


def test_epochs_are_not_mixed(spark, tmp_path):
    path = str(tmp_path / "batches")
    batches = spark.range(48).select(
        (F.col("id") % 2).cast("int").alias("rank"), (F.col("id") / 24).cast("int").alias("epoch"),
        (F.col("id") % 24 / 4).cast("bigint").alias("step"), (F.col("id") / 2 % 2).cast("int").alias("slot"), "id",
    )
    sinks.write_batches(batches, path)
    for file in (tmp_path / "batches" / "rank=1").glob("*.parquet"):
        order = [(r["epoch"], r["step"], r["slot"]) for r in spark.read.parquet(str(file)).collect()]
        assert order == sorted(order)


def test_scratch_folder_comes_from_the_session(spark, conf):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


METRICS = "run_id bigint, rank int, epoch int, step bigint, global_step bigint, key string, value double"


def table_at(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*sinks.METRIC_COLUMNS).collect()), key=repr)


def test_metrics_written_twice_are_there_once(spark, tmp_path):
    path = str(tmp_path / "metrics")
    rows = [(run, 0, 0, s, s + 1, "loss", float(s)) for run in (1, 2, None) for s in range(3)]
    df = spark.createDataFrame(rows, METRICS)
    sinks.append_metrics(df.where("step < 2"), path)
    sinks.append_metrics(df.withColumn("value", F.lit(9.0)).union(df), path)
    found = table_at(spark, path)
    # What is held stays; of new rows with one name one is taken.
    assert [r[:6] for r in found] == sorted([r[:6] for r in rows], key=repr)
    assert all(r[6] == r[3] for r in found if r[3] < 2)
    sinks.append_metrics(df, path)
    assert table_at(spark, path) == found


def test_upserted_metrics_replace_what_is_held(spark, tmp_path):
    path = str(tmp_path / "metrics")
    rows = [(run, 0, 0, s, s + 1, "loss", float(s)) for run in range(40) for s in range(3)] + [(None, 0, 0, 0, 1, "loss", 5.0)]
    df = spark.createDataFrame(rows, METRICS)
    sinks.upsert_metrics(df, path)
    files = {f for f in spark.read.parquet(path).inputFiles()}
    changed = df.where("run_id = 7 AND step > 0 OR run_id IS NULL").withColumn("value", F.lit(-1.0))
    added = spark.createDataFrame([(7, 0, 0, 3, 4, "loss", 3.0), (7, 0, 0, 3, 4, "loss", 3.0)], METRICS)
    for _ in range(2):
        sinks.upsert_metrics(changed.union(added), path)
    expected = [(*r[:6], -1.0) if r[0] is None or (r[0] == 7 and r[3] > 0) else r for r in rows] + [(7, 0, 0, 3, 4, "loss", 3.0)]
    assert table_at(spark, path) == sorted(expected, key=repr)
    some = sinks.read_metrics(spark, path, [7, 8])
    assert sorted(map(tuple, some.collect())) == sorted(r for r in expected if r[0] in (7, 8))
    # Buckets of other runs keep their files.
    kept = files & set(spark.read.parquet(path).inputFiles())
    assert len(files) - 2 <= len(kept) < len(files)


def test_clustered_batches_hold_batches_whole(spark, tmp_path):
    df = batching.sequential_batches(spark.range(100).withColumn("n_tokens", F.lit(1)))
    sinks.write_clustered(df, "clustered_test", str(tmp_path / "clustered"), buckets=4)
    table = sinks.read_clustered(spark, "clustered_test")
    assert sorted(table.select(*df.columns).collect()) == sorted(df.collect())
    for file in (tmp_path / "clustered").glob("*.parquet"):
        order = [(r["batch_id"], r["slot"]) for r in spark.read.parquet(str(file)).collect()]
        assert order == sorted(order)
    spark.sql("DROP TABLE clustered_test")


def test_files_are_listed_by_tasks(spark, tmp_path):
    sizes = {"a.txt": 3, "one/b.bin": 0, "one/two/c": 5, "one/two/three/d d.txt": 7, "other/e": 1}
    for name, size in {**sizes, "_hidden": 2, ".dot/f": 2, "one/_SUCCESS": 0}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    (tmp_path / "empty").mkdir()
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        found = files.list_files(spark, root, tasks=3)
        assert {r["target_path"].removeprefix(f"{tmp_path}/"): r["length"] for r in found.collect()} == sizes
    assert files.list_files(spark, str(tmp_path / "empty")).count() == 0


@pytest.fixture
def source(spark, table, tmp_path):
    path = str(tmp_path / "source")
    table.write.parquet(path)
    return path


def builds(folder):
    return sorted(p.name for p in folder.iterdir()) if folder.exists() else []


def test_a_build_is_used_again_until_its_source_changes(spark, table, source, tmp_path):
    folder = tmp_path / "builds"

    def build(value=1):
        return spark.read.parquet(source).where(F.col("id") > value - 1).withColumn("n", F.length("instruction"))

    first = instructions.content_cached(build(), str(folder))
    file = next((folder / builds(folder)[0]).glob("*.parquet"))
    written = file.stat().st_mtime_ns
    again = instructions.content_cached(build(), str(folder))
    assert len(builds(folder)) == 1 and file.stat().st_mtime_ns == written
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect())) == sorted(map(tuple, build().collect()))
    # Another constant in the plan, then another file in the source.
    assert instructions.content_cached(build(2), str(folder)).count() == 2 and len(builds(folder)) == 2
    table.write.mode("append").parquet(source)
    assert instructions.content_cached(build(), str(folder)).count() == 6 and len(builds(folder)) == 3
    assert first.count() == 3


def test_two_writers_leave_one_build(spark, source, tmp_path):
    folder = tmp_path / "builds"
    with ThreadPoolExecutor(4) as pool:
        tables = list(pool.map(lambda _: instructions.content_cached(spark.read.parquet(source), str(folder)), range(4)))
    assert [t.count() for t in tables] == [3] * 4
    assert len(builds(folder)) == 1
    inside = sorted(p.name for p in (folder / builds(folder)[0]).iterdir() if p.is_dir())
    assert inside == []


def test_rows_of_no_file_have_no_content_key(spark, table, tmp_path):
    with pytest.raises(ValueError, match="read from files"):
        instructions.content_cached(table, str(tmp_path / "builds"))
