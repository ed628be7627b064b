import json
from functools import reduce

import pytest
from conftest import plan_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.functions import configs as cf
from tunemill.operators import tracking
from tunemill.sources import configs, sinks


def test_config_from_dict_and_from_file_agree(spark, tmp_path):
    config = configs.engine_config()
    path = tmp_path / "engine.json"
    path.write_text(json.dumps(config, indent=2))
    shown = F.to_json("config").alias("c")
    from_dict = configs.load_config(spark, config).select(shown).first()["c"]
    from_file = configs.load_config(spark, str(path)).select(shown).first()["c"]
    assert from_dict == from_file
    assert json.loads(from_dict) == config


@pytest.mark.parametrize("config", [None, 5])
def test_config_of_another_kind_is_an_error(spark, config):
    with pytest.raises(ValueError, match="dict or the path"):
        configs.load_config(spark, config)


def test_variants_replace_the_memory_section_as_a_whole(spark):
    base = {"a": 1, "zero_optimization": {"stage": 0, "left_over": True}}
    variants = configs.config_variants(spark, base).select("stage", F.to_json("config").alias("c")).collect()
    assert {r["stage"]: json.loads(r["c"]) for r in variants} == {
        stage: {"a": 1, "zero_optimization": section} for stage, section in configs.ZERO_STAGES.items()
    }


def test_offload_and_optimizer(spark):
    device = cf.offload_device(F.col("config"))
    rows = configs.config_variants(spark).select(
        "stage", device.alias("device"), cf.optimizer_choice(device).alias("optimizer")
    )
    found = {r["stage"]: (r["device"], r["optimizer"]) for r in rows.collect()}
    assert found["stage_3_offload"] == ("cpu", "DeepSpeedCPUAdam")
    assert {found[s] for s in ("stage_1", "stage_2", "stage_3")} == {(None, "FusedAdam")}


@pytest.mark.parametrize("config", [{}, {"zero_optimization": {}}, {"zero_optimization": 3}])
def test_offload_absent(spark, config):
    assert configs.load_config(spark, config).select(cf.offload_device(F.col("config"))).first()[0] is None


def test_prefix_reaches_top_level_keys_only(spark):
    df = configs.load_config(spark, {"a": 1, "b": {"c": 2}})
    found = df.select(F.to_json(cf.prefix_keys(F.col("config")))).first()[0]
    assert json.loads(found) == {"ds_a": 1, "ds_b": {"c": 2}}


def test_unknown_stage_is_an_error(spark):
    runs = spark.createDataFrame([(1, "stage_9")], "run_id int, stage string")
    with pytest.raises(PySparkException, match="stage_9"):
        tracking.select_variant(runs).collect()


def test_names_layout_and_parents(spark):
    runs = spark.createDataFrame(
        [(1, None, 0, 2, 1), (2, 1, 1, 2, 3)],
        "run_id int, parent_run_id int, rank int, gpus int, nodes int",
    )
    rows = runs.orderBy("run_id").select(
        cf.run_name(F.lit("r"), F.col("rank")).alias("name"),
        cf.num_processes(F.col("gpus"), F.col("nodes")).alias("n"),
        cf.is_local(F.col("nodes")).alias("local"),
        cf.global_batch_size(4, 1, cf.num_processes(F.col("gpus"), F.col("nodes"))).alias("size"),
        cf.multinode_parent(F.col("nodes"), F.col("parent_run_id")).alias("parent"),
    ).collect()
    assert [tuple(r) for r in rows] == [("r", 2, True, 8, None), ("r_rank_1", 6, False, 24, 1)]


def test_conflicts_of_the_fixed_values(spark):
    """The two sides agree on what they share and differ in three places."""
    engine = configs.load_config(spark, configs.engine_config()).withColumn("run_id", F.lit(1))
    trainer = configs.load_config(
        spark, {**configs.TRAINER_VALUES, "betas": [0.9, 0.95]}
    ).withColumn("run_id", F.lit(1))
    params = tracking.engine_params(engine, F.col("config")).union(
        sinks.explode_params(trainer, F.col("config"), tracking.TRAINER)
    )
    found = {r["trainer_key"]: (r["trainer_value"], r["engine_value"]) for r in tracking.config_conflicts(params).collect()}
    assert found == {
        "betas": ("[0.9,0.95]", "[0.9,0.999]"),
        "optim": ("paged_adamw_32bit", "AdamW"),
        "lr_scheduler_type": ("constant", "WarmupLR"),
    }


def test_engine_params_leave_out_what_is_not_set(spark):
    df = configs.load_config(spark, {"optimizer": {"type": "X"}}).withColumn("run_id", F.lit(1))
    rows = tracking.engine_params(df, F.col("config")).collect()
    assert [tuple(r) for r in rows] == [(1, "ds_", "optimizer.type", "X")]


@pytest.mark.parametrize(
    ("trainer", "engine", "conflict"),
    [
        ("4", "4.0", False),
        ("4", "8", True),
        ("True", "true", False),
        ("auto", "8", False),
        ("4", "auto", False),
        ("4", None, True),
        (None, "4", True),
        ("x", "4", True),
        ("[0.9, 0.999]", "[0.9,0.999]", False),
        ("[0.9, 0.95]", "[0.9,0.999]", True),
    ],
)
def test_agreement(spark, trainer, engine, conflict):
    rows = [(1, "hf", "per_device_train_batch_size", trainer)] if trainer else []
    rows += [(1, "ds_", "train_micro_batch_size_per_gpu", engine)] if engine else []
    df = spark.createDataFrame(rows, "run_id int, source string, key string, value string")
    assert (tracking.config_conflicts(df).count() == 1) == conflict


def test_run_tree(spark):
    runs = spark.createDataFrame(
        [(1, None, "p", 0), (2, 1, "c", 1), (3, 9, "orphan", 2)],
        "run_id bigint, parent_run_id bigint, run_name string, rank int",
    )
    rows = tracking.run_tree(runs).orderBy("run_id").collect()
    assert [(r["run_id"], r["parent_name"], r["parent_rank"]) for r in rows] == [
        (1, None, None), (2, "p", 0), (3, None, None),
    ]


def test_params_and_metrics_are_appended(spark, tmp_path):
    path = str(tmp_path / "params")
    runs = configs.load_config(spark, {"a": 1, "b": {"c": "x"}}).withColumn("run_id", F.lit(7))
    sinks.append_params(sinks.explode_params(runs, F.col("config"), "hf"), path)
    sinks.append_params(sinks.explode_params(runs, cf.prefix_keys(F.col("config")), "ds_"), path)
    assert {tuple(r) for r in spark.read.parquet(path).select(*sinks.PARAM_COLUMNS).collect()} == {
        (7, "hf", "a", "1"), (7, "hf", "b", '{"c":"x"}'),
        (7, "ds_", "ds_a", "1"), (7, "ds_", "ds_b", '{"c":"x"}'),
    }
    path = str(tmp_path / "metrics")
    metrics = spark.sql(
        "SELECT 1L run_id, 0 rank, 0 epoch, 3L step, 3L global_step, 'train_loss' key, 0.5D value, 9 extra"
    )
    sinks.append_metrics(metrics, path)
    sinks.append_metrics(metrics, path)
    sinks.append_metrics(metrics.withColumn("global_step", F.lit(4).cast("bigint")), path)
    stored = sinks.read_metrics(spark, path)
    assert stored.columns == sinks.METRIC_COLUMNS and stored.count() == 2
    assert tracking.rank0_metrics(stored).count() == 2


def test_a_cut_off_file_is_an_error(spark, tmp_path):
    (tmp_path / "engine.json").write_text('{"a": 1, "b": {')
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)malformed|corrupt|parse"):
        configs.load_config(spark, str(tmp_path / "engine.json")).collect()


def test_two_files_are_no_configuration(spark, tmp_path):
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text("{}")
    with pytest.raises(PySparkException, match="not one file"):
        configs.load_config(spark, str(tmp_path)).collect()


def test_batch_size_is_resolved_in_the_configuration(spark):
    runs = spark.createDataFrame([(1, 2, 3, "r")], "run_id int, gpus int, nodes int, run_name string")
    factors = {"train_batch_size": "auto", "train_micro_batch_size_per_gpu": 4, "gradient_accumulation_steps": 5}
    row = tracking.resolve_batch_size(runs.withColumn("config", configs.config_literal(factors)))
    shown = row.select("global_batch_size", F.to_json("config").alias("c")).first()
    assert shown["global_batch_size"] == 120 and json.loads(shown["c"]) == {**factors, "train_batch_size": 120}
    params = {(r["source"], r["key"]): r["value"] for r in tracking.logged_params(row, "/out").collect()}
    assert params["hf", "output_dir"] == "/out" and params["hf", "run_name"] == "r"
    assert json.loads(params["hf", "deepspeed"])["train_batch_size"] == 120
    assert params["ds_", "ds_train_batch_size"] == "120" and ("hf", "ddp_find_unused_parameters") in params
    odd = runs.withColumn("config", configs.config_literal({"train_batch_size": "auto"}))
    assert tracking.resolve_batch_size(odd).select(F.to_json("config")).first()[0] == '{"train_batch_size":"auto"}'


def test_a_launch_becomes_its_runs(spark):
    launches = spark.createDataFrame(
        [(7, 2, 1, "x", 3), (8, 1, 2, "y", 3)], "launch_id int, gpus int, nodes int, run_name string, parent_run_id int"
    )
    assert sorted(map(tuple, tracking.expand_runs(launches).collect())) == [
        (7, 0, "x", None), (7, 1, "x_rank_1", None), (8, 0, "y", 3), (8, 1, "y_rank_1", 3),
    ]


def test_repeated_parameters_are_conflicts(spark):
    rows = [(1, "hf", "bf16", "true"), (1, "hf", "bf16", "false"), (1, "ds_", "bf16.enabled", "true")]
    df = spark.createDataFrame(rows, "run_id int, source string, key string, value string")
    assert [r["trainer_value"] for r in tracking.config_conflicts(df).collect()] == ["false | true"]


def test_leaves_at_any_depth(spark):
    config = {"a": 1, "b": {"c": {"d": {"e": "x"}}, "f": [1, {"g": 2}], "h": {}}, "i.j": {"k.l": None}, "m": False}
    df = configs.load_config(spark, config).withColumn("run_id", F.lit(1))
    found = {r["key"]: r["value"] for r in tracking.config_leaves(df).collect()}
    assert found == {"a": "1", "b.c.d.e": "x", "b.f": '[1,{"g":2}]', "b.h": "{}", "`i.j`.`k.l`": None, "m": "false"}
    assert tracking.config_leaves(df.where("run_id = 2")).count() == 0


def test_conflicts_at_any_depth_by_pairs_of_a_table(spark):
    sides = {"hf": {"x": {"y": {"z": 1, "same": 2}}, "only": 1}, "ds_": {"p": {"q": {"z": 3, "same": 2.0}}}}
    params = reduce(
        DataFrame.union,
        [
            tracking.config_leaves(configs.load_config(spark, config).withColumn("run_id", F.lit(5)), source=source)
            for source, config in sides.items()
        ],
    )
    pairs = spark.createDataFrame(
        [("x.y.z", "p.q.z"), ("x.y.z", "p.q.z"), ("x.y.same", "p.q.same"), ("only", "p.none")], "trainer_key string, engine_key string"
    )
    rows = {tuple(r[c] for c in ("run_id", "trainer_key", "engine_key", "trainer_value", "engine_value")) for r in tracking.config_conflicts(params, pairs).collect()}
    assert rows == {(5, "x.y.z", "p.q.z", "1", "3"), (5, "only", "p.none", "1", None)}


def test_sets_begin_after_the_rows_are_dealt_out(spark):
    """Else a task's memory follows what it reads."""
    params = spark.createDataFrame([(1, "hf", "optim", "a")], "run_id long, source string, key string, value string")
    plan = plan_of(tracking.config_conflicts(params))
    below = plan[plan.index("Exchange hashpartitioning(run_id") :]
    assert "collect_set" in plan and "collect_set" not in below


def test_pairs_travel_to_the_parameters(spark, tmp_path):
    """Parameters that repeat are small on disk, yet not small in memory."""
    one = spark.range(1000).selectExpr("id AS run_id", "'hf' AS source", "'optim' AS key", "'a' AS value")
    one.write.parquet(str(tmp_path / "params"))
    params = spark.read.parquet(str(tmp_path / "params"))
    keys = spark.range(1000, 3000).selectExpr("'optim' AS trainer_key", "concat('key', id) AS engine_key")
    plan = plan_of(tracking.config_conflicts(params, keys))
    assert "FileScan" in plan and "FileScan" not in plan[plan.index("BroadcastExchange") :]
