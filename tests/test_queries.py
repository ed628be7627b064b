"""Every query against its SQL counterpart."""

import os

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from tunemill.plans.oracles import ORACLES
from tunemill.plans.queries import QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = database.execute(ORACLES[name])
    theirs = [c[0] for c in cursor.description]
    assert sorted(theirs) == columns
    expected = [tuple(row[theirs.index(c)] for c in columns) for row in cursor.fetchall()]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["rank", "step", "slot", "id", "input_ids", "attention_mask", "labels"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["training_batches", "bigram_train_loss", "metrics_sink", "load_instructions"])
@pytest.mark.parametrize("partitions", ["1", "50"])
def test_results_do_not_depend_on_partitions(spark, database, conf, name, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    test_query(spark, database, name)
