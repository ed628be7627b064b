import collections

import pytest
import regex
from conftest import plan_of
from pyspark.errors import PySparkException

from tunemill.functions.tokens import BOS_ID, UNK_ID
from tunemill.operators.tokenization import Vocabulary, build_vocab, tokenize

TEXTS = [
    (1, "The cat, the dog."),
    (2, ""),
    (3, "Étude n° 5: naïve — 東京 2024!"),
    (4, "the the the the"),
    (5, None),
    (6, "cat " * 700),
]


def split(text):
    return regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]", text.lower()) if text else []


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id bigint, text string")


def expected_vocab(size):
    counts = collections.Counter(t for _, text in TEXTS for t in split(text))
    ranked = sorted(counts, key=lambda t: (-counts[t], t.encode()))
    return {t: i + 3 for i, t in enumerate(ranked[:size])}


@pytest.mark.parametrize("size", [4, 100])
def test_vocabulary_is_the_most_frequent_tokens(texts, size):
    found = {r["token"]: r["token_id"] for r in build_vocab(texts, size).table.collect()}
    assert found == expected_vocab(size)


@pytest.mark.parametrize("joined", [False, True])
@pytest.mark.parametrize("max_length", [None, 512, 3])
def test_ids_masks_and_lengths(texts, joined, max_length):
    vocab = expected_vocab(6)
    rows = tokenize(
        texts, build_vocab(texts, 6), max_length=max_length, joined=joined
    ).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        ids = [BOS_ID] + [vocab.get(t, UNK_ID) for t in split(row["text"])]
        assert row["input_ids"] == ids[:max_length]
        assert row["attention_mask"] == [1] * len(row["input_ids"])
        assert row["n_tokens"] == len(row["input_ids"])


@pytest.mark.parametrize(("words", "kept"), [(510, 511), (511, 512), (512, 512), (513, 512)])
def test_bos_counts_in_the_cut(spark, words, kept):
    df = spark.createDataFrame([(1, "w " * words)], "id bigint, text string")
    assert tokenize(df, build_vocab(df, 5)).first()["n_tokens"] == kept


@pytest.mark.parametrize(("words", "kept"), [(511, 511), (512, 512), (513, 512)])
def test_cut_without_bos(spark, words, kept):
    df = spark.createDataFrame([(1, "w " * words)], "id bigint, text string")
    assert tokenize(df, build_vocab(df, 5), add_bos=False).first()["n_tokens"] == kept


def test_stored_vocabulary(spark, texts, tmp_path):
    build_vocab(texts, 6).table.write.parquet(str(tmp_path / "vocab"))
    vocabulary = Vocabulary.read(spark, str(tmp_path / "vocab"))
    assert vocabulary.size == 6
    assert tokenize(texts, vocabulary).count() == len(TEXTS)


def test_lookup_needs_no_shuffle_and_no_copy_of_the_vocabulary(spark, texts):
    vocabulary = Vocabulary(spark.sql("SELECT 'the' AS token, 3 AS token_id"), 1)
    plan = plan_of(tokenize(texts, vocabulary).select("id", "input_ids"))
    main = plan.split("Subquery")[0] + plan.split("Scan ExistingRDD")[-1]
    assert "Exchange" not in main and "Join" not in main
    assert "Python" not in plan
    # The subquery is an argument of the lookup, not a column of its own.
    assert "_lookup" not in plan


@pytest.mark.parametrize(("ids", "message"), [([None, 1], "NULL in id"), ([1, 1], "repeated id 1")])
def test_the_join_needs_ids(spark, ids, message):
    df = spark.createDataFrame([(ids[0], "a a"), (ids[1], "a b a")], "id bigint, text string")
    vocabulary = build_vocab(df, 5)
    with pytest.raises(PySparkException, match=message):
        tokenize(df, vocabulary, joined=True).collect()
    assert [r["n_tokens"] for r in tokenize(df, vocabulary).collect()] == [3, 4]


def test_the_join_shuffles_places_as_numbers(spark, texts, conf):
    """No lists that are put together before a shuffle, no salt in the rows."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    vocabulary = Vocabulary(spark.createDataFrame([("the", 3), ("cat", 4)], "token string, token_id int"), 2)
    plan = plan_of(tokenize(texts, vocabulary, joined=True).select("id", "input_ids"))
    assert "collect_list" in plan and "collect_list" not in plan[plan.index("REPARTITION_BY_COL") :]
    assert "pmod(pos" in plan and "AS salt" not in plan.split("pmod(pos")[0]
