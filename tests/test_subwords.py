"""Byte-pair coding against a plain version and a public library."""

import base64
import random
from types import SimpleNamespace

import pyarrow as pa
import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tunemill.functions import byte_pairs
from tunemill.operators import batching, subwords, user_functions
from tunemill.plans.queries import RANK_FILE

ODD = [
    (1, ""),
    (2, None),
    (3, "Hello  world\n\n  it's 123 naïve 日本語🙂   x  y"),
    (4, "a" * 30_000),
    (5, "don't  \t\n"),
    (6, "\x1c\x1cz\x85q\x01"),
    (7, "   "),
    (7, "   "),
    (None, "no id"),
]


def small_ranks():
    """256 bytes and merges of a few letters, some of them reachable in two ways."""
    pieces = [bytes([b]) for b in range(256)]
    pieces += [b"ab", b"bc", b"abc", b"aa", b"aaaa", b"ca", b"abca", b"bca", b"\xc3\xa9", b" a"]
    return {piece: rank for rank, piece in enumerate(pieces)}


def plain(word: bytes, ranks):
    parts = [bytes([b]) for b in word]
    while True:
        joins = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not joins:
            return [ranks[p] for p in parts]
        _, at = min(joins)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


@pytest.fixture(scope="module")
def public_ranks():
    with open(RANK_FILE, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@pytest.fixture(scope="module")
def library(public_ranks):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=subwords.WORD_PATTERN, mergeable_ranks=public_ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcé ", max_size=40))
def test_merges_of_a_word(text):
    ranks = small_ranks()
    assert byte_pairs.merged(text.encode(), ranks, 4) == plain(text.encode(), ranks)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_texts_against_the_library(public_ranks, library, text):
    coder = byte_pairs.TextCoder(public_ranks, subwords.WORD_PATTERN)
    text = text.encode("utf-8", "ignore").decode()
    assert coder([text])[0] == library.encode_ordinary(text)


def test_a_long_word_takes_no_square(public_ranks, library):
    rng = random.Random(1)
    word = "".join(rng.choices("abcdefgh", k=200_000))
    assert byte_pairs.WordCoder(public_ranks).ids(word) == library.encode_ordinary(word)


def test_a_coder_remembers_a_bounded_number_of_words(monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 8)
    coder = byte_pairs.WordCoder(small_ranks())
    words = [f"ab{i % 50}" for i in range(1000)]
    assert [coder.ids(w) for w in words] == [plain(w.encode(), small_ranks()) for w in words]
    assert len(coder.young) <= 8 and len(coder.old) <= 8
    coder.ids("x" * 1000)
    assert "x" * 1000 not in coder.young


@pytest.mark.parametrize("transfer", ["1", "3", "10000"])
def test_rows_are_coded_and_come_back(spark, conf, library, transfer):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", transfer)
    ranks = subwords.read_ranks(spark, RANK_FILE)
    df = spark.createDataFrame([(*row, "other") for row in ODD], "id bigint, text string, note string")
    coded = subwords.tokenize_subwords(df, ranks, max_length=None)
    rows = coded.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["input_ids"] == library.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(r["input_ids"]) == len(r["attention_mask"]) and r["note"] == "other"
    back = subwords.decode_subwords(coded.withColumnRenamed("text", "was"), ranks)
    assert back.where("NOT coalesce(was, '') <=> text").count() == 0


def test_cut_rows(spark, library):
    ranks = subwords.read_ranks(spark, RANK_FILE)
    df = spark.createDataFrame(ODD, "id bigint, text string")
    for r in subwords.tokenize_subwords(df, ranks, max_length=5).collect():
        assert r["input_ids"] == library.encode_ordinary(r["text"] or "")[:5]
    cut = spark.createDataFrame([(1, library.encode_ordinary("🙂")[:1]), (2, None)], "id bigint, input_ids array<int>")
    assert [r["text"] for r in subwords.decode_subwords(cut, ranks).orderBy("id").collect()] == ["�", None]


def test_an_unknown_id_is_an_error(spark):
    ranks = subwords.read_ranks(spark, RANK_FILE)
    with pytest.raises(PySparkException, match="stands for no piece"):
        subwords.decode_subwords(spark.createDataFrame([([50_300],)], "input_ids array<int>"), ranks).collect()


def test_no_rows(spark):
    ranks = subwords.read_ranks(spark, RANK_FILE)
    empty = spark.createDataFrame([], "id bigint, text string")
    assert subwords.tokenize_subwords(empty, ranks).count() == 0


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda r: r.where("token_id <> 7"), "255 of 256"),
        (lambda r: r.union(r.where("token_id = 9000")), "unique"),
        (lambda r: r.withColumn("token_id", F.when(F.col("token_id") != 300, F.col("token_id"))), "unique"),
    ],
)
def test_a_broken_table_of_ranks_is_an_error(spark, change, message):
    with pytest.raises(ValueError, match=message):
        subwords.ranks_value(change(subwords.read_ranks(spark, RANK_FILE)))


def test_a_table_of_ranks_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(subwords, "MAX_PIECES", 1000)
    with pytest.raises(ValueError, match="too large"):
        subwords.ranks_value(subwords.read_ranks(spark, RANK_FILE))


def test_coding_shuffles_nothing(spark, tmp_path):
    spark.createDataFrame(ODD, "id bigint, text string").write.parquet(str(tmp_path / "texts"))
    known = subwords.ranks_value(subwords.read_ranks(spark, RANK_FILE))
    plan = plan_of(subwords.tokenize_subwords(spark.read.parquet(str(tmp_path / "texts")), known))
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def test_the_pluggable_form_goes_through_batches(spark, library):
    known = subwords.ranks_value(subwords.read_ranks(spark, RANK_FILE))
    df = spark.createDataFrame([(i, "Some words " * (i % 5 + 1)) for i in range(10)], "id bigint, text string")
    rows = user_functions.tokenize_with(df, subwords.text_coder(known))
    assigned = batching.batch_max_length(batching.sequential_batches(rows.select("id", "n_tokens")))
    for r in batching.collate(batching.attach_tokens(assigned, rows), 50256).collect():
        ids = library.encode_ordinary("Some words " * (r["id"] % 5 + 1))
        assert r["input_ids"][: len(ids)] == ids and set(r["input_ids"][len(ids) :]) <= {50256}
        assert len(r["input_ids"]) == r["batch_length"]


def test_words_are_coded_in_bounded_parts(spark, monkeypatch):
    """A large batch isn't worked out as a whole; rows keep their order, a long one stays whole."""
    monkeypatch.setattr(subwords, "WORDS_AT_A_TIME", 3)
    ranks = small_ranks()
    rows = [["skipped"], ["ab", " a"], [], ["abc"] * 7, ["q"], [], ["caé", "x"], []]
    code = subwords._coded(SimpleNamespace(value=ranks)).func
    parts = [part.to_pylist() for part in code(iter([pa.array(rows, pa.list_(pa.string())).slice(1), pa.array([["b"]])]))]
    assert [len(part) for part in parts] == [2, 1, 4, 1]
    assert [ids for part in parts for ids in part] == [[i for word in row for i in plain(word.encode(), ranks)] for row in [*rows[1:], ["b"]]]
