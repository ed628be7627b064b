"""The most frequent tokens from bounded summaries, against counting everything."""

import random
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tunemill.operators import heavy_hitters, tokenization


@given(st.lists(st.sampled_from("abcdefghij"), max_size=200), st.integers(1, 6))
def test_a_summary_is_wrong_by_its_error_at_most(tokens, capacity):
    summary = heavy_hitters.Summary(capacity)
    for start in range(0, len(tokens), 7):
        found = Counter(tokens[start : start + 7])
        summary.add(list(found), list(found.values()))
        assert len(summary.counts) <= 2 * capacity
    summary.cut()
    assert len(summary.counts) <= capacity
    for token, n in Counter(tokens).items():
        assert summary.counts.get(token, 0) <= n <= summary.counts.get(token, 0) + summary.error


def lists(seed, kind):
    rng = random.Random(seed)
    if kind == "even":
        # All tokens are nearly as frequent as one another: no small summary can tell.
        return [[f"t{rng.randrange(300)}" for _ in range(20)] for _ in range(200)]
    return [[f"t{int(rng.paretovariate(0.8))}" for _ in range(rng.randrange(30))] for _ in range(300)] + [None, [], [None, "t1"]]


@pytest.mark.parametrize("kind", ["skewed", "even"])
@pytest.mark.parametrize("capacity", [3, 40, None])
def test_most_frequent_tokens(spark, kind, capacity):
    rows = lists(1, kind)
    df = spark.createDataFrame([(r,) for r in rows], "tokens array<string>").repartition(5)
    counts = Counter(t for r in rows for t in r or [] if t is not None)
    expected = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:10]
    assert [tuple(r) for r in heavy_hitters.most_frequent(df, 10, capacity=capacity).collect()] == expected


def test_candidates_are_few_where_counts_differ(spark):
    rows = lists(2, "skewed")
    df = spark.createDataFrame([(r,) for r in rows], "tokens array<string>").repartition(4)
    held, exact = heavy_hitters.candidates(df, 5, capacity=60)
    different = len({t for r in rows for t in r or [] if t})
    assert not exact and 5 <= held.count() < different / 4
    assert heavy_hitters.task_summaries(df, "tokens", 60).count() <= 4 * 61
    assert heavy_hitters.candidates(df, 5, capacity=100_000)[1]


def test_fewer_tokens_than_asked_for_and_none(spark):
    df = spark.createDataFrame([(["b", "a", "b"],)], "tokens array<string>")
    assert [tuple(r) for r in heavy_hitters.most_frequent(df, 10, capacity=1).collect()] == [("b", 2), ("a", 1)]
    assert heavy_hitters.most_frequent(df.where("size(tokens) = 0"), 3).count() == 0


def test_both_vocabularies_agree(spark):
    df = spark.createDataFrame([(" ".join(t for t in r or [] if t),) for r in lists(3, "skewed")], "text string").repartition(3)
    exact, bounded = (build(df, 20).table.collect() for build in (tokenization.build_vocab, tokenization.build_vocab_bounded))
    assert sorted(exact) == sorted(bounded)
    assert [r["token_id"] for r in sorted(bounded, key=lambda r: r["token_id"])] == list(range(3, 23))
