"""Near-duplicate documents against all pairs by 5-word Jaccard."""

import random
import re

import pytest

from test_llm_duplicates import docs, reachable, spaced, texts  # noqa: F401
from tunemill.llm import near_dedup, simhash_dedup


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in spaced(text)]
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def near(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def kept(rows):
    """Ids that stay of (id, text) rows, ids unique and not null."""
    sets = {k: shingles(t) for k, t in rows}
    found = reachable(sets, lambda a, b: near(sets[a], sets[b]))
    return {k for k in sets if found[k] == k}


@pytest.fixture(scope="module")
def edited():
    """Texts of 4 to 300 words, with copies in which some words and line breaks differ."""
    draw = random.Random(11)
    out = []
    for _ in range(25):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.choice([4, 5, 8, 30, 60, 120, 300]))]
        for _ in range(8):
            words = list(base)
            for _ in range(draw.randrange(1 + len(base) // 25)):
                words[draw.randrange(len(words))] = f"edit{draw.randrange(10**6)}"
            out.append("".join(w + draw.choice("  \n") for w in words))
    draw.shuffle(out)
    return list(enumerate(out))


def test_edited_copies_go(spark, edited):
    sets = [shingles(t) for _, t in edited]
    assert sum(a != b and near(a, b) for k, a in enumerate(sets) for b in sets[:k]) > 50
    found = simhash_dedup.keep_one(spark.createDataFrame(edited, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"] for r in found} == kept(edited)


@pytest.mark.parametrize("nothing", [["near_fingerprints"], ["near_fingerprints", "first_partners"]])
def test_second_pass_completes_the_first(spark, edited, monkeypatch, nothing):
    for name in nothing:
        monkeypatch.setattr(near_dedup, name, lambda sets: spark.createDataFrame([], "x long, y long"))
    found = simhash_dedup.keep_one(spark.createDataFrame(edited, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found} == kept(edited)


def test_random_prose(docs, texts):  # noqa: F811
    assert {r["doc_id"] for r in simhash_dedup.keep_one(docs).collect()} == kept(list(enumerate(texts)))


def test_null_and_repeated_ids(spark):
    a, b, c = ("a b c d e f g", "h i j k l m n", "o p q r s t u")
    rows = [(None, a), (None, a), (1, a), (5, b), (5, c), (7, c), (3, b), (9, None), (8, " ")]
    found = simhash_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in found) == [(0, a), (0, a), (1, a), (3, b), (8, " ")]


def test_simhash_finds_most_links(spark, edited):
    """From the fingerprints alone: few of the unequal near copies lie within two bits, sampled bits bring most of them together."""
    docs = spark.createDataFrame(edited, "doc_id long, text string")
    found = near_dedup.shingle_sets(docs).cache()
    named = found.select("key", "fp").dropDuplicates(["key"])
    links = near_dedup.checked(near_dedup.near_fingerprints(named).union(near_dedup.first_partners(named)), found)
    unlike = {k: shingles(t) for k, t in edited}
    firsts = {s: k for k, s in reversed(unlike.items())}
    unlike = {k: s for k, s in unlike.items() if firsts[s] == k}
    by_key = {r["doc_id"]: r["key"] for r in found.select("doc_id", "key").collect()}
    linked = {frozenset(pair) for pair in links.collect()}
    by_simhash = reachable(unlike, lambda a, b: frozenset((by_key[a], by_key[b])) in linked)
    by_sets = reachable(unlike, lambda a, b: near(unlike[a], unlike[b]))
    lost, wanted = (sum(classes[k] != k for k in unlike) for classes in (by_simhash, by_sets))
    found.unpersist()
    assert 0.8 * wanted <= lost <= wanted
