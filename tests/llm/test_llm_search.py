"""Search by learned partitions against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunemill.llm import neighbour_search as search
from tunemill.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, part int, h1 string, ids int, best double"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, None, None, None, None) for i, v in rows], schema)


def plain(rows, k=20, every=20):
    """query_id -> best (vec_id, score) of all other rows."""
    good = [(n, i, np.array(v, np.float64)) for n, (i, v) in enumerate(rows) if i is not None and usable(v)]
    width = max((len(v) for *_, v in good), default=0)
    matrix = np.array([np.pad(v, (0, width - len(v))) for *_, v in good])
    ids = np.array([i for _, i, _ in good])
    answers = []
    for at in np.flatnonzero(ids % every == 0) if len(ids) else []:
        scores = matrix @ matrix[at]
        order = [o for o in np.lexsort((ids, -scores)) if o != at][:k]
        answers.append((int(ids[at]), [(int(ids[o]), round(float(scores[o]), 9)) for o in order]))
    return answers


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def answers(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], round(r["score"], 9))
    for ranks in found.values():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))
    return {q: [ranks[n] for n in sorted(ranks)] for q, ranks in found.items()}


def as_lists(rng, n, width=16):
    return [[float(np.float32(x)) for x in v] for v in rng.normal(size=(n, width)) * rng.lognormal(sigma=0.3, size=(n, 1))]


def test_all_parts_give_the_exact_answer(spark):
    rng = np.random.default_rng(1)
    rows = list(enumerate(as_lists(rng, 700)))
    # A third are copies, queries among them; small whole numbers tie.
    rows += [(1000 + i, rows[3][1]) for i in range(350)]
    rows += [(2000 + i, [float(x) for x in rng.integers(-1, 2, 16)]) for i in range(100)]
    found = search.nearest_neighbours(table(spark, rows), parts=6, probes=6, block=64)
    assert answers(found) == dict(plain(rows))


def test_recall_of_the_measured_probes(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    vectors = np.concatenate([centres[rng.integers(40, size=4000)] + 0.35 * rng.normal(size=(4000, 16)), rng.normal(size=(1000, 16))])
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    found, exact = answers(search.nearest_neighbours(table(spark, rows), sample=3000)), dict(plain(rows))
    assert found.keys() == exact.keys() and all(len(a) == 20 for a in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert hits >= 0.9 * 20 * len(exact)
    scores = {q: dict(plain_scores) for q, plain_scores in exact.items()}
    assert all(scores[q][i] == s for q, best in found.items() for i, s in best if i in scores[q])


def test_the_registered_query_finds_nine_of_ten(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found, exact = answers(QUERIES["op12_neighbour_search"](spark, sf_dir)), dict(plain(rows))
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert found.keys() == exact.keys() and hits >= 0.9 * 20 * len(exact)


def test_parts_are_balanced_and_cut_less_than_chance():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(12, 8))[rng.integers(12, size=1500)] + 0.2 * rng.normal(size=(1500, 8))
    links = search._best(rows, rows, 10, own=0)
    part = search.balanced_parts(rows, links, 10)
    sizes = np.bincount(part, minlength=10)
    assert sizes.max() <= 158 and sizes.min() >= 100
    assert np.mean(part[links] != part[:, None]) < 0.5


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [-1.0, -0.0]), (20, [0.0, 1.0]), (3, [0.5]),
        (40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]), (None, [1.0, 1.0]),
    ]
    found = search.nearest_neighbours(table(spark, rows))
    by_query = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())
    expected = sorted((q, n + 1, i, s) for q, best in plain(rows) for n, (i, s) in enumerate(best))
    assert by_query == expected and {q for q, *_ in by_query} == {0, 20}


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(0, None), (20, [])]])
def test_nothing_to_find(spark, rows):
    assert search.nearest_neighbours(table(spark, rows)).count() == 0


def test_few_rows_give_all_candidates(spark):
    rng = np.random.default_rng(4)
    rows = list(enumerate(as_lists(rng, 200)))
    found = search.nearest_neighbours(table(spark, rows), F.col("vec_id") % 50 == 0, k=150, parts=8, probes=1)
    assert {q: len(a) for q, a in answers(found).items()} == {0: 150, 50: 150, 100: 150, 150: 150}
    assert answers(found) == dict(plain(rows, k=150, every=50))
