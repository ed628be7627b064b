"""Nearest neighbours by inner product through learned partitions.

1. Equal vectors are one class. A class keeps its k + 1 smallest ids: no query needs more of them, as copies tie and
   the smaller id comes first. Each task cuts its copies to these before the shuffle.
2. Fit, in one task on at most `sample` classes, those with the smallest hashes: a graph of each vector's `links`
   best partners; parts of equal size by halving along main axes; exchanges of vectors between parts that cut fewer
   links, room for room, so the parts stay balanced; a softmax classifier from a vector to the parts of its partners.
3. Index. Every class goes to the part that the classifier holds likeliest, sampled or not.
4. Routing. A query goes to its `probes` likeliest parts. The number is measured at the fit: an eighth of the sample takes
   no part in it, and `probes` is the least number that finds `recall` of its true neighbours. Where the
   data have little structure that is many parts; the recall is what is kept to, not the number.
5. Reranking. A part meets its queries in blocks of at most `block` candidates and `block` queries, by exact inner
   products in double precision; each block gives a query's best k + 1, and the best of these are the answer.

Equal queries are answered once; those for which their parts hold too few rows are asked again in all parts. A query's
own row is taken out of its answer by id and vector.

Rows with a null id, a null or empty vector, a zero vector, or one with null or non-finite components take no part. A
shorter vector counts as filled up with zeros. Rows that repeat an id are rows of their own, as
candidates and as queries; one of them is a query's own. Ties go to the smaller id. An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import discard, stored

K, EVERY = 20, 20
SAMPLE, LINKS, RECALL, BLOCK = 16_384, 20, 0.95, 32_768
#: Bytes of sampled vectors, so that very long vectors make a smaller sample.
SAMPLE_BYTES = 64_000_000
CHUNK = 256
CLASS = ["h1", "h2"]


# The model, in numpy


def _best(queries: np.ndarray, rows: np.ndarray, k: int, own: int | None = None) -> np.ndarray:
    """Places of each query's k largest inner products; with `own`, queries are rows from there on and skip themselves."""
    found = [np.empty((0, k), np.int64)]
    for start in range(0, len(queries), CHUNK):
        scores = queries[start : start + CHUNK] @ rows.T
        if own is not None:
            here = np.arange(len(scores))
            scores[here, own + start + here] = -np.inf
        found.append(np.argpartition(-scores, k - 1, axis=1)[:, :k])
    return np.concatenate(found)


def halved(rows: np.ndarray, parts: int) -> np.ndarray:
    """A part for each row: the rows are cut across their main axis again and again, in proportion."""
    part = np.zeros(len(rows), np.int64)
    todo = [(np.arange(len(rows)), 0, parts)]
    while todo:
        at, low, high = todo.pop()
        if high - low == 1:
            part[at] = low
            continue
        centred = rows[at] - rows[at].mean(axis=0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = at[np.argsort(centred @ axis, kind="stable")]
        middle = (low + high) // 2
        cut = len(order) * (middle - low) // (high - low)
        todo += [(order[:cut], low, middle), (order[cut:], middle, high)]
    return part


def balanced_parts(rows: np.ndarray, links: np.ndarray, parts: int, rounds: int = 15) -> np.ndarray:
    """Parts of nearly equal size that cut few links of the graph."""
    part = halved(rows, parts)
    capacity = int(np.ceil(len(rows) / parts * 1.05))
    ends = np.repeat(np.arange(len(rows)), links.shape[1]), links.ravel()
    for _ in range(rounds):
        pull = np.zeros((len(rows), parts), np.float32)
        for a, b in (ends, ends[::-1]):
            np.add.at(pull, (a, part[b]), 1)
        here = np.arange(len(rows))
        to = pull.argmax(axis=1)
        gain = pull[here, to] - pull[here, part]
        ready = np.flatnonzero(gain > 0)
        ready = ready[np.argsort(-gain[ready], kind="stable")]
        # Rows that gain most take the room that is left; the others change places, pair by pair of parts.
        nth = _nth_of(to[ready])
        room = np.maximum(capacity - np.bincount(part, minlength=parts), 0)
        fits = nth < room[to[ready]]
        rest = ready[~fits]
        low, high = np.minimum(part[rest], to[rest]), np.maximum(part[rest], to[rest])
        up = part[rest] < to[rest]
        way = (low * parts + high) * 2 + up
        there = np.bincount(way, minlength=2 * parts * parts)
        swapped = rest[_nth_of(way) < there[way ^ 1]]
        moving = np.concatenate([ready[fits], swapped])
        if not len(moving):
            break
        part[moving] = to[moving]
    return part


def _nth_of(keys: np.ndarray) -> np.ndarray:
    """For each place, how many places before it hold the same key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    nth = np.empty(len(keys), np.int64)
    nth[order] = np.arange(len(keys)) - np.searchsorted(ordered, ordered)
    return nth


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def trained_classifier(rows: np.ndarray, target: np.ndarray, epochs: int = 40, rate: float = 0.01) -> list[np.ndarray]:
    """Weights and biases of a softmax from rows to shares of parts (Adam on cross entropy)."""
    rng = np.random.default_rng(0)
    values = [np.zeros((rows.shape[1], target.shape[1])), np.zeros(target.shape[1])]
    mean, spread = ([np.zeros_like(v) for v in values] for _ in range(2))
    step = 0
    for epoch in range(epochs):
        for at in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 512)):
            miss = (_softmax(rows[at] @ values[0] + values[1]) - target[at]) / len(at)
            step += 1
            for i, slope in enumerate((rows[at].T @ miss, miss.sum(axis=0))):
                mean[i] += 0.1 * (slope - mean[i])
                spread[i] += 0.001 * (slope**2 - spread[i])
                size = (mean[i] / (1 - 0.9**step)) / (np.sqrt(spread[i] / (1 - 0.999**step)) + 1e-8)
                values[i] -= rate * (1 - epoch / epochs) * size
    return values


def ordered_parts(model: dict, rows: np.ndarray) -> np.ndarray:
    """All parts for each row, likeliest first; equally likely ones by number."""
    scale = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.argsort(-(rows / scale @ model["weights"] + model["bias"]), axis=1, kind="stable")


def one_part(width: int) -> dict:
    """The model that holds everything in one part."""
    return {"weights": np.zeros((width, 1)), "bias": np.zeros(1), "probes": 1}


def fit_model(rows: np.ndarray, parts: int, k: int, recall: float) -> dict:
    """weights, bias, probes: from sampled vectors in random order. Too few vectors are one part."""
    apart = len(rows) // 8
    if parts < 2 or apart < 1 or len(rows) - apart <= max(parts, k):
        return one_part(rows.shape[1])
    asked, kept = rows[:apart], rows[apart:]
    links = _best(kept, kept, min(LINKS, len(kept) - 1), own=0)
    part = balanced_parts(kept, links, parts)
    target = np.zeros((len(kept), parts))
    here = np.arange(len(kept))
    np.add.at(target, (np.repeat(here, links.shape[1]), part[links.ravel()]), 1)
    target[here, part] += links.shape[1] / 4
    # Directions only: a vector's length doesn't change which partners are best.
    directions = kept / np.linalg.norm(kept, axis=1, keepdims=True)
    weights, bias = trained_classifier(directions, target / target.sum(axis=1, keepdims=True))
    model = {"weights": weights, "bias": bias}
    place = np.argsort(ordered_parts(model, asked), axis=1)
    home = ordered_parts(model, kept)[:, 0]
    needed = np.take_along_axis(place, home[_best(asked, kept, k)], axis=1)
    found = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
    return model | {"probes": int(np.argmax(found >= recall)) + 1}


def _leading(query: np.ndarray, value: np.ndarray, score: np.ndarray, name: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """query and value of each query's first `n` entries by falling score, then by name."""
    order = np.lexsort((name, -score, query))
    order = order[_nth_of(query[order]) < n]
    return query[order], value[order]


# The tables


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, vector, h1, h2 (two hashes that name the vector) of the rows that take part."""
    values = F.col(vector)
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", values.alias("vector")).where(
        F.col("vec_id").isNotNull() & (F.size(values) > 0) & ~F.coalesce(odd, F.lit(True)) & F.exists(values, lambda x: x != 0)
    )
    return rows.select("vec_id", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit("2"), "vector").alias("h2"))


def vector_classes(rows: DataFrame, k: int) -> DataFrame:
    """h1, h2, vector and the k + 1 smallest ids of each different vector."""
    by_id = Window.partitionBy(*CLASS).orderBy("vec_id")
    first = rows.withColumn("_nth", F.row_number().over(by_id)).where(F.col("_nth") <= k + 1)
    return first.groupBy(*CLASS).agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, short ones filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    rows = np.zeros((len(lists), width))
    rows[np.arange(width)[None] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return rows


def fitted(classes: DataFrame, width: int, parts: int, k: int, sample: int, recall: float) -> dict:
    """The model, fitted by one task on a sample that `sample` and SAMPLE_BYTES bound."""
    limit = min(sample, SAMPLE_BYTES // (8 * max(width, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate([np.zeros((0, width)), *[_matrix(batch["vector"], width) for batch in batches]])
        yield pa.record_batch([pa.array([pickle.dumps(fit_model(rows, parts, k, recall))], pa.binary())], ["model"])

    chosen = classes.orderBy(*CLASS).limit(limit).select(*CLASS, "vector")
    model = chosen.repartition(1).sortWithinPartitions(*CLASS).select("vector").mapInArrow(run, "model binary").first()
    # An empty table has no task that fits.
    return pickle.loads(model["model"]) if model else one_part(width)


def routed(rows: DataFrame, model: dict, width: int, probes: int) -> DataFrame:
    """`rows` once for each of their `probes` likeliest parts, as column `part`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = ordered_parts(model, _matrix(batch["vector"], width))[:, :probes]
            lists = pa.array(list(parts.astype(np.int32)), pa.list_(pa.int32()))
            yield pa.record_batch([*batch.columns, lists], [*batch.schema.names, "parts"])

    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema)}, parts array<int>"
    return rows.mapInArrow(run, schema).select("*", F.explode("parts").alias("part")).drop("parts")


def _pieces(sizes: dict[int, int], block: int) -> Column:
    """The number of blocks of the part in column `part`; `sizes` has a number per part."""
    counts = F.create_map(*[F.lit(v) for part, n in sizes.items() for v in (part, -(-n // block))]) if sizes else None
    return F.lit(1) if counts is None else F.coalesce(F.element_at(counts, F.col("part")), F.lit(1))


def best_of_blocks(asked: DataFrame, held: DataFrame, width: int, k: int, block: int) -> DataFrame:
    """h1, h2, best (array of minus_score, vec_id, own) of each query and block it meets."""
    # A row per part, and the parts are bounded in number.
    n_held, n_asked = ({r["part"]: r["count"] for r in t.groupBy("part").count().collect()} for t in (held, asked))
    of_held, of_asked = _pieces(n_held, block), _pieces(n_asked, block)

    def dealt(rows: DataFrame, own: Column, other: Column, own_name: str, other_name: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("h2", "h1"), own).cast("int").alias(own_name)
        return rows.select("*", mine, F.explode(F.sequence(F.lit(0), other - 1)).alias(other_name))

    left = dealt(asked, of_asked, of_held, "asked_block", "held_block")
    right = dealt(held, of_held, of_asked, "held_block", "asked_block")

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        rows, queries = _matrix(held["vector"], width), _matrix(asked["vector"], width)
        names = {c: (asked[c].to_numpy(), held[c].to_numpy()) for c in CLASS}
        ids = held["ids"].combine_chunks()
        starts, flat = ids.offsets.to_numpy(), ids.flatten().to_numpy()
        starts, copies = starts[:-1] - starts[0], np.diff(starts)
        out = {"h1": [], "h2": [], "minus_score": [], "vec_id": [], "own": []}
        top = min(k + 1, len(rows))
        for start in range(0, len(queries) if top else 0, CHUNK):
            # Adding zero makes one zero of two.
            scores = queries[start : start + CHUNK] @ rows.T + 0.0
            least = -np.partition(-scores, top - 1, axis=1)[:, top - 1 : top]
            query, place = np.nonzero(scores >= least)
            query, place = _leading(query, place, scores[query, place], flat[starts[place]], k + 1)
            # Each class stands for its copies.
            which = np.repeat(np.arange(len(place)), copies[place])
            before = np.cumsum(copies[place]) - copies[place]
            at = starts[place][which] + np.arange(len(which)) - before[which]
            query, at = _leading(query[which], at, scores[query, place][which], flat[at], k + 1)
            place = np.searchsorted(starts, at, side="right") - 1
            h1, h2 = (names[c][0][start + query] for c in CLASS)
            out["h1"].append(h1)
            out["h2"].append(h2)
            out["minus_score"].append(-scores[query, place])
            out["vec_id"].append(flat[at])
            out["own"].append((names["h1"][1][place] == h1) & (names["h2"][1][place] == h2))
        kinds = {"minus_score": np.float64, "own": np.bool_}
        return pa.table({c: np.concatenate([np.empty(0, kinds.get(c, np.int64)), *parts]) for c, parts in out.items()})

    by = ["part", "asked_block", "held_block"]
    schema = "h1 long, h2 long, minus_score double, vec_id long, own boolean"
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, schema)


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column | None = None,
    k: int = K,
    vector: str = "embedding",
    parts: int | None = None,
    probes: int | None = None,
    sample: int = SAMPLE,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query row.

    `queries` picks the query rows by vec_id, every twentieth by default. Without `parts` there are
    a quarter as many as the square root of the number of different vectors, at most 512.
    """
    rows = stored(usable(vectors, vector), "vectors")
    classes = stored(vector_classes(rows, k), "classes")
    n, width, n_rows = classes.agg(F.count("*"), F.max(F.size("vector")), F.sum(F.size("ids"))).first()
    width, enough = width or 0, min(k + 1, n_rows or 0)
    parts = parts or max(1, min(512, int(n**0.5) // 4))
    model = fitted(classes, width, parts, k, sample, recall)
    asked_rows = rows.where(F.col("vec_id") % EVERY == 0 if queries is None else queries).select("vec_id", *CLASS)
    asked = stored(classes.join(asked_rows.select(*CLASS).distinct(), CLASS, "left_semi").select(*CLASS, "vector"), "asked")
    held = stored(routed(classes, model, width, 1), "held")

    def answers(asked: DataFrame, probes: int) -> DataFrame:
        found = best_of_blocks(stored(routed(asked, model, width, probes), "routed"), held, width, k, block)
        by_score = Window.partitionBy(*CLASS).orderBy("minus_score", "vec_id")
        found = found.withColumn("_nth", F.row_number().over(by_score)).where(F.col("_nth") <= k + 1)
        entry = F.struct("minus_score", "vec_id", "own")
        return stored(found.groupBy(*CLASS).agg(F.sort_array(F.collect_list(entry)).alias("best")), "best")

    best = answers(asked, probes or model["probes"]).where(F.size("best") >= enough)
    short = asked.join(best.select(*CLASS), CLASS, "left_anti")
    if not short.isEmpty():
        best = best.union(answers(short, parts))
    # Both sides are stored tables, so that Spark can split a vector that a third of the queries share.
    met = asked_rows.withColumnRenamed("vec_id", "query_id").join(best, CLASS)
    own = F.transform("best", lambda b: b["own"] & (b["vec_id"] == F.col("query_id")))
    at = F.array_position(own, True).cast("int")
    others = F.when(at == 0, F.col("best")).otherwise(
        F.concat(F.slice("best", F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice("best", at + 1, F.lit(k)))
    )
    ranked = met.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "found"))
    answer = ranked.select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("found.vec_id").alias("vec_id"), (-F.col("found.minus_score")).alias("score")
    )
    discard(classes, asked, held)
    return answer
