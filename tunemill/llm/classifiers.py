"""Bounded training samples and scoring of whole tables for the two classifiers.

A model learns from at most `bound` positives and `bound` unlabelled rows, those with the smallest
hash of their id. Labels of held-out rows are never read into a model. The class prior is the share
of positives among the labelled rows that are not held out, over all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import encoded, held_out, per_row
from tunemill.llm.pu_learning import RATE, Rows, fit, sigmoid

SAMPLE = 20_000

Featurize = Callable[[bytes], np.ndarray]


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    prior: float


def smallest_by_hash(ids: DataFrame, bound: int) -> DataFrame:
    return ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    featurize: Featurize,
    width: int,
    bound: int = SAMPLE,
    most: int = 4096,
    least_z: float = 0.0,
    rate: float = RATE,
) -> Model:
    """A model from `labels.<label>` and the texts of `docs`.

    Rows with a null id or label teach nothing; a repeated id counts once, as positive if any
    of its labels is 1.
    """
    known = (
        labels.select("doc_id", F.col(label).alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    prior = known.agg(F.avg("y")).first()[0] or 0.0
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out())
    chosen = smallest_by_hash(known.where("y = 1").select("doc_id"), bound).withColumn("role", F.lit(1)).union(
        smallest_by_hash(ids, bound).withColumn("role", F.lit(0))
    )

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [featurize(encoded(text)).astype(np.int32).tobytes() for text in batch["text"].to_pylist()]
        return pa.record_batch([batch["doc_id"], batch["role"], pa.array(found, pa.binary())], ["doc_id", "role", "features"])

    # At most 2 x `bound` ids, so the broadcast has a proven size.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = per_row(texts, "doc_id long, role int, features binary", features).toArrow()
    rows = [_rows(sample.filter(pc.equal(sample["role"], role))) for role in (1, 0)]
    del sample
    weights, bias = fit(*rows, prior, width, most, least_z, rate)
    return Model(weights.astype(np.float32), bias, prior)


def _rows(sample: pa.Table) -> Rows:
    """The features as they lie in the table, without a copy for each row."""
    found = sample["features"].combine_chunks()
    lengths = pc.binary_length(found).to_numpy() // 4
    flat = np.frombuffer(found.buffers()[2] or b"", np.uint8) if len(found) else np.empty(0, np.uint8)
    offsets = np.frombuffer(found.buffers()[1], np.int32)[found.offset : found.offset + len(found) + 1] if len(found) else [0, 0]
    return Rows.of(flat[offsets[0] : offsets[-1]].view(np.int32), lengths, sample["doc_id"].to_numpy())


def score(docs: DataFrame, model: Model, featurize: Featurize, threshold: float, *carried: str) -> DataFrame:
    """doc_id, held_out, score, predicted for each row, and the columns named in `carried`."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights, bias = shared.value
        margins = [bias + float(weights[featurize(encoded(t))].sum()) for t in batch["text"].to_pylist()]
        scores = sigmoid(np.array(margins, dtype=np.float64))
        columns = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
        kept = [batch[name] for name in names]
        return pa.record_batch([*kept, *columns], [*names, "score", "predicted"])

    names = ["doc_id", "held_out", *carried]
    texts = docs.select("doc_id", held_out().alias("held_out"), *dict.fromkeys([*carried, "text"]))
    kinds = {field.name: field.dataType.simpleString() for field in texts.schema}
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in names) + ", score double, predicted int"
    return per_row(texts, schema, rows)
