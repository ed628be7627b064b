"""Toxicity: a linear classifier on hashed words, learnt from toxic examples and unlabelled text.

Learning is non-negative positive-unlabelled (see pu_learning). Features are the distinct words of
the whole text (lower case, letters and digits) and the first five bytes of longer words, hashed to
2^18 numbers; the few thousand that tell the two sets apart get a weight.

A null or empty text has no features; its score follows from the bias alone. A null id is scored
like any other and is never held out. Repeated rows get equal scores. Without labels, or without
one toxic label, every score is about 0. Other columns are not looked at.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.classifiers import SAMPLE, Model, score, train
from tunemill.llm.common import alnum_words

WIDTH = 1 << 18
STEM = 5
FEATURES = 4096
LEAST_Z = 4.0
THRESHOLD = 0.5


def featurize(text: bytes) -> np.ndarray:
    words = set(alnum_words(text))
    stems = {word[:STEM] for word in words if len(word) > STEM}
    hashed = [crc32(word) & (WIDTH - 1) for word in words]
    hashed += [crc32(stem, 1) & (WIDTH - 1) for stem in stems]
    return np.unique(np.array(hashed, dtype=np.int64))


def train_toxicity(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    return train(docs, labels, "toxic", featurize, WIDTH, bound, FEATURES, LEAST_Z)


def score_toxicity(docs: DataFrame, model: Model, *carried: str) -> DataFrame:
    """doc_id, held_out, score (1: toxic), predicted (score of 0.5 or more), and `carried` columns."""
    return score(docs, model, featurize, THRESHOLD, *carried)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that the classifier doesn't call toxic."""
    model = train_toxicity(docs, labels)
    rows = docs.select(
        F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )
    return score_toxicity(rows, model, "row").where("predicted = 0").select("row.*")
