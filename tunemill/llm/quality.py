"""Quality: an additive classifier on the shape of a text, learnt from good examples and unlabelled text.

Learning is non-negative positive-unlabelled (see pu_learning). A text is described by about a
dozen ratios (capitals, punctuation, digits, repeated words, word length and so on), each cut into
steps at fixed places; every step is a feature with its own weight.

A null or empty text falls into the lowest steps and is scored. A null id is scored like any other
and is never held out. Repeated rows get equal scores. Without labels, or without one label 1, every
score is about 0. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import DataFrame

from tunemill.llm.classifiers import SAMPLE, Model, score, train

THRESHOLD = 0.3
RATE = 0.2
#: Steps of a ratio between 0 and 1: narrow near 0, where most ratios lie.
STEPS = np.array([0, 0.001, 0.003, 0.006, 0.01, 0.015, 0.02, 0.03, 0.045, 0.06, 0.09, 0.13, 0.18, 0.25, 0.35, 0.5, 0.65, 0.8, 0.95])
RATIOS = 12
WIDTH = RATIOS * (len(STEPS) + 1)


def _bytes(*spans: tuple[int, int]) -> np.ndarray:
    chosen = np.zeros(256)
    for low, high in spans:
        chosen[low : high + 1] = 1
    return chosen


KINDS = np.stack(
    [
        _bytes((0x41, 0x5A)),
        _bytes((0x30, 0x39)),
        _bytes((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)),
        _bytes((0x21, 0x21), (0x3F, 0x3F)),
        _bytes((0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x3E), (0x40, 0x40), (0x5C, 0x5C), (0x5E, 0x60), (0x7C, 0x7C), (0x7E, 0x7E)),
        _bytes((0x0A, 0x0A)),
        _bytes((0x2C, 0x2C), (0x2E, 0x2E)),
    ],
    axis=1,
)


def ratios(text: bytes) -> np.ndarray:
    size = max(len(text), 1)
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ KINDS / size
    words = text.split()
    n = max(len(words), 1)
    distinct = Counter(words)
    repeated = sum(map(eq, words, words[1:])) / n
    commonest = max(distinct.values(), default=0) / n
    length = min(len(text) / n / 20, 1.0)
    return np.array([*kinds, len(distinct) / n, repeated, commonest, length, min(n / 1000, 1.0)])


def featurize(text: bytes) -> np.ndarray:
    step = np.searchsorted(STEPS, ratios(text), side="right")
    return np.arange(RATIOS) * (len(STEPS) + 1) + step


def train_quality(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    return train(docs, labels, "quality", featurize, WIDTH, bound, WIDTH, rate=RATE)


def score_quality(docs: DataFrame, model: Model, *carried: str) -> DataFrame:
    """doc_id, held_out, score (1: good), predicted (score of 0.3 or more), and `carried` columns."""
    return score(docs, model, featurize, THRESHOLD, *carried)
