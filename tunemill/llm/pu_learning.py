"""Non-negative positive-unlabelled learning for sparse 0/1 features, in numpy.

Trusted positives and unlabelled rows give an unbiased estimate of the classification risk once
the share of positives (the class prior) is known: the risk of calling the unlabelled rows
negative, less the part of it that the positives among them cause. That difference can't be below
zero for the true risk; where the estimate falls below it, the step goes the other way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

STEPS = 400
RATE = 0.05
RIDGE = 1e-5
FLOOR = 1e-6


#: Features counted or renumbered at a time.
PIECE = 1 << 20


class Rows:
    """Rows of feature numbers, all in one array with the number of each one's row."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.features = np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int32)
        self.owner = np.repeat(np.arange(self.n, dtype=np.int32), [len(row) for row in rows])

    @classmethod
    def of(cls, features: np.ndarray, lengths: np.ndarray, names: np.ndarray) -> Rows:
        """From one array of all features; rows are numbered in the order of their names."""
        rows = cls([])
        number = np.empty(len(lengths), np.int32)
        number[np.argsort(names, kind="stable")] = np.arange(len(lengths))
        rows.n, rows.features, rows.owner = len(lengths), features, np.repeat(number, lengths)
        return rows

    def pieces(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(self.features), PIECE):
            yield self.features[at : at + PIECE], self.owner[at : at + PIECE]

    def keep(self, column_of: np.ndarray) -> Rows:
        """The features with a column, renumbered, in order of row; column_of is -1 for the others."""
        found = [(column_of[some], owner) for some, owner in self.pieces()]
        out = Rows([column[column >= 0] for column, _ in found])
        owner = np.concatenate([*(owner[column >= 0] for column, owner in found), np.empty(0, np.int32)])
        order = np.lexsort((out.features, owner))
        out.n, out.features, out.owner = self.n, out.features[order], owner[order]
        return out

    def counts(self, width: int) -> np.ndarray:
        total = np.zeros(width, np.int64)
        for some, _ in self.pieces():
            total += np.bincount(some, minlength=width)
        return total

    def margins(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.owner, weights[self.features], minlength=self.n)

    def pulled(self, slopes: np.ndarray, width: int) -> np.ndarray:
        """Mean gradient of the weights, given each row's slope."""
        return np.bincount(self.features, slopes[self.owner], minlength=width) / max(self.n, 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def telling_features(positive: Rows, unlabelled: Rows, width: int, most: int, least_z: float) -> np.ndarray:
    """Numbers of the features whose share differs most between the two sets, by z value."""
    p, u = positive.counts(width), unlabelled.counts(width)
    share = (p + u + 1) / (positive.n + unlabelled.n + 2)
    spread = np.sqrt(share * (1 - share) * (1 / max(positive.n, 1) + 1 / max(unlabelled.n, 1))) + 1e-12
    z = np.abs(p / max(positive.n, 1) - u / max(unlabelled.n, 1)) / spread
    chosen = np.argsort(-z, kind="stable")[:most]
    return np.sort(chosen[z[chosen] >= least_z])


def fit(
    positive: Rows,
    unlabelled: Rows,
    prior: float,
    width: int,
    most: int = 4096,
    least_z: float = 0.0,
    rate: float = RATE,
) -> tuple[np.ndarray, float]:
    """Weights of all `width` features (zero where not chosen) and the bias.

    Without positives or unlabelled rows nothing can be learnt: every score is about 0.
    """
    weights = np.zeros(width)
    if not positive.n or not unlabelled.n or prior <= 0:
        return weights, -30.0
    prior = min(prior, 1 - FLOOR)
    chosen = telling_features(positive, unlabelled, width, most, least_z)
    column_of = np.full(width, -1, np.int32)
    column_of[chosen] = np.arange(len(chosen))
    p, u, k = positive.keep(column_of), unlabelled.keep(column_of), len(chosen)
    state = np.zeros(k + 1)
    state[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, STEPS + 1):
        on_p, on_u = p.margins(state[:-1], state[-1]), u.margins(state[:-1], state[-1])
        negative_risk = np.logaddexp(0, on_u).mean() - prior * np.logaddexp(0, on_p).mean()
        slope_p, slope_u = prior * sigmoid(on_p), sigmoid(on_u)
        gradient = np.append(u.pulled(slope_u, k) - p.pulled(slope_p, k), slope_u.mean() - slope_p.mean())
        if negative_risk < 0:
            gradient = -gradient
        else:
            pull = -prior * sigmoid(-on_p)
            gradient += np.append(p.pulled(pull, k), pull.mean())
        gradient[:-1] += RIDGE * state[:-1]
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        state -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights[chosen] = state[:-1]
    return weights, float(state[-1])
