"""Logistic models over hashed words, fitted on a bounded sample.

A row is the set of places its words hash to, each weighed by the log ratio of
its share among positive and negative rows, and some dense columns beside it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np

PLACE_BITS = 18
#: A model has as many weights.
PLACES = 1 << PLACE_BITS
#: Places of fewer rows of the sample are left out.
MIN_ROWS = 2
#: So many rows of the usual share count for each place beside those that have it.
SMOOTHING = 2.0
#: Rows that a model is fitted on, about; of more, rows are drawn by a hash.
MAX_TRAINING_ROWS = 8_000


def distinct_places(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of each row's words, each once: all rows' places, and where each row's begin."""
    rows = len(begins) - 1
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(begins))
    keys = np.unique(row << PLACE_BITS | (hashes >> np.uint64(64 - PLACE_BITS)).astype(np.int64))
    return (keys & (PLACES - 1)).astype(np.int32), np.searchsorted(keys, np.arange(rows + 1, dtype=np.int64) << PLACE_BITS)


def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The sum of each row's values."""
    running = np.concatenate([[0.0], np.cumsum(values)])
    return running[begins[1:]] - running[begins[:-1]]


@dataclass
class Model:
    weights: np.ndarray
    beside: np.ndarray
    bias: float
    threshold: float = field(default=0.5)

    def predict(self, places: np.ndarray, begins: np.ndarray, beside: np.ndarray) -> np.ndarray:
        z = _sums(self.weights[places].astype(np.float64), begins) + beside @ self.beside + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def constant(share: float, beside: int) -> Model:
    """The same probability for every row."""
    share = float(np.clip(share, 1e-9, 1 - 1e-9))
    return Model(np.zeros(PLACES, np.float32), np.zeros(beside), float(np.log(share / (1 - share))))


def log_ratios(places: np.ndarray, begins: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How much likelier a place is in positive rows, smoothed towards their share."""
    row = np.repeat(np.arange(len(y)), np.diff(begins))
    share = y.mean()
    positive = np.bincount(places, y[row], PLACES)
    seen = np.bincount(places, minlength=PLACES)
    odds = (positive + SMOOTHING * share) / (seen - positive + SMOOTHING * (1 - share))
    return np.where(seen >= MIN_ROWS, np.log(odds * (1 - share) / share), 0.0)


def fit(places: np.ndarray, begins: np.ndarray, beside: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 60) -> Model:
    """The logistic model of targets in [0, 1], by accelerated gradient steps from zero."""
    rows, k = len(begins) - 1, beside.shape[1]
    ratios = log_ratios(places, begins, y)
    used = np.unique(places)
    at = np.searchsorted(used, places)
    row = np.repeat(np.arange(rows), np.diff(begins))
    values = ratios[places]

    def times(w: np.ndarray) -> np.ndarray:
        return _sums(w[: len(used)][at] * values, begins) + beside @ w[len(used) : -1] + w[-1]

    def back(r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(at, values * r[row], len(used)), beside.T @ r, [r.sum()]]) / rows

    v = np.ones(len(used) + k + 1)
    for _ in range(8):  # the largest curvature
        v = back(times(v / np.linalg.norm(v)))
    step = 1 / (0.3 * np.linalg.norm(v) + penalty)
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    w = np.zeros(len(v))
    w[-1] = np.log(share / (1 - share))
    ahead, t = w, 1.0
    free = np.full(len(v), penalty)
    free[-1] = 0
    for _ in range(rounds):
        gradient = back(1 / (1 + np.exp(-np.clip(times(ahead), -50, 50))) - y) + free * ahead
        after, t_after = ahead - step * gradient, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = after + (t - 1) / t_after * (after - w)
        w, t = after, t_after
    weights = np.zeros(PLACES, np.float32)
    weights[used] = w[: len(used)] * ratios[used]
    return Model(weights, w[len(used) : -1].copy(), float(w[-1]))


def take(places: np.ndarray, begins: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given rows of a set of rows."""
    counts = np.diff(begins)[rows]
    starts = np.concatenate([[0], np.cumsum(counts)])
    return places[np.repeat(begins[:-1][rows] - starts[:-1], counts) + np.arange(starts[-1])], starts


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where F1 is highest, in the middle between two predictions."""
    order = np.argsort(-p)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    k = int(np.argmax(f1))
    below = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + below) / 2)


def stacked(lists: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows' places as one array, and where each row's begin."""
    parts = [np.asarray(x, np.int32) for x in lists]
    begins = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), begins
