"""A generalised additive model with pairwise interactions.

Each feature has a table of contributions by bin, and so has each chosen pair of
features. Boosting goes round the features in turn: a tree of a few leaves
over one feature's bins is fitted to the current residuals and a small part of it
added to the table; then the same for pairs. A score is a sum of look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np

#: Added to sums of second derivatives, and the least such sum of a leaf.
_RIDGE, _LEAST = 1.0, 1.5


@dataclass(frozen=True)
class Boosting:
    bins: int = 48
    pair_bins: int = 12
    rounds: int = 120
    pair_rounds: int = 40
    pairs: int = 6
    leaves: int = 4
    rate: float = 0.15


@dataclass
class Additive:
    """A fitted model; ``predict`` takes rows of features."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, rows[:, k], "right")]
        coarse = {k: np.searchsorted(self.pair_edges[k], rows[:, k], "right") for pair in self.pairs for k in pair[:2]}
        for i, j, table in self.pairs:
            total += table[coarse[i], coarse[j]]
        return _chance(total)


def _chance(total: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts at quantiles of the rows and, for long tails, of the distinct values; the least value has a bin of its own."""
    part = np.linspace(0, 1, bins // 2 + 1)[1:-1]
    distinct = np.unique(values)
    return np.unique(np.concatenate([np.quantile(values, part), np.quantile(distinct, part), distinct[1:2]]))


def _worth(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + _RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut of a row of bins, and the number of bins to its left."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = _worth(left_g, left_h) + _worth(right_g, right_h) - _worth(g.sum(), h.sum())
    gain[(left_h < _LEAST) | (right_h < _LEAST)] = 0
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf values by bin of a tree over one feature, split where it gains most."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b]), a, b) for a, b in parts]
        gain, k, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + _RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree that cuts one feature and then, on each side, the other."""
    best, out = 0.0, np.zeros_like(g)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        up_g, up_h = np.cumsum(a, 0), np.cumsum(b, 0)
        for k in range(1, len(a)):
            sides = ((up_g[k - 1], up_h[k - 1]), (up_g[-1] - up_g[k - 1], up_h[-1] - up_h[k - 1]))
            if min(s[1].sum() for s in sides) < _LEAST:
                continue
            cuts = [_best_cut(*s) for s in sides]
            gain = sum(c[0] + _worth(s[0].sum(), s[1].sum()) for c, s in zip(cuts, sides, strict=True))
            gain -= _worth(g.sum(), h.sum())
            if gain > best:
                values = np.zeros_like(a)
                for (own_g, own_h), (_, cut), rows in zip(sides, cuts, (slice(0, k), slice(k, None)), strict=True):
                    for columns in (slice(0, cut), slice(cut, None)):
                        if own_h[columns].sum() > 0:
                            values[rows, columns] = own_g[columns].sum() / (own_h[columns].sum() + _RIDGE)
                best, out = gain, values.T if turned else values
    return best, out


def fit(rows: np.ndarray, labels: np.ndarray, rule: Boosting | None = None) -> Additive:
    """Fit to labels 0 and 1. No rows, or one class, give a constant."""
    rule = rule or Boosting()
    mean = float(np.clip(labels.mean() if len(labels) else 0.5, 0.02, 0.98))
    model = Additive(base=float(np.log(mean / (1 - mean))))
    if len(labels) < 2 or labels.min() == labels.max():
        return model
    count = rows.shape[1]
    model.edges = [_edges(rows[:, k], rule.bins) for k in range(count)]
    model.pair_edges = [_edges(rows[:, k], rule.pair_bins) for k in range(count)]
    bins = [np.searchsorted(model.edges[k], rows[:, k], "right") for k in range(count)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(labels), model.base)
    for _ in range(rule.rounds):
        for k in range(count):
            p = _chance(total)
            size = len(model.tables[k])
            g = np.bincount(bins[k], labels - p, size)
            step = rule.rate * _tree(g, np.bincount(bins[k], p * (1 - p), size), rule.leaves)
            model.tables[k] += step
            total += step[bins[k]]
    coarse = [np.searchsorted(model.pair_edges[k], rows[:, k], "right") for k in range(count)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = _chance(total)
        at = coarse[i] * sizes[j] + coarse[j]
        shape = (sizes[i], sizes[j])
        both = [np.bincount(at, w, sizes[i] * sizes[j]).reshape(shape) for w in (labels - p, p * (1 - p))]
        return both[0], both[1]

    ranked = sorted(combinations(range(count), 2), key=lambda pair: -_pair_tree(*sums(*pair))[0])
    model.pairs = [(i, j, np.zeros((sizes[i], sizes[j]))) for i, j in ranked[: rule.pairs]]
    for _ in range(rule.pair_rounds):
        for i, j, held in model.pairs:
            step = rule.rate * _pair_tree(*sums(i, j))[1]
            held += step
            total += step[coarse[i], coarse[j]]
    return model
