"""Hard negatives against a plain search in whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from epilake.llm import negatives
from epilake.llm.negatives import HardNegatives, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
BOUNDS = (-(2**63) + 1, 2**63 - 1)


def plain(rows: list[tuple], rule: HardNegatives) -> list[tuple]:
    whole = {}
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        label = (label + 1) % rule.labels if vec_id % rule.moved == 0 else label
        whole[vec_id, label, tuple(float(np.float32(v)) for v in x)] = None
    held = [(i, label, [int(math.floor(rule.scale * v)) for v in x]) for i, label, x in whole]
    out = []
    for a in held:
        if a[0] % rule.every:
            continue

        def score(other: tuple) -> int:
            return min(max(sum(p * q for p, q in zip(a[2], other[2], strict=False)), BOUNDS[0]), BOUNDS[1])  # noqa: B023

        others = sorted((-score(v), v[0], v[1] == a[1]) for v in held if v is not a)
        positives = [(i, -s) for s, i, same in others if same][: rule.positives]
        for i, p in positives:
            fits = [(j, -s) for s, j, same in others if not same and rule.low * p <= -100 * s <= 100 * p][: rule.negatives]
            out += [(a[0], i, k, j, p, s) for k, (j, s) in enumerate(fits, 1)]
    return sorted(out)


def same(spark, rows: list[tuple], rule: HardNegatives | None = None, partitions: int = 3) -> int:
    rule = rule or HardNegatives()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    found = sorted(tuple(r) for r in hard_negatives(frame, rule).collect())
    assert found == plain(rows, rule)
    return len(found)


def vectors(n: int, dim: int, seed: int, clusters: int = 0, labels: int = 4) -> list[tuple]:
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    if clusters:
        x = 3 * rng.normal(size=(clusters, dim))[rng.integers(0, clusters, n)] + 0.3 * x
    return [(k, [float(v) for v in x[k]], int(rng.integers(0, labels))) for k in range(n)]


@pytest.mark.parametrize("clusters", [0, 6])
@pytest.mark.parametrize("dim", [1, 3, 16])
def test_random_vectors(spark, dim, clusters):
    assert same(spark, vectors(700, dim, dim, clusters), HardNegatives(every=10))


def test_waves_lists_and_walkers_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(negatives, "WAVE", 1)
    monkeypatch.setattr(negatives, "STRIDE", 16)
    monkeypatch.setattr(negatives, "MEMBERS", 8)
    assert same(spark, vectors(600, 8, 5, 4), HardNegatives(every=3))


def test_walks_end_early_in_clusters(spark):
    rows = vectors(400, 8, 2, 5)
    x = np.floor(256 * np.array([r[1] for r in rows]).astype(np.float32).astype(float))
    wave = negatives._Wave(np.arange(20), np.zeros(20, int), x[:20], np.linalg.norm(x[:20], axis=1), [], True)
    for k in range(20):
        wave.walkers.append((k, k + 1, negatives._unit(x[k : k + 1])[0], 0.0))
    scored = []
    kept = negatives._products
    try:
        negatives._products = lambda a, b, exact: scored.append(len(a) * len(b)) or kept(a, b, exact)
        best = negatives._Best(20, 5)
        stride, negatives.STRIDE = negatives.STRIDE, 16
        negatives._walk(wave, best, HardNegatives(), np.arange(400), np.zeros(400, int), x)
    finally:
        negatives._products, negatives.STRIDE = kept, stride
    assert sum(scored) < 0.7 * 20 * 400
    for k in range(20):
        others = sorted((-int(x[k] @ x[j]), j) for j in range(400) if j != k)[:5]
        assert [(-s, i) for s, i in zip(best.scores[k].tolist(), best.ids[k].tolist(), strict=True)] == others


def test_ties_copies_and_repeated_rows(spark):
    rows = [(k, [1.0, 0.5], k % 2) for k in range(60)]  # all scores tie
    rows += rows[:20]  # repeated rows are one
    rows += [(0, [1.0, 0.25], 1), (0, [1.0, 0.5], 0), (5, [0.9, 0.5], 0)]  # ids that repeat with other values
    assert same(spark, rows, HardNegatives(every=10))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(120, 3, 9)
    rows += [(200, None, 1), (300, [1.0, None, 0.0], 1), (400, [1.0, nan, 0.0], 1), (500, [inf, 0.0, 0.0], 1)]
    rows += [(600, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (700, [0.0, 0.0, 0.0], 2), (800, [], 3), (900, [1.0], 0)]
    assert same(spark, rows, HardNegatives(every=100))


def test_few_rows_of_a_label(spark):
    rows = [(0, [1.0, 1.0], 3), (1, [1.0, 0.9], 4), (2, [0.9, 1.0], 5), (100, [1.0, 1.0], 4), (101, [0.8, 0.9], 4)]
    same(spark, rows)


def test_scores_beyond_doubles(spark):
    rows = [(k, [1e6 * (k % 5 + 1), 1.0 + k, -3e5], k % 3) for k in range(40)]
    rows += [(100 + k, [3e20, 1.0, float(k)], k % 3) for k in range(10)]
    same(spark, rows, HardNegatives(every=10))


def test_negative_and_zero_scores(spark):
    rows = [(k, [(-1.0) ** k, 0.0], k % 3) for k in range(30)] + [(100 + k, [0.0, 0.0], k % 3) for k in range(10)]
    same(spark, rows, HardNegatives(every=10))


def test_no_rows_and_more_columns(spark):
    frame = spark.createDataFrame(vectors(50, 2, 3), SCHEMA)
    assert hard_negatives(frame.where("false")).collect() == []
    assert hard_negatives(frame.where("vec_id = 7")).collect() == []
    more = frame.withColumns({c: F.lit("x") for c in ("x", "slot", "score", "rank", "codes", "wave")})
    assert sorted(tuple(r) for r in hard_negatives(more, HardNegatives(every=10)).collect()) == plain(
        vectors(50, 2, 3), HardNegatives(every=10)
    )
