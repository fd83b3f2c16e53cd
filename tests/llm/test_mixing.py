"""Targets against exact shares, and what the mix takes against its targets."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from epilake.llm.mixing import Mixture, mix, mixed_documents


def exact_targets(sizes: dict, percent: int = 150, weights=(5, 2, 1), most: int = 2) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, rest, out = Fraction(sum(sizes.values()) * percent, 100), set(order), {}
    while rest:
        level = left / sum(weight[s] for s in rest)
        full = {s for s in rest if most * sizes[s] < level * weight[s]}
        if not full:
            return out | {s: level * weight[s] for s in rest}
        out |= {s: Fraction(most * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        rest -= full
    return out


def rows():
    out, k = [], 0
    for source, count in (("a", 300), ("b", 50), ("c", 700), (None, 40), ("é", 200), ("Z", 10), ("empty", 3)):
        for n in range(count):
            out.append((k, "w " * (0 if source == "empty" else 1 + (n * n) % 37), "en", source))
            k += 1
    return out + [(k, None, "en", "a")]


@pytest.mark.parametrize("slice_rows", [16, 4096])
def test_targets_and_takes(documents, slice_rows):
    docs = documents(*rows())
    found = mix(docs, Mixture(slice_rows=slice_rows)).collect()
    sizes: Counter = Counter()
    for r in found:
        sizes[r.source] += r.size
    expected = exact_targets(sizes)
    taken: Counter = Counter()
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(expected[r.source]), rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 3 * 37
    again = mix(docs.repartition(7), Mixture(slice_rows=slice_rows)).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in found}


def test_documents_come_as_often_as_taken(documents):
    docs = documents(*rows(), (3, "w", "en", "a"), (3, "w", "en", "a"), (None, "w w", "de", None), (None, "w w", "de", None))
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    picks: Counter = Counter()
    for r in mix(docs).collect():
        picks[r.doc_id, r.source, r.size] += r.copies
    got = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in out.collect())
    assert got == +picks
    unique = documents(*rows())
    assert mixed_documents(unique).count() == sum(r.copies for r in mix(unique).collect())


def test_empty_and_wordless(documents):
    assert mix(documents((1, "a")).where("false")).collect() == []
    assert [(r.size, r.target, r.taken) for r in mix(documents((1, ""), (2, None))).collect()] == [(0, 0.0, 0)] * 2


def test_an_id_with_most_rows_is_divided(documents):
    rows = [(None, "w w w", "en", "a")] * 400 + [(7, "w w w", "en", "a")] * 300 + [(100 + k, "w w", "en", "b") for k in range(50)]
    docs = documents(*rows).withColumn("number", F.lit("own")).withColumn("parts", F.lit("own"))
    found = mix(docs, Mixture(slice_rows=8)).collect()
    sizes = {"a": 2100, "b": 100}
    expected = exact_targets(sizes)
    for source, target in expected.items():
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - target) <= 3 and len(own) == sum(r[3] == source for r in rows)
    out = mixed_documents(docs, Mixture(slice_rows=8))
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in found)


def test_rows_of_one_id_are_taken_each_by_its_own_count(documents):
    rows = [(1, f"text {k} " * (k % 5 + 1), "en", "ab"[k % 2]) for k in range(200)]
    out = Counter((r.text, r.source) for r in mixed_documents(documents(*rows)).collect())
    taken: Counter = Counter()
    for (text, source), n in out.items():
        assert n <= 2
        taken[source] += n * len(text.split())
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(text.split())
    for source, target in exact_targets(dict(sizes)).items():
        assert abs(taken[source] - target) <= 10
