"""The additive model and the text features it uses."""

from __future__ import annotations

import math
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from epilake.llm import quality, words
from epilake.llm.gam import Boosting, fit
from epilake.llm.quality import FEATURES, accepted_documents, quality_scores, text_features

TABLES = Path("/root/testdata/sf0.01")


def test_learns_single_features_and_a_pair():
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = fit(x[:3000], y[:3000])
    assert {(1, 2)} <= {p[:2] for p in model.pairs}
    plain = fit(x[:3000], y[:3000], Boosting(pairs=0))
    right = lambda m: np.mean((m.predict(x[3000:]) > 0.5) == y[3000:])
    assert right(model) > right(plain) + 0.05


def test_scores_are_sums_of_lookups():
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 1, (500, 3))
    y = (x.sum(1) > 1.5).astype(float)
    model = fit(x, y)
    for row, score in zip(x[:20], model.predict(x[:20]), strict=True):
        total = model.base
        for k in range(3):
            total += model.tables[k][sum(e <= row[k] for e in model.edges[k])]
        for i, j, table in model.pairs:
            total += table[sum(e <= row[i] for e in model.pair_edges[i]), sum(e <= row[j] for e in model.pair_edges[j])]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def boosted_by_hand(x: list[list[float]], y: list[int], model, rule: Boosting):
    """Cyclic boosting over rows instead of bins: ``(tables, pair tables)`` by the edges and pairs of ``model``."""
    rows = range(len(x))
    total = [model.base] * len(x)
    chance = lambda t: 1 / (1 + math.exp(-t))
    place = lambda edges, v: sum(e <= v for e in edges)
    g = lambda part: sum(y[r] - chance(total[r]) for r in part)
    h = lambda part: sum(chance(total[r]) * (1 - chance(total[r])) for r in part)
    worth = lambda part: g(part) ** 2 / (h(part) + 1.0)
    value = lambda part: g(part) / (h(part) + 1.0) if part else 0.0

    def cut(part, bins, low, high):
        """The best gain and where, among the cuts of the bins ``low..high``; small sides gain nothing."""
        best = (0.0, low + 1)
        for k in range(low + 1, high):
            left, right = [r for r in part if bins[r] < k], [r for r in part if bins[r] >= k]
            if h(left) >= 1.5 and h(right) >= 1.5:
                best = max(best, (worth(left) + worth(right) - worth(part), k), key=lambda c: c[0])
        return best

    tables = [[0.0] * (len(e) + 1) for e in model.edges]
    for _ in range(rule.rounds):
        for k, table in enumerate(tables):
            bins = [place(model.edges[k], row[k]) for row in x]
            parts = [(0, len(table))]
            while len(parts) < rule.leaves:
                inside = lambda a, b: [r for r in rows if a <= bins[r] < b]
                (gain, at), a, b = max((cut(inside(a, b), bins, a, b), a, b) for a, b in parts)
                if gain <= 1e-9:
                    break
                parts.remove((a, b))
                parts += [(a, at), (at, b)]
            step = [0.0] * len(table)
            for a, b in parts:
                step[a:b] = [rule.rate * value(inside(a, b))] * (b - a)
            table[:] = [t + s for t, s in zip(table, step, strict=True)]
            total = [t + step[b] for t, b in zip(total, bins, strict=True)]
    pairs = []
    for i, j, _ in model.pairs:
        sizes = len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1
        bins = [(place(model.pair_edges[i], row[i]), place(model.pair_edges[j], row[j])) for row in x]
        table = [[0.0] * sizes[1] for _ in range(sizes[0])]
        for _ in range(rule.pair_rounds):
            best = (0.0, None)
            for one, two in ((0, 1), (1, 0)):
                own = [b[two] for b in bins]
                for k in range(1, sizes[one]):
                    sides = [r for r in rows if bins[r][one] < k], [r for r in rows if bins[r][one] >= k]
                    if min(h(s) for s in sides) < 1.5:
                        continue
                    cuts = [cut(s, own, 0, sizes[two]) for s in sides]
                    gain = sum(c[0] + worth(s) for c, s in zip(cuts, sides, strict=True)) - worth(list(rows))
                    if gain > best[0]:
                        best = gain, (one, two, k, sides, cuts)
            assert best[1]
            one, two, k, sides, cuts = best[1]
            own = [b[two] for b in bins]
            # Without a cut that gains, both halves still take their own values on either side of the place given.
            step = {}
            for side, (_, at) in enumerate(cuts):
                at = at if cuts[side][0] > 0 else 1
                for half in (0, 1):
                    step[side, half] = rule.rate * value([r for r in sides[side] if (own[r] >= at) == half])
                cuts[side] = cuts[side][0], at
            found = lambda b: step[int(b[one] >= k), int(b[two] >= cuts[int(b[one] >= k)][1])]
            for a in range(sizes[0]):
                for b in range(sizes[1]):
                    table[a][b] += found((a, b))
            total = [t + found(b) for t, b in zip(total, bins, strict=True)]
        pairs.append(table)
        break  # pairs after the first go round with it
    return tables, pairs


def test_fitting_by_hand():
    rng = np.random.default_rng(11)
    x = rng.uniform(-1, 1, (70, 3))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] * x[:, 2] > 0.1)).astype(float)
    rule = Boosting(bins=8, pair_bins=6, rounds=3, pair_rounds=2, pairs=1, leaves=3)
    model = fit(x, y, rule)
    tables, pairs = boosted_by_hand(x.tolist(), y.astype(int).tolist(), model, rule)
    for got, wanted in zip(model.tables, tables, strict=True):
        assert np.allclose(got, wanted, atol=1e-9) and any(wanted)
    assert np.allclose(model.pairs[0][2], pairs[0], atol=1e-9)


def test_one_class_or_none():
    assert fit(np.zeros((0, 2)), np.zeros(0)).predict(np.zeros((3, 2))).tolist() == [0.5] * 3
    assert len(set(fit(np.ones((5, 2)), np.ones(5)).predict(np.zeros((3, 2))).tolist())) == 1


def features(*texts):
    return np.concatenate([text_features(p) for p in words.slices(pa.array(texts, pa.string()))])


def test_features():
    texts = ["a b c", "", None, "A!! A!! a\nx\nx\n\nx", "é | # 12", "w " * 50, "no-spaces" * 30]
    rows = features(*texts)
    for text, row in zip(texts, rows, strict=True):
        assert np.allclose(features(text)[0], row)
    got = dict(zip(FEATURES, rows[3], strict=True))
    assert np.isclose(got["distinct_words"], 3 / 6) and np.isclose(got["next_word_equal"], 3 / 6)
    assert np.isclose(got["top_word"], 3 / 6) and np.isclose(got["repeated_lines"], 2 / 4)
    assert np.isclose(got["mark"], 4 / 16) and np.isclose(got["upper"], 2 / 16)
    assert not rows[1].any() and not rows[2].any()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(str(TABLES / f"{t}.parquet")) for t in ("documents", "labels"))
    found = quality_scores(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(str(TABLES / f"{t}.parquet")) for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    assert one == {r.doc_id: r.score for r in quality_scores(docs, turned).collect()}


def test_missing_repeated_and_extra(spark, documents):
    good = [(k, f"some plain words number {k} in a row") for k in range(40)]
    bad = [(100 + k, "!! ## !! " * (k + 1)) for k in range(40)]
    docs = documents(*good, *bad, (900, None), (901, ""), (None, "!! ##"), (5, good[5][1]))
    docs = docs.withColumn("features", F.lit(1)).withColumn("score", F.lit(2))
    marks = [(k, 1, 0) for k, _ in good] + [(k, 0, 0) for k, _ in bad] + [(None, 0, 0), (3, None, 0), (7777, 1, 0), (901, None, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = quality_scores(docs, labels).collect()
    assert len(found) == 84 and all(r.score is not None for r in found)
    by = {r.doc_id: r.predicted for r in found}
    assert all(by[k] == 1 for k, _ in good) and all(by[k] == 0 for k, _ in bad)
    kept = accepted_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {k for k, _ in good}
    assert len({r.score for r in quality_scores(docs, labels.where("false")).collect()}) == 1
    assert quality_scores(docs.where("false"), labels).collect() == []


def test_an_id_of_very_many_labels_counts_once(spark, documents, monkeypatch):
    """Separable texts, and thousands of label rows of one more id, under a low bound."""
    monkeypatch.setattr(quality, "LABELLED_ROWS", 100)
    good = "Plain words make whole sentences that people read, and they go on for a while. "
    rows = [(k, good * 3 + str(k) if k % 2 else "#$%& <<>> ||| " * 9 + str(k)) for k in range(400)]
    labels = [(k, k % 2, 0) for k in range(400)] + [(1000, 1, 0)] * 40_000
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality_scores(documents(*rows, (1000, good)), marks).where("doc_id < 400").collect()
    assert sum(r.predicted == r.doc_id % 2 for r in found) == 400


def test_rows_and_labels_that_repeat_change_nothing(spark, documents):
    rows = [(k, "a good text of words " * 5 if k % 2 else "#### $$$$ %%%%" * 5) for k in range(60)]
    marks = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    once = quality_scores(documents(*rows), marks)
    hot = [rows[1]] * 300
    often = quality_scores(documents(*rows, *hot), marks.union(marks.where("doc_id = 1")).union(marks.where("doc_id = 1")))
    scores = {r.doc_id: r.score for r in once.collect()}
    assert {r.doc_id: r.score for r in often.collect()} == scores
    # Labels that disagree: most of them decide.
    more = marks.union(spark.createDataFrame([(1, 0), (1, 0)], marks.schema))
    assert {r.doc_id: r.score for r in quality_scores(documents(*rows), more).collect()} != scores
