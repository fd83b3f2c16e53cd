"""Hard negatives by exact inner products: anchors in clusters walk shared lists.

Anchors are clustered by direction. A cluster sorts candidates once by an upper
bound of their score with any of its members, from the angle between candidate
and centre less the widest angle of a member; every member walks that list and
ends where the bound of what is left is certified to be below what it still
needs. The candidates stay in place: each task sorts those of its own part, a
few thousand at a time, and what a member has found in one part shortens its walk
of the next. Anchors come in waves of bounded size, the only thing broadcast.

A first walk finds the positives of each anchor (the nearest rows of its label),
a second the negatives that score close below each of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epilake.llm.tables import stored
from epilake.session import scratch_path

#: Numbers of candidates sorted together and of a wave of anchors, at most, and candidates scored in one product.
LIST, WAVE, STRIDE = 1 << 20, 1 << 20, 2_048
#: Anchors that the centres are fitted on, at most, and members of a cluster that walk together.
FITTED, MEMBERS = 4_096, 512
_NONE = np.iinfo(np.int64).min
_MOST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class HardNegatives:
    """``positives`` rows of the label, ``negatives`` rows of another for each.

    A negative scores from ``low`` / 100 of the positive's score up to that score.
    Anchors are the rows whose id ``every`` divides; labels of rows whose id
    ``moved`` divides go up by one among ``labels``. Components become
    ``floor(scale * x)``.
    """

    positives: int = 5
    negatives: int = 5
    low: int = 80
    every: int = 100
    moved: int = 7
    labels: int = 10
    scale: int = 256


def vectors(embeddings: DataFrame, rule: HardNegatives) -> DataFrame:
    """``vec_id, label, x`` of the rows that take part, each distinct one once."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"),
    )
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(finite)
    label = F.col("label")
    moved = F.when(F.col("vec_id") % rule.moved == 0, (label + 1) % rule.labels).otherwise(label)
    return rows.withColumn("label", moved).distinct()


def _codes(x: pa.Array, dim: int, scale: int) -> np.ndarray:
    """The components as whole numbers, shorter vectors filled up with zeros."""
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    sizes = np.diff(x.offsets.to_numpy())
    out = np.zeros((len(x), dim))
    out[np.arange(dim) < sizes[:, None]] = np.floor(scale * x.flatten().to_numpy())
    return out


def _products(left: np.ndarray, right: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as whole numbers, as doubles if those hold them; beyond 64 bits the bounds of 64 bits."""
    if exact:
        return (left @ right.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    found = whole(left) @ whole(right).T if left.size and right.size else np.zeros((len(left), len(right)), object)
    return np.clip(found, _NONE + 1, _MOST).astype(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def centres(sample: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Directions of about a cluster for every ``sqrt`` of the sample, by spherical k-means."""
    units = _unit(sample)
    centre = units[: max(1, min(64, int(np.sqrt(len(units)) / 2)))]
    for _ in range(rounds):
        own = np.argmax(units @ centre.T, axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, units)
        centre = _unit(np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, sums, centre))
    return centre


@dataclass
class _Wave:
    """Anchors by cluster, and the stretches of them that walk together with the centre and widest angle of each."""

    ids: np.ndarray
    labels: np.ndarray
    codes: np.ndarray
    norms: np.ndarray
    walkers: list[tuple[int, int, np.ndarray, float]]
    exact: bool
    #: Of each anchor the positives found, best first: scores and ids. Empty in the first walk.
    scores: np.ndarray | None = None
    positives: np.ndarray | None = None


def _wave(rows: pa.Table, dim: int, scale: int, centre: np.ndarray, exact: bool) -> _Wave:
    codes = _codes(rows.column("x"), dim, scale)
    units = _unit(codes)
    cluster = np.argmax(units @ centre.T, axis=1)
    order = np.argsort(cluster, kind="stable")
    codes, units, cluster = codes[order], units[order], cluster[order]
    walkers = []
    for c in np.unique(cluster):
        first, last = np.searchsorted(cluster, [c, c + 1])
        for a in range(first, last, MEMBERS):
            b = min(a + MEMBERS, last)
            widest = float(np.arccos(np.clip(units[a:b] @ centre[c], -1, 1)).max())
            walkers.append((a, b, centre[c], widest))
    ids, labels = (rows.column(c).to_numpy()[order] for c in ("vec_id", "label"))
    return _Wave(ids, labels, codes, np.linalg.norm(codes, axis=1), walkers, exact)


class _Best:
    """The ``k`` best of each slot: higher scores first, ties by smaller id."""

    def __init__(self, slots: int, k: int) -> None:
        self.scores = np.full((slots, k), _NONE)
        self.ids = np.full((slots, k), _MOST)
        self.k = k

    def add(self, slot: np.ndarray, score: np.ndarray, name: np.ndarray) -> None:
        touched = np.unique(slot)
        slot = np.concatenate([np.repeat(touched, self.k), slot])
        score = np.concatenate([self.scores[touched].ravel(), score])
        name = np.concatenate([self.ids[touched].ravel(), name])
        order = np.lexsort((name, ~score, slot))  # the complement turns the order round
        slot, score, name = slot[order], score[order], name[order]
        begins = np.searchsorted(slot, touched)
        best = begins[:, None] + np.arange(self.k)
        self.scores[touched], self.ids[touched] = score[best], name[best]


def _walk(wave: _Wave, best: _Best, rule: HardNegatives, ids: np.ndarray, labels: np.ndarray, codes: np.ndarray) -> None:
    """Every cluster's list over some candidates; each member walks until nothing that is left can count."""
    norms = np.linalg.norm(codes, axis=1)
    directions = codes / np.where(norms > 0, norms, 1)[:, None]
    slack = 1e-6 * norms.max(initial=0)
    first_walk = wave.scores is None
    if not first_walk:
        least = _least_scores(wave.scores, rule.low)
    for a, b, centre, widest in wave.walkers:
        angles = np.arccos(np.clip(directions @ centre, -1, 1))
        bounds = norms * np.cos(np.maximum(0, angles - widest))
        order = np.argsort(-bounds)
        members = np.arange(a, b)
        for start in range(0, len(order), STRIDE):
            if first_walk:
                needed = best.scores[members, -1]
            else:
                fifth = best.scores.reshape(len(wave.ids), -1, best.k)[members, :, -1]
                needed = np.maximum(least[members], fifth).min(axis=1)
            reach = wave.norms[members] * (bounds[order[start]] + slack) + 1
            members = members[reach >= needed.astype(float)]
            if not len(members):
                break
            here = order[start : start + STRIDE]
            scores = _products(wave.codes[members], codes[here], wave.exact)
            same = wave.labels[members][:, None] == labels[here][None, :]
            if first_walk:
                u, x = np.nonzero(same & (scores >= best.scores[members, -1][:, None]))
                score, x, u = scores[u, x], here[x], members[u]
                other = ids[x] != wave.ids[u]
                twins = np.flatnonzero(~other)  # rows of the anchor's id: all but the anchor itself
                other[twins] = (codes[x[twins]] != wave.codes[u[twins]]).any(axis=1)
                if other.any():
                    best.add(u[other], score[other], ids[x[other]])
                continue
            needed = np.maximum(least[members], best.scores.reshape(len(wave.ids), -1, best.k)[members, :, -1])
            u, x = np.nonzero(~same & (scores >= needed.min(axis=1)[:, None]) & (scores <= wave.scores[members, 0][:, None]))
            score, x = scores[u, x], here[x]
            fits = (score[:, None] >= needed[u]) & (score[:, None] <= wave.scores[members[u]])
            pair, j = np.nonzero(fits)
            if len(pair):
                best.add(members[u[pair]] * wave.scores.shape[1] + j, score[pair], ids[x[pair]])


def _least_scores(positives: np.ndarray, low: int) -> np.ndarray:
    """The least score of a negative of each positive: ``low`` / 100 of the positive's, rounded up; the greatest number where there is none."""
    whole, rest = np.divmod(positives, 100)
    least = whole * low - (-(rest * low) // 100)
    return np.where((positives == _NONE) | (least > positives), _MOST, least)


def _walked(rows: DataFrame, held: Broadcast[_Wave], rule: HardNegatives, dim: int) -> DataFrame:
    """``slot, anchor_id, positive_id, positive_score, score, vec_id``: the best of every task for each anchor or each of its positives."""
    size = max(256, min(16_384, LIST // max(dim, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = held.value
        first_walk = wave.scores is None
        per = 1 if first_walk else wave.scores.shape[1]
        best = _Best(len(wave.ids) * per, rule.positives if first_walk else rule.negatives)
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(x.num_rows for x in waiting) >= size:
                listed(waiting, wave, best)
                waiting = []
        listed(waiting, wave, best)
        slot, k = np.nonzero(best.scores != _NONE)
        anchor, j = np.divmod(slot, per)
        none = np.zeros(len(slot), np.int64)
        columns = {
            "slot": slot,
            "anchor_id": wave.ids[anchor],
            "positive_id": none if first_walk else wave.positives[anchor, j],
            "positive_score": none if first_walk else wave.scores[anchor, j],
            "score": best.scores[slot, k],
            "vec_id": best.ids[slot, k],
        }
        yield pa.RecordBatch.from_pydict({name: pa.array(x, pa.int64()) for name, x in columns.items()})

    def listed(waiting: list[pa.RecordBatch], wave: _Wave, best: _Best) -> None:
        if not waiting:
            return
        table = pa.Table.from_batches(waiting)
        for start in range(0, table.num_rows, size):
            part = table.slice(start, size)
            codes = _codes(part.column("x"), dim, rule.scale)
            _walk(wave, best, rule, part.column("vec_id").to_numpy(), part.column("label").to_numpy(), codes)

    schema = "slot long, anchor_id long, positive_id long, positive_score long, score long, vec_id long"
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
    k = rule.positives if held.value.scores is None else rule.negatives
    return rows.mapInArrow(run, schema).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, rule: HardNegatives | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``embeddings(vec_id, embedding, label)``.

    Rows without an id, label or vector, or with a component that is NULL or not
    finite, take no part. Rows that agree in id, label and vector are one row;
    rows that share only an id are different rows, each an anchor if its id is
    one's. Missing components of shorter vectors are zero. Scores beyond 64 bits
    count as the bounds of 64 bits. An anchor without positives, and a positive
    without negatives, has no rows. Other columns are ignored.
    """
    rule = rule or HardNegatives()
    spark = embeddings.sparkSession
    rows = stored(vectors(embeddings, rule), "vectors")
    most = F.max(F.aggregate("x", F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v)))).alias("most")
    anchors = rows.where(F.col("vec_id") % rule.every == 0)
    dim, most = rows.agg(F.max(F.size("x")).alias("dim"), most).first()
    dim, exact = dim or 0, (dim or 0) * (rule.scale * (most or 0.0) + 1) ** 2 < 2.0**53
    spread = F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(1 << 40))
    sample = anchors.orderBy(spread, "vec_id").limit(FITTED if dim <= 512 else max(64, (1 << 21) // dim)).select("x").toArrow()
    centre = centres(_codes(sample.column("x"), dim, rule.scale)) if sample.num_rows else None
    waves = -(-anchors.count() // max(64, min(16_384, WAVE // max(dim, 1))))
    folder = scratch_path(spark, "negatives")
    for number in range(waves):
        wave = _wave(anchors.where(spread % waves == number).toArrow(), dim, rule.scale, centre, exact)
        if not len(wave.ids):
            continue
        held = spark.sparkContext.broadcast(wave)
        found = _walked(rows, held, rule, dim).select("slot", "rank", "score", "vec_id").toArrow()
        held.unpersist()
        slot, rank = found.column("slot").to_numpy(), found.column("rank").to_numpy() - 1
        wave.scores = np.full((len(wave.ids), rule.positives), _NONE)
        wave.positives = np.zeros_like(wave.scores)
        wave.scores[slot, rank], wave.positives[slot, rank] = found.column("score").to_numpy(), found.column("vec_id").to_numpy()
        held = spark.sparkContext.broadcast(wave)
        _walked(rows, held, rule, dim).write.parquet(f"{folder}/wave={number}")
        held.unpersist()
    schema = "slot long, anchor_id long, positive_id long, positive_score long, score long, vec_id long, rank int"
    result = spark.read.schema(schema).parquet(f"{folder}/wave=*") if waves else spark.createDataFrame([], schema)
    return result.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
