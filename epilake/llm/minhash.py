"""Near-duplicates by b-bit MinHash.

A document is the set of its distinct word shingles. Its signature holds the
minima of ``count`` hash functions; bands of whole minima propose groups, and
of each minimum only ``BITS`` low bits are kept, packed, to estimate the
similarity inside a group from the number of equal fields, corrected for those
that are equal by chance. Documents that may be alike by that estimate are
confirmed on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.components import components
from epilake.llm.tables import anonymous, map_batches, stored, with_row_ids

#: Low bits of each minimum that the packed signature keeps.
BITS = 4
#: Documents compared at once inside a task.
BLOCK = 192


@dataclass(frozen=True)
class NearDuplicates:
    """Parameters: ``width`` words a shingle, link at ``percent`` / 100 or more.

    ``rows`` minima make a band. ``bands`` follows from the chance that a pair
    exactly at the threshold shares no band, which is kept under ``missed``.
    """

    width: int = 5
    percent: int = 80
    rows: int = 4
    missed: float = 1e-7

    @property
    def bands(self) -> int:
        return int(np.ceil(np.log(self.missed) / np.log1p(-((self.percent / 100) ** self.rows))))

    @property
    def count(self) -> int:
        return self.bands * self.rows

    @property
    def least_estimate(self) -> float:
        """An estimate below this is over five standard errors under the threshold."""
        s = self.percent / 100
        equal = s + (1 - s) / 2**BITS
        return s - 5.5 * float(np.sqrt(equal * (1 - equal) / self.count)) / (1 - 2.0**-BITS)


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    values = words.mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return (values[:count] >> np.uint64(32)).astype(np.uint32), (values[count:] >> np.uint64(32)).astype(np.uint32) | 1


def minima(flat: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """The minima of ``count`` hash functions over each set; ``flat`` holds the sets one after another."""
    values = (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), count), np.uint32)
    for j, (x, m) in enumerate(zip(*_functions(count), strict=True)):
        out[:, j] = np.minimum.reduceat((values ^ x) * m, starts)
    return out


def packed(signatures: np.ndarray) -> np.ndarray:
    """``BITS`` = 4 low bits of two minima to a byte. High bits of a product mix best, so they are folded in first."""
    low = ((signatures ^ (signatures >> 16)) & 15).astype(np.uint8)
    if low.shape[1] % 2:
        low = np.pad(low, ((0, 0), (0, 1)))
    return low[:, ::2] | (low[:, 1::2] << 4)


_EQUAL = np.array([((x & 15) == 0) + ((x >> 4) == 0) for x in range(256)], np.uint8)


def estimates(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """Estimated similarity of every row of ``left`` with every row of ``right``."""
    equal = np.zeros((len(left), len(right)), np.int32)
    for k in range(left.shape[1]):
        equal += _EQUAL[left[:, k, None] ^ right[None, :, k]]
    equal -= count % 2  # the padding
    chance = 2.0**-BITS
    return (equal / count - chance) / (1 - chance)


def sketches(docs: DataFrame, rule: NearDuplicates) -> DataFrame:
    """``row_id, doc_id, n_shingles, digest, bands, signature`` of every row; no bands without words."""

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, digests, bands, packs = [], [], [], []
        for part in words.slices(batch.column("text")):
            sets = list(words.shingle_sets(part, rule.width))
            n = np.array([len(x) for x in sets], np.int64)
            full = np.flatnonzero(n)
            digest = np.zeros((len(sets), 2), np.uint64)
            band = np.zeros((len(sets), rule.bands), np.uint64)
            pack = np.zeros((len(sets), (rule.count + 1) // 2), np.uint8)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                digest[full, 0] = words.mixed(np.add.reduceat(flat, starts))
                digest[full, 1] = np.add.reduceat(words.mixed(flat ^ np.uint64(0x5851F42D4C957F2D)), starts)
                signatures = minima(flat, starts, rule.count)
                pack[full] = packed(signatures)
                wide = signatures.reshape(len(full), rule.bands, rule.rows).astype(np.uint64)
                key = np.broadcast_to(np.arange(1, rule.bands + 1, dtype=np.uint64), wide.shape[:2]).copy()
                for k in range(rule.rows):
                    key = words.mixed(key * np.uint64(0xD6E8FEB86659FD93) + wide[:, :, k])
                band[full] = key
            sizes.append(n)
            digests += [bytes(x) for x in digest]
            bands += [x if m else x[:0] for x, m in zip(band.view(np.int64), n, strict=True)]
            packs += [bytes(x) for x in pack]
        lengths = np.concatenate([[0], np.cumsum([len(x) for x in bands])]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("row_id"),
                batch.column("doc_id"),
                pa.array(np.concatenate(sizes)),
                pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(lengths, np.concatenate(bands)),
                pa.array(packs, pa.binary()),
            ],
            names=["row_id", "doc_id", "n_shingles", "digest", "bands", "signature"],
        )

    schema = "row_id long, doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"
    return map_batches(docs.select("row_id", "doc_id", "text"), sketch, schema)


def full_sets(docs: DataFrame, rule: NearDuplicates) -> DataFrame:
    """``rep, shingles`` with the whole set of every row as packed 64-bit values."""

    def gather(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [x.tobytes() for part in words.slices(batch.column("text")) for x in words.shingle_sets(part, rule.width)]
        return pa.RecordBatch.from_arrays(
            [batch.column("row_id"), pa.array(sets, pa.binary())], names=["rep", "shingles"]
        )

    return map_batches(docs.select("row_id", "text"), gather, "rep long, shingles binary")


def _linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of ``left`` x ``right`` (positions in ``sets``) reach the threshold, on full sets."""
    used = np.unique(np.concatenate([left, right]))
    flat = np.concatenate([sets[i] for i in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column] > 1  # a shingle of one document adds to no intersection
    column, owner = column[shared], owner[shared]
    _, column = np.unique(column, return_inverse=True)
    a, b = np.searchsorted(used, left), np.searchsorted(used, right)
    inter = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        i, j = np.searchsorted(column, [low, low + 2048])
        has = np.zeros((len(used), 2048), np.float32)
        has[owner[i:j], column[i:j] - low] = 1
        inter += has[a] @ has[b].T
    size = np.array([len(sets[i]) for i in used], np.int64)
    inter = inter.astype(np.int64)
    return 100 * inter >= percent * (size[a][:, None] + size[b][None, :] - inter)


def _spanning(n: int, pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs that join what was apart before."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def candidate_groups(reps: DataFrame) -> DataFrame:
    """``pivot, rep``: every bucket of a band, under the smallest document in it, the pivot itself included."""
    keyed = reps.select("rep", F.explode("bands").alias("band"))
    buckets = keyed.groupBy("band").agg(F.min("rep").alias("pivot"), F.max("rep").alias("most"))
    shared = stored(buckets.where("pivot < most").select("band", "pivot"), "buckets")
    members = keyed.join(shared, "band")  # tables on both sides, so that a large bucket can be split
    return members.select("pivot", "rep").distinct()


_ENDS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _unpacked(group: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Numbers, sets and signatures of the rows of a group."""
    sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
    marks = np.array([np.frombuffer(x, np.uint8) for x in group.column("signature").to_pylist()])
    return group.column("rep").to_numpy(), sets, marks


def _pairs(rule: NearDuplicates, sets: list[np.ndarray], marks: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of ``left`` x ``right`` are links: likely ones by their signatures, confirmed on full sets."""
    likely = estimates(marks[left], marks[right], rule.count) >= rule.least_estimate
    a, b = np.flatnonzero(likely.any(axis=1)), np.flatnonzero(likely.any(axis=0))
    if len(a) and len(b):
        likely[np.ix_(a, b)] &= _linked(sets, left[a], right[b], rule.percent)
    return likely


def _blocks_of(rows: DataFrame, label: str) -> DataFrame:
    """``pivot, many``: how many blocks the rows of each pivot are dealt to, of the pivots with several.

    A table of its own, so that a join with it can split a large group.
    """
    sizes = rows.groupBy("pivot").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias(label))
    return stored(sizes.where(F.col(label) > 1), "large")


def _dealt(rows: DataFrame, blocks: DataFrame, label: str) -> DataFrame:
    """``rows`` with the number of blocks of their pivot, 1 unless ``blocks`` has more."""
    return rows.join(blocks, "pivot", "left").withColumn(label, F.coalesce(label, F.lit(1).cast("long")))


def _steps(many: str):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(many) - 1))


def confirmed_links(groups: DataFrame, sets: DataFrame, rule: NearDuplicates) -> DataFrame:
    """Links ``a, b`` that connect whatever is connected inside the groups.

    First every member of a group is compared with the group's pivot, which goes
    out once with each block of members: the rows sent grow with the members. Members
    that link to it are connected already. Only those that do not are then
    compared, in blocks, with all other members; a task holds two blocks and puts
    out links that connect something new. Whether a pair links is decided by an
    estimate from the packed signatures and, where that is not far below the
    threshold, on full sets.
    """
    members = groups.where("pivot != rep")
    dealt = _dealt(members, _blocks_of(members, "blocks"), "blocks")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    heads = dealt.select("pivot", "blocks").distinct().select("pivot", F.col("pivot").alias("rep"), _steps("blocks").alias("block"))
    star = dealt.select("pivot", "rep", block.alias("block")).union(heads)

    def first(group: pa.Table) -> pa.Table:
        reps, own, marks = _unpacked(group)
        head = reps == group.column("pivot")[0].as_py()
        left, right = np.flatnonzero(head), np.flatnonzero(~head)
        found = _pairs(rule, own, marks, left, right)[0] if len(left) and len(right) else np.zeros(len(right), bool)
        return pa.table({"pivot": group.column("pivot").take(right), "rep": reps[right], "linked": found})

    rows = star.join(sets, "rep").groupBy("pivot", "block")
    compared = stored(rows.applyInArrow(first, "pivot long, rep long, linked boolean"), "compared")
    links = compared.where("linked").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))

    apart = compared.groupBy("pivot").agg(F.count("*").alias("n"), F.count_if(~F.col("linked")).alias("open"))
    apart = stored(apart.where("n > 1 AND open > 0").select("pivot"), "apart")
    rest = stored(compared.join(apart, "pivot"), "rest")
    lone = rest.where("NOT linked").select("pivot", "rep")
    lone_blocks, all_blocks = _blocks_of(lone, "lone"), _blocks_of(rest, "whole")
    lone = _dealt(_dealt(lone, lone_blocks, "lone"), all_blocks, "whole")
    lone = lone.select("pivot", "rep", F.pmod(F.xxhash64("rep"), F.col("lone")).alias("one"), _steps("whole").alias("two"), F.lit(True).alias("left"))
    whole = _dealt(_dealt(rest.select("pivot", "rep"), lone_blocks, "lone"), all_blocks, "whole")
    whole = whole.select("pivot", "rep", _steps("lone").alias("one"), F.pmod(F.xxhash64("rep"), F.col("whole")).alias("two"), F.lit(False).alias("left"))

    def second(group: pa.Table) -> pa.Table:
        reps, own, marks = _unpacked(group)
        side = group.column("left").to_numpy()
        left, right = np.flatnonzero(side), np.flatnonzero(~side)
        kept: list[tuple[int, int]] = []
        if len(left) and len(right):
            found = _pairs(rule, own, marks, left, right) & (reps[left][:, None] != reps[right][None, :])
            x, y = np.nonzero(found)
            names, place = np.unique(reps, return_inverse=True)
            kept = _spanning(len(names), zip(place[left[x]].tolist(), place[right[y]].tolist(), strict=True))
            kept = [(int(names[a]), int(names[b])) for a, b in kept]
        ends = np.array(kept, np.int64).reshape(-1, 2)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]}, schema=_ENDS)

    rows = lone.union(whole).join(sets, "rep").groupBy("pivot", "one", "two")
    return links.union(rows.applyInArrow(second, "a long, b long")).distinct()


def _marked(docs: DataFrame, rule: NearDuplicates) -> DataFrame:
    """``row_id, doc_id, n_shingles, component_id, stays`` for every row of ``docs(row_id, doc_id, text)``.

    ``stays``: whether the row is the one of its group that stays, that of the least id. Rows without an id are alone.
    """
    sketch = stored(sketches(docs, rule), "sketch")
    known = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    least = F.min(F.struct("doc_id", "row_id")).alias("least")
    nodes = stored(known.groupBy("digest", "n_shingles").agg(F.min("row_id").alias("rep"), least), "nodes")
    own = nodes.select(F.col("rep").alias("row_id"))
    reps = known.join(own, "row_id", "left_semi").select(F.col("row_id").alias("rep"), "bands", "signature")
    reps = stored(reps, "reps")
    groups = stored(candidate_groups(reps), "groups")
    wanted = groups.select(F.col("rep").alias("row_id")).distinct()
    texts = docs.select("row_id", "text").join(wanted.hint("shuffle_hash"), "row_id", "left_semi")
    sets = full_sets(texts, rule).join(reps.select("rep", "signature"), "rep")
    found = components(confirmed_links(groups, stored(sets, "sets"), rule)).select(F.col("node").alias("rep"), "component")
    held = stored(nodes.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "held")
    # One row for each node, so a large component is few rows of each task.
    firsts = stored(held.groupBy("component").agg(F.min("least").alias("first")), "firsts")
    final = held.join(firsts, "component").select("digest", "n_shingles", "first")
    rows = sketch.select("row_id", "doc_id", "n_shingles", "digest").join(final, ["digest", "n_shingles"], "left")
    alone = F.col("first").isNull() | F.col("doc_id").isNull()
    return rows.select(
        "row_id",
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (alone | (F.col("row_id") == F.col("first.row_id"))).alias("stays"),
    )


def _numbered(docs: DataFrame) -> DataFrame:
    return with_row_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))


def near_duplicates(docs: DataFrame, rule: NearDuplicates | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Rows with equal sets become one node before candidates are sought, so exact
    copies cost an aggregate. A document without words is linked with nothing.
    Rows that share an id are documents of their own. A NULL id is returned with a
    NULL component and is kept; other rows are kept if their id is their
    component's. Other columns of ``docs`` are ignored.
    """
    rows = _marked(_numbered(docs), rule or NearDuplicates())
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return rows.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def distinct_documents(docs: DataFrame, rule: NearDuplicates | None = None) -> DataFrame:
    """The rows of ``docs`` that stay when one of each group of near-duplicates does, with all their columns.

    The row of the least id stays, one of them where several have it. Rows without
    words or without an id stay.
    """
    plain = anonymous(docs, "doc_id", "text")
    numbered = with_row_ids(plain.withColumn("doc_id", F.col("doc_id").cast("long")))
    removed = _marked(numbered.select("row_id", "doc_id", "text"), rule or NearDuplicates()).where("NOT stays").select("row_id")
    rows = numbered.join(removed.hint("shuffle_hash"), "row_id", "left_anti")
    return rows.select(*plain.columns).toDF(*docs.columns)
