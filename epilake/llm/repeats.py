"""Repeated byte strings of a fixed length, by parsing the corpus into phrases.

A rolling hash over windows of ``trigger`` bytes picks triggers: for every
starting point of a string of ``length`` bytes, the window in that string with
the least hash. Starting points with the same trigger make a phrase, which spans
all their strings. Equal strings have the same trigger at the same place, so two
suffixes of the corpus agree on ``length`` bytes only if their triggers agree.

Corpus order comes from the parse and two suffix arrays of its dictionary, the
distinct phrases. All phrases of a trigger are aligned at it: one array orders what
follows from the trigger on, the other what precedes it, read backwards, each with
the common lengths of neighbours. Suffixes that start ``d`` bytes before the
trigger tie on ``length`` bytes where the second array ties on ``d`` and the first
on ``length - d``. A phrase that the parse has more than once ties with itself.

A trigger with more than ``ranked`` phrases would make one task too large. Its
suffixes get names by digest (two halves of 64 bits) instead, in two refinements
that can be dealt to any number of tasks: blocks of starting points, and single
starting points of blocks that occur in several forms. Both ways are exact.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.tables import map_batches, stored, with_row_ids


@dataclass(frozen=True)
class Parsing:
    """How texts are parsed, and how much one task is given.

    ``ranked``: phrases of a trigger that one task orders.
    ``block``: starting points that are named together beyond that.
    ``frequent``: bound of the forms sent to all tasks, 16 bytes each; a form can be among them from 1024 occurrences on.
    """

    length: int = 400
    trigger: int = 64
    block: int = 32
    ranked: int = 1024
    frequent: int = 50_000


#: Bits of a place in a slice; the others are for the hash, so that all slices choose the same triggers.
_PLACE_BITS = 32
#: Phrases that are ordered at once.
_BUCKET = 2048


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _phrases(part: words.Slice, prefix: np.ndarray, rule: Parsing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last starting point and trigger of every phrase of a slice, in order.

    Starting points whose string would run over the end of its text are left out.
    """
    none = np.zeros(0, np.int64)
    n = len(part.data)
    if n < rule.length:
        return none, none, none
    at = np.arange(n - rule.trigger + 1)
    keys = words.span_hashes(prefix, at, at + rule.trigger)
    keys = (keys >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | at.astype(np.uint64)
    least = _sliding_least(keys, rule.length - rule.trigger + 1)
    trigger = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    valid = np.zeros(len(trigger) + 1, np.int8)
    starts, stops = part.offsets[:-1], part.offsets[1:] - rule.length + 1
    long = stops > starts
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, stops[long], -1)
    points = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(points):
        return none, none, none
    trigger = trigger[points]
    new = np.ones(len(points), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (points[1:] != points[:-1] + 1)
    first = np.flatnonzero(new)
    return points[first], points[np.append(first[1:], len(points)) - 1], trigger[first]


def _of_texts(part: words.Slice, first: np.ndarray) -> np.ndarray:
    """For each text the number of phrases before it."""
    return np.searchsorted(first, part.offsets)


def _lists(values: np.ndarray, bounds: list[int], kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _named(parts: list[list[np.ndarray]], counts: list[np.ndarray]) -> list[pa.ListArray]:
    """One list column for each kind of value, from the values of the slices and their numbers by text."""
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).tolist()
    return [_lists(np.concatenate([p[k] for p in parts]), bounds, pa.int64()) for k in range(len(parts[0]))]


def parsed(docs: DataFrame, rule: Parsing) -> DataFrame:
    """``doc_id, n_bytes, sha256`` and, by phrase, ``keys`` (names of triggers), ``forms`` (names of phrases), ``low, high`` and ``near`` (bytes before the trigger)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, digests, parts, counts = [], [], [], []
        for part in words.slices(batch.column("text")):
            prefix = words.prefix_hashes(part.data)
            low, high, trigger = _phrases(part, prefix, rule)
            keys = words.digests(part.data, trigger, trigger + rule.trigger)[:, 0]
            forms = words.digests(part.data, low, high + rule.length)[:, 1]
            forms = words.mixed(forms ^ words.mixed((trigger - low).astype(np.uint64)))
            of = _of_texts(part, low)
            base = np.repeat(part.offsets[:-1], np.diff(of))
            parts.append([keys.view(np.int64), forms.view(np.int64), low - base, high - base, trigger - low])
            counts.append(np.diff(of))
            for a, b in zip(part.offsets[:-1], part.offsets[1:], strict=True):
                digests.append(hashlib.sha256(part.data[a:b]).hexdigest())
                sizes.append(int(b - a))
        return pa.RecordBatch.from_arrays(
            [batch.column("row_id"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests), *_named(parts, counts)],
            names=["row_id", "doc_id", "n_bytes", "sha256", "keys", "forms", "low", "high", "near"],
        )

    schema = "row_id long, doc_id long, n_bytes long, sha256 string, keys array<long>, forms array<long>, low array<long>, high array<long>"
    schema += ", near array<long>"
    return map_batches(docs, run, schema)


def blocks(rows: DataFrame, rule: Parsing) -> DataFrame:
    """``row_id, keys, forms, low, high`` for the blocks of the phrases with the numbers ``wanted`` of ``rows(row_id, text, wanted)``.

    A block's key names the bytes that all its strings share, its form the bytes
    that they cover together; where those run over an end of the text, the form
    is its own.
    """
    size, length = rule.block, rule.length

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, counts = [], []
        wanted = batch.column("wanted").to_pylist()
        names = batch.column("row_id").to_numpy()
        for part in words.slices(batch.column("text")):
            prefix = words.prefix_hashes(part.data)
            low, high, trigger = _phrases(part, prefix, rule)
            of = _of_texts(part, low)
            n = part.last - part.first
            chosen = [np.sort(np.array(wanted[part.first + k], np.int64)) + of[k] for k in range(n)]
            own = np.repeat(np.arange(n), [len(x) for x in chosen])
            chosen = np.concatenate(chosen)
            low, high, trigger = low[chosen], high[chosen], trigger[chosen]
            first, last = (trigger - high) // size, (trigger - low) // size
            times = last - first + 1
            index = np.repeat(np.arange(len(chosen)), times)
            k = np.arange(len(index)) - np.repeat(np.cumsum(times) - times, times) + first[index]
            own, trigger = own[index], trigger[index]
            begin, end = part.offsets[own], part.offsets[own + 1]
            near = trigger - k * size
            keys = words.digests(part.data, near, near - size + 1 + length)[:, 0]
            far = near - size + 1
            whole = (far >= begin) & (near + length <= end)
            forms = words.digests(part.data, np.maximum(far, begin), np.minimum(near + length, end))[:, 1]
            alone = names[part.first + own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (near - begin).astype(np.uint64)
            forms = np.where(whole, forms, words.mixed(words.mixed(alone)))
            salt = words.mixed((k + 1).astype(np.uint64))
            keys = words.mixed(keys ^ salt)
            parts.append(
                [
                    keys.view(np.int64),
                    words.mixed(forms ^ salt).view(np.int64),
                    np.maximum(far, low[index]) - begin,
                    np.minimum(near, high[index]) - begin,
                ]
            )
            counts.append(np.bincount(own, minlength=n))
        return pa.RecordBatch.from_arrays([batch.column("row_id"), *_named(parts, counts)], names=["row_id", "keys", "forms", "low", "high"])

    return map_batches(rows, run, "row_id long, keys array<long>, forms array<long>, low array<long>, high array<long>")


def points(rows: DataFrame, rule: Parsing) -> DataFrame:
    """``row_id, keys, forms, low``: the two halves of the name of the string at each point of the stretches ``ranges`` of ``rows(row_id, text, ranges)``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, counts = [], []
        ranges = batch.column("ranges").to_pylist()
        for part in words.slices(batch.column("text")):
            at = []
            for k in range(part.last - part.first):
                marks = {p for r in ranges[part.first + k] for p in range(r["low"], r["high"] + 1)}
                at.append(np.array(sorted(marks), np.int64))
            n = np.array([len(x) for x in at])
            local = np.concatenate(at)
            start = local + np.repeat(part.offsets[:-1], n)
            name = words.digests(part.data, start, start + rule.length).view(np.int64)
            parts.append([name[:, 0], name[:, 1], local])
            counts.append(n)
        return pa.RecordBatch.from_arrays([batch.column("row_id"), *_named(parts, counts)], names=["row_id", "keys", "forms", "low"])

    return map_batches(rows, run, "row_id long, keys array<long>, forms array<long>, low array<long>")


def dictionary(rows: DataFrame, rule: Parsing) -> DataFrame:
    """``row_id, keys, alone, low, high, near, phrase`` for the phrases ``wanted`` of ``rows(row_id, text, wanted)``; ``phrase``: their bytes."""
    names = ["keys", "alone", "low", "high", "near"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        wanted = batch.column("wanted")
        of, cells = wanted.value_parent_indices().to_numpy(), wanted.flatten()
        cells = {c: cells.field(c) for c in names}
        texts = [memoryview(t.as_buffer()) if t.is_valid else b"" for t in batch.column("text")]
        ends = (cells["high"].to_numpy() + rule.length).tolist()
        phrases = [bytes(texts[k][a:b]) for k, a, b in zip(of.tolist(), cells["low"].to_pylist(), ends, strict=True)]
        own = batch.column("row_id").take(pa.array(of))
        return pa.RecordBatch.from_arrays([own, *cells.values(), pa.array(phrases, pa.binary())], names=["row_id", *names, "phrase"])

    return map_batches(rows, run, "row_id long, keys long, alone boolean, low long, high long, near long, phrase binary")


def _suffix_array(keys: list[int], suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of suffixes by key and bytes, and how many bytes each shares with the one before it (-1: not even the key)."""
    order = sorted(range(len(keys)), key=lambda k: (keys[k], suffixes[k]))
    held = [suffixes[k] for k in order]
    sizes = np.array([len(x) for x in held])
    width = int(sizes.max(initial=0)) + 1
    cells = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in held), np.uint8).reshape(len(held), width)
    common = np.full(len(held), -1)
    differ = cells[1:] != cells[:-1]
    first = np.where(differ.any(1), differ.argmax(1), width)
    first = np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))
    own = np.array(keys, np.int64)[order]
    common[1:] = np.where(own[1:] == own[:-1], first, -1)
    return np.array(order), common


def _tied(keys: list[int], phrases: list[bytes], near: np.ndarray, span: np.ndarray, rule: Parsing) -> np.ndarray:
    """For every phrase (rows) and number of bytes before the trigger (columns) whether the suffix there ties with one of another phrase.

    ``span``: starting points of a phrase but one; the first of them lies ``near`` bytes before the trigger.
    """
    n = len(keys)
    after, shared_after = _suffix_array(keys, [p[k:] for p, k in zip(phrases, near.tolist(), strict=True)])
    before, shared_before = _suffix_array(keys, [p[:k][::-1] for p, k in zip(phrases, near.tolist(), strict=True)])
    out = np.zeros((n, rule.length - rule.trigger + 1), bool)
    step = max(1, (1 << 18) // n)
    for low in range(0, out.shape[1], step):
        distance = np.arange(low, min(low + step, out.shape[1]))[:, None]
        # Suffixes that agree on so many bytes are neighbours in the array, so they have one number.
        left, right = np.empty((2, len(distance), n), np.int64)
        left[:, before] = np.cumsum(shared_before < distance, axis=1)
        right[:, after] = np.cumsum(shared_after < rule.length - distance, axis=1)
        there = (distance <= near) & (distance >= near - span)
        name = np.where(there, left * (n + 1) + right, -1 - np.arange(n))
        order = np.argsort(name, axis=1)
        name = np.take_along_axis(name, order, axis=1)
        same = np.zeros((len(distance), n + 1), bool)
        same[:, 1:-1] = name[:, 1:] == name[:, :-1]
        ties = np.zeros((len(distance), n), bool)
        np.put_along_axis(ties, order, same[:, 1:] | same[:, :-1], axis=1)
        out[:, low : low + len(distance)] = ties.T
    return out


def ranked_ties(phrases: DataFrame, buckets: int, rule: Parsing) -> DataFrame:
    """``row_id, low, high``: stretches of starting points of phrases that are ``alone`` whose suffix ties with one of another phrase.

    All phrases of a key are in one of the ``buckets``, each ordered by a task.
    """

    def run(table: pa.Table) -> pa.Table:
        near = table.column("near").to_numpy()
        first, last = table.column("low").to_numpy(), table.column("high").to_numpy()
        tied = _tied(table.column("keys").to_pylist(), table.column("phrase").to_pylist(), near, last - first, rule)
        tied &= table.column("alone").to_numpy()[:, None]
        edges = np.diff(tied[:, ::-1].astype(np.int8), axis=1, prepend=0, append=0)  # starting points ascend
        own, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        base = (first + near)[own] - (tied.shape[1] - 1)
        arrays = [pa.array(table.column("row_id").to_numpy()[own]), pa.array(base + begin), pa.array(base + end - 1)]
        return pa.table(arrays, names=["row_id", "low", "high"])

    bucket = F.pmod(F.xxhash64("keys"), F.lit(buckets)).alias("bucket")
    return phrases.select(bucket, "*").groupBy("bucket").applyInArrow(run, "row_id long, low long, high long")


def _exploded(rows: DataFrame) -> DataFrame:
    values = [c for c in ("keys", "forms", "low", "high", "near") if c in rows.columns]
    cell = F.posexplode(F.arrays_zip(*values)).alias("number", "cell")
    return rows.select("row_id", cell).select("row_id", "number", "cell.*")


def _forms(cells: DataFrame, label: str) -> DataFrame:
    """Per form (of a key that occurs more than once): how often it occurs, the forms of its key, and one occurrence."""
    found = cells.groupBy("keys", "forms").agg(F.count("*").alias("n"), F.min("row_id").alias("row_id"))
    found = stored(found, label)
    several = stored(found.groupBy("keys").agg(F.count("*").alias("kinds")).where("kinds > 1"), label)
    # Tables on both sides, so that the join can split a key with very many forms.
    joined = found.join(several, "keys", "left")
    joined = joined.withColumn("kinds", F.coalesce("kinds", F.lit(1))).where("n > 1 OR kinds > 1")
    return stored(joined, label)  # or joins by form would be dealt by key


def _settled(cells: DataFrame, forms: DataFrame, rule: Parsing) -> DataFrame:
    """Stretches of starting points whose form occurs more than once.

    Cells of the most frequent forms, at most ``rule.frequent`` forms, are found where they lie and not dealt by form.
    """
    again = forms.where("n > 1").select("keys", "forms", "n")
    least = max(1024, (again.agg(F.sum("n")).first()[0] or 0) // max(1, rule.frequent))
    frequent = F.broadcast(again.where(F.col("n") > least).select("keys", "forms"))
    others = again.where(F.col("n") <= least).select("keys", "forms")
    here = cells.join(frequent, ["keys", "forms"], "left_semi")
    dealt = cells.join(frequent, ["keys", "forms"], "left_anti").join(others, ["keys", "forms"], "left_semi")
    return here.union(dealt).select("row_id", "low", "high")


def _to_refine(cells: DataFrame, forms: DataFrame) -> DataFrame:
    """One occurrence, with the least row and place, of each form whose key has several forms."""
    several = forms.where("kinds > 1").select("keys", "forms", "row_id", "kinds", (F.col("n") == 1).alias("alone"))
    found = cells.join(several, ["keys", "forms", "row_id"])
    values = [c for c in ("low", "number", "high", "near") if c in cells.columns]
    one = found.groupBy("keys", "forms", "row_id", "kinds", "alone").agg(F.min(F.struct(*values)).alias("at"))
    return one.select("row_id", "keys", "kinds", "alone", "at.*")


def _named_ties(texts: DataFrame, refine: DataFrame, rule: Parsing) -> list[DataFrame]:
    """Stretches of starting points, by blocks and by points, that occur more than once among the phrases of ``refine``."""
    wanted = refine.groupBy("row_id").agg(F.collect_list("number").alias("wanted"))
    cells = _exploded(stored(blocks(texts.join(wanted, "row_id"), rule), "blocks"))
    found = _forms(cells, "block-forms")
    ranges = _to_refine(cells, found).groupBy("row_id").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    named = points(texts.join(ranges, "row_id"), rule)
    single = named.select("row_id", F.explode(F.arrays_zip("keys", "forms", "low")).alias("cell")).select("row_id", "cell.*")
    single = stored(single, "points")
    again = single.groupBy("keys", "forms").agg(F.count("*").alias("n")).where("n > 1").select("keys", "forms")
    hits = single.join(again, ["keys", "forms"], "left_semi").select("row_id", "low", F.col("low").alias("high"))
    return [_settled(cells, found, rule), hits]


def repeated_spans(docs: DataFrame, rule: Parsing) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows`` (``row_id, doc_id, n_bytes, sha256``), ``spans`` (``row_id, low, high``: starting points) and ``texts`` (``row_id, text``) of rows that may have spans."""
    parse = stored(parsed(docs, rule), "parse")
    cells = _exploded(parse)
    phrases = _forms(cells, "phrases")
    spans = stored(_settled(cells, phrases, rule), "settled")
    refine = stored(_to_refine(cells, phrases), "refine")
    touched = refine.select("row_id").union(spans.select("row_id")).distinct()
    texts = stored(docs.select("row_id", "text").join(touched.hint("shuffle_hash"), "row_id", "left_semi"), "texts")
    few, many = refine.where(F.col("kinds") <= rule.ranked), refine.where(F.col("kinds") > rule.ranked)
    cell = F.struct("keys", "alone", "low", "high", "near")
    wanted = few.groupBy("row_id").agg(F.collect_list(cell).alias("wanted"))
    buckets = max(1, few.count() // _BUCKET)
    spans = spans.union(stored(ranked_ties(dictionary(texts.join(wanted, "row_id"), rule), buckets, rule), "ties"))
    if not many.limit(1).isEmpty():
        for named in _named_ties(texts, many, rule):
            spans = spans.union(named)
    return parse.select("row_id", "doc_id", "n_bytes", "sha256"), spans, texts


def without_repeats(docs: DataFrame, rule: Parsing | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_sha256`` and ``kept`` for every row of ``docs(doc_id, text)``.

    Every byte covered by a string of ``length`` bytes that also starts anywhere
    else, in this row or another, is removed; all occurrences go. ``kept`` (the
    bytes left) is NULL where nothing was removed. A NULL text is empty; texts
    shorter than ``length`` bytes stay whole. Equal rows are rows of their own, so
    both lose what they share.
    """
    rule = rule or Parsing()
    length = rule.length
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    numbered = with_row_ids(numbered)
    rows, spans, texts = repeated_spans(numbered, rule)
    by_row = spans.groupBy("row_id").agg(F.collect_list(F.struct("low", "high")).alias("found"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, cuts, removed, digests = [], [], [], []
        for found, text in zip(batch.column("found").to_pylist(), batch.column("text"), strict=True):
            data = text.as_py()
            merged: list[list[int]] = []
            for low, high in sorted((r["low"], r["high"] + length) for r in found):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            edges = [0, *(x for span in merged for x in span), len(data)]
            left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            kept.append(left)
            cuts.append(edges[1:-1])
            removed.append(len(data) - len(left))
            digests.append(hashlib.sha256(left).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("row_id"), pa.array(removed, pa.int64()), pa.array(cuts, pa.list_(pa.int64())), pa.array(digests), pa.array(kept, pa.binary())],
            names=["row_id", "n_removed", "spans", "left_sha256", "kept"],
        )

    schema = "row_id long, n_removed long, spans array<long>, left_sha256 string, kept binary"
    cut = map_batches(texts.join(by_row, "row_id"), run, schema)
    out = rows.join(cut, "row_id", "left")
    return out.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<long>")).alias("spans"),
        F.coalesce("left_sha256", "sha256").alias("kept_sha256"),
        "kept",
    )
