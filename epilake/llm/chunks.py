"""Repeated passages by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where its top bits are zero, at
least ``LEAST`` and at most ``MOST`` bytes after the last end. The ends depend on the
32 bytes before them, so an insertion moves at most the chunks it touches. Chunks
are told apart by digest; a run of chunks that all occur earlier is removed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.tables import map_batches, stored

_GEAR = (words.BYTE_VALUES >> np.uint64(32)).astype(np.uint32)
_REACH = 32
_LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Chunking:
    """``bits`` zero bits end a chunk; ``run`` is the least length in bytes of a passage that is removed."""

    least: int = 16
    most: int = 256
    bits: int = 4
    run: int = 96


def _gear(data: np.ndarray) -> np.ndarray:
    """The hash after each byte: sums of byte values, shifted one bit for every later byte."""
    out = _GEAR[data]
    step = 1
    while step < _REACH:
        shifted = out[:-step] << np.uint32(step)
        out[step:] += shifted
        step *= 2
    return out


def chunk_ends(part: words.Slice, rule: Chunking) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of the texts end, and for each text the number of chunks before it."""
    at = np.flatnonzero(_gear(part.data) < np.uint32(1 << (32 - rule.bits))) + 1
    low = np.searchsorted(at, part.offsets[:-1] + _REACH, "left")
    high = np.searchsorted(at, part.offsets[1:], "left")
    ends: list[int] = []
    first = [0]
    candidates = at.tolist()
    for k, (start, stop) in enumerate(zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), strict=True)):
        last = start
        for end in [*candidates[low[k] : high[k]], stop]:
            while end - last > rule.most:
                last += rule.most
                ends.append(last)
            if end - last >= rule.least or (end == stop and end > last):
                ends.append(end)
                last = end
        first.append(len(ends))
    return np.array(ends, np.int64), np.array(first, np.int64)


def _digests(part: words.Slice, rule: Chunking) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ends, first = chunk_ends(part, rule)
    starts = np.zeros_like(ends)
    starts[1:] = ends[:-1]
    begin = first[:-1][first[:-1] < first[1:]]
    starts[begin] = part.offsets[:-1][first[:-1] < first[1:]]
    return starts, ends, first, words.digests(part.data, starts, ends).view(np.int64)


def chunk_rows(docs: DataFrame, rule: Chunking) -> DataFrame:
    """``row_id, doc_id, one, two``: the halves of the distinct chunk digests of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = []
        for part in words.slices(batch.column("text")):
            _, _, first, digests = _digests(part, rule)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                # Half a digest tells the chunks of one row apart.
                lists.append(digests[a:b][np.unique(digests[a:b, 0], return_index=True)[1]])
        lengths = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        halves = np.concatenate(lists)
        one, two = (pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.ascontiguousarray(halves[:, k]))) for k in (0, 1))
        return pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("doc_id"), one, two], names=["row_id", "doc_id", "one", "two"])

    return map_batches(docs, run, "row_id long, doc_id long, one array<long>, two array<long>")


def _cut(data: bytes, starts: np.ndarray, ends: np.ndarray, known: np.ndarray, rule: Chunking) -> tuple[bytes, list[int]]:
    """What is left of a text, and the starts and ends of its removed runs in bytes."""
    edge = np.diff(known.astype(np.int8), prepend=0, append=0)
    spans, left, last = [], [], 0
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        start, end = int(starts[a]), int(ends[b - 1])
        while start < end and data[start] & 0xC0 == 0x80:  # whole characters only
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if end - start >= rule.run:
            left.append(data[last:start])
            spans += [start, end]
            last = end
    left.append(data[last:])
    return b"".join(left), spans


def without_repeats(docs: DataFrame, rule: Chunking | None = None) -> DataFrame:
    """``doc_id, text, n_bytes, n_chunks, spans`` for every row of ``docs(doc_id, text)``; the text without its repeats.

    Of all occurrences of a chunk, the first one stays: in the document of the
    least id, and there the first. Runs of repeated chunks shorter than ``run``
    bytes stay too. A NULL text is empty. Rows that share an id count as one
    document, so an exact repetition of a row is no repeat. Rows with a NULL id
    are documents of their own and come last.
    """
    rule = rule or Chunking()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    names, place = ["row_id"], F.col("row_id")
    if rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        rows = rows.withColumn("row_id", F.col("doc_id"))
    else:
        rows = stored(rows.withColumn("row_id", F.monotonically_increasing_id()), "numbered")
        last = F.lit(_LAST).cast("decimal(20,0)") + 1 + F.col("row_id")
        names, place = ["row_id", "doc_id"], F.coalesce("doc_id", last).cast("decimal(20,0)")
    held = chunk_rows(rows, rule).select(*names, F.explode(F.arrays_zip("one", "two")).alias("digest")).select(*names, "digest.*")
    firsts = held.groupBy("one", "two").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    firsts = firsts.where("first < last").select("one", "two", "first")
    later = held.join(firsts, ["one", "two"]).where(place > F.col("first"))
    known = later.groupBy("row_id").agg(F.collect_set("one").alias("known"))
    schema = "doc_id long, text string, n_bytes long, n_chunks long, spans array<long>"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, sizes, counts, spans = [], [], [], []
        elsewhere = batch.column("known").to_pylist()
        for part in words.slices(batch.column("text")):
            starts, ends, first, digests = _digests(part, rule)
            for k in range(part.last - part.first):
                a, b, base = int(first[k]), int(first[k + 1]), int(part.offsets[k])
                data = part.data[base : part.offsets[k + 1]].tobytes()
                own = digests[a:b, 0]
                again = np.ones(b - a, bool)
                again[np.unique(own, return_index=True)[1]] = False
                if elsewhere[part.first + k]:
                    again |= np.isin(own, np.array(elsewhere[part.first + k], np.int64))
                text, cuts = _cut(data, starts[a:b] - base, ends[a:b] - base, again, rule) if again.any() else (data, [])
                texts.append(text.decode())
                sizes.append(len(data))
                counts.append(b - a)
                spans.append(cuts)
        arrays = [batch.column("doc_id"), pa.array(texts, pa.string()), *(pa.array(x, pa.int64()) for x in (sizes, counts))]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(spans, pa.list_(pa.int64()))], names=["doc_id", "text", "n_bytes", "n_chunks", "spans"])

    return map_batches(rows.join(known, "row_id", "left"), run, schema)
