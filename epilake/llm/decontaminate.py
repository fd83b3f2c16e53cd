"""Benchmark passages in documents, by Wu-Manber search over words.

The alphabet is the words. Patterns are the windows of the benchmark items; those
of one length are searched together. A table by block (two words) says how far
the window may move on; where it may not, the block is the end of some pattern:
its bucket of patterns is compared word by word, and then as text.
"""

from __future__ import annotations

import itertools
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.tables import anonymous, shared_file_system, stored
from epilake.session import scratch_path

#: Bytes of distinct benchmark texts and their item ids whose tables a task holds at once; larger sets are searched in turns.
BLOCK_BYTES = 4 << 20
#: Windows that one cursor of a search moves over; many cursors move together.
STRETCH = 64
TABLE_BITS = 18

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _found_words(part: words.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts and ends, words before each text, and word hashes."""
    data = words.LOWER[part.data]
    starts, ends, first = words.word_bounds(data, part.offsets, words.ALNUM)
    return data, starts, ends, first, words.word_hashes(data, starts, ends)


def _blocks(values: np.ndarray, width: int) -> np.ndarray:
    """A hash for every block of ``width`` (1 or 2) neighbouring words; the last axis shrinks by ``width - 1``."""
    if width == 1:
        return values
    return words.mixed(values[..., :-1] * _PRIME + values[..., 1:])


@dataclass
class _Items:
    """Words of some texts, one after another: their hashes, and their bytes in one buffer with a space between any two."""

    values: np.ndarray
    data: bytes
    starts: np.ndarray
    ends: np.ndarray

    def spelled(self, first: int, size: int) -> bytes:
        return self.data[self.starts[first] : self.ends[first + size - 1]]


class Patterns:
    """Tables for all windows of ``size`` words of some items. ``first``: where each distinct window begins in them.

    ``rows[bounds[k]:bounds[k + 1]]`` are the numbers of the texts that hold window ``k``.
    """

    def __init__(self, size: int, items: _Items, first: np.ndarray, texts: np.ndarray) -> None:
        self.size, self.width, self.items = size, min(2, size), items
        whole = np.ascontiguousarray(items.values[first[:, None] + np.arange(size)])
        _, example, kind = np.unique(whole.view(f"V{8 * size}").reshape(-1), return_index=True, return_inverse=True)
        held = np.unique(np.stack([kind.reshape(-1), texts]), axis=1)
        first = first[example]
        blocks = _blocks(items.values[first[:, None] + np.arange(size)], self.width)
        order = np.argsort(blocks[:, -1], kind="stable")
        self.first, blocks = first[order], blocks[order]
        begin, end = np.searchsorted(held[0], order, "left"), np.searchsorted(held[0], order, "right")
        self.bounds = np.concatenate([[0], np.cumsum(end - begin)])
        self.rows = held[1][np.repeat(begin - self.bounds[:-1], end - begin) + np.arange(self.bounds[-1])]
        self.suffixes = blocks[:, -1]
        self.shift = np.full(1 << TABLE_BITS, size - self.width + 1, np.int32)
        for j in range(blocks.shape[1]):
            np.minimum.at(self.shift, self._slot(blocks[:, j]), size - self.width - j)

    @staticmethod
    def _slot(blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and pattern numbers at which all words have equal hashes."""
        last = len(values) - self.size
        none = np.zeros(0, np.int64)
        if last < 0 or not len(self.first):
            return none, none
        blocks = _blocks(values, self.width)
        moves = self.shift[self._slot(blocks)]
        at = np.arange(0, last + 1, STRETCH)
        stop = np.minimum(at + STRETCH, last + 1)
        tail, held = self.size - self.width, []
        while len(at):
            move = moves[at + tail]
            held.append(at[move == 0])
            at = at + np.maximum(move, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        places = np.concatenate(held)
        low = np.searchsorted(self.suffixes, blocks[places + tail], "left")
        high = np.searchsorted(self.suffixes, blocks[places + tail], "right")
        times = high - low
        places, low = np.repeat(places, times), np.repeat(low, times)
        number = low + np.arange(len(low)) - np.repeat(np.cumsum(times) - times, times)
        for k in range(self.size):
            same = values[places + k] == self.items.values[self.first[number] + k]
            places, number = places[same], number[same]
        return places, number


def pattern_tables(texts: pa.Array, window: int) -> list[Patterns]:
    """Tables for the windows of some texts, one for each length; a text without words has none."""
    values, spelled, counts = [], [], []
    for part in words.slices(texts):
        data, starts, ends, first, found = _found_words(part)
        values.append(found)
        spelled += [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        counts.append(np.diff(first))
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    ends = np.cumsum([len(x) + 1 for x in spelled], dtype=np.int64) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)[: len(spelled)]
    items = _Items(np.concatenate([*values, np.zeros(0, np.uint64)]), b" ".join(spelled), starts, ends)
    begin = np.cumsum(n) - n
    tables = []
    for size in np.unique(np.minimum(n[n > 0], window)).tolist():
        own = np.flatnonzero(np.minimum(n, window) == size)
        windows = n[own] - size + 1
        text = np.repeat(own, windows)
        first = begin[text] + np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        tables.append(Patterns(size, items, first, text))
    return tables


class _Search:
    """What blocks of a benchmark, one after another, find in the texts of a batch."""

    def __init__(self, texts: pa.Array) -> None:
        self.texts = texts
        self.counts = np.zeros(len(texts), np.int64)
        self.spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
        self.items: list[set[str]] = [set() for _ in range(len(texts))]

    def add(self, tables: list[Patterns], ids: list[list[str]]) -> None:
        """Search for the tables of texts with these item ids."""
        for part in words.slices(self.texts):
            data, starts, ends, first, values = _found_words(part)
            self.counts[part.first : part.last] = np.diff(first)
            for table in tables:
                places, number = table.search(values)
                rows = np.searchsorted(first, places, "right") - 1
                inside = places + table.size <= first[rows + 1]
                for place, n, row in zip(places[inside].tolist(), number[inside].tolist(), rows[inside].tolist(), strict=True):
                    own = b" ".join([data[starts[k] : ends[k]].tobytes() for k in range(place, place + table.size)])
                    if own == table.items.spelled(int(table.first[n]), table.size):
                        at = place - int(first[row])
                        self.spans[part.first + row].append((at, at + table.size))
                        for text in table.rows[table.bounds[n] : table.bounds[n + 1]].tolist():
                            self.items[part.first + row].update(ids[text])

    def columns(self) -> dict[str, pa.Array]:
        merged = []
        for spans in self.spans:
            out: list[int] = []
            for start, end in sorted(spans):
                if out and start <= out[-1]:
                    out[-1] = max(out[-1], end)
                else:
                    out += [start, end]
            merged.append(out)
        return {
            "wm_words": pa.array(self.counts),
            "wm_spans": pa.array(merged, pa.list_(pa.int64())),
            "wm_items": pa.array([sorted(x) for x in self.items], pa.list_(pa.string())),
        }


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` (with a column ``text``) and ``wm_words, wm_spans, wm_items``.

    ``wm_spans`` holds the starts and ends, in words, of the stretches that lie
    inside an occurrence; ``wm_items`` the ids, as strings, of the items of
    ``benchmark(item_id, text)`` found. A NULL text has no words. An item with a
    NULL id marks words but is not listed. The distinct texts of the benchmark
    are cut into blocks of about ``BLOCK_BYTES``, whose tables tasks write to the
    shared folder; a search task reads and holds the tables of one block at a time.
    """
    paths = stored_tables(benchmark, window)
    schema = docs.withColumns(
        {
            "wm_words": F.lit(0).cast("long"),
            "wm_spans": F.array().cast("array<long>"),
            "wm_items": F.array().cast("array<string>"),
        }
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            search = _Search(batch.column("text"))
            for path in paths:
                if kept is None or kept[0] != path:
                    kept = None  # before the next is read
                    kept = (path, _read_block(path))
                search.add(*kept[1])
            if not paths:
                search.add([], [])
            found = search.columns()
            yield pa.RecordBatch.from_arrays([*batch.columns, *found.values()], names=[*batch.schema.names, *found])

    return docs.mapInArrow(run, schema)


def _read_block(path: str) -> tuple[list[Patterns], list[list[str]]]:
    system, name = shared_file_system(path)
    with system.open_input_stream(name) as file:
        return pickle.loads(file.read())


def stored_tables(benchmark: DataFrame, window: int) -> list[str]:
    """The paths of files with the tables of one block each; at least one block. Only the paths reach the driver.

    The item ids of a text are dealt to several rows, by hash, if all ids
    together are larger than a block.
    """
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL")
    ids = bench.agg(F.sum(F.octet_length("item_id"))).first()[0] or 0
    part = F.pmod(F.xxhash64("item_id"), F.lit(-(-ids // BLOCK_BYTES) or 1))
    grouped = bench.groupBy("text", part.alias("part")).agg(F.collect_set("item_id").alias("ids"))
    size = F.octet_length("text") + F.aggregate("ids", F.lit(0), lambda n, x: n + F.octet_length(x))
    grouped = stored(grouped.select("text", "part", "ids", size.cast("long").alias("size")), "benchmark")
    blocks = max(1, -(-(grouped.agg(F.sum("size")).first()[0] or 0) // BLOCK_BYTES))
    folder = scratch_path(benchmark.sparkSession, "benchmark-tables")
    system, base = shared_file_system(folder)
    system.create_dir(base, recursive=True)

    def write(block: pa.Table) -> pa.Table:
        block = block.sort_by([("text", "ascending"), ("part", "ascending")])  # the same files if a task is run again
        number = block.column("block")[0].as_py()
        sizes, cuts, held = block.column("size").to_pylist(), [0], 0
        for k, size in enumerate(sizes):  # hashes deal unevenly
            if held and held + size > BLOCK_BYTES:
                cuts.append(k)
                held = 0
            held += size
        for turn, (first, last) in enumerate(itertools.pairwise([*cuts, len(sizes)])):
            own = block.slice(first, last - first)
            made = pattern_tables(own.column("text").combine_chunks(), window), own.column("ids").to_pylist()
            files, base = shared_file_system(folder)
            path = f"{base}/.{number:08d}-{turn:08d}-{uuid.uuid4().hex}"
            with files.open_output_stream(path) as out:
                out.write(pickle.dumps(made, protocol=5))
            files.move(path, f"{base}/{number:08d}-{turn:08d}.tables")
        return pa.table({"block": pa.array([number] * len(cuts), pa.int64()), "turn": pa.array(range(len(cuts)), pa.int64())})

    dealt = grouped.select(F.pmod(F.xxhash64("text", "part"), F.lit(blocks)).alias("block"), "text", "part", "ids", "size")
    written = stored(dealt.groupBy("block").applyInArrow(write, "block long, turn long"), "benchmark-blocks")
    return [f"{folder}/{row['block']:08d}-{row['turn']:08d}.tables" for row in written.orderBy("block", "turn").collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, contaminated`` for every row of ``docs(doc_id, text)``."""
    rows = find_passages(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, window)
    hit = F.aggregate(
        F.transform("wm_spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return rows.select(
        "doc_id",
        F.col("wm_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("wm_items").cast("long").alias("n_items"),
        F.col("wm_items").alias("items"),
        (F.size("wm_spans") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no benchmark passage occurs, with all their columns."""
    plain = anonymous(docs, "text")
    rows = find_passages(plain, benchmark, window).where(F.size("wm_spans") == 0)
    return rows.select(*plain.columns).toDF(*docs.columns)
