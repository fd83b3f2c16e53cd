"""Token ids in Arrow files of fixed-size-list batches.

A file holds the documents of one range of ids, in ascending order, packed into
sequences of equal length: ``ids`` (fixed-size list), ``mask`` (fixed-size list
of booleans, false for the padding after the last document), ``ends``
(fixed-size list of booleans, true where a document ends) and ``docs`` (the ids
of the documents that end in the sequence). Nothing is compressed, so a
memory-mapped file gives any sequence without a copy.
"""

from __future__ import annotations

import itertools
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.tables import shared_file_system, stored
from epilake.session import scratch_path

#: Distinct pieces kept with their ids by a task before it starts anew.
CACHE_WORDS = 1_000_000
SLICE_BYTES = 1 << 20
#: Ids for each file that the driver sees when it divides them into ranges.
SAMPLED = 64
#: A word of Latin letters, with or without a space before it.
_PLAIN = re.compile(r" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+")
#: Kinds of bytes: a space, ASCII letters, ASCII punctuation but the apostrophe, other visible ASCII, lead and later bytes.
_SPACE, _LETTER, _PUNCTUATION, _OTHER, _LEAD, _TAIL = range(1, 7)
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = _PUNCTUATION
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KINDS[[*range(0x30, 0x3A), 0x27]] = _OTHER
_KINDS[0x20] = _SPACE
_KINDS[0xC3:0xE0] = _LEAD
_KINDS[0x80:0xC0] = _TAIL


@dataclass(frozen=True)
class TokenFiles:
    """``tokenizer``: path of a byte-level BPE file. ``end``: id put after each document.

    ``added``: the tokenizer's added tokens, special ones too, get their own ids
    where a text spells them, as the library has it; if false, they are text
    like any other.

    A task writes the documents of one range of about ``docs_per_file`` ids, or of
    more where there are more than ``most_ranges`` such ranges, to files that each end
    with the document that brings them to ``ids_per_file`` ids.
    """

    tokenizer: str
    end: int = 2
    length: int = 1024
    batch: int = 512
    docs_per_file: int = 4096
    most_ranges: int = 16_384
    ids_per_file: int = 1 << 26
    added: bool = False


class _Encoder:
    """Encodes slices of texts. Each distinct piece is encoded once, until ``CACHE_WORDS`` are held."""

    def __init__(self, path: str, added: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = [t for t in self.tokenizer.get_added_tokens_decoder().values() if added or not t.special]
        names = sorted((t.content.encode() for t in tokens), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, names))) if names else None
        #: Whether added tokens are found without regard to what surrounds them.
        self.free = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in tokens)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in visible]
        self.alphabet = {b: 256 + k for k, b in enumerate(others)}
        self.forget()

    def forget(self) -> None:
        # Hashes of pieces in order, the slot of each, and by slot where its ids and its bytes begin.
        self.known = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.starts = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, self.dtype)
        self.spelled = np.zeros(1 << 16, np.int64)
        self.bytes = np.zeros(1 << 18, np.uint8)

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece. Plain words need no pre-tokenizer, which would leave them as they are."""
        text = data.decode()
        if _PLAIN.fullmatch(text) and not (self.added and self.added.search(data)):
            name = text.replace(" ", "\u0120") if text.isascii() else data.decode("latin-1").translate(self.alphabet)
            return [t.id for t in self.tokenizer.model.tokenize(name)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def added_spans(self, part: words.Slice) -> np.ndarray:
        """Begin and end of every added token, or of every text with one where what surrounds it counts."""
        data = part.data.tobytes()
        if self.added is None or not self.added.search(data):
            return np.zeros((0, 2), np.int64)
        spans = []
        for a, b in itertools.pairwise(part.offsets.tolist()):
            found = [m.span() for m in self.added.finditer(data, a, b)]
            spans += found if self.free else [(a, b)] * bool(found)
        return np.array(spans, np.int64).reshape(-1, 2)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        count = len(self.known)
        new = [self.piece(x) for x in pieces]
        ends = np.cumsum([len(x) for x in new]) + self.starts[count]
        while len(self.starts) <= count + len(new):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.starts[count] : ends[-1]] = [i for x in new for i in x]
        self.starts[count + 1 : count + 1 + len(new)] = ends
        spelled = np.cumsum([len(x) for x in pieces]) + self.spelled[count]
        while len(self.spelled) < len(self.starts):
            self.spelled = np.concatenate([self.spelled, np.zeros_like(self.spelled)])
        while len(self.bytes) < spelled[-1]:
            self.bytes = np.concatenate([self.bytes, np.zeros_like(self.bytes)])
        self.bytes[self.spelled[count] : spelled[-1]] = np.frombuffer(b"".join(pieces), np.uint8)
        self.spelled[count + 1 : count + 1 + len(new)] = spelled
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.slots = np.concatenate([self.slots, count + np.arange(len(new))])[order]

    def encode(self, part: words.Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, the same as encoding each text whole, and for each text the number of ids before it."""
        spans = self.added_spans(part)
        if len(spans):
            offsets = np.sort(np.concatenate([part.offsets, np.unique(spans)]))
            starts, _ = piece_starts(words.Slice(part.first, part.last, part.data, offsets))
            span = np.searchsorted(spans[:, 0], starts) - 1  # the last that begins before
            starts = starts[(span < 0) | (starts >= spans[span, 1])]
            first = np.searchsorted(starts, part.offsets)
        else:
            starts, first = piece_starts(part)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(part.offsets), np.int64)
        ends = np.append(starts[1:], len(part.data))
        hashes = words.word_hashes(part.data, starts, ends)
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        example, names = order[new], ordered[new]
        if len(self.known) + len(names) > CACHE_WORDS:
            self.forget()
        place = np.searchsorted(self.known, names)
        found = place < len(self.known)
        found[found] = self.known[place[found]] == names[found]
        known = np.empty(len(names), np.int64)
        known[found] = self.slots[place[found]]
        unknown = np.flatnonzero(~found)
        if len(unknown):
            data, at = part.data.tobytes(), example[unknown]
            pieces = [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            known[unknown] = len(self.known) + np.arange(len(unknown))
            self._learn(names[unknown], pieces)
        slot = known[kind]
        if not self._spells(slot, part.data, starts[0]):
            return self._one_by_one(part)
        low = self.starts[slot]
        sizes = self.starts[slot + 1] - low
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(low - before[:-1], sizes) + np.arange(before[-1])]
        return ids, before[first]

    def _spells(self, slot: np.ndarray, data: np.ndarray, start: int) -> bool:
        """Whether the pieces in these slots, one after another, are the data: a hash alone does not decide."""
        low = self.spelled[slot]
        sizes = self.spelled[slot + 1] - low
        before = np.cumsum(sizes) - sizes
        if before[-1] + sizes[-1] != len(data) - start:
            return False
        return np.array_equal(self.bytes[np.repeat(low - before, sizes) + np.arange(len(data) - start)], data[start:])

    def _one_by_one(self, part: words.Slice) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a slice in which two pieces have the same hash, each text encoded whole."""
        data = part.data.tobytes()
        texts = [data[a:b].decode() for a, b in itertools.pairwise(part.offsets.tolist())]
        ids = [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        before = np.cumsum([0, *map(len, ids)])
        return np.array([i for x in ids for i in x], self.dtype), before


def piece_starts(part: words.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin that are encoded alike in any context, and for each text the number of pieces before it.

    They begin with a text, at a single space between visible characters, and at
    ASCII punctuation (but the apostrophe) after an ASCII letter. Around spaces
    only ASCII and two-byte letters from U+00C0 on count as visible.
    """
    data = part.data
    kind = np.zeros(len(data) + 2, np.uint8)
    kind[1:-1] = _KINDS[data]
    here, before, after = kind[1:-1], kind[:-2], kind[2:]
    two = np.zeros(len(data), bool)  # after the last byte of a two-byte character
    two[2:] = (kind[2:-2] == _TAIL) & (kind[1:-3] == _LEAD)
    left = (before == _LETTER) | (before == _PUNCTUATION) | (before == _OTHER) | two
    right = (after == _LETTER) | (after == _PUNCTUATION) | (after == _OTHER) | (after == _LEAD)
    begins = ((here == _SPACE) & left & right) | ((here == _PUNCTUATION) & (before == _LETTER))
    begin = part.offsets[:-1][part.offsets[:-1] < part.offsets[1:]]
    inside = part.offsets[1:-1]
    last = inside[inside > 0] - 1
    begins[last[here[last] == _SPACE]] = False  # a space that ends a text
    begins[begin] = True
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, part.offsets)


_loaded: dict[tuple[str, bool], _Encoder] = {}


def encoder(path: str, added: bool = False) -> _Encoder:
    if (path, added) not in _loaded:
        _loaded[path, added] = _Encoder(path, added)
    return _loaded[path, added]


def token_rows(docs: DataFrame, rule: TokenFiles, files: _Files) -> DataFrame:
    """``file, doc_id, ids``: the ids of every text (NULL: empty) and the end id, deflated, and the file that holds the document."""
    path, added, end = rule.tokenizer, rule.added, rule.end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = encoder(path, added)
        tail = np.array([end], held.dtype).tobytes()
        for batch in batches:
            place = pa.array(files.places(batch.column("doc_id"), batch.column("part")))
            for part in words.slices(batch.column("text"), SLICE_BYTES):
                ids, before = held.encode(part)
                lists = [zlib.compress(ids[a:b].tobytes() + tail, 1) for a, b in zip(before[:-1], before[1:], strict=True)]
                rows = part.last - part.first
                own = [place.slice(part.first, rows), batch.column("doc_id").slice(part.first, rows), pa.array(lists, pa.binary())]
                yield pa.RecordBatch.from_arrays(own, names=["file", "doc_id", "ids"])

    return docs.select("doc_id", "text", "part").mapInArrow(run, "file long, doc_id long, ids binary")


class _Writer:
    """One file: documents in, equal sequences out; visible under its name only when complete."""

    def __init__(self, folder: str, name: int, turn: int, dtype: type, rule: TokenFiles) -> None:
        self.system, base = shared_file_system(folder)
        self.name, self.turn = name, turn
        self.path = f"{base}/{name:08d}-{turn:08d}.arrow"
        self.own = f"{base}/.{name:08d}-{turn:08d}-{uuid.uuid4().hex}"
        self.rule, self.dtype, n = rule, dtype, rule.length
        self.schema = pa.schema(
            [
                ("ids", pa.list_(pa.from_numpy_dtype(dtype), n)),
                ("mask", pa.list_(pa.bool_(), n)),
                ("ends", pa.list_(pa.bool_(), n)),
                ("docs", pa.list_(pa.int64())),
            ]
        )
        self.sink = self.system.open_output_stream(self.own)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = self.tokens = self.documents = 0
        self.marks: list[tuple[int, int | None]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        values = np.frombuffer(ids, self.dtype)
        self.parts.append(values)
        self.held += len(values)
        self.tokens += len(values)
        self.documents += 1
        self.marks.append((self.held - 1, doc_id))
        if self.held >= self.rule.length * self.rule.batch:
            self.flush(self.held // self.rule.length)

    def flush(self, rows: int) -> None:
        n = self.rule.length
        size = rows * n
        if not size:
            return
        flat = np.concatenate(self.parts)
        real = min(len(flat), size)
        ids, mask, ends = np.zeros(size, self.dtype), np.zeros(size, bool), np.zeros(size, bool)
        ids[:real], mask[:real] = flat[:real], True
        done = [m for m in self.marks if m[0] < size]
        at = np.array([m[0] for m in done], np.int64)
        ends[at] = True
        offsets = np.searchsorted(at, np.arange(rows + 1) * n).astype(np.int32)
        docs = pa.ListArray.from_arrays(pa.array(offsets), pa.array([m[1] for m in done], pa.int64()))
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), n) for x in (ids, mask, ends)]
        self.file.write_batch(pa.RecordBatch.from_arrays([*lists, docs], schema=self.schema))
        self.marks = [(at - size, doc) for at, doc in self.marks[len(done) :]]
        self.parts = [flat[real:]]
        self.held = len(flat) - real

    def close(self) -> None:
        self.flush(-(-self.held // self.rule.length))
        self.file.close()
        self.sink.close()
        self.system.move(self.own, self.path)


def write_token_files(docs: DataFrame, folder: str, rule: TokenFiles) -> DataFrame:
    """Write all of ``docs(doc_id, text)`` to new files in ``folder``; returns ``file, turn, documents, tokens``.

    ``file`` numbers ranges of about ``docs_per_file`` ids, and ``turn`` the files of
    one; a NULL id comes before all others. The rows of an id that has more are
    dealt to ranges of their own. A task that is run again writes the same file once
    more under the same name.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    files = _files(docs.select("doc_id"), rule)
    docs = files.dealt(docs)
    path, added = rule.tokenizer, rule.added
    system, base = shared_file_system(folder)
    system.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(path, added).dtype
        writer, name, turn = None, None, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("file", "doc_id", "ids")]
            for file, doc_id, ids in zip(*columns, strict=True):
                if file != name:
                    if writer:
                        yield closed(writer)
                    writer, name, turn = None, file, 0
                writer = writer or _Writer(folder, file, turn, dtype, rule)
                writer.add(doc_id, zlib.decompress(ids))
                if writer.tokens >= rule.ids_per_file:
                    yield closed(writer)
                    writer, turn = None, turn + 1
        if writer:
            yield closed(writer)

    def closed(writer: _Writer) -> pa.RecordBatch:
        writer.close()
        row = {"file": writer.name, "turn": writer.turn, "documents": writer.documents, "tokens": writer.tokens}
        return pa.RecordBatch.from_pydict({name: [value] for name, value in row.items()})

    rows = token_rows(docs, rule, files)
    rows = rows.repartitionById(files.count, F.col("file").cast("int")).sortWithinPartitions("file", "doc_id", "ids")
    written = rows.mapInArrow(run, "file long, turn long, documents long, tokens long")
    return stored(written, "token-manifest")


class _Files:
    """Numbers of files, from the last ids of ranges and the ids that have several files, with the numbers of those."""

    def __init__(self, bounds: list[int], parts: dict[int | None, int]) -> None:
        self.nulls, self.parts = parts.get(None, 1), {k: n for k, n in parts.items() if k is not None}
        before = [k - 1 for k in self.parts if k > -(1 << 63)]
        self.last = np.unique(np.array([*bounds, *before, *self.parts], np.int64))
        sizes = np.ones(len(self.last) + 1, np.int64)
        sizes[np.searchsorted(self.last, np.array([*self.parts], np.int64))] = [*self.parts.values()]
        # NULL ids share the first file, unless they have several.
        self.first = np.cumsum(sizes) - sizes + (self.nulls if self.nulls > 1 else 0)
        self.count = int(self.first[-1] + sizes[-1])

    def places(self, ids: pa.Array, part: pa.Array) -> np.ndarray:
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        place = self.first[np.searchsorted(self.last, ids.fill_null(0).to_numpy())]
        return np.where(known, place, 0) + part.to_numpy()

    def dealt(self, docs: DataFrame) -> DataFrame:
        """``docs`` and the ``part`` of its id that a row belongs to, the same in every run of a task."""
        if not self.parts and self.nulls < 2:
            return docs.withColumn("part", F.lit(0).cast("long"))
        spark, parts = docs.sparkSession, [*self.parts.items(), (None, self.nulls)]
        sizes = F.broadcast(spark.createDataFrame(parts, "id long, parts long"))
        rows = docs.withColumn("row_id", F.monotonically_increasing_id()).join(sizes, F.col("doc_id").eqNullSafe(F.col("id")), "left")
        part = F.pmod(F.xxhash64("row_id"), F.coalesce("parts", F.lit(1)))
        return stored(rows.select("doc_id", "text", part.alias("part")), "dealt")


def _files(ids: DataFrame, rule: TokenFiles) -> _Files:
    """Ranges of ids by a sample by hash of about ``SAMPLED`` ids for each file, and more files for ids with more rows than one."""
    count = ids.count()
    files = min(rule.most_ranges, -(-count // rule.docs_per_file))
    if files < 2:
        return _Files([], {})
    each = max(rule.docs_per_file, -(-count // rule.most_ranges))
    hot = ids.groupBy("doc_id").count().where(F.col("count") > each).collect()
    parts = {r["doc_id"]: -(-r["count"] // each) for r in hot}
    most = -(2.0**63) + 2.0**64 * SAMPLED * files / count
    sample = ids.where("doc_id IS NOT NULL").where(F.xxhash64("doc_id").cast("double") <= most).distinct()
    found = np.sort(sample.toArrow().column("doc_id").to_numpy())
    bounds = found[[len(found) * k // files for k in range(1, files)]].tolist() if len(found) else []
    return _Files(bounds, parts)


def read_sequences(content: pa.Buffer | str) -> pa.RecordBatchFileReader:
    """Open a file, by path (memory-mapped) or from its bytes; ``get_batch(i)`` copies nothing."""
    return pa.ipc.open_file(pa.memory_map(content) if isinstance(content, str) else pa.BufferReader(content))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``file, turn, doc_id, start, n_tokens, ids_crc32`` of every document, from the files; starts count from the file's first id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name, turn = map(int, re.search(r"(\d+)-(\d+)\.arrow$", path.as_py()).groups())
                reader = read_sequences(content.as_buffer())
                begun, size, crc = 0, 0, 0
                for i in range(reader.num_record_batches):
                    data = reader.get_batch(i)
                    ids, mask, ends = (data.column(k).flatten().to_numpy(zero_copy_only=False) for k in range(3))
                    ids = ids[: int(mask.sum())].astype("<u4")
                    stops = np.flatnonzero(ends[: len(ids)]) + 1
                    docs = data.column(3).flatten()
                    rows, last = [], 0
                    for stop in stops.tolist():
                        whole = zlib.crc32(ids[last:stop].tobytes(), crc)
                        rows.append((begun, size + stop - last, whole))
                        begun += size + stop - last
                        size, crc, last = 0, 0, stop
                    size, crc = size + len(ids) - last, zlib.crc32(ids[last:].tobytes(), crc)
                    starts, sizes, crcs = np.array(rows, np.int64).reshape(-1, 3).T
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.array(np.full(len(rows), x, np.int64)) for x in (name, turn)),
                            docs,
                            *map(pa.array, (starts, sizes, crcs)),
                        ],
                        names=["file", "turn", "doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.arrow").load(folder).select("path", "content")
    return files.mapInArrow(run, "file long, turn long, doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, rule: TokenFiles, folder: str | None = None) -> DataFrame:
    """Write ``docs(doc_id, text)`` and read back ``doc_id, start, n_tokens, ids_crc32`` per document.

    A NULL text is empty and has the end id alone. NULL ids come first; rows
    that share an id lie side by side, in the order of their ids. An empty table
    makes no file and gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    manifest = write_token_files(docs, folder, rule)
    if manifest.isEmpty():
        return manifest.select(*[F.lit(None).cast("long").alias(c) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]).limit(0)
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("file", "turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = manifest.select("file", "turn", before.alias("before"))
    rows = read_documents(spark, folder).join(starts, ["file", "turn"])
    return rows.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
