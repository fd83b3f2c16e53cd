"""Alignment of two tokenizers over the same texts, by the byte offsets where tokens of both end.

Tables of tokens are Arrow columns throughout. A slice of texts is tokenized by
both; the lists are flattened, with the index of the text as parent, and lengths
in bytes are summed up within each text to the offset where each token ends. A
hash join of the two token tables on (text, end) gives the links, and a
group-by the partial counts of linked id pairs, which Spark adds up over the
corpus. The counts go back to each slice, once for each distinct pair in it, and
are joined there with the links of every text.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.tables import stored
from epilake.llm.token_files import encoder

#: Bytes of text that are aligned at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: What a piece has in place of a space.
_SPACE = "▁"


@dataclass(frozen=True)
class Tokenizers:
    """Paths of a byte-level BPE file (A) and of a model of pieces with byte fallback (B), which puts a space before each text."""

    a: str
    b: str


class _Pieces:
    """B, and the bytes of its ids."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        self.bytes = pa.array([self._spelled(i) for i in ids], pa.large_binary())

    def _spelled(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        if self.model.is_unknown(i) or self.model.is_control(i):
            return b"\xff"  # in no text: a text that needs it has no tokens
        return piece.replace(_SPACE, " ").encode()


def _byte_level(path: str) -> pa.Array:
    """The bytes of the ids of A, from their spelling in visible characters."""
    held = encoder(path)
    visible = [b for b in range(256) if b not in held.alphabet]
    letter = {chr(b): b for b in visible} | {chr(c): b for b, c in held.alphabet.items()}
    vocabulary = held.tokenizer.get_vocab(with_added_tokens=True)
    out = [b"\xff"] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if all(c in letter for c in token):
            out[i] = bytes(letter[c] for c in token)
    return pa.array(out, pa.large_binary())


_loaded: dict[Tokenizers, tuple] = {}


def _tables(rule: Tokenizers) -> tuple:
    """Both tokenizers, the bytes of their ids, and the ids as decimal text."""
    if rule not in _loaded:
        a, b = encoder(rule.a), _Pieces(rule.b)
        spelled = _byte_level(rule.a), b.bytes
        _loaded[rule] = (a, b.model, spelled, pa.array([str(i) for i in range(max(map(len, spelled)))], pa.string()))
    return _loaded[rule]


@dataclass
class _Tokens:
    """The ids of some texts as one list column, and where each token ends in its text."""

    lists: pa.LargeListArray
    ids: pa.Array
    text: pa.Array
    end: pa.Array

    @staticmethod
    def of(ids: np.ndarray, offsets: np.ndarray, spelled: pa.Array) -> _Tokens:
        lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids, pa.int32()))
        flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        summed = pc.cumulative_sum(pc.binary_length(spelled.take(flat)))
        before = pa.concat_arrays([pa.array([0], pa.int64()), summed]).take(pa.array(offsets[:-1]))  # of each text
        return _Tokens(lists, flat, parent, pc.subtract(summed, before.take(parent)))

    def table(self, name: str) -> pa.Table:
        """``text, end`` and the place and id of each token."""
        place = pa.array(np.arange(len(self.ids)))
        return pa.table({"text": self.text, "end": self.end, f"at_{name}": place, name: self.ids})


def _spell(ids: np.ndarray, offsets: np.ndarray, spelled: pa.Array, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text whether its tokens' bytes, joined, are its bytes ``data[bounds[k]:bounds[k + 1]]``."""
    joined = spelled.take(pa.array(ids))
    _, at, held = joined.buffers()
    at = np.frombuffer(at, np.int64)[: len(joined) + 1]
    own = np.frombuffer(held, np.uint8)[: at[-1]] if held is not None else np.zeros(0, np.uint8)
    cuts = at[offsets]
    if np.array_equal(cuts, bounds) and np.array_equal(own, data):
        return np.ones(len(offsets) - 1, bool)
    spans = zip(itertools.pairwise(cuts.tolist()), itertools.pairwise(bounds.tolist()), strict=True)
    return np.array([np.array_equal(own[a:b], data[c:d]) for (a, b), (c, d) in spans], bool)


def _kept(ids: np.ndarray, offsets: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the texts that ``texts`` marks; the others have none."""
    sizes = np.diff(offsets)
    return ids[np.repeat(texts, sizes)], np.concatenate([[0], np.cumsum(np.where(texts, sizes, 0))])


def _spelled_groups(tokens: _Tokens, last: np.ndarray, decimals: pa.Array) -> pa.Array:
    """The ids of each group, comma-joined; ``last``: the places of the tokens that end groups."""
    bounds = pa.array(np.concatenate([[0], last + 1]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(bounds, decimals.take(tokens.ids)), ",")


def _aligned(texts: list[bytes], rule: Tokenizers) -> dict:
    """Counts and digests of some texts, the distinct id pairs with their counts, and those of each text by their place in these."""
    tool_a, tool_b, (spelled_a, spelled_b), decimals = _tables(rule)
    n = len(texts)
    spaced = [b" " + x for x in texts]
    data = np.frombuffer(b"".join(spaced), np.uint8)
    bounds = np.cumsum([0, *map(len, spaced)])
    ids_a, at_a = tool_a.encode(words.Slice(0, n, data, bounds))
    lists = tool_b.encode([x.decode(errors="replace") for x in texts], num_threads=1)
    ids_b, at_b = np.fromiter(itertools.chain.from_iterable(lists), np.int32), np.cumsum([0, *map(len, lists)])
    whole = np.array([len(x) > 0 for x in texts], bool)
    whole &= _spell(ids_a, at_a, spelled_a, data, bounds)
    # An empty text has no tokens of B, not even its space.
    whole &= _spell(ids_b, at_b, spelled_b, data, bounds)
    a = _Tokens.of(*_kept(ids_a.astype(np.int32), at_a, whole), spelled_a)
    b = _Tokens.of(*_kept(ids_b, at_b, whole), spelled_b)
    links = a.table("a").join(b.table("b"), ["text", "end"], join_type="inner", use_threads=False).sort_by("at_a").combine_chunks()
    links = links.append_column("pair", pc.add(pc.multiply(links["a"].cast(pa.int64()), len(spelled_b)), links["b"].cast(pa.int64())))
    pairs = links.group_by("pair", use_threads=False).aggregate([("pair", "count")]).sort_by("pair")
    own = links.group_by(["text", "pair"], use_threads=False).aggregate([("pair", "count")]).sort_by([("text", "ascending"), ("pair", "ascending")])
    text = own["text"].to_numpy()
    groups = np.bincount(links["text"].to_numpy(), minlength=n)
    shown = pc.binary_join_element_wise(
        _spelled_groups(a, links["at_a"].to_numpy(), decimals), _spelled_groups(b, links["at_b"].to_numpy(), decimals), "|"
    )
    shown = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *groups]), pa.int32()), shown), ";").to_pylist()
    return {
        "n_a": np.diff(a.lists.offsets.to_numpy()),
        "n_b": np.diff(b.lists.offsets.to_numpy()),
        "n_links": groups,
        "sha": [hashlib.sha256(x.encode()).hexdigest() if ok else "" for x, ok in zip(shown, whole.tolist(), strict=True)],
        "pairs": pairs["pair"].combine_chunks(),
        "counts": pairs["pair_count"].combine_chunks(),
        "bounds": np.searchsorted(text, np.arange(n + 1)),
        "own": pc.index_in(own["pair"], value_set=pairs["pair"].combine_chunks()).combine_chunks(),
        "times": own["pair_count"].combine_chunks().cast(pa.int32()),
    }


_ROWS = "kind int, slice long, doc_id long, n_a long, n_b long, n_links long, sha string, pairs array<long>, own array<int>, times array<int>"


def linked_slices(docs: DataFrame, rule: Tokenizers) -> DataFrame:
    """Rows of two kinds. 1: a slice with its distinct ``pairs`` (A's id times B's size plus B's id) and their ``times``.
    0: a text of a slice with its counts, its pairs by their places in those of the slice (``own``), and their ``times``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        kind = pa.list_(pa.int32())
        for batch in batches:
            for part in words.slices(batch.column("text"), SLICE_BYTES):
                data, n = part.data.tobytes(), part.last - part.first
                found = _aligned([data[i:j] for i, j in itertools.pairwise(part.offsets.tolist())], rule)
                bounds = pa.array(found["bounds"], pa.int32())
                rows = {
                    "kind": np.zeros(n, np.int32),
                    "slice": np.full(n, number),
                    "doc_id": batch.column("doc_id").slice(part.first, n),
                    **{c: pa.array(found[c], pa.int64()) for c in ("n_a", "n_b", "n_links")},
                    "sha": found["sha"],
                    "pairs": pa.nulls(n, pa.list_(pa.int64())),
                    "own": pa.ListArray.from_arrays(bounds, found["own"]),
                    "times": pa.ListArray.from_arrays(bounds, found["times"]),
                }
                yield pa.RecordBatch.from_pydict(rows)
                m = len(found["pairs"])
                whole = pa.array([0, m], pa.int32())
                one = {
                    "kind": np.ones(1, np.int32),
                    "slice": np.full(1, number),
                    **{c: pa.nulls(1, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_links")},
                    "sha": pa.nulls(1, pa.string()),
                    "pairs": pa.ListArray.from_arrays(whole, found["pairs"]),
                    "own": pa.nulls(1, kind),
                    "times": pa.ListArray.from_arrays(whole, found["counts"].cast(pa.int32())),
                }
                yield pa.RecordBatch.from_pydict(one)
                number += 1
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ROWS)


def pair_counts(slices: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: how many links of the corpus hold each pair, and whether no other pair of the same id of B has more."""
    each = F.explode(F.arrays_zip("pairs", "times")).alias("cell")
    counts = stored(slices.select(each).groupBy("cell.pairs").agg(F.sum("cell.times").alias("n")).withColumnRenamed("pairs", "pair"), "pair-counts")
    b = F.col("pair") % size_b
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return stored(counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def align(docs: DataFrame, rule: Tokenizers) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs(doc_id, text)``.

    A links to B where a token of each ends at the same byte; these ends cut the
    tokens into groups. Special tokens that a text spells are text. Texts that are
    NULL, empty, or that a tokenizer does not give back byte for byte have no
    tokens: zeros, and an empty digest. Every row is a row of its own, whether
    its id repeats or is NULL. Other columns are ignored.
    """
    size_b = len(_tables(rule)[2][1])
    rows = stored(linked_slices(docs, rule), "links")
    texts, slices = rows.where("kind = 0"), rows.where("kind = 1").select("slice", "pairs", "times")
    counts = pair_counts(slices, size_b)
    each = slices.select("slice", F.posexplode("pairs").alias("place", "pair"))
    # Tables on both sides, so that the join can split a pair that is in every slice.
    priced = each.join(counts, "pair").select("slice", "place", "n", "best")

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right["place"].to_numpy()
        n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[place], best[place] = right["n"].to_numpy(), right["best"].to_numpy()
        own = left["own"].combine_chunks()
        times = pc.list_flatten(left["times"].combine_chunks()).to_numpy()
        at, parent = pc.list_flatten(own).to_numpy(), pc.list_parent_indices(own).to_numpy()
        cells = pa.table({"text": parent, "count_sum": times * n[at], "n_best": times * best[at]})
        sums = cells.group_by("text", use_threads=False).aggregate([("count_sum", "sum"), ("n_best", "sum")])
        out = {c: np.zeros(left.num_rows, np.int64) for c in ("n_best", "count_sum")}
        for c, values in out.items():
            values[sums["text"].to_numpy()] = sums[f"{c}_sum"].to_numpy()
        return pa.table(
            {
                **{c: left[c] for c in ("doc_id", "n_a", "n_b")},
                "n_groups": left["n_links"],
                "n_links": left["n_links"],
                **out,
                "groups_sha256": left["sha"],
            }
        )

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    texts = texts.select(F.col("slice").alias("held"), "doc_id", "n_a", "n_b", "n_links", "sha", "own", "times")
    return texts.groupBy("held").cogroup(priced.groupBy("slice")).applyInArrow(total, schema)
