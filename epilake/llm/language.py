"""Language by prediction by partial matching over bytes.

Each language has a tree of the byte contexts that it has seen, of every order up
to ``Training.order``. A symbol's probability comes from the longest context that
has seen it; each shorter step costs the escape probability (method C) and leaves
out what the longer contexts offered. The statistics are frozen, so a seen symbol
has one code length and a context one escape length, in sorted tables by order; a
slice of texts looks up each of its distinct stretches of symbols once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.tables import crc_class

UNKNOWN = "und"
#: Symbols before any is dropped: a separator for ASCII that is no letter, a-z, one for bytes never learned, 128 beyond ASCII.
_SEPARATOR, _RARE, _ALL = 0, 27, 156
_CODES = np.zeros(256, np.uint8)
_CODES[0x61:0x7B] = np.arange(1, 27)
_CODES[0x80:] = np.arange(28, 156)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


#: Bits of a symbol in the number of a stretch, and the longest context that such a number has room for.
_BITS, MOST_ORDER = 8, 6
#: Contexts up to this order are kept however seldom they are.
_SHORT = 2
#: Bytes of a slice: stretches repeat, so larger slices look up fewer.
_SLICE = 1 << 21


@dataclass(frozen=True)
class Training:
    """How languages are learned.

    ``per_language``: rows learned from for each language, those with the least hash of their id.
    ``languages``: languages learned, those with the most ids (about, and by name on a tie).
    ``order``: symbols of the longest context, at most ``MOST_ORDER``.
    ``least``: how often a context of more than two symbols must have been seen to be in a tree.

    The trees at the driver and in tasks take some 20 bytes for each distinct
    stretch of ``order + 1`` symbols or fewer that the rows learned from have.
    """

    per_language: int = 2000
    held_out_class: int = 2
    modulus: int = 4
    languages: int = 200
    order: int = 4
    least: int = 4

    def __post_init__(self) -> None:
        if not 0 <= self.order <= MOST_ORDER:
            raise ValueError(f"order {self.order} is not from 0 to {MOST_ORDER}")


def _codes(part: words.Slice) -> np.ndarray:
    """Symbols of a slice, in lower case: A-Z, and the Latin letters that have the lead byte C3."""
    data = words.LOWER[part.data]
    upper = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    data[1:] += (upper * 0x20).astype(np.uint8)
    return _CODES[data]


def _stretches(codes: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For every byte one number for itself and the ``order`` before it; a text begins after separators."""
    out = codes.astype(np.int64)
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    for k in range(1, order + 1):
        before = np.zeros(len(codes), np.int64)
        before[k:] = codes[:-k] if k < len(codes) else 0
        for j in range(min(k, len(codes))):
            at = begin + j
            before[at[at < len(codes)]] = _SEPARATOR
        out |= before << (_BITS * k)
    return out


def _last(stretch, order: int):
    """The last symbol of a stretch and the ``order`` before it."""
    return stretch & ((1 << (_BITS * (order + 1))) - 1)


def context_counts(docs: DataFrame, rule: Training) -> DataFrame:
    """``lang, order, stretch, n``: how often each symbol follows each context of a tree, over ``docs(lang, text)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part in words.slices(batch.column("text"), _SLICE):
                at = _stretches(_codes(part), part.offsets, rule.order)
                for lang in sorted(set(langs[part.first : part.last])):
                    own = [
                        at[part.offsets[k] : part.offsets[k + 1]]
                        for k in range(part.last - part.first)
                        if langs[part.first + k] == lang
                    ]
                    stretch, n = np.unique(np.concatenate(own), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n), pa.string()), pa.array(stretch, pa.int64()), pa.array(n, pa.int64())],
                        names=["lang", "stretch", "n"],
                    )

    whole = docs.select("lang", "text").mapInArrow(count, "lang string, stretch long, n long")
    whole = whole.groupBy("lang", "stretch").agg(F.sum("n").alias("n"))
    cells = [F.struct(F.lit(k).alias("order"), _cut("stretch", k).alias("stretch")) for k in range(rule.order + 1)]
    rows = whole.select("lang", F.explode(F.array(*cells)).alias("cell"), "n")
    rows = rows.groupBy("lang", "cell.order", "cell.stretch").agg(F.sum("n").alias("n"))
    # A window holds the symbols of one context, at most all of them.
    context = Window.partitionBy("lang", "order", F.shiftright("stretch", _BITS))
    rows = rows.withColumn("total", F.sum("n").over(context))
    return rows.where((F.col("order") <= _SHORT) | (F.col("total") >= rule.least)).select("lang", "order", "stretch", "n")


def _cut(column: str, order: int):
    return F.col(column).bitwiseAND(F.lit((1 << (_BITS * (order + 1))) - 1).cast("long"))


def _found(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are in a sorted table, and where."""
    if not len(table):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return table[at] == wanted, at


@dataclass
class Level:
    """One order of a tree: code lengths of symbols after contexts, and escape lengths of the contexts, in bits."""

    stretches: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


def _tree(order: np.ndarray, stretch: np.ndarray, n: np.ndarray, size: int) -> list[Level]:
    """The levels of a language, order 0 first, over an alphabet of ``size`` symbols."""
    levels: list[Level] = []
    for k in range(int(order.max(initial=0)) + 1):
        own = order == k
        sort = np.argsort(stretch[own])
        stretches, counts = stretch[own][sort], n[own][sort].astype(np.float64)
        if not len(stretches):
            break
        contexts, first = np.unique(stretches >> _BITS, return_index=True)
        kinds = np.diff(np.append(first, len(stretches)))
        total = np.add.reduceat(counts, first)
        if levels:
            _, at = _found(levels[-1].stretches, _last(stretches, k - 1))  # all are there: what a long context saw, a shorter one did
            shorter = np.exp2(-levels[-1].bits[at])
        else:
            shorter = np.full(len(stretches), 1 / size)
        left = np.maximum(1 - np.add.reduceat(shorter, first), 1e-15)
        open_ = kinds < size
        whole = total + np.where(open_, kinds, 0)
        escapes = -np.log2(kinds / whole / left)
        levels.append(Level(stretches, -np.log2(counts / np.repeat(whole, kinds)), contexts, escapes))
    return levels


class Languages:
    """The context tree of each learned language, from a table ``lang, order, stretch, n``."""

    def __init__(self, table: pa.Table, rule: Training) -> None:
        lang, order, stretch, n = (table.column(c).to_numpy() for c in ("lang", "order", "stretch", "n"))
        self.order = rule.order
        self.names = sorted(set(lang.tolist()))
        used = np.unique(np.concatenate([[_SEPARATOR, *range(1, 27), _RARE], stretch[order == 0]]).astype(np.int64))
        self.size = len(used)
        self.place = np.full(_ALL, _RARE, np.uint8)
        self.place[used] = used
        self.trees = [_tree(order[own], stretch[own], n[own], self.size) for own in (lang == name for name in self.names)]

    def bits(self, tree: list[Level], stretches: np.ndarray) -> np.ndarray:
        """The code length of the last symbol of each stretch after those before it."""
        out = np.zeros(len(stretches))
        open_ = np.arange(len(stretches))
        for k in reversed(range(len(tree))):
            level, own = tree[k], _last(stretches[open_], k)
            hit, at = _found(level.stretches, own)
            out[open_[hit]] += level.bits[at[hit]]
            open_, own = open_[~hit], own[~hit]
            hit, at = _found(level.contexts, own >> _BITS)
            out[open_[hit]] += level.escapes[at[hit]]
        out[open_] += np.log2(self.size)
        return out

    def lengths(self, part: words.Slice) -> np.ndarray:
        """Code length of every text (rows) under every language (columns)."""
        codes = self.place[_codes(part)]
        number, distinct = pd.factorize(_stretches(codes, part.offsets, self.order))
        sort = np.argsort(distinct)  # look-ups in order are faster
        out = np.zeros((part.last - part.first, len(self.names)))
        for k, tree in enumerate(self.trees):
            bits = np.empty(len(distinct))
            bits[sort] = self.bits(tree, distinct[sort])
            sums = np.concatenate([[0.0], np.cumsum(bits[number])])
            out[:, k] = sums[part.offsets[1:]] - sums[part.offsets[:-1]]
        return out


def _without_letter(part: words.Slice) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_LETTER[part.data])])
    none = sums[part.offsets[1:]] == sums[part.offsets[:-1]]
    for k in np.flatnonzero(none):
        text = part.data[part.offsets[k] : part.offsets[k + 1]].tobytes().decode("utf-8", "replace")
        none[k] = not any(c.isalpha() for c in text)
    return none


def learn(docs: DataFrame, rule: Training) -> Languages:
    """Learn from ``docs(doc_id, text, lang)`` outside the held-out class.

    NULL ids, texts and languages are left out. The sample is of ids: one that has many
    rows of a language counts once for it.
    """
    rows = docs.select("doc_id", "text", "lang").where(crc_class("doc_id", rule.modulus) != rule.held_out_class)
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # Hashes of ids are even, so twice the share of the ids that is wanted leaves enough, and no language is gathered whole.
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).orderBy(F.desc("n"), "lang").limit(rule.languages)
    sizes = sizes.select("lang", (F.lit(-(2.0**63)) + 2.0**65 * rule.per_language / F.col("n")).alias("most"))
    # One row for each language, far less than the model, which the driver holds and sends out.
    low = rows.select("doc_id", "lang").join(F.broadcast(sizes), "lang").where(F.xxhash64("doc_id").cast("double") <= F.col("most"))
    chosen = low.select("doc_id", "lang").distinct().withColumn("place", F.row_number().over(order))
    chosen = chosen.where(F.col("place") <= rule.per_language).select("doc_id", "lang")
    sample = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
    # An id counts once, with the text of the least hash, however many rows it has.
    sample = sample.groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return Languages(context_counts(sample.select("least.text", "lang"), rule).toArrow(), rule)


def predict_language(docs: DataFrame, rule: Training | None = None, model: Languages | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs(doc_id, text, lang)``.

    The language with the shortest code wins, the first by name on a tie. The
    score is its share when languages weigh two to the power of minus their
    code length. A text that is NULL or has no letter is ``und`` with score 0, and
    so is everything if nothing could be learned. A NULL id is not held out.
    """
    rule = rule or Training()
    held = docs.sparkSession.sparkContext.broadcast(model or learn(docs, rule))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            names, scores = [], []
            for part in words.slices(batch.column("text"), _SLICE):
                n = part.last - part.first
                if not languages.names:
                    names += [UNKNOWN] * n
                    scores.append(np.zeros(n))
                    continue
                bits = languages.lengths(part)
                best = bits.argmin(1)
                share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                none = _without_letter(part)
                names += [UNKNOWN if x else languages.names[k] for x, k in zip(none.tolist(), best.tolist(), strict=True)]
                scores.append(np.where(none, 0.0, share))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    out = F.coalesce(crc_class("doc_id", rule.modulus) == rule.held_out_class, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
