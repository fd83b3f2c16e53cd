"""Quality scores of documents by an additive model over text statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.gam import Additive, Boosting, fit
from epilake.llm.tables import anonymous, crc_class, map_batches, stored

#: Labelled rows that a model is fitted on: those with the least hash of their id.
LABELLED_ROWS = 40_000
ACCEPT = 0.3

FEATURES = (
    "log_bytes", "log_words", "word_length", "upper", "digit", "mark", "symbol", "bar", "other_punctuation", "beyond_ascii",
    "words_per_line", "distinct_words", "top_word", "next_word_equal", "repeated_lines", "repeated_fives", "long_words",
)

_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[0x0A] = False


def _table(*codes: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


_CLASSES = {
    "upper": _table(*range(0x41, 0x5B)),
    "digit": _table(*range(0x30, 0x3A)),
    "mark": _table(*b"!?"),
    "symbol": _table(*b"#*$%&<>"),
    "bar": _table(*b"|"),
    "other_punctuation": _table(*b"\"'(),-./:;@[\\]^_`{}~+="),
    "beyond_ascii": _table(*range(0xC0, 0x100)),
}


def _repeats(values: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of distinct values and the count of the most frequent one."""
    keys = np.sort((owner.astype(np.uint64) << np.uint64(47)) | (values >> np.uint64(17)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    times = np.diff(at, append=len(keys))
    own = (keys[at] >> np.uint64(47)).astype(np.int64)
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, own, times)
    return np.bincount(own, minlength=rows), top


def text_features(part: words.Slice) -> np.ndarray:
    """One row of ``FEATURES`` for each text of a slice; an empty text has zeros."""
    rows = part.last - part.first
    size = np.diff(part.offsets).astype(np.float64)

    def share(n: np.ndarray, of: np.ndarray) -> np.ndarray:
        return n / np.maximum(of, 1)

    out = {"log_bytes": np.log1p(size)}
    for name, kind in _CLASSES.items():
        sums = np.concatenate([[0], np.cumsum(kind[part.data], dtype=np.int32)])
        out[name] = share(sums[part.offsets[1:]] - sums[part.offsets[:-1]], size)
    starts, ends, first = words.word_bounds(part.data, part.offsets, words.VISIBLE)
    n = np.diff(first)
    owner = np.repeat(np.arange(rows), n)
    values = words.word_hashes(part.data, starts, ends)
    distinct, top = _repeats(values, owner, rows)
    lengths = ends - starts
    out["log_words"] = np.log1p(n)
    out["word_length"] = share(np.bincount(owner, lengths, rows), n)
    out["long_words"] = share(np.bincount(owner, lengths > 20, rows), n)
    out["distinct_words"], out["top_word"] = share(distinct, n), share(top, n)
    equal = (values[1:] == values[:-1]) & (owner[1:] == owner[:-1])
    out["next_word_equal"] = share(np.bincount(owner[1:], equal, rows), n)
    fives = words.windows(values, 5)
    inside = owner[: len(fives)] == owner[len(owner) - len(fives) :]
    of_fives = owner[: len(fives)][inside]
    distinct, _ = _repeats(fives[inside], of_fives, rows)
    whole = np.bincount(of_fives, minlength=rows)
    out["repeated_fives"] = share(whole - distinct, whole)
    starts, ends, first = words.word_bounds(part.data, part.offsets, _NOT_NEWLINE)
    lines = np.diff(first)
    owner = np.repeat(np.arange(rows), lines)
    distinct, _ = _repeats(words.word_hashes(part.data, starts, ends), owner, rows)
    out["repeated_lines"] = share(lines - distinct, lines)
    out["words_per_line"] = share(n, lines)
    return np.stack([out[name] for name in FEATURES], axis=1).astype(np.float32)


def with_features(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` and ``features``, from its column ``text``."""
    kept = docs.select(*columns, "text")
    schema = kept.drop("text").withColumn("features", F.array().cast("array<float>")).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.concatenate([text_features(part) for part in words.slices(batch.column("text"))])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), pa.array(rows.reshape(-1)))
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], lists], names=[*columns, "features"])

    return map_batches(kept, run, schema)


def train(rows: DataFrame, labels: DataFrame, rule: Boosting | None = None, modulus: int = 5) -> Additive:
    """Fit to ``rows(doc_id, features)`` that ``labels(doc_id, quality)`` marks, but for ids of class 0.

    NULL ids and qualities are left out. An id counts once, whatever its rows in
    either table: with the label of most of its labels (1 on a tie) and one of its
    texts. At most ``LABELLED_ROWS`` ids reach the driver.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.where("quality IN (0, 1)").where(crc_class("doc_id", modulus) != 0)
    # An id counts once, by what most of its labels say, however many rows it has.
    marks = stored(marks.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality")), "marks")
    # Hashes are even, so twice the share that is wanted leaves enough, and tasks send no more than that.
    most = -(2.0**63) + 2.0**65 * LABELLED_ROWS / max(1, marks.count())
    marks = marks.where(F.xxhash64("doc_id").cast("double") <= most)
    found = rows.join(marks, "doc_id").groupBy("doc_id", "quality").agg(
        F.min(F.struct(F.xxhash64("features").alias("hash"), "features")).alias("least")
    )
    found = found.select("doc_id", "quality", "least.features").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS)
    held = found.select("features", "quality").toArrow()
    x = np.array(held.column("features").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, held.column("quality").to_numpy().astype(np.float64), rule)


def with_scores(rows: DataFrame, model: Additive) -> DataFrame:
    """Replace ``features`` by ``score`` (0 to 1; higher: better)."""
    names = [c for c in rows.columns if c != "features"]
    schema = rows.drop("features").withColumn("score", F.lit(0.0)).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES)).astype(np.float64)
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(model.predict(x))], names=[*names, "score"])

    return map_batches(rows, run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Empty and NULL texts have a score like any other. A NULL id is not held out.
    Without labels of both classes the score is a constant.
    """
    rows = stored(with_features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id"), "features")
    scored = with_scores(rows, train(rows, labels, modulus=modulus))
    held = F.coalesce(crc_class("doc_id", modulus) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``ACCEPT``, all their columns.

    Features are computed twice, for the model and on the way through, so that
    texts are neither joined nor written here.
    """
    rows = with_features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    model = train(stored(rows, "features"), labels)
    plain = anonymous(docs, "text")
    schema = plain.withColumn("score", F.lit(0.0)).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.concatenate([text_features(part) for part in words.slices(batch.column("text"))])
        scores = pa.array(model.predict(rows.astype(np.float64)))
        return pa.RecordBatch.from_arrays([*batch.columns, scores], names=schema.names)

    return map_batches(plain, run, schema).where(F.col("score") >= ACCEPT).drop("score").toDF(*docs.columns)
