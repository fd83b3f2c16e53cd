"""Mix sources to target weights by systematic sampling.

Within a source the expected copies of its documents, ordered by size, are laid
end to end; one random offset is added, and a document is put out once for each
whole number that its stretch crosses. Since neighbours are of a size, the words
taken stay within about one document of the target.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epilake.llm.tables import anonymous, stored, with_row_ids

WORD = "[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Mixture:
    """Sources, by code point and NULL last, weigh ``weights`` in turn and share ``percent`` of all words.

    A target stops at ``most`` times its source. ``slice_rows`` bounds the rows
    of one source and size that a task ranks together.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    percent: int = 150
    most: int = 2
    seed: int = 7
    slice_rows: int = 4096


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, rule: Mixture) -> DataFrame:
    """``source, source_size, target``: one row per source.

    What sources at their limit leave over goes to the others by weight. In
    order of limit per weight, the level that shares what is left among the rest
    rises while sources are at their limit and falls after; its greatest value
    is the level that fits all.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*[F.lit(w) for w in rule.weights])
    weight = F.get(weights, F.pmod(place - 1, F.lit(len(rule.weights)))).cast("double")
    rows = totals.withColumn("weight", weight).withColumn("limit", (rule.most * F.col("source_size")).cast("double"))
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    everywhere = Window.partitionBy()
    total = F.sum("source_size").over(everywhere) * rule.percent / 100
    rows = rows.withColumn("total", total).withColumn("level", (F.col("total") - before) / onward)
    rows = rows.withColumn("level", F.max("level").over(everywhere))
    return rows.select("source", "source_size", F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def _spread(text: Column) -> Column:
    """A number below 2**32 from a text, the same in any SQL that has MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame, rule: Mixture | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs(doc_id, text, source)``.

    A NULL text has size 0; such rows are copied like others and take no words.
    NULL is a source of its own. Rows equal in id, source and size may swap
    their copies. A source without words has target 0 and gives no copies.
    """
    rule = rule or Mixture()
    sizes = docs.select("doc_id", "source", word_count().alias("size"), *keep)
    sizes = stored(sizes.withColumn("number", F.monotonically_increasing_id()), "sizes")
    plan = stored(targets(sizes, rule), "targets")
    slices = max(1, -(-sizes.count() // rule.slice_rows))
    rows = sizes.withColumn("slice", F.coalesce(_spread(F.col("doc_id").cast("string")) % slices, F.lit(0)).cast("long"))
    rows = _divided(rows, rule)
    # Rows before each size in its source, and before each slice in its size: both from counts.
    by_slice = rows.groupBy("source", "size", "slice").agg(F.count("*").alias("n"))
    by_size = by_slice.groupBy("source", "size").agg(F.sum("n").alias("n"))
    lower = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.select("source", "size", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("lower"))
    earlier = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    by_slice = by_slice.select("source", "size", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("doc_id", *keep, "number")) - 1
    rows = rows.withColumn("inside", inside)
    for extra, keys in ((by_slice, ["source", "size", "slice"]), (by_size, ["source", "size"]), (plan, ["source"])):
        rows = _join_null_safe(rows, extra, keys)
    rank = F.col("lower") + F.col("earlier") + F.col("inside")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _spread(F.concat(F.lit(f"{rule.seed} "), F.coalesce("source", F.lit("")))) / float(1 << 32)
    crossed = F.floor((rank + 1) * each + offset) - F.floor(rank * each + offset)
    rows = rows.withColumn("copies", crossed.cast("long"))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *keep
    )


def _divided(rows: DataFrame, rule: Mixture) -> DataFrame:
    """``rows`` with finer slices where one id, or none, fills a slice of a source and size far beyond the others."""
    keys = ["source", "size", "slice"]
    full = rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 4 * rule.slice_rows)
    full = stored(full.select(*keys, F.ceil(F.col("n") / rule.slice_rows).alias("parts")), "full-slices")
    if full.isEmpty():
        return rows
    named = full.select(*[F.col(k).alias(f"r_{k}") for k in keys], "parts")
    joined = rows.join(named, [rows[k].eqNullSafe(named[f"r_{k}"]) for k in keys], "left")
    # Slices are counted up to their number, so these stay in the place of the one that they divide.
    part = F.pmod(F.xxhash64("number"), F.coalesce("parts", F.lit(1).cast("long")))
    slice_ = F.col("slice") * F.lit(1 << 20) + part
    return joined.withColumn("slice", slice_).drop("parts", *[f"r_{k}" for k in keys])


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which NULL equals NULL; keys come from the left."""
    named = right.select(*[F.col(k).alias(f"r_{k}") if k in keys else F.col(k) for k in right.columns])
    test = [left[k].eqNullSafe(named[f"r_{k}"]) for k in keys]
    return left.join(named, test).drop(*[f"r_{k}" for k in keys])


def mixed_documents(docs: DataFrame, rule: Mixture | None = None) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it, with the columns of ``docs``.

    Rows are told apart by a number of their own, so every row is taken by its own
    count, whether its id repeats or is NULL. Texts are shuffled once, by that
    number, and not sorted.
    """
    plain = anonymous(docs, "doc_id", "text", "source")
    numbered = with_row_ids(plain)
    picks = mix(numbered, rule, keep=("row_id",)).where("copies > 0")
    picks = picks.select(F.col("row_id").alias("own"), "copies").hint("shuffle_hash")
    rows = numbered.join(picks, F.col("row_id") == F.col("own"))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")
    return rows.select(*plain.columns, copies).drop("copy").toDF(*docs.columns)
