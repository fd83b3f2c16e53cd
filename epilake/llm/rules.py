"""Quality rules: text statistics and a learned decision list, as Spark expressions only.

The list is learned by sequential covering. Each step asks Spark for one small
table, the numbers of good and bad labelled documents by statistic and bin; the
driver sees nothing else. A rule is a conjunction of thresholds. It is grown on
two thirds of the labelled rows, pruned on the rest, and kept if what it
covers there is bad often enough. The result is a chain of ``when`` branches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epilake.llm.tables import stored

SPACE = "[\\x20\\x09-\\x0D]+"
WIDTH = 8

#: Statistics that conditions may use: name and expression over the columns of ``statistics``.
MEASURES = {
    "words": "double(n_words)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
}
QUANTILES = [0.002, 0.01, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.99, 0.998]


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value, limit = F.col(self.measure), F.lit(self.threshold)
        return value > limit if self.above else value <= limit


Rule = tuple[Condition, ...]


def statistics(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)`` the counts that the base rules and the list use.

    A NULL or empty text has zero everywhere. Long arrays are made once per row
    and used as columns, so their cost is linear; positions of repeated windows
    are found by sorting, and only in texts that have any.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select(
        "doc_id",
        F.filter(F.split("text", SPACE), lambda w: w != "").alias("w"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", "[^!?]+", "")).cast("long").alias("n_marks"),
        F.length(F.regexp_replace("text", "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"),
    )
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("w") - WIDTH), lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WIDTH)])
    )
    rows = rows.select(
        "doc_id",
        "n_symbols",
        "n_marks",
        "n_upper",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= WIDTH, hashes).alias("h"),
    )
    counts = [c for c in rows.columns if c != "h"]
    repeated = F.size(F.array_distinct("h")) < F.size("h")
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    rows = rows.select(*counts, F.when(repeated, pairs).alias("s"))

    def twice(pair: Column, i: Column) -> Column:
        before, after = F.get("s", i - 1)["h"], F.get("s", i + 1)["h"]
        return F.coalesce(before == pair["h"], F.lit(False)) | F.coalesce(after == pair["h"], F.lit(False))

    at = F.sort_array(F.transform(F.filter("s", twice), lambda pair: pair["i"]))
    covered = F.aggregate(
        at,
        F.struct(F.lit(-WIDTH).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WIDTH), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return rows.select(*counts, F.coalesce(F.when(F.col("s").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"))


def measured(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.expr(text) for name, text in MEASURES.items()})


def conjunction(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule], F.lit(True))


def disjunction(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [conjunction(r) for r in rules], F.lit(False))


def verdict(rules: list[Rule]) -> Column:
    """True unless a rule of the ordered list says no."""
    if not rules:
        return F.lit(True)
    chain = F
    for rule in rules:
        chain = chain.when(conjunction(rule), F.lit(False))
    return chain.otherwise(F.lit(True))


def _thresholds(labelled: DataFrame) -> dict[str, list[float]]:
    """Quantiles of every measure among good and among bad rows: two rows at the driver."""
    quantiles = [F.percentile_approx(name, QUANTILES, 10_000).alias(name) for name in MEASURES]
    found: dict[str, set[float]] = {name: set() for name in MEASURES}
    for row in labelled.groupBy("bad").agg(*quantiles).collect():
        for name in MEASURES:
            found[name] |= set(row[name] or [])
    return {name: sorted(values) for name, values in found.items()}


def _tally(rows: DataFrame, limits: dict[str, list[float]]) -> dict[Condition, tuple[int, int]]:
    """Bad and good rows under every possible condition, from one row per measure and bin."""
    bins = []
    for name, values in limits.items():
        passed = [F.when(F.col(name) > v, 1).otherwise(0) for v in values]
        at = reduce(lambda a, b: a + b, passed, F.lit(0))
        bins.append(F.struct(F.lit(name).alias("measure"), at.alias("bin")))
    cells = rows.select("bad", F.explode(F.array(*bins)).alias("cell"))
    sums = cells.groupBy("cell.measure", "cell.bin").agg(
        F.sum(F.col("bad").cast("long")).alias("bad"), F.sum((~F.col("bad")).cast("long")).alias("good")
    )
    grid = {name: [[0, 0] for _ in range(len(values) + 1)] for name, values in limits.items()}
    for row in sums.collect():
        grid[row["measure"]][row["bin"]] = [row["bad"], row["good"]]
    tally = {}
    for name, values in limits.items():
        total = [sum(x[k] for x in grid[name]) for k in (0, 1)]
        below = [0, 0]
        for value, cell in zip(values, grid[name], strict=False):
            below = [below[0] + cell[0], below[1] + cell[1]]
            tally[Condition(name, False, value)] = (below[0], below[1])
            tally[Condition(name, True, value)] = (total[0] - below[0], total[1] - below[1])
    return tally


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """Bad rows kept, times what the condition adds to the (smoothed) share of bad rows, in bits."""
    return bad * (math.log2((bad + 0.1) / (bad + good + 0.2)) - math.log2((all_bad + 0.1) / (all_bad + all_good + 0.2)))


def _counts(rows: DataFrame, rules: list[Rule]) -> list[tuple[int, int]]:
    """Bad and good rows that each rule covers, in one pass."""
    sums = []
    for k, rule in enumerate(rules):
        hit = conjunction(rule)
        sums += [F.sum((hit & F.col("bad")).cast("long")).alias(f"b{k}"), F.sum((hit & ~F.col("bad")).cast("long")).alias(f"g{k}")]
    row = rows.agg(*sums).first()
    return [(row[f"b{k}"] or 0, row[f"g{k}"] or 0) for k in range(len(rules))]


def learn(labelled: DataFrame, max_rules: int = 8, max_conditions: int = 3, precision: float = 0.9) -> list[Rule]:
    """Ordered rules for what to reject, from ``labelled(doc_id, bad, measures)``.

    ``precision`` is the share of bad rows that a rule must reach on the rows it
    is pruned on, after adding one good row to what it covers. One class alone,
    or no rows, gives no rules.
    """
    limits = _thresholds(labelled)
    grown = F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2
    grow, prune = labelled.where(grown), labelled.where(~grown)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = ~disjunction(rules)
        rest, rule = grow.where(left), ()
        counts = None
        while len(rule) < max_conditions:
            tally = _tally(rest.where(conjunction(rule)), limits)
            some = next(((v, tally[Condition(c.measure, not c.above, c.threshold)]) for c, v in tally.items()), ((0, 0), (0, 0)))
            total = (some[0][0] + some[1][0], some[0][1] + some[1][1])
            counts = counts or total
            if not total[0] or not total[1]:
                break
            best = max(tally, key=lambda c: _gain(*tally[c], *total))
            if _gain(*tally[best], *total) <= 1e-9:
                break
            rule = (*rule, best)
            if not tally[best][1]:
                break
        if not rule:
            break
        options = [rule[: k + 1] for k in range(len(rule))]
        held = _counts(prune.where(left), options)
        worth = [(b - g) / (b + g + 1) for b, g in held]
        best = max(range(len(options)), key=lambda k: (worth[k], -k))
        bad, good = held[best]
        if not bad or bad / (bad + good + 1) < min(precision, bad / (bad + 1)):
            break
        rules.append(options[best])
    return rules


def quality_rules(docs: DataFrame, labels: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` for every row of ``docs``; learns from ``labels(doc_id, quality)`` unless given rules.

    NULL ids and labels without a document or a quality take no part in the
    learning. Rows that fail the base rules are not learned from.
    """
    rows = stored(statistics(docs), "statistics")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    if rules is None:
        bad = labels.where("quality IS NOT NULL").select("doc_id", (F.col("quality") == 0).alias("bad"))
        labelled = measured(rows.where(~F.col("base_failed"))).join(bad, "doc_id").select("doc_id", "bad", *MEASURES)
        rules = learn(stored(labelled, "labelled"))
    out = measured(rows).withColumn("kept", ~F.col("base_failed") & verdict(rules))
    return out.drop(*MEASURES)
