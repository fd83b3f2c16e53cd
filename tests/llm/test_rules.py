"""Text statistics against plain Python, and the learned list."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from epilake.llm.rules import MEASURES, Condition, _thresholds, learn, measured, quality_rules, statistics, verdict

TABLES = Path("/root/testdata/sf0.01")


def by_hand(text: str | None) -> tuple[int, ...]:
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(own[k : k + 8]) for k in range(len(own) - 7))
    covered = {k + j for k in range(len(own) - 7) if seen[tuple(own[k : k + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def cases() -> list[tuple[int, str | None]]:
    rng = random.Random(8)
    out = ["", None, " \n\t ", "a", "a\n\na\na \n b", "x " * 7, "x " * 8, "x " * 9, "x " * 3000, "é ñ z <|> #$%&*", "a\x0bb\x0cc\rd", "\x1c a\x85b"]
    for _ in range(80):
        own = [rng.choice("abc") + rng.choice(["", "", "!", "#"]) for _ in range(rng.randrange(60))]
        if own and rng.random() < 0.5:
            own += own[rng.randrange(len(own)) :]
        out.append(rng.choice([" ", "  ", "\n", " \t"]).join(own))
    return list(enumerate(out))


def test_statistics(documents):
    rows = cases()
    found = {r.doc_id: r for r in statistics(documents(*rows).withColumn("n_words", F.lit("x"))).collect()}
    for doc_id, text in rows:
        r = found[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == by_hand(text), repr(text)


def test_learned_list_on_a_table(spark):
    docs, labels = (spark.read.parquet(str(TABLES / f"{t}.parquet")) for t in ("documents", "labels"))
    rows = quality_rules(docs, labels).join(labels, "doc_id").collect()
    left = [r for r in rows if not r.base_failed]
    assert sum(r.kept for r in left if r.quality == 1) >= 0.98 * sum(r.quality == 1 for r in left)
    assert sum(not r.kept for r in left if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in left)
    assert not any(r.kept for r in rows if r.base_failed)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows)


def test_a_conjunction_is_grown(spark):
    rng = random.Random(6)
    data = []
    for k in range(1500):
        a, b = rng.random(), rng.random()
        data.append((k, a > 0.6 and b > 0.5, *(a if m == "symbols_per_word" else b if m == "upper_share" else 0.0 for m in MEASURES)))
    rows = spark.createDataFrame(data, ["doc_id", "bad", *MEASURES])
    rules = learn(rows)
    assert {c.measure for c in rules[0]} == {"symbols_per_word", "upper_share"} and all(c.above for c in rules[0])
    wrong = rows.where(verdict(rules) == F.col("bad")).count()
    assert wrong < 60


def covered_by_hand(rows: list[dict], limits: dict[str, list[float]], max_rules: int, max_conditions: int, precision: float):
    """Sequential covering by trying every condition on every row."""
    conditions = [Condition(m, above, v) for m, values in limits.items() for v in values for above in (False, True)]
    holds = lambda c, r: (r[c.measure] > c.threshold) == c.above
    count = lambda part: (sum(r["bad"] for r in part), sum(not r["bad"] for r in part))
    under = lambda rule, part: [r for r in part if all(holds(c, r) for c in rule)]
    rules = []
    while len(rules) < max_rules:
        left = [r for r in rows if not any(under(rule, [r]) for rule in rules)]
        grow, prune, rule = [r for r in left if r["grown"]], [r for r in left if not r["grown"]], ()
        while len(rule) < max_conditions:
            part = under(rule, grow)
            bad, good = count(part)
            if not bad or not good:
                break

            def gain(c, part=part, bad=bad, good=good):
                b, g = count(under((c,), part))
                return b * (math.log2((b + 0.1) / (b + g + 0.2)) - math.log2((bad + 0.1) / (bad + good + 0.2)))

            best = max(conditions, key=gain)
            if gain(best) <= 1e-9:
                break
            rule = (*rule, best)
            if not count(under((best,), part))[1]:
                break
        if not rule:
            break
        held = [count(under(rule[: k + 1], prune)) for k in range(len(rule))]
        worth = [(b - g) / (b + g + 1) for b, g in held]
        kept = max(range(len(rule)), key=lambda k: (worth[k], -k))
        bad, good = held[kept]
        if not bad or bad / (bad + good + 1) < min(precision, bad / (bad + 1)):
            break
        rules.append(rule[: kept + 1])
    return rules


def test_covering_by_hand(spark):
    rng = random.Random(12)
    names = list(MEASURES)[:3]
    data = []
    for k in range(240):
        x = [round(rng.random(), 1) for _ in names]
        bad = (x[0] > 0.6 and x[1] < 0.7) or x[2] > 0.8 or rng.random() < 0.02
        data.append((k, bad, *(x[names.index(m)] if m in names else 0.0 for m in MEASURES)))
    rows = spark.createDataFrame(data, ["doc_id", "bad", *MEASURES])
    held = [r.asDict() for r in rows.withColumn("grown", F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).collect()]
    limits = _thresholds(rows)
    for settings in ((8, 3, 0.9), (2, 1, 0.9), (8, 3, 0.99)):
        wanted = covered_by_hand(held, limits, *settings)
        assert learn(rows, *settings) == wanted
    assert len(covered_by_hand(held, limits, 8, 3, 0.9)) >= 2


def test_no_python_in_the_plan(spark):
    docs, labels = (spark.read.parquet(str(TABLES / f"{t}.parquet")) for t in ("documents", "labels"))
    for df in (statistics(docs), quality_rules(docs, labels)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_missing_repeated_and_extra(spark, documents):
    rows = documents(*cases(), (None, "a b"), (None, "a b"), (0, "")).withColumn("bad", F.lit(1))
    labels = spark.createDataFrame([(3, 0), (None, 1), (4, None), (4, 1), (9999, 0)], "doc_id long, quality int")
    assert quality_rules(rows, labels).count() == rows.count()
    assert quality_rules(rows, labels.where("false")).where("kept AND base_failed").count() == 0
    assert quality_rules(rows.where("false"), labels).collect() == []


def test_verdict_takes_the_first_rule_that_fires(spark):
    rules = [(Condition("upper_share", True, 0.5),), (Condition("words", False, 2.0), Condition("marks_per_word", True, 0.0))]
    docs = spark.createDataFrame([(1, "AB CD EF"), (2, "ab!"), (3, "ab"), (4, "ab cd ef!")], "doc_id long, text string")
    kept = measured(statistics(docs)).where(verdict(rules)).collect()
    assert sorted(r.doc_id for r in kept) == [3, 4]
