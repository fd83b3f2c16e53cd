"""Benchmark passages against a search by hand."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from epilake.llm import decontaminate
from epilake.llm.decontaminate import clean_documents, contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def found_words(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = {}
    grams = []
    for item_id, text in items:
        own = found_words(text)
        size = min(window, len(own))
        grams += [(item_id, own[k : k + size]) for k in range(len(own) - size + 1) if size]
    for doc_id, text in docs:
        own, hit, ids = found_words(text), set(), set()
        for item_id, gram in grams:
            for k in range(len(own) - len(gram) + 1):
                if own[k : k + len(gram)] == gram:
                    hit |= set(range(k, k + len(gram)))
                    if item_id is not None:
                        ids.add(str(item_id))
        out[doc_id] = (len(own), len(hit), sorted(ids), bool(hit))
    return out


def cases():
    rng = random.Random(2)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "Delta", "ñu", "über", "x1", "7"])
    items = [(k, " ".join(word() for _ in range(rng.choice([3, 9, 10, 14, 25])))) for k in range(30)]
    items += [(30, ""), (31, None), (None, items[2][1]), (32, "Zebra"), (33, "a-b, c.d")]
    docs = []
    for k in range(60):
        own = [word() for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(own) + 1)
            own[at:at] = (rng.choice(items)[1] or "").split()
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(own)))
    docs += [(60, None), (61, ""), (62, "the ZEBRA!"), (63, "x A b c D y"), (64, "...")]
    return docs, items


@pytest.mark.parametrize("block", [1 << 22, 64])
def test_matches_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination(documents(*docs).withColumn("items", F.lit("x")), bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows} == brute(docs, items)


def block_sizes(bench) -> list[int]:
    """Bytes of the texts and item ids of each block of tables."""
    blocks = [decontaminate._read_block(path) for path in decontaminate.stored_tables(bench, 10)]
    return [len(tables[0].items.data if tables else b"") + sum(len(x) for own in ids for x in own) for tables, ids in blocks]


def test_equal_texts_and_many_ids_stay_within_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    docs, items = cases()
    items += [(100 + k, items[5][1]) for k in range(2000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination(documents(*docs), bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows} == brute(docs, items)
    sizes = block_sizes(bench)
    assert len(sizes) > 3 and max(sizes) <= 2000
    assert len(block_sizes(spark.createDataFrame([(k % 3, items[5][1]) for k in range(2000)], bench.schema))) == 1


def test_many_blocks_are_one_node_and_stay_off_the_driver(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    made = []
    monkeypatch.setattr(decontaminate, "_read_block", lambda path: made.append(path))  # of this process, not of the tasks
    rows = contamination(documents(*docs), bench)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and len(decontaminate.stored_tables(bench, 10)) >= 20
    assert not made


def test_a_window_in_very_many_items(spark, documents):
    items = [(k, f"one two three four five six seven eight nine ten own{k}") for k in range(3000)]
    docs = [(1, "one two three four five six seven eight nine ten"), (2, "two three four five six seven eight nine ten own7")]
    rows = {r.doc_id: r for r in contamination(documents(*docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert rows[1].n_items == 3000 and rows[1].n_hit == 10
    assert rows[2]["items"] == ["7"]


def test_windows_do_not_cross_documents(spark, documents):
    text = "a b c d e f g h i j"
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    rows = documents((1, "a b c d e"), (2, "f g h i j"), (3, text), partitions=1)
    assert [r.doc_id for r in contamination(rows, bench).where("contaminated").collect()] == [3]
    assert sorted(r.doc_id for r in clean_documents(rows, bench).collect()) == [1, 2]
    assert clean_documents(rows, bench).columns == rows.columns


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    rows = documents((1, "a b"), (None, "a b"), (None, "c"))
    assert contamination(rows.where("false"), bench).collect() == []
    assert [r.contaminated for r in contamination(rows, bench.where("false")).collect()] == [False] * 3
    assert [r.text for r in clean_documents(rows, bench).collect()] == ["c"]
