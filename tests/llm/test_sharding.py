"""Shards against a plain search, and what is promised of them."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epilake.llm import sharding
from epilake.llm.sharding import Shards, plan_shards, shards, write_shards


def groups_of(rows: list[tuple]) -> list[tuple[str, int]]:
    sizes = Counter()
    for _, text in rows:
        sizes[hashlib.sha256((text or "").encode()).hexdigest()] += len((text or "").encode()) + 1
    return sorted(sizes.items())


def plain(groups: list[tuple[str, int]], count: int) -> dict[str, int]:
    """The shard of every group: large ones alone, then the least capacity by trying all."""
    left, rest, out = count, sum(n for _, n in groups), {}
    for key, n in sorted(groups, key=lambda g: (-g[1], g[0])):
        if n * left <= rest:
            break
        out[key] = len(out)
        left, rest = left - 1, rest - n
    others = [g for g in groups if g[0] not in out]

    def fill(capacity: int) -> list[int]:
        shard, room, own = 0, capacity, []
        for _, n in others:
            if n > room:
                shard, room = shard + 1, capacity
            room -= n
            own.append(shard)
        return own

    capacity = max([-(-rest // left), *(n for _, n in others)], default=0)
    while others and fill(capacity)[-1] >= left:
        capacity += 1
    return out | {g[0]: count - left + s for g, s in zip(others, fill(capacity), strict=True)}


def check(found, rows: list[tuple], count: int) -> None:
    found = found.collect()
    want = plain(groups_of(rows), count)
    expect = Counter()
    for doc_id, text in rows:
        data = (text or "").encode()
        expect[doc_id, len(data) + 1, zlib.crc32(data), want[hashlib.sha256(data).hexdigest()]] += 1
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard) for r in found) == expect
    slots: dict[int, list[int]] = {}
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


@pytest.mark.parametrize("count", [1, 2, 5, 16])
def test_shards_are_those_of_a_plain_search(documents, count):
    rows = [(k, "x" * (k * 37 % 101) + str(k % 60)) for k in range(150)]
    rows += [(1000 + k, "the same") for k in range(40)] + [(2000, None), (2001, ""), (2002, "é")]
    check(shards(documents(*rows), Shards(count)), rows, count)


def test_a_group_with_most_bytes_has_a_shard_of_its_own(documents):
    rows = [(k, "copy " * 20) for k in range(100)] + [(500 + k, f"text {k} " * 3) for k in range(100)]
    found = shards(documents(*rows), Shards(8))
    check(found, rows, 8)
    sizes = dict(found.groupBy("shard").agg(F.sum("size")).collect())
    assert len(sizes) == 8
    assert max(n for s, n in sizes.items() if s) < 2 * min(sizes.values())


def test_fewer_groups_than_shards_repeated_and_null_ids(documents):
    rows = [(None, "a")] * 30 + [(7, "a")] * 5 + [(7, "b")] * 5 + [(None, None)]
    check(shards(documents(*rows), Shards(16)), rows, 16)


def test_no_rows(documents):
    assert shards(documents((1, "a")).where("false")).collect() == []


def test_columns_with_the_names_used_inside(documents):
    rows = [(k, f"t{k}") for k in range(20)]
    more = documents(*rows).withColumns({c: F.lit("x") for c in ("key", "size", "shard", "bin", "part", "slot", "n")})
    check(shards(more, Shards(4)), rows, 4)


@pytest.mark.parametrize("slots", [1, 3])
def test_bins_that_one_id_fills_are_dealt_on(documents, monkeypatch, slots):
    monkeypatch.setattr(sharding, "SLOTS", slots)
    rows = [(5, "hot")] * 60 + [(None, "none")] * 40 + [(k, f"t{k}") for k in range(30)]
    check(shards(documents(*rows), Shards(6)), rows, 6)


def test_a_long_text(documents):
    rows = [(1, "long " * 300_000), (2, "short"), (3, "short")]
    check(shards(documents(*rows), Shards(3)), rows, 3)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(1, 400), min_size=1, max_size=80), count=st.integers(1, 9))
def test_the_search_divides_sections(spark, sizes, count):
    """With sections of few digits, groups share sections and the search has to look closer."""
    kept, sharding.FIRST = sharding.FIRST, 1
    try:
        groups = [(hashlib.sha256(str(k).encode()).hexdigest(), n) for k, n in enumerate(sizes)]
        frame = spark.createDataFrame(groups, "key string, size long")
        plan = plan_shards(frame, Shards(count))
        assert dict(frame.select("key", plan.shard(F.col("key"))).collect()) == plain(sorted(groups), count)
    finally:
        sharding.FIRST = kept


def test_written_shards_hold_all_rows_and_columns(spark, documents, tmp_path):
    rows = [(k, f"text {k % 50}") for k in range(120)]
    docs = documents(*rows).withColumn("key", F.lit("own"))
    sums = write_shards(docs, str(tmp_path / "out"), Shards(4), max_records=20)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*docs.columns, "shard"}
    want = plain(groups_of(rows), 4)
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(k, want[hashlib.sha256(x.encode()).hexdigest()]) for k, x in rows}
    assert {(r.shard, r.rows) for r in sums.collect()} == set(Counter(r.shard for r in back.collect()).items())
    with pytest.raises(ValueError):
        write_shards(docs.withColumn("Shard", F.lit(1)), str(tmp_path / "no"))


def test_no_python_on_the_executors(documents):
    plan = shards(documents((1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
