"""Results stay whole when tasks die late and run again."""

from __future__ import annotations

from collections import Counter

import pytest

from epilake.layout import Batch, LakeLayout
from epilake.operators.aggregate import zero_count
from epilake.operators.latest import latest_per_key
from epilake.operators.rename import sort_desc
from epilake.sinks.files import write_batch, write_curated
from epilake.sinks.pointers import write_pointer
from epilake.sinks.jdbc import missing_rows
from epilake.sources.control import latest_batches
from epilake.sources.registry import DatasetSpec, read_batch

SPEC = DatasetSpec("linhas", {"l_suppkey": "bigint", "l_discount": "double"})


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def lines(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    return frame.select("l_suppkey", "l_returnflag", "l_linestatus", "l_discount").repartition(6)


@pytest.fixture(scope="module")
def flaky(lines):
    def die_once(batches):
        from pyspark import TaskContext

        yield from batches
        task = TaskContext.get()
        if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
            raise RuntimeError("lost")

    return lines.mapInArrow(die_once, lines.schema)


def test_writes(spark, tmp_path, lines, flaky):
    layout = LakeLayout(f"{tmp_path}/raw", f"{tmp_path}/curated", "csv", "parquet")
    batch = Batch(SPEC.name, "20221103", "u")
    write_batch(flaky, layout, batch)
    write_pointer(spark, layout, batch)
    found = latest_batches(spark, layout, [SPEC.name])[SPEC.name]
    assert rows(read_batch(spark, layout, SPEC, found)) == rows(lines)
    assert rows(write_curated(flaky, layout, "saida", "20221103")) == rows(lines)


def test_operators(lines, flaky):
    closed = "l_linestatus = 'F'"
    assert rows(missing_rows(flaky, flaky.filter(closed))) == rows(lines) - rows(lines.filter(closed))
    assert rows(sort_desc(flaky, "l_discount")) == rows(lines)
    for run in (
        lambda df: zero_count(df, ["l_suppkey"], "l_discount", "n"),
        lambda df: latest_per_key(df, ["l_suppkey"], "l_discount"),
    ):
        assert rows(run(flaky)) == rows(run(lines))
