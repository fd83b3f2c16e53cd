"""The pipeline, stage by stage, against brute force over what the stage before kept."""

from __future__ import annotations

import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from epilake.llm.mixing import mix
from epilake.llm.quality import quality_scores
from epilake.llm.queries import byte_tokenizer
from test_decontaminate import brute as brute_passages
from test_minhash import brute as brute_groups
from test_mixing import exact_targets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], SF), "test-stage"))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "minhash near-dedup", "benchmark decontamination", "mixing", "token files",
    ]
    for df in stages[:5]:
        assert df.columns == stages[0].columns


def test_quality(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    accepted = {r.doc_id for r in quality_scores(stages[0], labels).collect() if r.predicted}
    assert {i for i, _ in pairs(stages[1])} == accepted
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good & accepted) >= 0.98 * len(good)


def test_near_duplicates(stages):
    groups = brute_groups(pairs(stages[1]), 5, 80)
    assert {i for i, _ in pairs(stages[2])} == {label for _, label in groups.values()}


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = brute_passages(pairs(stages[2]), items)
    assert {i for i, _ in pairs(stages[3])} == {i for i, f in found.items() if not f[3]}


def test_mixing_stage(stages):
    picks = mix(stages[3]).collect()
    sizes: Counter = Counter()
    for r in picks:
        sizes[r.source] += r.size
    expected = exact_targets(sizes)
    assert all(r.target == pytest.approx(float(expected[r.source])) for r in picks)
    assert Counter(i for i, _ in pairs(stages[4])) == +Counter({r.doc_id: r.copies for r in picks})


def test_token_files_stage(stages):
    tokenizer = Tokenizer.from_file(byte_tokenizer())
    tokenizer.encode_special_tokens = True
    rows, start = [], 0
    for doc_id, text in sorted(pairs(stages[4])):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in stages[5].orderBy("start").collect()] == rows


def test_run_gives_the_same_rows(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[5].collect()))


def test_odd_rows_pass_through_all_stages(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for rows in ([], [(None, None, None, None, None)] * 2 + [(1, "", "en", "a", 0), (1, "a b c", None, None, 5), (2, "a b c", "x", "b", 5)]):
        folder = Path(tmp_path) / f"t{len(rows)}"
        spark.createDataFrame(rows, schema).write.parquet(str(folder / "documents.parquet"))
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{SF}/{name}.parquet").where("false").write.parquet(str(folder / f"{name}.parquet"))
        assert corpus_pipeline.run(spark, str(folder)).count() >= 0


def test_columns_with_clashing_names_pass_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ("score", "features", "wm_spans", "place", "own_id", "copies", "rep", "component", "size", "c0", "kept")
    for name in names:
        docs = docs.withColumn(name, docs.doc_id)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "clash")
    assert docs.columns[-len(names) :] == list(names)
    assert docs.where(" OR ".join(f"{name} != doc_id" for name in names)).isEmpty() and not docs.isEmpty()
