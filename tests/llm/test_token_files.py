"""Token files against encoding every text whole, and an exact round trip."""

from __future__ import annotations

import json
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from epilake.llm import words
from epilake.llm.queries import byte_tokenizer, op8_token_files
from epilake.llm.token_files import TokenFiles, encoder, read_sequences, token_output


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(byte_tokenizer())
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


TRICKY = ["", " ", "a", " a", "a ", "a  b", "a b", "a \n b", "\na b", "don't we'll  'S", "x y z", "x   y", " a b", "\x1c a b",
          "<|endoftext|> a", "#!#", "1 22 333", "héé ñ 文字 字", "a\tb c", "  lead", "tail  ", "😀 😀", "a​b c", "\x85 x y", "x\x85 y",
          "　  a b", "''' \" x", "A" * 300 + " " + "b" * 80, "x ÀÖ×÷ßŸ, naïve.) (y) z|*** #$% don't, 's a_b _ a1 1a ² Ⅷ x² ʰ", "a ñandú!! ***"]


def expected(rows, whole):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_pieces_are_those_of_the_whole_text(whole):
    rng = random.Random(1)
    own = encoder(byte_tokenizer())
    cases = TRICKY + ["".join(rng.choice(TRICKY) + rng.choice(["", " ", "\n", "  "]) for _ in range(5)) for _ in range(400)]
    for size in (1 << 20, 50):
        for part in words.slices(pa.array(cases), size):
            ids, before = own.encode(part)
            for k, text in enumerate(cases[part.first : part.last]):
                assert ids[before[k] : before[k + 1]].tolist() == whole(text)[:-1], repr(text)


def test_forgotten_pieces_are_learned_again(monkeypatch, whole):
    monkeypatch.setattr("epilake.llm.token_files.CACHE_WORDS", 5)
    own = encoder(byte_tokenizer())
    for text in ("a b c d e f g", "h i j k a b", "a b"):
        assert own.encode(next(words.slices(pa.array([text]))))[0].tolist() == whole(text)[:-1]


@pytest.mark.parametrize("rule", [{}, {"length": 8, "batch": 2, "docs_per_file": 7}, {"length": 3, "batch": 1, "docs_per_file": 1}])
def test_round_trip(documents, whole, rule, tmp_path):
    rows = [(k * 3 - 20, t) for k, t in enumerate(TRICKY + [None, "x " * 500])]
    folder = (tmp_path / "tokens").as_uri()
    found = token_output(documents(*rows), TokenFiles(byte_tokenizer(), **rule), folder).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected(rows, whole)
    length = rule.get("length", 1024)
    total = 0
    for path in sorted((tmp_path / "tokens").glob("*.arrow")):
        reader = read_sequences(str(path))
        assert reader.schema.field("ids").type == pa.list_(pa.uint16(), length)
        before = pa.total_allocated_bytes()
        batches = [reader.get_batch(i) for i in range(reader.num_record_batches)]
        assert pa.total_allocated_bytes() == before  # nothing is copied
        mask = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in batches])
        assert not mask[int(mask.sum()) :].any() and len(mask) - mask.sum() < length
        total += int(mask.sum())
    assert total == sum(r.n_tokens for r in found)
    assert not [p for p in (tmp_path / "tokens").iterdir() if p.name.startswith(".") and p.suffix != ".crc"]


def test_missing_repeated_and_extra(documents, whole):
    rows = [(None, "n"), (None, None), (4, "x y"), (4, "x y"), (4, "z"), (-1, "")]
    docs = documents(*rows).withColumn("file", F.lit("f")).withColumn("ids", F.lit("i"))
    found = token_output(docs, TokenFiles(byte_tokenizer(), length=4, docs_per_file=2)).collect()
    assert sorted(r.n_tokens for r in found) == sorted(len(whole(t)) for _, t in rows)
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ids == [None, None, -1, 4, 4, 4]


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> ", " é<|endoftext|>'s", "<|endoftext", "|>", "<|endoftext|>|>", "<|endof"]


def as_loaded(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("odd", [None, {"lstrip": True}, {"single_word": True, "content": "lead"}, {"content": "ad"}])
def test_added_tokens_as_the_library_has_them(odd, tmp_path):
    path = byte_tokenizer()
    if odd:
        data = json.loads(Path(path).read_text())
        new = {"id": 50257, "content": "<x>", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}
        path = str(tmp_path / "tokenizer.json")
        Path(path).write_text(json.dumps(data | {"added_tokens": [*data["added_tokens"], new | odd]}))
    whole, own = as_loaded(path), encoder(path, True)
    rng = random.Random(2)
    some = ADDED + TRICKY + ["a  <x> b", "lead"]
    cases = some + ["".join(rng.choice(some) + rng.choice(["", " ", "\n", "  "]) for _ in range(5)) for _ in range(400)]
    for size in (1 << 20, 50):
        for part in words.slices(pa.array(cases), size):
            ids, before = own.encode(part)
            for k, text in enumerate(cases[part.first : part.last]):
                assert ids[before[k] : before[k + 1]].tolist() == whole(text)[:-1], repr(text)


def test_query_has_the_ids_of_the_tokenizer_as_loaded(spark, documents, tmp_path):
    rows = list(enumerate(ADDED + TRICKY))
    documents(*rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = expected(rows, as_loaded(byte_tokenizer()))
    assert [tuple(r) for r in op8_token_files(spark, str(tmp_path)).orderBy("start").collect()] == want
    stage = dict(corpus_pipeline.STAGES)["token files"]
    assert [tuple(r) for r in stage(spark, documents(*rows), str(tmp_path)).orderBy("start").collect()] == want


def test_an_id_of_many_rows_has_several_files(documents, whole, tmp_path):
    rows = [(k, "x y") for k in range(30)] + [(7, f"z {k}") for k in range(40)] + [(None, f"n {k}") for k in range(50)] + [(7, "same")] * 20
    docs = documents(*rows).withColumn("part", F.lit("p")).withColumn("parts", F.lit(1)).withColumn("id", F.lit(3))
    folder = (tmp_path / "tokens").as_uri()
    found = sorted(token_output(docs, TokenFiles(byte_tokenizer(), docs_per_file=10), folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]
    crc = lambda text: zlib.crc32(np.array(whole(text), "<u4").tobytes())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids_crc32) for r in found) == sorted((i is None, i or 0, crc(t)) for i, t in rows)
    sizes = [sum(b.column(3).flatten().to_pylist().__len__() for b in (reader.get_batch(i) for i in range(reader.num_record_batches)))
             for reader in (read_sequences(str(p)) for p in sorted((tmp_path / "tokens").glob("*.arrow")))]
    assert sum(sizes) == len(rows) and max(sizes) < 30


@pytest.mark.parametrize("ids", [1, 50, 2000])
def test_files_end_by_their_ids(documents, whole, tmp_path, ids):
    rows = [(k, "some words " * (k % 37)) for k in range(300)] + [(500, "a long one " * 20_000), (None, "x")]
    folder = (tmp_path / "tokens").as_uri()
    rule = TokenFiles(byte_tokenizer(), length=16, batch=4, docs_per_file=100, ids_per_file=ids)
    found = token_output(documents(*rows), rule, folder).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected([(None, "x"), *rows[:-1]], whole)
    sizes = []
    for path in (tmp_path / "tokens").glob("*.arrow"):
        reader = read_sequences(str(path))
        batches = [reader.get_batch(i) for i in range(reader.num_record_batches)]
        marks = [np.concatenate([b.column(k).flatten().to_numpy(zero_copy_only=False) for b in batches]) for k in (1, 2)]
        last = np.flatnonzero(marks[1])[-2:]
        sizes.append(last[-2] + 1 if len(last) > 1 else 0)  # without its last document
    assert max(sizes) < ids and len(sizes) > 3


def test_empty_table(documents):
    none = documents((1, "a")).where("false")
    out = token_output(none, TokenFiles(byte_tokenizer()))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.collect() == []


def test_small_table(spark, whole):
    docs = spark.read.parquet(str(Path("/root/testdata/sf0.001/documents.parquet")))
    found = token_output(docs, TokenFiles(byte_tokenizer(), docs_per_file=30)).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected([(r.doc_id, r.text) for r in docs.collect()], whole)
