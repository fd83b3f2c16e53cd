"""Chunk deduplication against the same rules written byte by byte."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.chunks import _GEAR, Chunking, chunk_ends, without_repeats


def cut(data: bytes, rule: Chunking) -> list[bytes]:
    out, last, h = [], 0, 0
    for k, byte in enumerate(data):
        h = ((h << 1) + int(_GEAR[byte])) & 0xFFFFFFFF
        ends = k + 1 >= 32 and h >> (32 - rule.bits) == 0 and k + 1 < len(data)
        while k + 1 - last > rule.most and (ends or k + 1 == len(data)):
            out.append(data[last : last + rule.most])
            last += rule.most
        if (ends and k + 1 - last >= rule.least) or (k + 1 == len(data) and k + 1 > last):
            out.append(data[last : k + 1])
            last = k + 1
    return out


def brute(rows, rule):
    cuts = {i: cut((t or "").encode(), rule) for i, t in rows}
    first: dict[bytes, int] = {}
    for i in sorted(cuts):
        for chunk in cuts[i]:
            first.setdefault(chunk, i)
    out = {}
    for i, chunks in cuts.items():
        seen, again = set(), []
        for chunk in chunks:
            again.append(first[chunk] != i or chunk in seen)
            seen.add(chunk)
        spans, at, begin = [], 0, None
        for chunk, known in [*zip(chunks, again, strict=True), (b"", False)]:
            if known and begin is None:
                begin = at
            if not known and begin is not None:
                if at - begin >= rule.run:
                    spans += [begin, at]
                begin = None
            at += len(chunk)
        out[i] = (len(chunks), spans)
    return out


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def corpus():
    rng = random.Random(11)
    passages = [prose(rng, n) for n in (55, 70, 120)]
    rows = []
    for k in range(40):
        parts = [prose(rng, rng.randrange(0, 150))]
        if k % 3 == 0:
            parts += [passages[k % 9 // 3], prose(rng, 20)]
        rows.append((k, "\n".join(parts)))
    return rows + [(40, ""), (41, None), (42, "a" * 3000), (43, rows[3][1]), (44, "!" + rows[5][1])], passages


def test_matches_brute_force(documents):
    rows, _ = corpus()
    for rule in (Chunking(), Chunking(least=8, most=40, bits=3, run=30)):
        found = {r.doc_id: (r.n_chunks, r.spans) for r in without_repeats(documents(*rows), rule).collect()}
        assert found == brute(rows, rule)


def test_passages_go_but_for_the_first(documents):
    rows, passages = corpus()
    text = dict(rows)
    found = {r.doc_id: r for r in without_repeats(documents(*rows)).collect()}
    for k in range(40):
        if k % 3 or k < 9:
            assert found[k].text == text[k] and not found[k].spans
        else:
            gone = len(text[k]) - len(found[k].text)
            assert 0.4 * len(passages[k % 9 // 3]) < gone <= len(passages[k % 9 // 3]) + 2
    assert found[43].text == ""
    assert len(found[44].text) < 120  # one byte before a copy moves the first chunks only


def test_whole_characters(documents):
    rng = random.Random(3)
    passage = "".join(rng.choice("éüñ文😀 ") for _ in range(400))
    rows = [(k, prose(rng, 10) + passage + prose(rng, 10)) for k in range(6)]
    for r in without_repeats(documents(*rows)).collect():
        assert r.text.encode().decode() == r.text
        data = dict(rows)[r.doc_id].encode()
        edges = [0, *r.spans, len(data)]
        assert b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode() == r.text


def test_ends_do_not_depend_on_neighbours():
    rng = random.Random(4)
    texts = [prose(rng, n) for n in (30, 0, 5, 200, 1)]
    part = next(words.slices(pa.array(texts)))
    ends, first = chunk_ends(part, Chunking())
    for k, text in enumerate(texts):
        own = next(words.slices(pa.array([text])))
        assert (ends[first[k] : first[k + 1]] - part.offsets[k]).tolist() == chunk_ends(own, Chunking())[0].tolist()
    assert np.all(np.diff(ends) > 0)


def test_missing_repeated_and_extra(documents):
    long = prose(random.Random(1), 100)
    rows = documents((1, long), (1, long), (None, long), (None, long)).withColumn("digest", F.lit(1))
    found = [(r.doc_id, r.text) for r in without_repeats(rows).collect()]
    assert sorted(found, key=str) == sorted([(1, long), (1, long), (None, ""), (None, "")], key=str)
    assert without_repeats(rows.where("false")).collect() == []


def test_rows_without_id_are_told_apart(documents):
    long, other = prose(random.Random(1), 100), prose(random.Random(2), 100)
    greatest = (1 << 63) - 1
    found = [(r.doc_id, r.text) for r in without_repeats(documents((None, long), (None, long), (greatest, other), (None, other))).collect()]
    assert sorted(found, key=str) == sorted([(None, long), (None, ""), (greatest, other), (None, "")], key=str)
