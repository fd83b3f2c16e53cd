"""Repeated strings against a search of every starting point."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from epilake.llm import words
from epilake.llm.repeats import Parsing, _phrases, _tied, without_repeats


def brute(rows: list[tuple[int | None, str | None]], length: int) -> Counter:
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[p : p + length] for _, d in data for p in range(len(d) - length + 1))
    out = Counter()
    for doc_id, d in data:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = True
        left = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
        out[doc_id, len(d), int(gone.sum()), tuple(edges), hashlib.sha256(left).hexdigest()] += 1
    return out


def found(rows, rule):
    out = without_repeats(rows, rule).collect()
    for r in out:
        if r.kept is not None:
            assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    return Counter((r.doc_id, r.n_bytes, r.n_removed, tuple(r.spans), r.kept_sha256) for r in out)


def texts(seed: int, alphabet: str, sizes: list[int]) -> list[str]:
    rng = random.Random(seed)
    passages = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (30, 60, 13, 200)]
    out = []
    for n in sizes:
        own = "".join(rng.choice(alphabet) for _ in range(n))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(own) + 1)
            piece = rng.choice(passages)
            a = rng.randrange(len(piece))
            own = own[:at] + piece[a : a + rng.randrange(1, 80)] + own[at:]
        out.append(own)
    return out + out[:3]


@pytest.mark.parametrize(
    ("alphabet", "rule"),
    [
        ("ab", Parsing(length=24, trigger=5, block=4)),
        ("abcdefghij ", Parsing(length=20, trigger=6, block=7)),
        ("aé ", Parsing(length=17, trigger=3, block=1)),
        ("abcdef", Parsing(length=25, trigger=25, block=3)),
        ("ab", Parsing(length=24, trigger=5, block=4, ranked=0)),
        ("ab", Parsing(length=24, trigger=5, block=4, ranked=3)),
        ("abcdefghij ", Parsing(length=20, trigger=6, block=7, ranked=2)),
        ("aé ", Parsing(length=17, trigger=3, block=1, ranked=0)),
        ("a\0", Parsing(length=17, trigger=2, block=5)),
    ],
)
def test_matches_brute_force(documents, alphabet, rule):
    cases = texts(4, alphabet, [0, 1, 10, 23, 24, 25, 60, 61, 90, 120, 200, 400] * 2)
    rows = [*enumerate(cases), (500, None), (501, "a" * 100), (502, "a" * 30), (503, "b" * rule.length)]
    assert found(documents(*rows), rule) == brute(rows, rule.length)


@pytest.mark.parametrize("seed", range(6))
def test_ties_of_phrases_around_a_trigger(seed):
    """Suffixes of aligned phrases against a comparison of all strings; zero bytes and ends of texts among them."""
    rng = random.Random(seed)
    rule = Parsing(length=9, trigger=2)
    keys, phrases, near, span = [], [], [], []
    for _ in range(60):
        high = rng.randrange(8)
        low = rng.randrange(high + 1)
        body = [bytes(rng.choice(b"a\0") for _ in range(n)) for n in (high, 7 - low)]
        key = rng.randrange(4)
        keys.append(key)
        phrases.append(body[0] + bytes([key, 9]) + body[1])
        near.append(high)
        span.append(high - low)
    got = _tied(keys, phrases, np.array(near), np.array(span), rule)
    named = [{d: (k, d, p[n - d : n - d + 9]) for d in range(n - s, n + 1)} for k, p, n, s in zip(keys, phrases, near, span, strict=True)]
    seen = Counter(x for each in named for x in each.values())
    assert all(len(x[2]) == 9 for x in seen)
    for row, each in zip(got, named, strict=True):
        assert [d for d in range(8) if row[d]] == [d for d in sorted(each) if seen[each[d]] > 1]


def test_triggers_do_not_depend_on_the_slice():
    """A text has the same phrases alone and behind texts of any size."""
    rng = random.Random(2)
    text = "".join(rng.choice("ab ") for _ in range(3000))
    rule = Parsing(length=40, trigger=2)

    def own(part):
        low, high, trigger = _phrases(part, words.prefix_hashes(part.data), rule)
        inside = low >= part.offsets[-2]
        return [(x[inside] - part.offsets[-2]).tolist() for x in (low, high, trigger)]

    alone = own(next(words.slices(pa.array([text]))))
    for size in (1, 1000, 200_000):
        assert own(next(words.slices(pa.array(["z" * size, text])))) == alone


def test_production_length(documents):
    rng = random.Random(9)
    base = " ".join(f"w{rng.randrange(1000)}" for _ in range(900))
    rows = [(1, base), (2, "x" + base[:2500] + "y" + base[2500:]), (3, base[100:499]), (4, base[700:1100]), (5, "z" * 900)]
    assert found(documents(*rows), Parsing()) == brute(rows, 400)


def test_a_passage_of_very_many_texts(documents):
    """More occurrences of one form than are dealt by form, and some that are not so many."""
    rng = random.Random(7)
    hot, cold = ("".join(rng.choice("abcdef") for _ in range(40)) for _ in range(2))
    rows = [(k, hot if k < 1500 else f"{k}{hot}{k}" if k < 1540 else cold + str(k)) for k in range(1560)]
    for ranked in (1024, 1):
        rule = Parsing(length=24, trigger=5, block=4, ranked=ranked)
        assert found(documents(*rows), rule) == brute(rows, 24)


def test_missing_repeated_and_extra(documents):
    rule = Parsing(length=8, trigger=3, block=2)
    cases = [(None, "abcdefghijk"), (None, "abcdefghijk"), (1, "zzabcdefghz"), (1, "zzabcdefghz"), (2, None), (3, "")]
    rows = documents(*cases).withColumn("row_id", F.lit(0)).withColumn("keys", F.lit("x"))
    assert found(rows, rule) == brute(cases, 8)
    assert without_repeats(documents((1, "a")).where("false"), rule).collect() == []
