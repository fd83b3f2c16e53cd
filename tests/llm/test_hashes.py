"""Texts made to have equal polynomial hashes modulo 2**64 stay different."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from epilake.llm import chunks, repeats, token_files, words
from epilake.llm.minhash import NearDuplicates, near_duplicates
from epilake.llm.queries import byte_tokenizer


def alternating(n: int) -> str:
    """The Thue-Morse word of ``n`` letters."""
    return "".join("ab"[k.bit_count() % 2] for k in range(n))


ONE = alternating(1024)
OTHER = ONE.translate(str.maketrans("ab", "ba"))


def spans(*texts: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(x.encode()) for x in texts])
    return data, np.concatenate([[0], ends[:-1]]), ends


def test_the_rolling_hash_is_fooled_and_the_others_are_not():
    data, starts, ends = spans(ONE, OTHER)
    rolling = words.span_hashes(words.prefix_hashes(data), starts, ends)
    assert rolling[0] == rolling[1]
    assert len(set(words.word_hashes(data, starts, ends).tolist())) == 2
    assert len({x.tobytes() for x in words.digests(data, starts, ends)}) == 2


@pytest.mark.parametrize("size", [20, 1 << 19, 5 << 20])
def test_word_hashes_depend_on_bytes_alone(size):
    rng = np.random.default_rng(size)
    data = rng.integers(0, 256, size, np.uint8)
    data[-7:] = data[:7]
    starts, ends = np.array([0, size - 7, 1, 0]), np.array([7, size, 7, 6])
    found = words.word_hashes(data, starts, ends)
    assert found[0] == found[1]
    assert len(set(found.tolist())) == 3
    short = words.word_hashes(data[:7].copy(), np.array([0]), np.array([7]))
    assert short[0] == found[0]


def test_near_duplicates_keep_them_apart(documents):
    rows = near_duplicates(documents((1, ONE), (2, OTHER), (3, ONE)), NearDuplicates(width=3, percent=85, rows=5)).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 2, 3: 1}


def test_token_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    held = token_files._Encoder(byte_tokenizer(), added=True)
    library = Tokenizer.from_file(byte_tokenizer())
    texts = [ONE, OTHER, f"{OTHER} {ONE}", ""]
    for part in words.slices(pa.array(texts), 1 << 20):
        ids, before = held.encode(part)
        for k, text in enumerate(texts[part.first : part.last]):
            assert ids[before[k] : before[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_collision_in_the_piece_cache_is_seen(monkeypatch):
    monkeypatch.setattr(words, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    held = token_files._Encoder(byte_tokenizer(), added=True)
    texts = ["one two six", "ten", "the end of it"]
    for part in words.slices(pa.array(texts)):
        ids, before = held.encode(part)
        for k, text in enumerate(texts):
            assert ids[before[k] : before[k + 1]].tolist() == held.tokenizer.encode(text, add_special_tokens=False).ids


def test_repeated_strings_keep_them(documents):
    rows = repeats.without_repeats(documents((1, ONE), (2, OTHER), (3, f"{ONE}x"))).collect()
    plain = {1: ONE, 2: OTHER, 3: f"{ONE}x"}
    starts: dict[bytes, list[tuple[int, int]]] = {}
    for k, text in plain.items():
        for p in range(len(text) - 399):
            starts.setdefault(text[p : p + 400].encode(), []).append((k, p))
    gone: dict[int, set[int]] = {k: set() for k in plain}
    for places in starts.values():
        if len(places) > 1:
            for k, p in places:
                gone[k].update(range(p, p + 400))
    for row in rows:
        left = "".join(c for p, c in enumerate(plain[row.doc_id]) if p not in gone[row.doc_id])
        assert row.n_removed == len(gone[row.doc_id])
        assert row.kept_sha256 == hashlib.sha256(left.encode()).hexdigest()


def test_chunks_keep_them(documents):
    rule = chunks.Chunking(least=512, most=1024, bits=20, run=96)
    rows = chunks.without_repeats(documents((1, ONE), (2, OTHER)), rule).collect()
    assert {r.doc_id: r.text for r in rows} == {1: ONE, 2: OTHER}
