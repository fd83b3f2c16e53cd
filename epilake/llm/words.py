"""Words, shingles and their hashes for whole Arrow batches, as NumPy arrays.

Texts are handled as UTF-8 bytes in slices of about ``SLICE_BYTES``, so the
arrays stay in cache and memory does not depend on the batch. A text is never
cut: one longer than a slice is a slice of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of words that are anything but white space.
VISIBLE = ~SPACES
#: Bytes of words made of letters a-z, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the word."""
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xFF51AFD7ED558CCD)
    x ^= x >> _U64(33)
    x *= _U64(0xC4CEB9FE1A85EC53)
    x ^= x >> _U64(33)
    return x


#: A random 64-bit value for every byte.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=_U64) * _U64(0xD6E8FEB86659FD93))

_powers = {"up": np.ones(1, _U64), "down": np.ones(1, _U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the powers 0..n, and its inverses, modulo 2**64."""
    if len(_powers["up"]) <= n:
        size = max(n + 1, 2 * SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            values = np.full(size, base, _U64)
            values[0] = 1
            _powers[name] = np.cumprod(values, dtype=_U64)
    return _powers["up"], _powers["down"]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``P`` of length ``len(data) + 1``: sums of byte values times powers of the base."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, _U64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], dtype=_U64, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A rolling hash of each ``data[start:end]``; equal bytes have equal hashes wherever they lie.

    Different bytes with equal hashes can be made, so it may choose places but
    must not decide what is equal: ``word_hashes`` and ``digests`` are for that.
    """
    _, down = powers(len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(_U64))


@dataclass
class Slice:
    """Rows ``first..last`` of a batch: their bytes and where each text begins."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts (null: empty) of a batch, a few at a time."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    _, at, held = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(texts), first + 65_536)
        yield Slice(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of words before it."""
    inside = np.zeros(len(data) + 2, bool)
    np.take(kind, data, out=inside[1:-1])
    here = inside[1:-1]
    begins, stops = here & ~inside[:-2], here & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = here[cuts]
    stops[cuts - 1] = here[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 128-bit cryptographic digest of each ``data[start:end]``, as two columns of 64 bits."""
    view, blake = memoryview(np.ascontiguousarray(data)), hashlib.blake2b
    held = [blake(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return np.frombuffer(b"".join(held), np.uint64).reshape(-1, 2)


#: Two primes, and for each a base: equal hashes of different words are as rare as 2**-62, and not made by patterns.
_MODULI = ((2_147_483_647, 1_664_525_717), (2_147_483_629, 1_013_904_223))
_residues: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _residue_powers(modulus: int, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the powers 0..n, and its inverses, to a prime modulus."""
    if modulus not in _residues or len(_residues[modulus][0]) <= n:
        size = max(n + 1, 2 * SLICE_BYTES)
        found = []
        for factor in (base, pow(base, -1, modulus)):
            values = np.ones(1, _U64)
            while len(values) < size:
                values = np.concatenate([values, values * _U64(pow(factor, len(values), modulus)) % _U64(modulus)])
            found.append(values)
        _residues[modulus] = (found[0], found[1])
    return _residues[modulus]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each ``data[start:end]``: polynomials to two prime moduli, mixed with the length."""
    out = np.zeros(len(starts), _U64)
    small = data.astype(_U64) + _U64(1)
    for modulus, base in _MODULI:
        up, down = _residue_powers(modulus, base, len(data))
        terms = small * up[: len(data)]
        if len(data) > 1 << 22:  # or the sums would not fit
            terms %= _U64(modulus)
        prefix = np.zeros(len(data) + 1, _U64)
        np.cumsum(terms, out=prefix[1:])
        value = (prefix[ends] - prefix[starts]) % _U64(modulus) * down[starts] % _U64(modulus)
        out = (out << _U64(32)) | value
    return mixed(out ^ mixed((ends - starts).astype(_U64)))


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` values in a row; windows over the end of a text are the caller's to skip."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, _U64)
    out = values[:n].copy()
    for k in range(1, width):
        out ^= out >> _U64(29)
        out *= _U64(_BASE)
        out += values[k : n + k]
    return mixed(out)


def shingle_sets(part: Slice, width: int, lower: bool = True) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles.

    A text with fewer than ``width`` words has one shingle, all its words; a
    text without words has none.
    """
    data = LOWER[part.data] if lower else part.data
    starts, ends, first = word_bounds(data, part.offsets, VISIBLE)
    words = word_hashes(data, starts, ends)
    grams = windows(words, width)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(grams[a : b - width + 1])
        elif b > a:
            whole = words[a:b]
            yield windows(whole, b - a) ^ _U64(b - a)
        else:
            yield np.zeros(0, _U64)
