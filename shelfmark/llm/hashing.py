"""Vectorised 64-bit hashing of words and word n-grams over batches of whole texts.

A word is a run of bytes other than space and \\x09-\\x0D, A-Z lower-cased (UTF-8 keeps every
other character away from those bytes).  A batch is hashed with a handful of numpy passes, so the
cost is a few nanoseconds a byte and the memory is bounded by ``CHUNK`` bytes of text at a time,
however long a single text is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Bytes of text hashed at a time; a longer text is cut at white space and its words joined again.
CHUNK = 1 << 17

_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(size, b, np.uint64))) for b in (base, inverse))


def _hash_buffer(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word: a polynomial's value, as a difference of prefix sums moved back to power 0."""
    edge = np.flatnonzero(np.diff(_SPACE.take(buf).view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    return hash_spans(buf, edge[::2], edge[1::2]), edge[::2]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of the bytes of every span."""
    up, down = _powers(CHUNK * 2 if len(buf) <= CHUNK * 2 else 1 << len(buf).bit_length())
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE.take(buf) * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Cuts a long text at white space; a word stays whole."""
    at = 0
    while len(raw) - at > CHUNK:
        end = at + CHUNK
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def word_hashes(texts: Iterable[str | None], lower: bool = True) -> Iterator[np.ndarray]:
    """The word hashes of each text in order; none for a null or blank text."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        raw = raw.translate(_LOWER) if lower else raw
        if len(raw) > CHUNK:
            yield from _flush(held)
            held, size = [], 0
            yield np.concatenate([_hash_buffer(np.frombuffer(p, np.uint8))[0] for p in _pieces(raw)])
            continue
        held.append(raw)
        size += len(raw)
        if size >= CHUNK:
            yield from _flush(held)
            held, size = [], 0
    yield from _flush(held)


def _flush(held: list[bytes]) -> Iterator[np.ndarray]:
    if not held:
        return
    words, starts = _hash_buffer(np.frombuffer(b" ".join(held) + b" ", np.uint8))
    ends = np.cumsum([len(x) + 1 for x in held])
    cut = np.searchsorted(starts, ends)
    at = 0
    for end in cut:
        yield words[at:end]
        at = end


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of n words; none if there are fewer words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    total = words[: len(words) - n + 1] * _MULT[0]
    for k in range(1, n):
        total = total + words[k : len(words) - n + 1 + k] * _MULT[k]
    return mix(total)


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct n-word shingles; the whole sequence as one if it has fewer words."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    if len(words) < n:
        return ngrams(words, len(words)) + np.uint64(len(words))
    found = np.sort(ngrams(words, n))
    return found[np.append(True, found[1:] != found[:-1])]
