"""64-bit codes of words and word shingles, computed per text with numpy."""

from __future__ import annotations

import functools

import numpy as np

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))
_SOLID = bytes(b not in (9, 10, 11, 12, 13, 32) for b in range(256))  # for bytes.translate
_BYTE = np.random.default_rng(20240501).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    for _ in range(2):
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)])


@functools.lru_cache(maxsize=8)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_B, n), _powers(_B_INVERSE, n)


def word_codes(text: str | None, lower: bool = True) -> np.ndarray:
    """One code per word, equal for equal words (A-Z lower-cased unless ``lower`` is off).

    A word's code is a polynomial over its bytes, taken from prefix sums of
    the whole text, so the cost is a few array passes and does not depend on
    the number of words. The codes are the same in every process.
    """
    if not text:
        return np.zeros(0, np.uint64)
    raw = text.encode()
    if lower:
        raw = raw.lower()
    solid = np.frombuffer((b" " + raw + b" ").translate(_SOLID), np.uint8)
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _tables(1 << max(12, len(raw).bit_length()))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    body = sums[1:]
    np.take(_BYTE, np.frombuffer(raw, np.uint8), out=body, mode="clip")
    np.multiply(body, up[:len(raw)], out=body)
    np.cumsum(body, out=body)
    body = (sums[ends] - sums[starts]) * down[starts]
    return mixed(body + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def shingle_codes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """One code per run of ``size`` words; a text of fewer words is one shingle, one without words none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = out * np.uint64(0x9FB21C651E98DF25) + words[k:n + k]
    return mixed(out)


def occurrence_labelled(codes: np.ndarray) -> np.ndarray:
    """The codes with the how-manieth occurrence of its value worked into each, so that all differ."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    at = np.arange(len(codes))
    turn = at - np.maximum.accumulate(np.where(first, at, 0))
    label = np.empty(len(codes), np.uint64)
    label[order] = turn.astype(np.uint64)
    return mixed(codes + label * np.uint64(0xA0761D6478BD642F))


def first_occurrences(codes: np.ndarray) -> np.ndarray:
    """The distinct codes in order of their first place."""
    values, places = np.unique(codes, return_index=True)
    return codes[np.sort(places)]
