"""Hashed word shingles of texts, computed over the bytes of many texts at once."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(0, 1 << 60)) * 8 + 5
_PLACE = [np.uint64(int(x) * 2 + 1) for x in _RNG.integers(0, 1 << 63, 64)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


@cache
def _powers(bits: int) -> np.ndarray:
    up = np.full(1 << bits, _BASE, np.uint64)
    up[0] = 1
    return np.cumprod(up, dtype=np.uint64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes end to end, and the places where each begins (one more at the end). Null is empty."""
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    filled = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset:filled.offset + len(filled) + 1]
    body = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.empty(0, np.uint8)
    return body, at - at[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the number of words before it (one more at the end). A word is a
    run of characters other than ASCII white space, with A-Z lower-cased."""
    body, at = text_bytes(texts)
    if len(body) == 0:
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    white = _WHITE[body]
    edge = np.empty(len(body) + 1, bool)   # a word cannot go on here
    edge[1:-1] = white[1:] != white[:-1]
    edge[0] = edge[-1] = True
    edge[at] = True
    cut = np.flatnonzero(edge)
    length = np.diff(cut)
    inside = np.arange(len(body)) - np.repeat(cut[:-1], length)
    value = _BYTE[_LOWER[body]] * _powers(int(length.max()).bit_length())[inside]
    word = ~white[cut[:-1]]
    return mix(np.add.reduceat(value, cut[:-1])[word]), np.searchsorted(cut[:-1][word], at)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """For each text its distinct shingles of `width` words as sorted 64-bit hashes. With fewer words, the whole
    sequence is the only shingle; without words there is none."""
    words, at = word_hashes(texts)
    wide = np.empty(0, np.uint64)
    if len(words) >= width:
        wide = words[:len(words) - width + 1] * _PLACE[0]
        for k in range(1, width):
            wide = wide + words[k:len(words) - width + 1 + k] * _PLACE[k]
        wide = mix(wide)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(wide[a:b - width + 1]))
        elif b == a:
            out.append(np.empty(0, np.uint64))
        else:
            whole = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                whole = mix(whole * _PLACE[63] + words[k:k + 1])
            out.append(whole)
    return out
