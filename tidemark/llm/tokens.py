"""Words of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {1: np.ones(1, U64), -1: np.ones(1, U64)}


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of a well-known hash family)."""
    h = h + U64((seed * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & (2**64 - 1))
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def powers(n: int, sign: int = 1) -> np.ndarray:
    """At least ``n`` powers of the base, or with ``sign`` -1 of its inverse."""
    held = _powers[sign]
    if len(held) < n:
        steps = np.full(max(n, 2 * len(held)), U64(_BASE if sign > 0 else _INVERSE))
        steps[0] = 1
        held = _powers[sign] = np.cumprod(steps, dtype=U64)
    return held


def word_hashes(raw: bytes, is_space: np.ndarray = SPACE, slice_bytes: int = 1 << 18) -> np.ndarray:
    """Hashes of the words (runs of bytes that are no space) of one buffer, in order."""
    return split_hashes(raw, is_space, slice_bytes)[0]


def split_hashes(raw: bytes, is_space: np.ndarray = SPACE, slice_bytes: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word. Long buffers are cut between words, so work space stays bounded."""
    found, places, at = [], [], 0
    buf = np.frombuffer(raw, np.uint8)
    while at < len(buf):
        end = min(len(buf), at + slice_bytes)
        while end < len(buf):
            for back in (4096, slice_bytes):  # most words are short
                first = max(at, end - back)
                gaps = np.flatnonzero(is_space[buf[first:end]])
                if len(gaps):
                    break
            if len(gaps):
                end = first + int(gaps[-1]) + 1
                break
            end = min(len(buf), end + slice_bytes)
        h, s = _slice_hashes(buf[at:end], is_space)
        found.append(h)
        places.append(s + at)
        at = end
    if not found:
        return np.empty(0, U64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(places)


def _slice_hashes(buf: np.ndarray, is_space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of (byte + 1) * base ** place over each word: differences of running sums, moved back to place 0 by the inverse."""
    padded = np.ones(len(buf) + 2, np.uint8)
    padded[1:-1] = np.frombuffer(buf.tobytes().translate(is_space.astype(np.uint8).tobytes()), np.uint8)
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, U64), np.empty(0, np.int64)
    sums = np.zeros(len(buf) + 1, U64)
    np.add(buf, U64(1), out=sums[1:], dtype=U64)
    sums[1:] *= powers(len(buf))[: len(buf)]
    np.cumsum(sums, out=sums)
    return mix((sums[ends] - sums[starts]) * powers(len(buf), -1)[starts] + (ends - starts).astype(U64)), starts


def text_word_hashes(texts: list[bytes], is_space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, offsets): words of text i are offsets[i]:offsets[i + 1]."""
    joined = b"\n".join(texts)
    hashes, places = split_hashes(joined, is_space)
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(places, first)


def window_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    factor = U64((_BASE * (2 * seed + 3)) & (2**64 - 1) | 1)
    out = words[:n].copy()
    for i in range(1, k):
        out *= factor
        out += words[i : n + i]
    return mix(out, seed + k)
