"""Word spans and rolling hashes over UTF-8 bytes, vectorised with numpy.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09``-``\\x0D`` (the
class ``[^\\x20\\x09-\\x0D]+``; those bytes never occur inside a multi-byte
character). Hashes are polynomials mod 2**64 with an odd base, finished by a
mixing step, and depend on the bytes alone, so every executor agrees.
Texts are hashed in segments that end at white space, so that the scratch
arrays stay near ``SEGMENT`` bytes however long a text is.
"""

from __future__ import annotations

import numpy as np

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SEGMENT = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` mod 2**64; the longest table so far is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; different seeds give independent-looking hashes."""
    h = h + np.uint64((seed * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans(data: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are no separators."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~separators[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _segments(data: np.ndarray, separators: np.ndarray):
    at = 0
    while at < len(data):
        end = at + SEGMENT
        while end < len(data):  # go on to the next separator
            gap = np.flatnonzero(separators[data[end:end + SEGMENT]])
            if len(gap):
                end += int(gap[0])
                break
            end += SEGMENT
        yield at, data[at:end]
        at = end


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``data[start:end]`` for each run."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(_INVERSE, len(data) + 1)[starts])


def word_hashes(text: bytes, separators: np.ndarray = SPACES) -> np.ndarray:
    """One hash per word, in order."""
    data = np.frombuffer(text, dtype=np.uint8)
    parts = []
    for _, segment in _segments(data, separators):
        starts, ends = spans(segment, separators)
        if len(starts):
            parts.append(run_hashes(segment, starts, ends))
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of ``words[i:i+size]`` for every i; empty when there are fewer words."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(mix(words, seed) * powers(_BASE, len(words)), out=total[1:])
    n = len(words) - size + 1
    return mix((total[size:] - total[:n]) * powers(_INVERSE, n), seed)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Windows of ``size`` words; a shorter text that has words is one shingle."""
    if 0 < len(words) < size:
        return window_hashes(words, len(words), seed=len(words))
    return window_hashes(words, size)
