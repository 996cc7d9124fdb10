"""Vectorised word hashing shared by the word-level operators (numpy inside tasks).

A text is cut into words by a 256-entry byte class, and every word gets a 64-bit
hash: the sum of its bytes times random odd multipliers, one per position in the
word, finished by a mixing step. Windows of ``k`` words get a polynomial hash of
their word hashes. Work runs in pieces of about a megabyte that end at a word
boundary, so memory stays at 8 bytes a word plus one piece, however long a text is.
"""

from __future__ import annotations

import hashlib

import numpy as np

PIECE_BYTES = 1 << 20
#: Words up to this many bytes use one multiplier per position; longer ones are hashed by blake2b.
LONG_WORD = 1 << 12

#: ``[^\\x20\\x09-\\x0D]+``: every byte but ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased: digits, a-z and all non-ASCII bytes.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_RNG = np.random.default_rng(20240607)
_MULTIPLIERS = _RNG.integers(1, 1 << 63, LONG_WORD, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_2 = np.uint64(0xD1B54A32D192ED03)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece_spans(raw: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.empty(len(raw) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = member[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_spans(data: bytes, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of ``data``."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) <= PIECE_BYTES:
        return _piece_spans(raw, member)
    starts, ends = [], []
    for lo, hi in pieces(raw, member):
        s, e = _piece_spans(raw[lo:hi], member)
        starts.append(s + lo)
        ends.append(e + lo)
    return np.concatenate(starts), np.concatenate(ends)


def pieces(raw: np.ndarray, member: np.ndarray):
    """(from, to) cuts of about PIECE_BYTES that never split a word."""
    lo, n = 0, len(raw)
    while lo < n:
        hi = min(n, lo + PIECE_BYTES)
        while hi < n and member[raw[hi]]:
            step = raw[hi:hi + 4096]
            gap = np.flatnonzero(~member[step])
            hi += int(gap[0]) if len(gap) else len(step)
        yield lo, hi
        lo = hi


def word_hashes(data: bytes, member: np.ndarray = SPACED) -> np.ndarray:
    """The 64-bit hash of each word of ``data``, in order."""
    raw = np.frombuffer(data, np.uint8)
    parts = []
    for lo, hi in pieces(raw, member):
        piece = raw[lo:hi]
        starts, ends = _piece_spans(piece, member)
        if not len(starts):
            continue
        size = ends - starts
        at = np.repeat(starts - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
        offset = at - np.repeat(starts, size)
        value = (piece[at].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[offset & (LONG_WORD - 1)]
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        out = mix(np.add.reduceat(value, first) + size.astype(np.uint64))
        for i in np.flatnonzero(size > LONG_WORD):
            word = piece[starts[i]:ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        parts.append(out)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (empty when there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # doubling: the hash of 2m words from two hashes of m
    out, have = words, 1
    for bit in bin(k)[3:]:
        m = len(words) - 2 * have + 1
        out = out[:m] * np.uint64(pow(int(_BASE), have, 1 << 64)) + out[have:have + m]
        have *= 2
        if bit == "1":
            m = len(words) - have
            out = out[:m] * _BASE + words[have:have + m]
            have += 1
    return mix(out)


def second_hash(words: np.ndarray) -> np.ndarray:
    """Independent word values for a second window hash (128 bits together)."""
    return mix(words ^ _BASE_2)
