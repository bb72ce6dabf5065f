"""Vectorised word shingles: 64-bit hashes of every run of five words of many texts at once.

A word is a run of bytes other than space and 0x09-0x0D, after A-Z are lower-cased.  A text's set
holds the hashes of its distinct five-word shingles; a text with one to four words has a single
shingle, the whole word sequence; a null text, or one without words, has the empty set.

Word hashes come from one wrapping cumulative sum of byte * base**position over the whole block,
so the work is a fixed number of numpy passes however many words there are.  A shingle mixes five
word hashes with distinct odd multipliers; two different shingles of the same pair of texts meet
with probability about 2**-64.
"""

from __future__ import annotations

import numpy as np

from .common import caches

_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
_powers: dict[int, np.ndarray] = caches.setdefault("powers", {})


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, cached and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, dtype=np.uint64)
        while len(have) < n:
            step = np.uint64(pow(base, len(have), 1 << 64))
            have = np.concatenate([have, have * step])
        _powers[base] = have
    return have[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, in order, and the number of words of each text."""
    block = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = _SPACE[block]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(block) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    total = np.zeros(len(block) + 1, dtype=np.uint64)
    np.cumsum((_FOLD[block] + np.uint64(1)) * powers(_BASE, len(block)), out=total[1:])
    hashes = mix64((total[ends] - total[starts]) * powers(_INVERSE, len(block))[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, bounds))


def shingle_sets(texts: list[bytes | None], width: int = 5, block_bytes: int = 1 << 18):
    """Yields, for each text in order, its sorted distinct shingle hashes (uint64)."""
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end] or b"") <= block_bytes):
            held += len(texts[end] or b"")
            end += 1
        words, counts = word_hashes([t or b"" for t in texts[at:end]])
        runs = np.zeros(max(len(words), 1), dtype=np.uint64)
        n = len(words) - width + 1
        if n > 0:
            for k in range(width):
                runs[:n] += words[k : k + n] * _MIX[k % 5] + np.uint64(k)
            runs[:n] = mix64(runs[:n])
        first = 0
        for c in counts.tolist():
            if c >= width:
                yield np.unique(runs[first : first + c - width + 1])
            elif c:
                short = np.uint64(c)
                for k in range(c):
                    short = mix64(np.array([short * np.uint64(31) + words[first + k] * _MIX[k]], dtype=np.uint64))[0]
                yield np.array([short], dtype=np.uint64)
            else:
                yield np.empty(0, dtype=np.uint64)
            first += c
        at = end
