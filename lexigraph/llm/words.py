"""Words of UTF-8 bytes by a vectorised byte automaton, and their CRC32s, all advanced at once.

A class table says of each byte whether a word goes on with it; words start and end where the class differs from that
of the byte before.  The CRC32 of many words is a table-driven automaton too: its states are stepped together, one byte
of every word that isn't over, so the number of numpy passes is the length of the longest word.  What few words are
left after `_ALONE` bytes are finished one by one.
"""

from __future__ import annotations

import zlib

import numpy as np

from .shingles import mix64, powers

_ALONE, _FEW = 64, 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _crc_table() -> np.ndarray:
    """Where each byte takes the automaton of the reflected polynomial 0xEDB88320."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


CRC = _crc_table()
LOWER = np.arange(256, dtype=np.uint8)  # A-Z to a-z
LOWER[65:91] += 32
SPACE = 32


def joined(texts: list[bytes | None], pad: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased bytes of texts with `pad` spaces after each, and where each text starts; one more start ends them."""
    block = np.frombuffer((b" " * pad).join([t or b"" for t in texts]) + b" " * pad, dtype=np.uint8)
    return LOWER[block], np.cumsum([0] + [len(t or b"") + pad for t in texts])


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    return edge[0::2], edge[1::2]


def advance(state: np.ndarray, block: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """States of CRC automata after the bytes from starts to ends; a fresh automaton has 0xFFFFFFFF, and a CRC is the
    state's complement."""
    if not len(starts):
        return state.astype(np.uint32)
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    at, lengths, state = starts[order], lengths[order], state[order].astype(np.uint32)
    left = len(at) - np.cumsum(np.bincount(lengths))  # how many are longer than 0, 1, 2 ...
    for k in range(lengths[0]):
        m = left[k]
        if k >= _ALONE and m <= _FEW:
            for i in range(m):
                rest = block[at[i] + k : at[i] + lengths[i]].tobytes()
                state[i] = zlib.crc32(rest, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
            break
        state[:m] = CRC[(state[:m] ^ block[at[:m] + k]) & np.uint32(255)] ^ (state[:m] >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state
    return out


def hashes(block: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from starts to ends, from one wrapping cumulative sum over the block."""
    total = np.zeros(len(block) + 1, dtype=np.uint64)
    np.cumsum((block + np.uint64(1)) * powers(_BASE, len(block)), out=total[1:])
    return mix64((total[ends] - total[starts]) * powers(_INVERSE, len(block))[starts] + (ends - starts).astype(np.uint64))
