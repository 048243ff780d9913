"""Words and shingles of whole texts as 64-bit hashes, computed with numpy over the bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_SLOT = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8_pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about PIECE bytes; a longer text is a run of its own. Nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + PIECE, "right")) - 1)
        to = min(to, len(column))
        yield at, raw[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def word_spans(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes other than 9..13 and 32) and, for each row, where its words begin."""
    solid = ~_SPACE[raw]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = offs[:-1][offs[:-1] < offs[1:]]
    begins[heads] |= solid[heads]
    starts = np.flatnonzero(begins)
    n = np.diff(np.append(np.flatnonzero(begins[solid]), solid.sum()))
    return starts, starts + n, np.searchsorted(starts, offs)


def hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each of the given runs of bytes, none of them empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = ends - starts
    first = np.cumsum(n) - n
    pos = np.arange(int(n.sum())) - np.repeat(first, n)
    power = np.full(int(n.max()) + 1, _BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    return mix(np.add.reduceat(_BYTE[raw[np.repeat(starts, n) + pos]] * power[pos], first))


def word_hashes(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and, for each row, where its words begin."""
    starts, ends, bounds = word_spans(raw, offs)
    return hashed(_LOWER[raw], starts, ends), bounds


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles; a text of fewer words is one shingle, an empty one none."""
    for _, raw, offs in utf8_pieces(column):
        words, bounds = word_hashes(raw, offs)
        grams = np.zeros(max(0, len(words) - k + 1), np.uint64)
        for j in range(k):
            grams += words[j : j + len(grams)] * _SLOT[j]
        grams = mix(grams)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo >= k:
                yield np.unique(grams[lo : hi - k + 1])
            elif hi > lo:
                yield mix(np.array([(words[lo:hi] * _SLOT[: hi - lo]).sum() + _SLOT[63 - (hi - lo)]], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
