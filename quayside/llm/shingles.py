"""Word shingles of batches of texts, in numpy."""

from __future__ import annotations

import numpy as np

from quayside.llm.common import mix

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))  # a value for each byte
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True  # fixed: blank and the controls 09 to 0D


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts data[offsets[i]:offsets[i + 1]], A-Z
    taken as a-z, and the bounds of each text among the words."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    data = np.frombuffer(data.tobytes().lower(), np.uint8)  # bytes: only A-Z have a lower case
    inside = ~_SEPARATOR[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    starts = np.flatnonzero(inside & (begins[:-1] | np.concatenate([[True], ~inside[:-1]])))
    ends = np.flatnonzero(inside & (begins[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(data))[starts]
    return mix(value + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of one text from the hashes of its words, sorted; the
    whole sequence is one where it is shorter than ``size``."""
    n = min(size, len(hashes))
    if not n:
        return np.zeros(0, np.uint64)
    width = len(hashes) - n + 1
    value = np.full(width, n, np.uint64)
    for k in range(n):
        value = value * _BASE + hashes[k:k + width]
    return np.unique(mix(value))


def sequence_hashes(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each text's whole word sequence, as int64."""
    out = []
    for seed in (3, 5):
        base = mix(np.array([seed], np.uint64))[0] | np.uint64(1)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes + np.uint64(seed)) * powers(base, len(hashes)), out=sums[1:])
        back = powers(np.uint64(pow(int(base), -1, 1 << 64)), len(hashes) + 1)
        value = (sums[bounds[1:]] - sums[bounds[:-1]]) * back[bounds[:-1]]
        out.append(mix(value + np.diff(bounds).astype(np.uint64)).view(np.int64))
    return out[0], out[1]
