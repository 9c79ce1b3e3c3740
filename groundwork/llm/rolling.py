"""Polynomial hashes modulo 2**64 over byte buffers, vectorised: any substring's hash from two prefix sums."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLANK = re.compile(rb"[\x20\x09-\x0D]")
SEGMENT = 2 << 20

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n + 1024, np.uint64(x))])) for x in (BASE, INVERSE)]
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between blanks (A-Z lower-cased) of all texts, and how many each text has."""
    buffer = b"\n".join(texts) + b"\n"
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    hashes, places = [], []
    for at, part in segments(buffer):
        data = np.frombuffer(part.lower(), np.uint8)
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
        low, high = edge[::2], edge[1::2]
        sums = prefix_sums(data)
        hashes.append(mixed((sums[high] - sums[low]) * powers(len(data))[1][low]))
        places.append(low + at)
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.diff(np.searchsorted(place, starts))


def segments(buffer: bytes) -> Iterator[tuple[int, bytes]]:
    """Parts of about SEGMENT bytes, cut at blanks only."""
    at = 0
    while at < len(buffer):
        m = BLANK.search(buffer, min(len(buffer), at + SEGMENT))
        end = m.end() if m else len(buffer)
        yield at, buffer[at:end]
        at = end
