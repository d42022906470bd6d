"""Words of many texts at once: bytes to runs and 64-bit hashes, without a loop per word.

A word is a run of ASCII letters and bytes beyond ASCII, of digits, or of signs; white
space and control characters separate. A run's hash is a polynomial over its bytes,
taken from prefix sums, so its cost does not depend on the number of runs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

LETTER, DIGIT, SIGN = 1, 2, 3


def _classes() -> np.ndarray:
    out = np.full(256, SIGN, np.uint8)
    out[:33] = 0
    out[127] = 0
    out[ord("0") : ord("9") + 1] = DIGIT
    for lo, hi in (("A", "Z"), ("a", "z")):
        out[ord(lo) : ord(hi) + 1] = LETTER
    out[128:] = LETTER
    return out


CLASS = _classes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (BASE, INVERSE):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all its bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """Runs in the order of the texts. ``start`` and ``stop`` are places in ``raw``."""

    raw: np.ndarray
    text_start: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    kind: np.ndarray
    hash: np.ndarray
    _prefix: np.ndarray

    def stem(self, size: int) -> np.ndarray:
        """Hash of each run's first ``size`` bytes, apart from those of whole runs."""
        stop = np.minimum(self.start + size, self.stop)
        inverse = _powers(_room(len(self.raw)))[1]
        return mix((self._prefix[stop] - self._prefix[self.start]) * inverse[self.start] + np.uint64(size))


def _room(size: int) -> int:
    """Table sizes in steps, so that few tables are made."""
    return max(1 << 21, 1 << int(size).bit_length())


def split(texts: list[bytes], lower: bool = False) -> Words:
    # A separator after every text keeps runs from crossing into the next.
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    text_start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    if lower:
        raw = LOWER[raw]
    kind = CLASS[raw]
    change = np.flatnonzero(np.diff(kind)) + 1
    start = np.concatenate([[0], change])
    stop = np.concatenate([change, [len(raw)]])
    real = kind[start] > 0
    start, stop = start[real], stop[real]
    power, inverse = _powers(_room(len(raw)))
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=prefix[1:])
    value = mix((prefix[stop] - prefix[start]) * inverse[start])
    owner = np.searchsorted(text_start, start, side="right") - 1
    return Words(raw, text_start, owner, start, stop, kind[start], value, prefix)
