"""Byte n-grams packed into integers, and a vectorised hash table for them."""

from __future__ import annotations

import numpy as np

from rankforge.llm.shared import mix

END = 0x0A
PAD = 0x20
_U = np.uint64


def padded(raw: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams, document): for every byte of every document and for the end
    byte after it, the ``order`` bytes that finish there.  A document is
    preceded by pad bytes."""
    n, docs = len(raw), len(off) - 1
    gap = order                                       # order - 1 pads before and one end byte after
    doc = np.repeat(np.arange(docs), np.diff(off))
    buf = np.full(n + docs * gap, PAD, dtype=np.uint8)
    buf[np.arange(n) + doc * gap + order - 1] = raw
    end = off[1:] + np.arange(docs) * gap + order - 1
    buf[end] = END
    real = np.ones(len(buf), dtype=bool)
    first = off[:-1] + np.arange(docs) * gap
    for i in range(order - 1):
        real[first + i] = False
    key = np.zeros(len(buf), dtype=_U)
    for i in range(order):                            # byte i places back
        key[i:] |= buf[:len(buf) - i].astype(_U) << _U(8 * i)
    at = np.flatnonzero(real)
    return key[at], np.searchsorted(end, at, side="left")


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts."""
    keys = np.sort(keys)
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[new], np.diff(np.append(new, len(keys)))


class Table:
    """Values by 64-bit key; open addressing, all keys of a call probed together."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, 0, dtype=_U)
        self.used = np.zeros(1 << bits, dtype=bool)
        self.values = np.zeros(1 << bits, dtype=values.dtype)
        self.probes = 0
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            self.probes += 1
            free = left[~self.used[slot[left]]]
            _, pick = np.unique(slot[free], return_index=True)
            won = free[pick]
            self.used[slot[won]] = True
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys + _U(1)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value); the value is 0 where nothing is found."""
        slot = self._slot(keys)
        hit = (self.keys[slot] == keys) & self.used[slot]
        value = np.where(hit, self.values[slot], 0)
        left = np.flatnonzero(~hit & self.used[slot])
        for _ in range(self.probes - 1):
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & self.mask
            s = slot[left]
            ok = self.used[s] & (self.keys[s] == keys[left])
            value[left[ok]] = self.values[s[ok]]
            hit[left[ok]] = True
            left = left[~ok & self.used[s]]
        return hit, value
