"""Hashed byte n-grams of texts as count vectors, shared by the classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of a text that are hashed at once.
SLICE = 1 << 20


def buckets(data: bytes, n: int, bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all byte n-grams, slice by slice."""
    for at in range(0, max(1, len(data) - n + 1), SLICE):
        a = np.frombuffer(data[at : at + SLICE + n - 1], np.uint8).astype(np.uint32)
        if len(a) < n:
            return
        h = a[: len(a) - n + 1]
        for i in range(1, n):
            h = h * np.uint32(0x9E3779B1) + a[i : len(a) - n + 1 + i]
        yield (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)


def counts(data: bytes, n: int, bits: int) -> np.ndarray:
    out = np.zeros(1 << bits, np.int64)
    for part in buckets(data, n, bits):
        out += np.bincount(part, minlength=1 << bits)
    return out
