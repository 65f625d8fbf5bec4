"""Words and word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words that a task remembers.
REMEMBERED = 100_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
FINISH = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Hash of each distinct word, worked out once; starts anew when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


HASHES = WordHashes()


def words(text: str | None) -> list[bytes]:
    """Runs of bytes other than ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * FINISH
    return x ^ (x >> np.uint64(27))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of k words; of all words, if there are fewer; none without words."""
    own = words(text)
    h = np.fromiter(map(HASHES.__getitem__, own), np.uint64, len(own))
    if not len(h):
        return h
    width = min(k, len(h))
    s = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        s = s * MULTIPLIER + h[i : len(h) - width + 1 + i]
    return np.unique(mixed(s))
