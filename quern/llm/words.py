"""Words as the corpus operators take them: runs of bytes without ASCII white space, A-Z lower-cased."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words that a worker remembers the hash of before it starts anew.
MEMO = 1 << 17


class Hashes(dict):
    """64-bit hashes of words, computed once each."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words of a whole text, in order; bytes.split() parts at exactly x20 and x09-x0D."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ordered pairs."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ ((b + np.uint64(0x7F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))
