"""Helpers that run inside tasks: words as bytes, and a bounded cache for what is asked again and again."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import xxhash

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Lower case, and every ASCII character that is neither letter nor digit becomes a blank.
ALNUM = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER)


def spaced_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; none for null."""
    return [] if text is None else text.encode("utf-8", "replace").translate(LOWER).split()


def plain_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case."""
    return [] if text is None else text.encode("utf-8", "replace").translate(ALNUM).split()


class RecentCache(dict):
    """Results of ``make`` by key. At most two generations of ``size`` entries; what is used again moves on."""

    def __init__(self, make: Callable, size: int = 300_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def word_hashes() -> RecentCache:
    # A hash costs little more than a lookup: what seldom comes again is not worth its memory.
    return RecentCache(xxhash.xxh64_intdigest, 50_000)


def hashed(words: list[bytes], cache: RecentCache) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# Fixed value: the characters beyond ASCII with the property White_Space.
BEYOND = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANKS = f"\\t-\\r {BEYOND}"
RUNS = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")


def plain_chunks(text: str) -> list[str] | None:
    """A text whose only white space is single blanks and line feeds between visible characters, cut before each: blanks
    are left out, line feeds open their chunk. ``None`` for other texts."""
    if len(text.split()) != text.count(" ") + text.count("\n") + 1:
        return None
    return text.replace("\n", " \n").split(" ")
