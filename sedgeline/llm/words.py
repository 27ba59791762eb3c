"""Words, shingles and their hashes, in batches of texts."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import xxhash

#: A longest run of Unicode letters or digits.
WORD = re.compile(r"[^\W_]+")

_CACHE: dict[str, int] = {}
_CACHE_WORDS = 500_000


def word_hash(word: str) -> int:
    """64-bit hash of a word."""
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


_ASCII = bytes(i if chr(i).isalnum() and i < 128 else 32 for i in range(256))


# Frequent signs outside ASCII that are no part of words.
_SIGNS = "€–—’‘“”•"


def words_of(text: str) -> list[str]:
    """The words of a text, in lower case."""
    if not text.isascii():
        for sign in _SIGNS:
            if sign in text:
                text = text.replace(sign, " ")
    if text.isascii():  # the same words, by a table instead of an expression
        return text.lower().encode().translate(_ASCII).decode().split()
    return WORD.findall(text.lower())


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalising mix, element by element."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def hashed_batch(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in a row, and the number of words of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    if len(_CACHE) > _CACHE_WORDS:  # a worker remembers the words it meets, up to a bound
        _CACHE.clear()
    flat = list(chain.from_iterable(texts))
    for w in set(flat).difference(_CACHE):
        _CACHE[w] = word_hash(w)
    return np.fromiter(map(_CACHE.__getitem__, flat), np.uint64, len(flat)), lengths


def shingle_hashes(flat: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words within each text, and their number per text (repeats included)."""
    counts = np.maximum(lengths - size + 1, 0)
    n = max(len(flat) - size + 1, 0)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + flat[k : n + k]
        h = mixed(h)
    text = np.repeat(np.arange(len(lengths)), lengths)[:n]
    ends = np.cumsum(lengths)
    inside = np.arange(n) + size <= ends[text] if n else np.zeros(0, bool)
    return h[inside], counts
