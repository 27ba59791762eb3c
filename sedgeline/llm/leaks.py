"""Held-out passages inside corpus documents, by greedy string tiling.

Runs of `seed` words of the items are hashed; a document's rolling hashes are matched
against them (shared-token seeds). The seeds that a document shares with an item cover a part of the item, which
no tiling can exceed: pairs whose cover reaches neither the longest run nor the share that make a leak go no further.
The others are tiled: the longest common runs of
unmarked words are marked again and again (running Karp-Rabin: runs of length s are found by
equal rolling hashes and extended word by word, with s falling), until none of `seed`
words is left. A leak is an item of which one tile has `longest` words, or whose tiles cover the share `coverage` of it: so
a passage that is cut up or reordered is found as well.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedgeline.llm.words import hashed_batch, shingle_hashes, word_hash, words_of
from sedgeline.runtime import bounded_rows


@dataclass(frozen=True)
class Leaks:
    """seed: words of a seed, and least words of a tile. longest, coverage: the words of one tile, or the share
    of the item's words in tiles, that make a leak. block_words: words of items held in a task at once (an item is
    never parted); more are searched in further passes."""

    seed: int = 5
    longest: int = 10
    coverage: float = 0.5
    block_words: int = 2_000_000


def tiles(item: list[int], doc: list[int], shortest: int, longest_first: int = 64) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: (start in item, start in document, length).

    In each round the longest runs of unmarked words common to both are marked, in order of
    their start in the item, then in the document. Marked words take part in no other tile.
    """
    free_i, free_d = [True] * len(item), [True] * len(doc)
    out: list[tuple[int, int, int]] = []
    s = max(shortest, min(longest_first, len(item), len(doc)))
    while True:
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)
        longest, again = 0, False
        for i, j in _equal_runs(item, free_i, doc, free_d, s):
            k = s
            while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and free_i[i + k] and free_d[j + k]:
                k += 1
            if k > 2 * s:
                s, again = k, True
                break
            found[k].append((i, j))
            longest = max(longest, k)
        if again:
            continue
        for k in sorted(found, reverse=True):
            for i, j in found[k]:
                if all(free_i[i : i + k]) and all(free_d[j : j + k]):
                    out.append((i, j, k))
                    free_i[i : i + k] = [False] * k
                    free_d[j : j + k] = [False] * k
        if s > 2 * shortest:
            s //= 2
        elif s > shortest:
            s = shortest
        elif not any(all(free_i[i : i + s]) and all(free_d[j : j + s]) for k in found for i, j in found[k]):
            return out


def _rolled(words: list[int], free: list[bool], s: int) -> Iterator[tuple[int, int]]:
    """(hash, start) of each run of s free words."""
    mod, base = (1 << 61) - 1, 1_000_003
    top, h, n = pow(base, s - 1, mod), 0, 0
    for k, w in enumerate(words):
        if not free[k]:
            h = n = 0
            continue
        if n == s:
            h = (h - words[k - s] * top) % mod
            n -= 1
        h = (h * base + w) % mod
        n += 1
        if n == s:
            yield h, k - s + 1


def _equal_runs(item, free_i, doc, free_d, s: int) -> list[tuple[int, int]]:
    at = defaultdict(list)
    for h, j in _rolled(doc, free_d, s):
        at[h].append(j)
    return [(i, j) for h, i in _rolled(item, free_i, s) for j in at.get(h, ()) if item[i : i + s] == doc[j : j + s]]


def _blocks(items: list[tuple[int, list[int]]], most: int) -> Iterator[list[tuple[int, list[int]]]]:
    """Items in blocks of about so many words."""
    block, held = [], 0
    for item in items:
        if block and held + len(item[1]) > most:
            yield block
            block, held = [], 0
        block.append(item)
        held += len(item[1])
    yield block


def leaked_items(documents: DataFrame, items: DataFrame, p: Leaks = Leaks(), most_items: int = 1_000_000) -> DataFrame:
    """doc_id, item_id, longest (words in one piece), coverage (share of the item's words in tiles).

    documents: doc_id, text; items: item_id, text. Words are runs of letters or digits in
    lower case, so breaks and punctuation do not count. Items and texts that are null or
    shorter than the seed match nothing; equal rows give one row; other columns are ignored. Items are a stated query
    set: they are searched in blocks against all documents, whole texts, without a cap.
    """
    rows = bounded_rows(items.select("item_id", "text").filter("item_id is not null and text is not null").distinct(), most_items, "test items")
    hashed = [(i, [word_hash(w) for w in words_of(t)]) for i, t in sorted((r[0], r[1]) for r in rows)]
    schema = "doc_id long, item_id long, longest int, coverage double"
    out = None
    for block in _blocks([x for x in hashed if len(x[1]) >= p.seed], p.block_words):
        flat, lengths = np.array([w for _, x in block for w in x], np.uint64), np.array([len(x) for _, x in block], np.int64)
        seeds, counts = shingle_hashes(flat, lengths, p.seed)
        owner = np.repeat(np.arange(len(block)), counts)
        position = np.arange(len(seeds)) - np.repeat(np.cumsum(counts) - counts, counts)
        order = np.argsort(seeds, kind="stable")
        shared = documents.sparkSession.sparkContext.broadcast((block, seeds[order], owner[order], position[order]))
        found = documents.select("doc_id", "text").mapInPandas(lambda batches, shared=shared: _search(batches, shared.value, p), schema)
        out = found if out is None else out.unionByName(found)
    return out.filter("doc_id is not null").groupBy("doc_id", "item_id").agg(F.max("longest").alias("longest"), F.max("coverage").alias("coverage"))


def covered(position: np.ndarray, new: np.ndarray, size: int) -> np.ndarray:
    """Words covered by runs of `size` words at rising positions; new marks the first of each group. One number per group."""
    gap = np.full(len(position), size, np.int64)
    gap[:-1] = np.where(new[1:], size, np.minimum(size, np.diff(position)))
    return np.add.reduceat(gap, np.flatnonzero(new)) if len(position) else np.zeros(0, np.int64)


def _search(batches: Iterator[pd.DataFrame], shared, p: Leaks) -> Iterator[pd.DataFrame]:
    block, seeds, owner, position = shared
    length = np.array([len(x) for _, x in block], np.int64)
    enough = np.minimum(p.longest, np.ceil(p.coverage * length - 1e-9)).astype(np.int64)
    for b in batches:
        texts = [words_of(t) if isinstance(t, str) else [] for t in b["text"]]
        flat, lengths = hashed_batch(texts)
        h, counts = shingle_hashes(flat, lengths, p.seed)
        out = []
        if len(seeds) and len(h):
            low = np.searchsorted(seeds, h)
            hit = np.flatnonzero(seeds[np.minimum(low, len(seeds) - 1)] == h)
            times = np.searchsorted(seeds, h[hit], "right") - low[hit]
            at = np.repeat(low[hit] - (np.cumsum(times) - times), times) + np.arange(times.sum())  # every equal seed of every item
            where = np.repeat(hit, times)
            doc = np.searchsorted(np.cumsum(counts), where, "right")
            order = np.lexsort((position[at], owner[at], doc))
            doc, item, pos, where = doc[order], owner[at][order], position[at][order], where[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
            starts = np.flatnonzero(new)
            good = np.flatnonzero(covered(pos, new, p.seed) >= enough[item[starts]]) if len(starts) else []
            stops, text_at, shift = np.append(starts[1:], len(doc)), np.cumsum(lengths) - lengths, np.cumsum(counts) - counts
            for g in good:
                a, d = starts[g], int(doc[starts[g]])
                item_id, words = block[item[a]]
                spots = np.unique(where[a : stops[g]]) - shift[d]
                got = tiles(words, _around(flat[text_at[d] : text_at[d] + lengths[d]], spots, p.seed), p.seed)
                longest, share = max((k for _, _, k in got), default=0), sum(k for _, _, k in got) / len(words)
                if longest >= p.longest or share >= p.coverage - 1e-9:
                    out.append((b["doc_id"].iloc[d], item_id, longest, share))
        yield pd.DataFrame(out, columns=["doc_id", "item_id", "longest", "coverage"])


def _around(words: np.ndarray, spots: np.ndarray, size: int) -> list[int]:
    """The words of a text that stand in a shared seed, runs of them parted by marks that equal no word:
    a tile is made of seeds, so the rest of the text can hold none."""
    out: list[int] = []
    cuts = np.flatnonzero(np.diff(spots) > size) + 1
    for k, run in enumerate(np.split(spots, cuts)):
        out += words[run[0] : run[-1] + size].tolist()
        out.append(-1 - k)
    return out
