"""Near-duplicate records by b-bit MinHash over word shingles.

1. A count-min sketch of fixed size counts all shingles of all texts. Shingles in more than
   `common_share` of the texts (and `least_common` of them) are common. A text's other shingles give
   its band keys, the more of them the greater its share of common ones, so that what the common
   ones take from the similarity of two texts costs no recall. Texts with `common_limit` or more of
   common shingles (as in a large family of variants) have keys over all their shingles besides.
2. Each key is made of `rows` minima (`full_rows` over all shingles). Keys travel to their shard
   packed: a batch's keys for a shard in rising order, by their lower bits and a bitmap of the upper ones, beside the
   upper half of each text's name. In a shard equal keys give candidate pairs. A text is named by the hash of its
   words, so any number of copies of a text is one candidate (combined per batch before the
   shuffle and again in the shard). Candidates are stored, so that the keys' shuffle files are freed before the joins;
   texts that share half a name all take part in these. Beyond `pass_texts` texts the bands are made in two passes over
   the texts, and beyond `slice_pairs` candidates a text these meet the signatures slice by slice, each of which
   frees its files before the next: a matter of disk only, the pairs are the same.
3. Candidates meet packed signatures: the lowest `bits` bits of `hashes` minima over all
   shingles. Equal bits are counted in the JVM (xor and bit_count on 64-bit words) and
   corrected for chance agreement; a margin of `deviations` standard deviations below the
   threshold is kept.
4. What is left is checked exactly on the texts.

The band keys decide recall: a pair at the threshold is found with probability
1 - (1 - threshold**rows)**bands at least, whatever part of its texts is common; more bands are
taken where needed for that. Nothing is capped or sampled.

exact=True takes the place of bands and signatures by a way that misses nothing: a prefix filter over the shingles
in the order of the sketch's counts, the rarest first, with bounds by size and position.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedgeline.llm.words import hashed_batch, mixed, shingle_hashes, words_of
from sedgeline.runtime import stored


@dataclass(frozen=True)
class NearDuplicates:
    """Parameters. The defaults are those for training texts: five words, similarity 0.8."""

    shingle: int = 5
    threshold: float = 0.8
    least_words: int = 5
    rows: int = 3
    bands: int = 36
    hashes: int = 64
    bits: int = 2
    deviations: float = 3.0
    common_share: float = 0.01
    least_common: int = 100
    common_limit: float = 0.25
    full_rows: int = 4
    sketch_rows: int = 3
    sketch_bits: int = 18
    shard_entries: int = 1_000_000
    pass_texts: int = 1_000_000
    slice_pairs: int = 12


def _multipliers(seed: int, n: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _minima(h: np.ndarray, starts: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Least 32-bit hash of each text under each multiplier; no text may be empty.

    Hashes are well mixed already, so an odd 32-bit multiplier makes a new order of them.
    """
    out = np.empty((len(multipliers), len(starts)), np.uint32)
    short, held = (h >> np.uint64(32)).astype(np.uint32), np.empty(len(h), np.uint32)
    with np.errstate(over="ignore"):
        for k, m in enumerate(multipliers):
            np.multiply(short, np.uint32(int(m) >> 32 | 1), out=held)
            np.minimum.reduceat(held, starts, out=out[k])
    return out


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.zeros(0, np.int64)


def _cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((h >> np.uint64(row * bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _texts(p: NearDuplicates, values) -> tuple[list[list[str]], np.ndarray]:
    """The words of each text that counts, and their positions in the batch."""
    words = [words_of(t) if isinstance(t, str) else [] for t in values]
    at = np.array([i for i, w in enumerate(words) if len(w) >= max(p.least_words, p.shingle)], np.int64)
    return [words[i] for i in at], at


def _class_ids(words: list[list[str]]) -> np.ndarray:
    """The 64-bit name of each text: the hash of its words."""
    return np.fromiter((xxhash.xxh64_intdigest(" ".join(w).encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words)).view(np.int64)


def _packed(counts: np.ndarray) -> bytes:
    """Counts as compressed bytes, with the bytes of equal rank side by side."""
    return zlib.compress(np.ascontiguousarray(counts.ravel().view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T).ravel().view(np.int64)


def shingle_counts(counted: DataFrame, p: NearDuplicates) -> tuple[int, np.ndarray]:
    """From the sketches among signed_and_counted(): number of texts, and the counts per sketch row and cell.

    The sketch has one size whatever the input; it is summed in a tree of tasks.
    """
    sketches = counted.filter("cells is not null").select("n", "cells")
    if sketches.isEmpty():
        return 0, np.zeros((p.sketch_rows, 1 << p.sketch_bits), np.int64)
    n, cells = sketches.rdd.map(tuple).treeReduce(lambda a, b: (a[0] + b[0], _packed(_unpacked(a[1]) + _unpacked(b[1]))), depth=3)
    return n, _unpacked(cells).reshape(p.sketch_rows, -1)


def common_shingles(n: int, counts: np.ndarray, p: NearDuplicates) -> np.ndarray:
    """Per sketch row and cell whether it counts above the share."""
    return counts > max(p.common_share * n, p.least_common)


SHARES = np.arange(0, 1.001, 0.025)


def _bands_for(p: NearDuplicates, rows: int, similarity: float) -> int:
    """Bands of so many rows that miss a pair of this similarity no oftener than p.bands of p.rows one at the threshold."""
    miss = p.bands * math.log1p(-min(p.threshold, 1 - 1e-9) ** p.rows)
    return math.ceil(miss / math.log1p(-min(similarity, 1 - 1e-9) ** rows) - 1e-9)


def _needed_bands(p: NearDuplicates) -> np.ndarray:
    """Per step of SHARES, up to common_limit: the bands over rare shingles for a text with at most that share of common ones.

    Two texts share at most a part x of their union in common shingles, x the lesser of their shares, so a
    pair at the threshold t has rare sets of similarity (t - x) / (1 - x) at least.
    """
    x = np.minimum(SHARES, p.common_limit)
    return np.array([_bands_for(p, p.rows, (p.threshold - v) / (1 - v)) for v in x])


def _distinct_counts(h: np.ndarray, text: np.ndarray, rare: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of each text, and how many of them are rare: by sorting one number per shingle, of its
    text (24 bits, more than a batch holds), its hash (39 bits) and whether it is rare."""
    x = np.sort((text.astype(np.uint64) << np.uint64(40)) | ((h >> np.uint64(25)) << np.uint64(1)) | rare.astype(np.uint64))
    x = x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x
    of = (x >> np.uint64(40)).astype(np.int64)
    return np.bincount(of, minlength=n), np.bincount(of, weights=(x & np.uint64(1)).astype(float), minlength=n).astype(np.int64)


def _band_keys(h: np.ndarray, text: np.ndarray, rows: int, bands: range, multipliers: np.ndarray) -> np.ndarray:
    """Keys (band by text) of the texts whose shingles are given; text rises."""
    minima = _minima(h, np.flatnonzero(np.diff(text, prepend=-1)), multipliers).astype(np.uint64)
    keys = np.empty((len(bands), minima.shape[1]), np.uint64)
    with np.errstate(over="ignore"):
        for i, k in enumerate(bands):
            x = np.full(minima.shape[1], k + 1, np.uint64)
            for r in range(rows):
                x = mixed(x * np.uint64(0x9E3779B97F4A7C15) + minima[i * rows + r])
            keys[i] = x
    return keys


def half_name(name: str) -> Column:
    """The upper 32 bits of a text's name."""
    return F.shiftrightunsigned(name, 32)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Rising 32-bit keys: the number of lower bytes, these of each key, and a bitmap in which the upper part of key i sets bit i plus that part."""
    low = min((1, 2, 3), key=lambda k: 8 * k * len(keys) + (1 << (32 - 8 * k)))
    bits = np.zeros(len(keys) + (1 << (32 - 8 * low)), np.uint8)
    bits[(keys >> np.uint32(8 * low)).astype(np.int64) + np.arange(len(keys))] = 1
    return bytes([low]) + keys.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :low].tobytes() + np.packbits(bits).tobytes()


def _rising_keys(data: bytes, n: int) -> np.ndarray:
    """The n keys of _packed_keys()."""
    low = data[0]
    out = np.zeros((n, 4), np.uint8)
    out[:, :low] = np.frombuffer(data, np.uint8, n * low, 1).reshape(n, low)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, -1, 1 + n * low))) - np.arange(n)
    return out.view("<u4").ravel() | (high.astype(np.uint32) << np.uint32(8 * low))


def _entries_by_shard(keys: np.ndarray, texts: np.ndarray, names: np.ndarray, shards: int) -> pa.RecordBatch:
    """One row per shard (16 bits at most) with the keys that fall to it and the names of their texts (positions in names).

    Sorted as one number per entry, of its shard, its key and its text, so far as a text's position has 16 bits.
    """
    shard = (keys >> np.uint64(32)) % np.uint64(shards)
    where = shard << np.uint64(32) | keys & np.uint64(0xFFFFFFFF)
    if len(names) <= 1 << 16:
        x = np.sort(where << np.uint64(16) | texts.astype(np.uint64))
        where, texts = x >> np.uint64(16), (x & np.uint64(0xFFFF)).astype(np.int64)
    else:
        order = np.argsort(where)
        where, texts = where[order], texts[order]
    cuts = np.searchsorted(where, np.arange(shards + 1, dtype=np.uint64) << np.uint64(32))
    keys, ents = (where & np.uint64(0xFFFFFFFF)).astype(np.uint32), names[texts]
    full = [s for s in range(shards) if cuts[s] < cuts[s + 1]]
    return pa.RecordBatch.from_pydict({"shard": full, "keys": [_packed_keys(keys[cuts[s] : cuts[s + 1]]) for s in full], "ents": [ents[cuts[s] : cuts[s + 1]].tobytes() for s in full]})


def candidate_pairs(texts: DataFrame, p: NearDuplicates, n: int, common: np.ndarray) -> DataFrame:
    """Pairs of half names (a < b, see half_name()) that share a band key; a pair may occur once per shard."""
    passes = 1 if n <= p.pass_texts else 2
    shards = min(max(1, math.ceil(n * p.bands / p.shard_entries / passes)), 1 << 16)
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(common))
    needed = _needed_bands(p)
    levels = [int(x) for x in np.unique(needed)]
    full_bands = _bands_for(p, p.full_rows, p.threshold)
    multipliers, full_multipliers = _multipliers(11, p.rows * levels[-1]).reshape(-1, p.rows), _multipliers(37, p.full_rows * full_bands).reshape(-1, p.full_rows)

    def entries(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        hot = np.unpackbits(shared.value).astype(bool).reshape(common_shape)
        for b in batches:
            words, _ = _texts(p, b["text"].to_pylist())
            if not words:
                continue
            names, first = np.unique(_class_ids(words), return_index=True)
            words = [words[i] for i in first]
            h, counts = shingle_hashes(*hashed_batch(words), p.shingle)
            text = np.repeat(np.arange(len(words)), counts)
            rare = ~np.logical_and.reduce([hot[r][_cells(h, r, p.sketch_bits)] for r in range(p.sketch_rows)])
            n_all, n_rare = _distinct_counts(h, text, rare, len(words))
            share = 1 - n_rare / n_all
            wanted = np.where(n_rare > 0, needed[np.searchsorted(SHARES, np.minimum(share, p.common_limit))], 0)
            got_keys, got_texts = [], []
            for low, high in zip([0, *levels], levels):
                chosen, bands = wanted >= high, range(low + (turn - low) % passes, high, passes)
                if chosen.any() and bands:
                    got_keys.append(_band_keys(h[rare & chosen[text]], text[rare & chosen[text]], p.rows, bands, multipliers[bands].ravel()).ravel())
                    got_texts.append(np.tile(np.flatnonzero(chosen), len(bands)))
            chosen, bands = share >= p.common_limit, range(turn, full_bands, passes)
            if chosen.any() and bands:
                got_keys.append(_band_keys(h[chosen[text]], text[chosen[text]], p.full_rows, [100_000 + k for k in bands], full_multipliers[bands].ravel()).ravel())
                got_texts.append(np.tile(np.flatnonzero(chosen), len(bands)))
            if not got_keys:
                continue
            yield _entries_by_shard(np.concatenate(got_keys), np.concatenate(got_texts), (names.view(np.uint64) >> np.uint64(32)).astype(np.uint32), shards)

    common_shape = common.shape

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for b in batches:
            for s, k, e in zip(b["shard"], b["keys"], b["ents"]):
                held.setdefault(s, []).append((k, e))
        for s in list(held):
            got = held.pop(s)
            keys = np.concatenate([_rising_keys(k, len(e) // 4) for k, e in got])
            ents = np.frombuffer(b"".join(e for _, e in got), np.uint32)
            for x in _pairs_of_shard(keys, ents.astype(np.int64)):
                yield pd.DataFrame({"pair": x["a"].to_numpy() << 32 | x["b"].to_numpy()})

    packed = [texts.select("text").mapInArrow(partial(entries, turn=i), "shard long, keys binary, ents binary") for i in range(passes)]
    found = reduce(DataFrame.union, [stored(x.repartition(shards, "shard").mapInPandas(pairs, "pair long"), free=True) for x in packed])
    return found.select(F.shiftrightunsigned("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"))


def _pairs_of_shard(keys: np.ndarray, ents: np.ndarray, block: int = 2_000_000) -> Iterator[pd.DataFrame]:
    order = np.argsort(keys)
    again = keys[order][1:] == keys[order][:-1]
    order = order[np.append(again, False) | np.append(False, again)] if len(order) else order  # keys that occur once pair nothing
    keys, ents = keys[order], ents[order]
    order = np.lexsort((ents, keys))
    keys, ents = keys[order], ents[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ents[1:] != ents[:-1])
    keys, ents = keys[new], ents[new]
    if not len(keys):
        return
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(starts, len(keys)))
    ends = np.repeat(starts + sizes, sizes)
    later = ends - np.arange(len(keys)) - 1  # partners behind each entry in its run
    total = np.concatenate(([0], np.cumsum(later)))
    at = 0
    while at < len(keys):
        to = max(at + 1, int(np.searchsorted(total, total[at] + block, "right")) - 1)
        left = np.repeat(np.arange(at, to), later[at:to])
        if len(left):
            right = left + 1 + (np.arange(len(left)) - np.repeat(total[at:to] - total[at], later[at:to]))
            a, b = ents[left], ents[right]
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            yield pd.DataFrame({"a": a[new], "b": b[new]})
        at = to


def prefix_length(size: np.ndarray, threshold: float) -> np.ndarray:
    """Of so many shingles in one order for all texts, two texts that reach the threshold share one among the first so many of each."""
    return size - np.ceil(threshold * size - 1e-9).astype(np.int64) + 1


def exact_candidates(texts: DataFrame, p: NearDuplicates, n: int, counts: np.ndarray) -> DataFrame:
    """All pairs of text names (a < b) that can reach the threshold; a pair may occur once per shared shingle.

    Each text sends the rarest of its shingles (by the sketch's counts, ties by hash) that the prefix filter asks for, with its size
    and the shingle's place. Two texts that are similar share a first such shingle, from whose place on both have
    room for the overlap that they need.
    """
    shared = texts.sparkSession.sparkContext.broadcast(counts)
    shards = max(1, math.ceil(n * 16 / p.shard_entries))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for b in batches:
            words, _ = _texts(p, b["text"].to_pylist())
            if not words:
                continue
            names, first = np.unique(_class_ids(words), return_index=True)
            words = [words[i] for i in first]
            h, lengths = shingle_hashes(*hashed_batch(words), p.shingle)
            text = np.repeat(np.arange(len(words)), lengths)
            rarity = np.minimum.reduce([held[r][_cells(h, r, p.sketch_bits)] for r in range(p.sketch_rows)])
            order = np.lexsort((h, rarity, text))
            h, text = h[order], text[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            h, text = h[new], text[new]
            size = np.bincount(text, minlength=len(words))
            place = np.arange(len(h)) - (np.cumsum(size) - size)[text]
            sent = place < prefix_length(size, p.threshold)[text]
            h, text, place = h[sent], text[sent], place[sent]
            shard = ((h >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = np.zeros(len(h), _ENTRY)
            rows["key"], rows["name"], rows["size"], rows["place"] = h, names[text], size[text], place
            rows = rows[order]
            full = [s for s in range(shards) if cuts[s] < cuts[s + 1]]
            yield pa.RecordBatch.from_pydict({"shard": full, "rows": [rows[cuts[s] : cuts[s + 1]].tobytes() for s in full]})

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for b in batches:
            for s, r in zip(b["shard"], b["rows"]):
                held.setdefault(s, []).append(r)
        for s in list(held):
            yield from _prefix_pairs(np.frombuffer(b"".join(held.pop(s)), _ENTRY), p.threshold)

    return texts.select("text").mapInArrow(entries, "shard long, rows binary").repartition(shards, "shard").mapInPandas(pairs, "a long, b long")


_ENTRY = np.dtype([("key", np.uint64), ("name", np.int64), ("size", np.uint32), ("place", np.uint32)])


def _prefix_pairs(rows: np.ndarray, threshold: float, block: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """Pairs of entries of one key that the bounds by size and place leave, a block of pairs at a time."""
    rows = np.unique(rows)  # copies of a text send the same entries
    if not len(rows):
        return
    starts = np.flatnonzero(np.concatenate(([True], rows["key"][1:] != rows["key"][:-1])))
    sizes = np.diff(np.append(starts, len(rows)))
    later = np.repeat(starts + sizes, sizes) - np.arange(len(rows)) - 1
    total = np.concatenate(([0], np.cumsum(later)))
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(total, total[at] + block, "right")) - 1)
        left = np.repeat(np.arange(at, to), later[at:to])
        right = left + 1 + (np.arange(len(left)) - np.repeat(total[at:to] - total[at], later[at:to]))
        x, y = rows[left], rows[right]
        room = np.minimum(x["size"].astype(np.int64) - x["place"], y["size"].astype(np.int64) - y["place"])
        need = threshold / (1 + threshold) * (x["size"].astype(np.int64) + y["size"])
        keep = (room >= need - 1e-9) & (x["name"] != y["name"])
        if keep.any():
            a, b = np.minimum(x["name"][keep], y["name"][keep]), np.maximum(x["name"][keep], y["name"][keep])
            yield pd.DataFrame({"a": a, "b": b}).drop_duplicates()
        at = to


def signed_and_counted(texts: DataFrame, p: NearDuplicates) -> DataFrame:
    """One pass over the texts: for each its id, the name of its text and its packed signature as
    64-bit words (s0, s1, ...); and per task one row with its number of texts (n) and its sketch (cells)."""
    multipliers = _multipliers(23, p.hashes)
    words_64 = [f"s{i}" for i in range(p.hashes * p.bits // 64)]
    schema = pa.schema([("id", pa.int64()), ("name", pa.int64()), *[(s, pa.int64()) for s in words_64], ("n", pa.int64()), ("cells", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((p.sketch_rows, 1 << p.sketch_bits), np.int64), 0
        for b in batches:
            words, at = _texts(p, b["text"].to_pylist())
            if not words:
                continue
            n += len(at)
            h, counts = shingle_hashes(*hashed_batch(words), p.shingle)
            for r in range(p.sketch_rows):
                total[r] += np.bincount(_cells(h, r, p.sketch_bits), minlength=total.shape[1])
            low = _minima(h, _starts(counts), multipliers)
            planes = [((low >> np.uint32(k)) & np.uint32(1)).astype(np.uint8) for k in range(p.bits)]
            packed = np.concatenate([np.packbits(x, axis=0) for x in planes], axis=0)  # bit planes, 8 texts' bits a byte
            as_words = np.ascontiguousarray(packed.T).view(np.int64)
            columns = [b["id"].to_numpy(zero_copy_only=False)[at], _class_ids(words), *as_words.T]
            nulls = pa.nulls(len(at))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], nulls.cast(pa.int64()), nulls.cast(pa.binary())], schema=schema)
        yield pa.RecordBatch.from_pydict({c: [None] for c in schema.names} | {"n": [n], "cells": [_packed(total)]}, schema=schema)

    return texts.select("id", "text").mapInArrow(run, ", ".join(f"{c} {'binary' if c == 'cells' else 'long'}" for c in schema.names))


def signatures(counted: DataFrame) -> DataFrame:
    """The signatures among signed_and_counted()."""
    return counted.filter("cells is null").drop("n", "cells")


def estimated_similarity(p: NearDuplicates, a: str, b: str) -> Column:
    """Similarity from equal low bits, corrected for the 2**-bits of chance agreement."""
    per_plane = p.hashes // 64
    equal = F.lit(0)
    for w in range(per_plane):
        differs = F.lit(0).cast("long")
        for k in range(p.bits):
            i = k * per_plane + w
            differs = differs.bitwiseOR(F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}")))
        equal = equal + (F.lit(64) - F.bit_count(differs))
    chance = 2.0**-p.bits
    return (equal / p.hashes - chance) / (1 - chance)


def _least_estimate(p: NearDuplicates) -> float:
    chance = 2.0**-p.bits
    m = chance + (1 - chance) * p.threshold
    return p.threshold - p.deviations * math.sqrt(m * (1 - m) / p.hashes) / (1 - chance)


def similar_classes(texts: DataFrame, p: NearDuplicates, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(pairs of text names with their similarity, members: id and name of its text).

    texts: id (bigint), text; other columns are ignored. Null ids and texts, and texts of fewer than
    least_words words, are left out; repeated rows count once; texts are read in full,
    however long. A similarity equal to the threshold counts. An empty table gives empty results.
    """
    texts = texts.filter("id is not null and text is not null").select("id", "text")
    counted = stored(signed_and_counted(texts, p))
    n, counts = shingle_counts(counted, p)
    signed = signatures(counted)
    width = p.hashes * p.bits // 64
    sig = [f"s{i}" for i in range(width)]
    classes = signed.groupBy("name").agg(F.min("id").alias("rep"), *[F.first(s).alias(s) for s in sig])
    key = F.col("name") if exact else half_name("name")
    side = lambda x: classes.select(key.alias(f"{x}_key"), F.col("name").alias(x), *[F.col(s).alias(f"{x}_{s}") for s in sig], F.col("rep").alias(f"{x}_rep"))
    found = exact_candidates(texts, p, n, counts) if exact else candidate_pairs(texts, p, n, common_shingles(n, counts, p))
    if not exact:  # different texts that share half a name are candidates too
        found = found.union(signed.select("name").distinct().groupBy(key.alias("a")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", F.col("a").alias("b")))
    found = found.toDF("a_key", "b_key")

    def in_signatures(found: DataFrame) -> DataFrame:
        likely = found.repartition("a_key").dropDuplicates(["a_key", "b_key"]).join(side("a"), "a_key").join(side("b"), "b_key").filter("a_key <> b_key or a < b")
        if not exact:
            likely = likely.filter(estimated_similarity(p, "a_", "b_") >= _least_estimate(p))
        return stored(likely.select("a", "b", "a_rep", "b_rep"), free=True)

    slices = 1 if exact else max(1, math.ceil(found.count() / max(1, p.slice_pairs * n)))
    likely = reduce(DataFrame.union, [in_signatures(found.filter(F.pmod(F.xxhash64("a_key"), F.lit(slices)) == i) if slices > 1 else found) for i in range(slices)])
    needed = likely.select(F.col("a_rep").alias("id")).unionByName(likely.select(F.col("b_rep").alias("id"))).distinct()
    plain = texts.join(needed, "id", "left_semi").dropDuplicates(["id"])
    both = likely.join(plain.select(F.col("id").alias("a_rep"), F.col("text").alias("text_a")), "a_rep").join(plain.select(F.col("id").alias("b_rep"), F.col("text").alias("text_b")), "b_rep")

    def checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[int, frozenset] = {}

        def shingles(name: int, text: str) -> frozenset:
            got = memo.get(name)
            if got is None:
                if len(memo) > 50_000:
                    memo.clear()
                w = words_of(text)
                got = memo[name] = frozenset(zip(*[w[k:] for k in range(p.shingle)]))
            return got

        for b in batches:
            out = []
            for a_name, b_name, ta, tb in zip(b["a"], b["b"], b["text_a"], b["text_b"]):
                x, y = shingles(a_name, ta), shingles(b_name, tb)
                shared = len(x & y)
                out.append(shared / max(1, len(x) + len(y) - shared))
            keep = np.array(out) >= p.threshold - 1e-12
            yield pd.DataFrame({"a": b["a"][keep], "b": b["b"][keep], "similarity": np.array(out)[keep]})

    pairs = both.select("a", "b", "text_a", "text_b").mapInPandas(checked, "a long, b long, similarity double")
    return pairs, signed.select("id", "name").distinct()


def near_duplicate_pairs(texts: DataFrame, p: NearDuplicates, exact: bool = False) -> DataFrame:
    """All pairs of rows (id_a < id_b) whose texts reach the threshold, copies included."""
    pairs, members = similar_classes(texts, p, exact)
    m = lambda name, i: members.select(F.col("name").alias(name), F.col("id").alias(i))
    across = pairs.select("a", "b").join(m("a", "x"), "a").join(m("b", "y"), "b").filter("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    within = m("a", "id_a").join(m("a", "id_b"), "a").filter("id_a < id_b").select("id_a", "id_b")
    return across.unionByName(within).distinct()


def near_duplicate_classes(texts: DataFrame, p: NearDuplicates, exact: bool = False) -> DataFrame:
    """One row per text-bearing row: id, class_id (least id of its equal texts), n_copies and
    n_links (different texts that are near it)."""
    pairs, members = similar_classes(texts, p, exact)
    links = pairs.select(F.explode(F.array("a", "b")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n_links"))
    sizes = members.groupBy("name").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_copies"))
    return members.join(sizes, "name").join(links, "name", "left").select("id", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
