"""Text read from scanned pages: finding and repairing cut words, misread letters and page furniture.

Statistics over all rows come first: how often each word occurs (words below a share of the rows
are dropped, which bounds the vocabulary), which line shapes are repeated in ever different
surroundings and interrupt sentences there (running and table headings), and sketches of fixed size
with counts of word pairs.

Then each text is read on its own, where it lies:

1. Lines that are page furniture (printed page numbers, running and table headings) are set aside.
2. A word cut by a hyphen at a line's end, or torn by a stray space, is joined when the whole is
   far more frequent than its rarer part.
3. A word that is rare against a word from which letter confusions lead to it is misread. All words
   within the bounds come from intersecting Levenshtein automata of the word with a trie of the
   vocabulary: one whose cheap edits are the confusions of a reader (among them two-for-one
   letters), one whose edits are letters of like shape (one, in long words two). Candidates are ranked by the cost of what
   the reader confused, how often they stand beside the neighbours, and their count together. In a word
   of letters any other slip of the reader is a letter for one of like shape, and only the
   neighbours can prove it; further slips are the requester's own and no noise.
4. What remains is flowed into continuous paragraphs; list items keep their lines.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
import zlib
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedgeline.llm.words import mixed
from sedgeline.runtime import bounded_rows, stored

# What a reader of scanned letters takes for what (read -> meant).
CONFUSIONS = [
    ("c", "e"), ("1", "i"), ("1", "l"), ("l", "i"), ("i", "l"), ("†", "t"), ("$", "s"), ("5", "s"), ("@", "a"), ("0", "o"),
    ("ri", "n"), ("rn", "m"), ("cl", "d"), ("ii", "u"), ("vv", "w"), ("q", "g"), ("b", "h"), ("m", "rn"), ("d", "cl"), ("8", "b"), ("6", "b"), ("2", "z"), ("|", "l"), ("!", "i"), ("€", "e"), ("£", "e"), ("9", "g"),
]
# Letters of like shape, of which a reader takes one for another.
LIKE_SHAPES = ["aceo", "nmruh", "iltjf", "gqy", "uvy", "bh", "sz", "kx", "ce"]
ALIKE = {(a, b) for group in LIKE_SHAPES for a in group for b in group if a != b}
PAGE_NUMBER = re.compile(r"(?:(?:page|pg\.?|p\.|lch\.?|leathanach)\s*\d{1,4}(?:\s*(?:of|/|as)\s*\d{1,4})?|\[\s*\d{1,4}\s*\]|[-–—]\s*\d{1,4}\s*[-–—]|\d{1,4}(?:\s*(?:of|/)\s*\d{1,4})?|\d{1,4}\s*\|\s*p\s?a\s?g\s?e)", re.IGNORECASE)
LIST_MARK = re.compile(r"^(?:[*•‣–-]|\(?\d{1,2}[.)]|\(?[a-z][.)])\s+")
EDGES = " .,;:()[]\"'’‘“”–—*•?!"
HYPHENS = "-¬\xad"
LINE = re.compile(r"\r\n|\r|\n")
ODD = re.compile(r"[^\w'’\-.]|\d", re.UNICODE)


@dataclass(frozen=True)
class ScanRepair:
    """least_share: a word in fewer of the texts is no vocabulary. ratio: how much more frequent the
    meant word must be. common_share: more frequent words are looked at only if a word outnumbers them by the ratio.
    short_word: shorter words are searched
    for confusions alone. long_word: from so many letters on two letters of like shape are searched. least_contexts, interrupting and
    broken_share: a line shape is a heading if it has so many different surroundings, ends a line in mid-sentence before it in
    such a share of cases, and stands between the parts of one sentence in such a share."""

    least_share: float = 1e-5
    ratio: float = 8.0
    common_share: float = 0.005
    most_confusions: int = 3
    short_word: int = 5
    long_word: int = 9
    least_contexts: int = 3
    interrupting: float = 0.5
    broken_share: float = 0.15
    sketch_rows: int = 2
    sketch_bits: int = 19
    most_words: int = 5_000_000


def core(token: str) -> str:
    """A token without punctuation around it, in lower case."""
    return token.strip(EDGES).lower()


def line_shape(line: str, name: str) -> str:
    """A line with numbers as 9 and a run of words of the body's name as N."""
    own, out = {w.lower() for w in name.split()}, []
    for w in line.split():
        x = "N" if w.lower() in own else re.sub(r"\d+", "9", w)
        if x != "N" or out[-1:] != ["N"]:
            out.append(x)
    return " ".join(out)


def _title_like(line: str) -> bool:
    return line[:1].isupper() and line[-1:] not in ".,;:" and not line.endswith(tuple(HYPHENS)) and not LIST_MARK.match(line)


def _lines_of(text: str) -> list[str]:
    return [x for x in map(str.strip, LINE.split(text)) if x]


def _seen_lines(text: str, name: str) -> Iterator[tuple[str, int, int, int]]:
    """Each line that may be a heading: its shape, its surroundings as a number, whether it follows an unended
    sentence, and whether that goes on behind it."""
    lines = _lines_of(text)
    for k, x in enumerate(lines):
        if _title_like(x):
            before, after = lines[k - 1] if k else "", lines[k + 1] if k + 1 < len(lines) else ""
            around = xxhash.xxh64_intdigest(f"{before.split()[-1] if before else ''}\n{after.split()[0] if after else ''}".encode("utf-8", "surrogatepass")) >> 1
            broken = bool(before) and before[-1] not in ".?!:;"
            yield line_shape(x, name), around, int(broken), int(broken and after[:1].islower())


@dataclass
class Statistics:
    n: int
    words: Trie
    headings: set[str]
    pairs: np.ndarray
    token: str = ""
    #: what the words of the vocabulary may stand for, where that is anything; null: not looked up yet
    meant: dict[str, dict[str, tuple[float, int, bool]]] | None = None


def statistics(texts: DataFrame, p: ScanRepair) -> Statistics:
    """Counts over all rows. texts: id, name, text."""
    width = 1 << p.sketch_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, shapes, n = Counter(), {}, 0
        pairs, hashes = np.zeros((p.sketch_rows, width), np.int64), {}
        for b in batches:
            flat, starts = [], []
            for name, t in zip(b["name"].to_pylist(), b["text"].to_pylist()):
                if not isinstance(t, str):
                    continue
                n += 1
                flat += t.split()
                starts.append(len(flat))
                if "\n" in t or "\r" in t:
                    for shape, around, broken, within in _seen_lines(t, name if isinstance(name, str) else ""):
                        held = shapes.setdefault((shape, around), [0, 0, 0])
                        held[0] += 1
                        held[1] += broken
                        held[2] += within
            raw.update(flat)
            for x in set(flat).difference(hashes):
                hashes[x] = xxhash.xxh64_intdigest(core(x).encode("utf-8", "surrogatepass"))
            h = np.fromiter(map(hashes.__getitem__, flat), np.uint64, len(flat))
            if len(h) > 1:
                ends = np.array(starts[:-1], np.int64) - 1
                keep = np.ones(len(h) - 1, bool)
                keep[ends[(ends >= 0) & (ends < len(h) - 1)]] = False
                for r, cells in enumerate(_pair_cells(h[:-1][keep], h[1:][keep], p)):
                    pairs[r] += np.bincount(cells, minlength=width)
            if len(hashes) > 500_000:
                hashes = {}
            if len(raw) > 500_000:
                yield _word_rows(raw)
                raw = Counter()
            if len(shapes) > 500_000:
                yield _line_rows(shapes)
                shapes = {}
        yield _word_rows(raw)
        yield _line_rows(shapes)
        yield _as_rows("n", [""], n=[n])
        pieces = np.array_split(pairs.ravel(), 16)
        yield _as_rows("p", [f"{k:02d}" for k in range(16)], cells=[zlib.compress(x.tobytes(), 1) for x in pieces])

    got = stored(texts.select("name", "text").mapInArrow(count, "kind string, key string, around long, n long, m long, k long, cells binary"))
    n = got.filter("kind = 'n'").agg(F.sum("n")).first()[0] or 0
    words = got.filter("kind = 'w'").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(2, p.least_share * n))
    lines = got.filter("kind = 'l'").groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("k").alias("k"), F.approx_count_distinct("around").alias("contexts"))
    headings = lines.filter((F.col("contexts") >= p.least_contexts) & (F.col("m") >= p.interrupting * F.col("n")) & (F.col("k") >= p.broken_share * F.col("n"))).select("key")
    cells = got.filter("kind = 'p'").select("key", "cells").rdd.map(tuple).reduceByKey(_added).collectAsMap()
    pairs = np.concatenate([np.frombuffer(zlib.decompress(cells[k]), np.int64) for k in sorted(cells)]) if cells else np.zeros(p.sketch_rows * width, np.int64)
    held = Trie({r[0]: r[1] for r in bounded_rows(words.select("key", "n"), p.most_words, "vocabulary")})
    return Statistics(n, held, {r[0] for r in bounded_rows(headings, p.most_words, "line shapes")}, pairs.reshape(p.sketch_rows, width), uuid.uuid4().hex)


def _added(a: bytes, b: bytes) -> bytes:
    return zlib.compress((np.frombuffer(zlib.decompress(a), np.int64) + np.frombuffer(zlib.decompress(b), np.int64)).tobytes(), 1)


def _pair_cells(a: np.ndarray, b: np.ndarray, p: ScanRepair) -> Iterator[np.ndarray]:
    """The cells of word pairs, one array per row of the sketch."""
    with np.errstate(over="ignore"):
        h = mixed(a * np.uint64(0x9E3779B97F4A7C15) + b)
        for r in range(p.sketch_rows):
            yield ((h >> np.uint64(r * p.sketch_bits)) & np.uint64((1 << p.sketch_bits) - 1)).astype(np.int64)


def _cores(raw: Counter) -> Counter:
    out: Counter = Counter()
    for x, k in raw.items():
        c = core(x)
        if c and c[-1] not in HYPHENS and any(ch.isalpha() for ch in c):
            out[c] += k
    return out


def _as_rows(kind: str, keys: list, **columns: list) -> pa.RecordBatch:
    size = len(keys)
    kinds = {"around": pa.int64(), "n": pa.int64(), "m": pa.int64(), "k": pa.int64(), "cells": pa.binary()}
    return pa.RecordBatch.from_pydict({"kind": pa.array([kind] * size, pa.string()), "key": pa.array(keys, pa.string())} | {c: pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in kinds.items()})


def _word_rows(raw: Counter) -> pa.RecordBatch:
    words = _cores(raw)
    return _as_rows("w", list(words), n=list(words.values()))


def _line_rows(shapes: dict[tuple[str, int], list[int]]) -> pa.RecordBatch:
    n, m, k = zip(*shapes.values()) if shapes else ((), (), ())
    return _as_rows("l", [s for s, _ in shapes], around=[a for _, a in shapes], n=n, m=m, k=k)


class Trie:
    """A vocabulary with counts as a trie over sorted words: a node is a range of words and the depth to
    which they agree, so that it takes the words' letters and three numbers each, however many tasks read it."""

    def __init__(self, words: dict[str, int]):
        order = sorted(words)
        self.text = "".join(order)
        self.ends = np.cumsum(np.fromiter(map(len, order), np.int64, len(order)))
        self.counts = np.fromiter((words[w] for w in order), np.int64, len(order))
        self.nodes: dict[tuple[int, int, int], tuple[int, dict[str, tuple[int, int]]]] = {}
        self.hashes: array | None = None

    def __len__(self) -> int:
        return len(self.counts)

    def __getstate__(self):
        return self.text, self.ends, self.counts

    def __setstate__(self, state):
        self.text, self.ends, self.counts = state
        self.nodes, self.hashes = {}, None

    def _span(self, i: int) -> tuple[int, int]:
        return int(self.ends[i - 1]) if i else 0, int(self.ends[i])

    def word(self, i: int) -> str:
        a, b = self._span(i)
        return self.text[a:b]

    def items(self) -> Iterator[tuple[str, int]]:
        return ((self.word(i), int(self.counts[i])) for i in range(len(self)))

    def count(self, w: str) -> int:
        """How often a word occurs; 0 if it is no vocabulary. Looked up by hash, then compared."""
        if self.hashes is None:
            h = np.fromiter((xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x, _ in self.items()), np.uint64, len(self))
            self.order = np.argsort(h, kind="stable")
            self.hashes = array("Q", h[self.order].tobytes())
        h = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        at = bisect_left(self.hashes, h)
        while at < len(self.hashes) and self.hashes[at] == h:
            i = int(self.order[at])
            if self.word(i) == w:
                return int(self.counts[i])
            at += 1
        return 0

    def node(self, low: int, high: int, depth: int) -> tuple[int, dict[str, tuple[int, int]]]:
        """(count of the word that ends here or 0, letter -> range of the words that go on with it)."""
        got = self.nodes.get((low, high, depth))
        if got is None:
            if len(self.nodes) > 500_000:
                self.nodes.clear()
            at, ends_here, below = low, 0, {}
            if at < high and self._span(at)[1] - self._span(at)[0] == depth:
                ends_here, at = int(self.counts[at]), at + 1
            while at < high:
                ch, a, b = self.text[self._span(at)[0] + depth], at + 1, high
                while a < b:  # the first word behind those that go on with ch
                    mid = (a + b) // 2
                    if self.text[self._span(mid)[0] + depth] == ch:
                        a = mid + 1
                    else:
                        b = mid
                below[ch] = (at, a)
                at = a
            got = self.nodes[low, high, depth] = (ends_here, below)
        return got

    def within(self, word: str, confusions: int, edits: int, table: dict[str, list[tuple[str, str]]] | None = None) -> dict[str, tuple[int, int, int]]:
        """All words that the automaton of `word` accepts: word -> (edits, confusions, count), at its least edits.

        A state is (position in word, confusions used, edits used); the traversal pairs states
        with trie nodes, so it visits only prefixes that both share. table: the confusions, by first letter read.
        """
        table = _CONFUSED if table is None else table
        out: dict[int, tuple[int, int, int]] = {}
        stack = [(0, len(self), 0, 0, 0, 0)]
        seen = set()
        last, node = len(word), self.node
        while stack:
            state = stack.pop()
            low, high, depth, i, c, e = state
            if low >= high or (key := (low, depth, i, c, e)) in seen:
                continue
            seen.add(key)
            ends_here, below = node(low, high, depth)
            if i == last:
                if ends_here:
                    found = (e, c, ends_here)
                    if low not in out or found[:2] < out[low][:2]:
                        out[low] = found
            else:
                ch = word[i]
                if (nxt := below.get(ch)) is not None:
                    stack.append((*nxt, depth + 1, i + 1, c, e))
                if c < confusions:
                    for read, meant in table.get(ch, ()):
                        if len(read) == 1 or word.startswith(read, i):
                            nxt, at = (low, high), depth
                            for x in meant:
                                nxt = node(*nxt, at)[1].get(x)
                                if nxt is None:
                                    break
                                at += 1
                            else:
                                stack.append((*nxt, at, i + len(read), c + 1, e))
                if e < edits:
                    stack.append((low, high, depth, i + 1, c, e + 1))
                    for x, nxt in below.items():
                        if x != ch:
                            stack.append((*nxt, depth + 1, i + 1, c, e + 1))
            if e < edits:
                for nxt in below.values():
                    stack.append((*nxt, depth + 1, i, c, e + 1))
        return {self.word(k): found for k, found in out.items()}


def _by_start(pairs: list[tuple[str, str]]) -> dict[str, list[tuple[str, str]]]:
    out: dict[str, list[tuple[str, str]]] = {}
    for read, meant in pairs:
        out.setdefault(read[0], []).append((read, meant))
    return out


_CONFUSED, _ALIKE = _by_start(CONFUSIONS), _by_start(sorted(ALIKE))


def _is_code(w: str) -> bool:
    """No word: without letters, or with no more letters than digits (numbers, references, dates)."""
    letters = sum(map(str.isalpha, w))
    return not letters or letters <= sum(map(str.isdigit, w))


class Reader:
    """Reads one text after another with the statistics of all."""

    def __init__(self, s: Statistics, p: ScanRepair):
        self.s, self.p = s, p
        self.unseen = max(1.0, p.least_share * s.n)
        self.common = p.common_share * s.n
        self.noise = float(s.pairs[0].sum()) / s.pairs.shape[1] if s.pairs.size else 0.0
        self.counts: dict[str, int] = {}
        self.status: dict[str, int] = {}
        self.cores: dict[str, str] = {}
        self.meant: dict[tuple[str, bool], dict] = {}
        # the first parts of words that outnumber both their parts by the ratio though these are common
        often = [(w, n) for w, n in s.words.items() if n >= p.ratio * self.common] if self.common else []
        self.torn = {w[:k] for w, n in often for k in range(1, len(w)) if self.common <= min(self.count(w[:k]), self.count(w[k:])) <= n / p.ratio}

    def count(self, w: str) -> int:
        got = self.counts.get(w)
        if got is None:
            if len(self.counts) > 500_000:
                self.counts.clear()
            got = self.counts[w] = self.s.words.count(w)
        return got

    def beside(self, a: str, b: str) -> float:
        """How often b follows a, as the sketches have it, less what chance puts in a cell."""
        if not a or not b:
            return 0.0
        h = [np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"))], np.uint64) for x in (a, b)]
        return max(0.0, min(float(self.s.pairs[r][cells[0]]) for r, cells in enumerate(_pair_cells(*h, self.p))) - self.noise)

    def candidates(self, w: str, plain: bool = True) -> dict[str, tuple[float, int, bool]]:
        """word -> (cost of reading it so, count, whether only its neighbours can prove it). plain: with plain edits."""
        if self.s.meant is not None and w in self.s.meant:
            return self.s.meant[w]
        if self.s.meant is not None and self.count(w):
            return {}
        got = self.meant.get((w, plain))
        if got is None:
            if len(self.meant) > 200_000:
                self.meant.clear()
            odd = bool(ODD.search(w))
            own = self.p.ratio * max(self.count(w), 0.5 if odd else self.unseen)
            good = lambda v, n: v != w and n >= own and len(v) > 1 and not ODD.search(v)
            got = {v: (float(c), n, False) for v, (_, c, n) in self.s.words.within(w, self.p.most_confusions, 0).items() if good(v, n)}
            if not got and plain and len(w) >= self.p.short_word:
                if odd:  # signs that nobody types inside a word: any edit will do
                    got = {v: (c + 2.0 * e, n, False) for v, (e, c, n) in self.s.words.within(w, self.p.most_confusions, 1).items() if good(v, n)}
                else:  # of the plain edits those that can be a misreading
                    found = self.s.words.within(w, 1 if len(w) < self.p.long_word else 2, 0, _ALIKE)
                    got = {v: (1.5 * c, n, True) for v, (_, c, n) in found.items() if good(v, n)}
            self.meant[w, plain] = got
        return got

    def misread(self, w: str, before: str, after: str, plain: bool = True) -> str | None:
        """The word that w was printed as, or null if it is none or unknown.

        The rank is the cost of reading it so, less what the neighbours and its count say for it.
        """
        if len(w) < 2 or _is_code(w):
            return None
        found = self.candidates(w, plain)
        if not found:
            return None
        best = None
        for v, (cost, n, unproved) in found.items():
            near = self.beside(before, v) + self.beside(v, after)
            if unproved and near <= self.beside(before, w) + self.beside(w, after):
                continue
            rank = (cost - 0.5 * math.log1p(near) - 0.1 * math.log1p(n), v)
            best = min(best, rank) if best else rank
        return best[1] if best else None

    def core(self, token: str) -> str:
        got = self.cores.get(token)
        if got is None:
            if len(self.cores) > 400_000:
                self.cores.clear()
            got = self.cores[token] = core(token)
        return got

    def look(self, raw: str) -> int:
        """0: nothing to see in this token; 1: rare or outnumbered, look at it and its neighbours; 2: ends in a hyphen."""
        got = self.status.get(raw)
        if got is None:
            if len(self.status) > 400_000:
                self.status.clear()
            w = self.core(raw)
            if raw[-1] in HYPHENS and len(w) > 1 and any(ch.isalpha() for ch in w):
                got = 2
            elif _is_code(w):
                got = 0
            else:
                got = int(self.count(w) < self.common or w in self.torn or bool(self.candidates(w)))
            self.status[raw] = got
        return got

    def furniture(self, text: str, name: str | None) -> tuple[list[str], set[str]]:
        """The lines that are text, and the kinds of noise that the others are."""
        lines = _lines_of(text)
        kinds: set[str] = set()
        if len(lines) < 2:
            return lines, kinds
        name = name if isinstance(name, str) else ""
        keep: list[str] = []
        for k, x in enumerate(lines):
            before, after = keep[-1] if keep else "", lines[k + 1] if k + 1 < len(lines) else ""
            if PAGE_NUMBER.fullmatch(x) and (not x.isdigit() or after or before.endswith((".", "?", "!"))):
                kinds.add("page_number")
            elif self._heading(x, name, before, after):
                kinds.add("running_header")
            else:
                keep.append(x)
        return keep, kinds

    def _heading(self, x: str, name: str, before: str, after: str) -> bool:
        """The body's name alone or set off at the start, three or more columns, or a learnt shape, unless
        its words run on from the line before and into the next far better than these without it."""
        body, low = name.strip().lower(), x.lower()
        if body and low.startswith(body) and (low == body or re.match(r"\s*[–—|:-]\s", low[len(body) :])):
            return True
        if not _title_like(x):
            return False
        if len(re.split(r"\s{3,}|\t|\s\|\s", x)) >= 3:
            return True
        if line_shape(x, name) not in self.s.headings:
            return False
        words, left, right = x.split(), before.split()[-1:], after.split()[:1]
        seams = [self.beside(self.core(left[0]), self.core(words[0]))] if left else []
        seams += [self.beside(self.core(words[-1]), self.core(right[0]))] if right else []
        without = self.beside(self.core(left[0]), self.core(right[0])) if left and right else 0.0
        return len(seams) < 2 or min(seams) <= self.p.ratio * (1 + without)

    def read(self, text: str, name: str | None) -> tuple[set[str], str]:
        """(kinds of noise, continuous text)."""
        if "\n" in text or "\r" in text:
            lines, kinds = self.furniture(text, name)
        else:
            lines, kinds = [text], set()
        tokens: list[str] = []
        breaks: set[int] = set()  # tokens before which a list item or paragraph begins
        for x in lines:
            if tokens and LIST_MARK.match(x):
                breaks.add(len(tokens))
            tokens += x.split()
        flags = list(map(self.look, tokens))
        if not any(flags):
            return kinds, _flowed(tokens, breaks)
        out: list[str] = []
        at: set[int] = set()
        k, n = 0, len(tokens)
        while k < n:
            t = tokens[k]
            if k in breaks:
                at.add(len(out))
            f = flags[k]
            if f == 2 and k + 1 < n and k + 1 not in breaks:
                joined = self._hyphenated(t, tokens[k + 1])
                if joined:
                    kinds.add("hyphen_break")
                    w = self.core(joined)
                    right = self.misread(w, self.core(out[-1]) if out else "", self.core(tokens[k + 2]) if k + 2 < n else "")
                    if right:
                        kinds.add("misread")
                        joined = _recased(joined, w, right)
                    tokens[k + 1], flags[k + 1] = joined, 2 if joined[-1] in HYPHENS else 0
                    k += 1
                    continue
            elif k + 1 < n and (f or flags[k + 1]) and k + 1 not in breaks and flags[k + 1] != 2:
                joined = self._torn(t, tokens[k + 1])
                if joined:
                    kinds.add("misread")
                    tokens[k + 1], flags[k + 1] = joined, 0
                    k += 1
                    continue
            if f == 1:
                w = self.core(t)
                right = self.misread(w, self.core(out[-1]) if out else "", self.core(tokens[k + 1]) if k + 1 < n else "")
                if right:
                    kinds.add("misread")
                    t = _recased(t, w, right)
            out.append(t)
            k += 1
        return kinds, _flowed(out, at)

    def _hyphenated(self, a: str, b: str) -> str | None:
        """The whole word, if a's hyphen only cuts it."""
        if not b[:1].isalpha() and b[:1] not in "†@$":
            return None
        left, right = a.rstrip(HYPHENS), self.core(b)
        whole = self.core(left) + right
        if self.count(self.core(left) + "-" + right) > self.count(whole) or (b[:1].isupper() and not left.isupper() and not self.count(whole)):
            return None
        return left + b

    def _torn(self, a: str, b: str) -> str | None:
        if not (a[-1:].isalpha() or a[-1:] in "†@$015") or not (b[:1].isalpha() or b[:1] in "†@$015"):
            return None
        x, y = self.core(a), self.core(b)
        if not (any(ch.isalpha() for ch in x) and any(ch.isalpha() for ch in y)) or (b[0].isupper() and not a.isupper()) or len(x) + len(y) < 3:
            return None
        whole = self.count(x + y)
        rarer = max(min(self.count(x), self.count(y)), self.unseen)
        if whole >= self.p.ratio * rarer:
            return a + b
        if not whole and max(self.count(x), self.count(y)) < self.common / 10 and self.candidates(x + y, plain=False) and not (self.candidates(x) or self.candidates(y)):
            best = self.misread(x + y, "", "", plain=False)
            if best and self.count(best) >= self.p.ratio * rarer:
                return _recased(a + b, x + y, best)
        return None


def _recased(token: str, read: str, meant: str) -> str:
    """The token with its word replaced, in the token's case."""
    at = token.lower().find(read)
    if at < 0:
        return token
    word = token[at : at + len(read)]
    if word.isupper() and len(word) > 1:
        meant = meant.upper()
    elif word[:1].isupper():
        meant = meant[:1].upper() + meant[1:]
    return token[:at] + meant + token[at + len(read) :]


def _flowed(tokens: list[str], breaks: set[int]) -> str:
    if not breaks:
        return " ".join(tokens)
    cuts = [0, *sorted(breaks), len(tokens)]
    return "\n".join(" ".join(tokens[a:b]) for a, b in zip(cuts, cuts[1:]) if a < b)


_READERS: dict[str, Reader] = {}


def _reader(s: Statistics, p: ScanRepair) -> Reader:
    """The reader of these statistics; a worker keeps the last one, with what it has looked up."""
    if s.token not in _READERS:
        _READERS.clear()
        _READERS[s.token] = Reader(s, p)
    return _READERS[s.token]


def looked_up(spark: SparkSession, s: Statistics, p: ScanRepair) -> Statistics:
    """The statistics with what each word of the vocabulary may stand for, worked out once, spread over the tasks."""
    shared, size = spark.sparkContext.broadcast(s), 2000

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value, p)
        for b in batches:
            for block in b["id"].to_pylist():
                words = [reader.s.words.word(i) for i in range(block * size, min((block + 1) * size, len(reader.s.words)))]
                found = {w: got for w in words if not _is_code(w) and (got := reader.candidates(w))}
                yield pa.RecordBatch.from_pydict({"found": pa.array([pickle.dumps(found)], pa.binary())})

    blocks = -(-len(s.words) // size)
    parts = bounded_rows(spark.range(0, blocks, 1, max(1, min(blocks, spark.sparkContext.defaultParallelism))).mapInArrow(look, "found binary"), p.most_words, "words") if blocks else []
    return replace(s, meant={w: got for (x,) in parts for w, got in pickle.loads(x).items()})


def repaired_texts(rows: DataFrame, key: str, name: str, text: str, p: ScanRepair = ScanRepair()) -> DataFrame:
    """key, kinds (sorted array of noise kinds found), repaired (continuous text), for each non-null text.

    Rows with a null key or text give none; repeated rows repeat; an empty text is repaired to
    an empty text. Whole texts are read, however long; other columns are ignored; an empty table gives no rows.
    """
    texts = rows.select(F.col(key).alias("id"), F.col(name).alias("name"), F.col(text).alias("text")).filter("id is not null and text is not null")
    shared = rows.sparkSession.sparkContext.broadcast(looked_up(rows.sparkSession, statistics(texts, p), p))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(shared.value, p)
        for b in batches:
            got = [reader.read(t, n) for t, n in zip(b["text"].to_pylist(), b["name"].to_pylist())]
            yield pa.RecordBatch.from_pydict({"id": b["id"], "kinds": pa.array([sorted(k) for k, _ in got], pa.list_(pa.string())), "repaired": pa.array([r for _, r in got], pa.string())})

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(read, f"id {kind}, kinds array<string>, repaired string").withColumnRenamed("id", key)
