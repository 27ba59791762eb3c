"""Languages of documents, paragraphs and segments by hierarchical discrimination.

Family first (one-versus-one linear support vector machines between families), then
one-versus-one machines between the languages of that family. Features are words and their
character n-grams; as everything is linear, a text's score is the sum of its words' scores,
which a worker computes once per word.

The machines are trained at run time on a bounded sample of labelled documents. Labels may be
wrong and documents mixed, so the fit is repeated: each paragraph of the sample takes the
language that the last fit gives it as a whole, and its sentences are then trained under that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Languages by family, and the names under which a label may name them
# (two- and three-letter codes, English name, own name).
FAMILIES = {"celtic": ["ga"], "germanic": ["de", "en"], "romance": ["es", "fr"], "slavic": ["pl"]}
NAMES = {
    "de": ["de", "deu", "ger", "german", "deutsch"],
    "en": ["en", "eng", "english"],
    "es": ["es", "spa", "spanish", "español", "espanol", "castellano"],
    "fr": ["fr", "fra", "fre", "french", "français", "francais"],
    "ga": ["ga", "gle", "irish", "gaeilge"],
    "pl": ["pl", "pol", "polish", "polski"],
}

PARAGRAPH_BREAK = re.compile(r"(?:\r\n|\r|\n)(?:[^\S\r\n]*(?:\r\n|\r|\n))+")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def named_language(label: Column) -> Column:
    """The language code that a free-entered label names, else null."""
    plain = F.lower(F.regexp_replace(label, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    base = F.regexp_extract(plain, r"^([a-z]{2,3})(?:[-_][a-z0-9]{2,8})*$", 1)
    out = F.lit(None).cast("string")
    for code, names in NAMES.items():
        out = F.when(plain.isin(names) | base.isin([n for n in names if len(n) <= 3]), code).otherwise(out)
    return out


@dataclass(frozen=True)
class LanguageModel:
    """bits: size of the hashed feature space. sample_docs: most labelled documents per language
    that training reads, and sample_sentences: most sentences of a side that one machine sees in an epoch (the documented
    bounds of the fit; what is judged is never sampled). batch: sentences per step. least_words: paragraphs below are not judged."""

    bits: int = 16
    sample_docs: int = 300
    sample_sentences: int = 4000
    batch: int = 32
    epochs: int = 8
    regularisation: float = 1e-3
    refits: int = 2
    least_words: int = 6


@dataclass(frozen=True)
class Machines:
    """codes; pairs: (kind, index, index) of each machine; weights: features x machines."""

    codes: list[str]
    families: list[list[int]]
    family_pairs: list[tuple[int, int]]
    inner_pairs: list[tuple[int, int]]
    weights: np.ndarray


def features(word: str, bits: int) -> list[int]:
    """Hashed features of a word: itself and its two- and three-letter pieces with its ends marked."""
    core = EDGE.sub("", word.lower())
    if not core or not any(ch.isalpha() for ch in core) or any(ch.isdigit() for ch in core):
        return []
    marked = f"<{core}>"
    pieces = {"w" + core} | {marked[i : i + n] for n in (2, 3) for i in range(len(marked) - n + 1)}
    return sorted({xxhash.xxh32_intdigest(p.encode("utf-8", "surrogatepass")) >> (32 - bits) for p in pieces})


def sentences_of(words: list[str]) -> Iterator[list[str]]:
    """The sentence-like segments of a paragraph's words."""
    part: list[str] = []
    for w in words:
        part.append(w)
        if w[-1] in ".!?:;":
            yield part
            part = []
    if part:
        yield part


def labelled_sample(documents: DataFrame, p: LanguageModel) -> list[tuple[str, str]]:
    """(code, text) of at most about sample_docs documents per language, chosen by a hash of their id."""
    known = documents.select("doc_id", "text", named_language(F.col("lang")).alias("code")).filter("code is not null and text is not null")
    counts = {r[0]: r[1] for r in known.groupBy("code").count().collect()}
    if not counts:
        return []
    share = F.create_map(*[x for c, n in sorted(counts.items()) for x in (F.lit(c), F.lit(min(1.0, p.sample_docs / n)))])
    pick = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("code")] * 1_000_000)
    rows = pick.select("code", "text", F.xxhash64("doc_id").alias("h")).limit(2 * p.sample_docs * len(counts)).collect()
    return [(r[0], r[1]) for r in sorted(rows, key=lambda r: (r[0], r[2]))]


def _fit(x: list[np.ndarray], y: np.ndarray, groups: list[list[int]], pairs: list[tuple[int, int]], epochs: int, last: np.ndarray | None, p: LanguageModel) -> np.ndarray:
    """Averaged Pegasos in mini-batches for each pair of groups of labels; x: feature numbers of each sentence.

    A pair of which one side has no sentence keeps the machine of the last fit.
    """
    size = 1 << p.bits
    out = np.zeros((size, len(pairs)), np.float32) if last is None else last.copy()
    rng = np.random.default_rng(5)
    lengths = np.fromiter(map(len, x), np.int64, len(x))
    ends = np.cumsum(lengths)
    flat = np.concatenate(x) if len(x) else np.zeros(0, np.int64)
    norms = np.maximum(lengths, 1) ** -0.5
    for m, (a, b) in enumerate(pairs):
        ia, ib = np.flatnonzero(np.isin(y, groups[a])), np.flatnonzero(np.isin(y, groups[b]))
        if not len(ia) or not len(ib):
            continue
        n = min(max(len(ia), len(ib)), 4 * min(len(ia), len(ib)), p.sample_sentences)
        w, total, scale, t = np.zeros(size), np.zeros(size), 1.0, 0
        for _ in range(epochs):
            order = rng.permutation(2 * n)
            rows = np.concatenate([rng.choice(ia, n), rng.choice(ib, n)])[order]
            signs = np.where(order < n, 1.0, -1.0)
            for at in range(0, 2 * n, p.batch):
                k, sign = rows[at : at + p.batch], signs[at : at + p.batch]
                t += len(k)
                starts = np.cumsum(lengths[k]) - lengths[k]
                f = flat[np.arange(lengths[k].sum()) + np.repeat(ends[k] - lengths[k] - starts, lengths[k])]
                wrong = sign * scale * np.add.reduceat(w[f], starts) * norms[k] < 1
                step = len(k) / (p.regularisation * (t + 1000))
                scale *= 1 - step * p.regularisation
                np.add.at(w, f, np.repeat(np.where(wrong, sign * norms[k] * step / (len(k) * scale), 0.0), lengths[k]))
            total += scale * w
        out[:, m] = total / epochs
    return out


def train(sample: list[tuple[str, str]], p: LanguageModel) -> Machines:
    """Fit all machines; languages without a labelled document are unknown to them."""
    held = {c for c, _ in sample}
    codes = sorted(held)
    families = [[codes.index(c) for c in f if c in held] for f in FAMILIES.values()]
    families = [f for f in families if f]
    family_pairs = list(combinations(range(len(families)), 2))
    inner_pairs = [pair for f in families for pair in combinations(f, 2)]
    memo: dict[str, list[int]] = {}
    x, y, para, whole = [], [], [], []
    for code, text in sample:
        for words in filter(None, map(str.split, PARAGRAPH_BREAK.split(text))):
            for w in words:
                if w not in memo:
                    memo[w] = features(w, p.bits)
            for s in sentences_of(words):
                f = {n for w in s for n in memo[w]}
                if len(s) >= 4 and f:
                    x.append(np.array(sorted(f), np.int64))
                    y.append(codes.index(code))
                    para.append(len(whole))
            whole.append(np.array([n for w in words for n in memo[w]], np.int64))
    y, para = np.array(y, np.int64), np.array(para, np.int64)
    singles = [[i] for i in range(len(codes))]
    first = second = None
    for k in range(p.refits + 1):
        epochs = p.epochs if k == p.refits else p.epochs // 2  # earlier fits need only tell whole paragraphs apart
        first, second = _fit(x, y, families, family_pairs, epochs, first, p), _fit(x, y, singles, inner_pairs, epochs, second, p)
        w = np.concatenate([first, second], axis=1)
        m = Machines(codes, families, family_pairs, inner_pairs, w)
        if k < p.refits and len(y):
            said, _ = decide(m, np.stack([w[f].sum(axis=0) / np.sqrt(max(len(f), 1)) for f in whole]))
            y = said[para]
    return m


def decide(m: Machines, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language number and margin of each row of machine scores: family by votes (ties by margin), then the pair within it."""
    n, nf = len(scores), len(m.families)
    votes, margin = np.zeros((n, nf)), np.zeros((n, nf))
    for k, (a, b) in enumerate(m.family_pairs):
        s = scores[:, k]
        votes[:, a] += s > 0
        votes[:, b] += s < 0
        margin[:, a] += s
        margin[:, b] -= s
    spread = np.abs(margin).max(axis=1, keepdims=True) + 1e-12
    family = np.argmax(votes + 0.5 * margin / spread, axis=1)
    lang = np.array([f[0] for f in m.families], np.int64)[family] if nf else np.zeros(n, np.int64)
    sure = np.full(n, np.inf)
    for k, (a, b) in enumerate(m.family_pairs):
        mine = (family == a) | (family == b)
        sure[mine] = np.minimum(sure[mine], np.abs(scores[mine, k]))
    inner = {pair: scores[:, len(m.family_pairs) + k] for k, pair in enumerate(m.inner_pairs)}
    for f, members in enumerate(m.families):
        if len(members) < 2:
            continue
        mine = np.flatnonzero(family == f)
        wins = np.zeros((len(mine), len(members)))
        for (a, b), s in inner.items():
            if a in members:
                wins[:, members.index(a)] += s[mine] > 0
                wins[:, members.index(b)] += s[mine] <= 0
                sure[mine] = np.minimum(sure[mine], np.abs(s[mine]))
        lang[mine] = np.array(members)[np.argmax(wins, axis=1)]
    return lang, np.where(np.isfinite(sure), sure, 1.0)


SEGMENTS = "doc_id long, para_no int, segment_no int, language string, confidence double, n_words int, n_judged int"


def segment_languages(documents: DataFrame, p: LanguageModel = LanguageModel()) -> DataFrame:
    """Language and confidence of each sentence-like segment of each paragraph.

    documents: doc_id, text, lang. Paragraphs are the non-empty blocks between blank lines,
    numbered from 1. A segment with fewer than three judged words (letters only) takes the
    language of its paragraph; a paragraph without any has language null and confidence 0.
    confidence: 0.5 to 1, a logistic curve of the least margin of the machines that decided. Null or empty
    texts give no rows; without any usable label there are no machines and no rows.
    """
    spark = documents.sparkSession
    machines = train(labelled_sample(documents, p), p)
    shared = spark.sparkContext.broadcast(machines)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        if not m.codes:
            return
        number: dict[str, int] = {}
        scores = np.zeros((1024, m.weights.shape[1]), np.float32)
        n_features, ending = np.zeros(1024, np.int64), np.zeros(1024, bool)
        codes = np.array([*m.codes, None], object)
        for b in batches:
            ids, paras, per_para, flat = [], [], [], []
            for d, t in zip(b["doc_id"], b["text"]):
                if not isinstance(t, str):
                    continue
                k = 0
                for para in PARAGRAPH_BREAK.split(t):
                    words = para.split()
                    if words:
                        k += 1
                        ids.append(d)
                        paras.append(k)
                        per_para.append(len(words))
                        flat.extend(words)
            if not flat:
                continue
            if len(number) > 300_000:
                number = {}
            at = np.empty(len(flat), np.int64)
            for i, w in enumerate(flat):
                n = number.get(w)
                if n is None:
                    n = number[w] = len(number)
                    if n >= len(scores):
                        scores = np.concatenate([scores, np.zeros_like(scores)])
                        n_features, ending = np.concatenate([n_features, n_features]), np.concatenate([ending, ending])
                    f = features(w, p.bits)
                    n_features[n], ending[n] = len(f), w[-1] in ".!?:;"
                    scores[n] = m.weights[f].sum(axis=0) if f else 0
                at[i] = n
            lengths = np.array(per_para)
            last = np.cumsum(lengths) - 1
            stop = ending[at].copy()
            stop[last] = True
            starts = np.concatenate(([0], np.flatnonzero(stop)[:-1] + 1))
            of_word, nf = scores[at], n_features[at]
            sums, judged = np.add.reduceat(of_word, starts, axis=0), np.add.reduceat((nf > 0).astype(np.int64), starts)
            n_words = np.diff(np.append(starts, len(at)))
            para = np.searchsorted(last, starts)
            p_starts = np.concatenate(([0], last[:-1] + 1))
            p_sums, p_judged = np.add.reduceat(of_word, p_starts, axis=0), np.add.reduceat((nf > 0).astype(np.int64), p_starts)
            lang, sure = decide(m, sums / np.sqrt(np.maximum(np.add.reduceat(nf, starts), 1))[:, None])
            p_lang, p_sure = decide(m, p_sums / np.sqrt(np.maximum(np.add.reduceat(nf, p_starts), 1))[:, None])
            short = judged < 3
            lang, sure = np.where(short, p_lang[para], lang), np.where(short, p_sure[para], sure)
            none = p_judged[para] == 0
            lang, sure = np.where(none, len(m.codes), lang), np.where(none, 0.0, sure)
            first = np.concatenate(([True], para[1:] != para[:-1]))
            seg_no = np.arange(len(para)) - np.maximum.accumulate(np.where(first, np.arange(len(para)), 0)) + 1
            conf = np.where(none, 0.0, 1 / (1 + np.exp(-2 * sure)))
            yield pd.DataFrame({"doc_id": np.array(ids, np.int64)[para], "para_no": np.array(paras, np.int32)[para], "segment_no": seg_no.astype(np.int32), "language": codes[lang], "confidence": conf.astype(float), "n_words": n_words.astype(np.int32), "n_judged": judged.astype(np.int32)})

    return documents.filter("doc_id is not null").select("doc_id", "text").mapInPandas(run, SEGMENTS)


def _majority(segments: DataFrame, by: list[str]) -> DataFrame:
    """The language of most words per group (ties: higher confidence, then code), its confidence and share."""
    per = segments.groupBy(*by, "language").agg(F.sum("n_words").alias("w"), (F.sum(F.col("confidence") * F.col("n_words")) / F.sum("n_words")).alias("c"))
    best = F.max(F.struct(F.col("language").isNotNull().alias("known"), "w", "c", "language")).alias("best")
    return per.groupBy(*by).agg(best, F.sum("w").cast("int").alias("n_words"), F.count(F.lit(1)).alias("n_languages")).select(
        *by, F.col("best.language").alias("language"), (F.col("best.c") * F.col("best.w") / F.col("n_words")).alias("confidence"), (F.col("best.w") / F.col("n_words")).alias("share"), "n_words", "n_languages"
    )


def paragraph_languages(documents: DataFrame, p: LanguageModel = LanguageModel()) -> DataFrame:
    return _majority(segment_languages(documents, p), ["doc_id", "para_no"])


def document_languages(documents: DataFrame, p: LanguageModel = LanguageModel()) -> DataFrame:
    return _majority(segment_languages(documents, p), ["doc_id"])


def mislabelled_paragraphs(documents: DataFrame, p: LanguageModel = LanguageModel()) -> DataFrame:
    """Paragraphs of at least least_words words whose language is not the one the label names.

    A label that is null, empty or names no known language names none: all such paragraphs of the
    document come out. Paragraphs without a judged word do not. Null ids and texts give no rows, equal rows
    one; other columns are ignored; texts are read in full, however long.
    """
    labels = documents.filter("doc_id is not null").select("doc_id", named_language(F.col("lang")).alias("named")).distinct()
    paras = paragraph_languages(documents, p).filter((F.col("n_words") >= p.least_words) & F.col("language").isNotNull())
    return paras.join(labels, "doc_id").filter(F.col("named").isNull() | (F.col("named") != F.col("language"))).select("doc_id", "para_no", "language", "confidence").distinct()
