"""Free-entered values to the labels of a closed list.

A symmetric-delete dictionary holds, for each known form of a label, all strings that arise by
a bounded number of deletions; a value's own deletions meet it there, so that every form within
that many edits is retrieved. Candidates are ranked by weighted Damerau-Levenshtein distance
and by how often their label occurs as written in the data. A second dictionary of the same kind
holds the words of the forms, with their prefixes as abbreviations; where no form is near as a whole, the
forms that share a word with the value are ranked by weighted Damerau-Levenshtein distance over
words, in which function words, qualifiers and numbers cost little. The rest is UNMATCHED.

Both dictionaries grow with the closed list only (its size is checked) and are sent to all
executors; values are resolved where the rows lie, so no value, however frequent, moves.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedgeline.runtime import bounded_rows

UNMATCHED = "UNMATCHED"

# English function words and negations, which do not tell labels apart.
FUNCTION_WORDS = {"a", "an", "the", "of", "or", "and", "in", "to", "by", "for", "from", "on", "at", "as", "be", "is", "was", "do", "does", "not", "no", "nil", "with", "behalf"}
# After these words a value says more about its head.
PREPOSITIONS = {"to", "by", "for", "from", "on", "at", "as", "with"}
# Endings that make another form of the same word.
ENDINGS = {"s", "es", "d", "ed", "ing", "ly", "ially", "al", "er", "or", "ers", "ors"}
# Placeholders, which mean no label.
PLACEHOLDERS = {"nil", "none", "unknown", "na", "tbc", "pending", "yes", "no", "not recorded"}


@dataclass(frozen=True)
class ValueMapping:
    """most_edits: deletions on either side of the dictionaries. most_forms: bound of the broadcast list.
    other_names: further names, label -> names, beside those of the list. word_limit: greatest distance over
    words per word in common. frequency_weight: how much a rare label counts against a frequent one."""

    most_edits: int = 2
    most_forms: int = 200_000
    other_names: dict = field(default_factory=dict)
    word_limit: float = 0.75
    frequency_weight: float = 0.1


def folded(value: str) -> str:
    """Lower case without accents; list marks, quotes, punctuation and remarks in digits dropped."""
    v = unicodedata.normalize("NFKD", value)
    v = "".join(ch for ch in v if not unicodedata.combining(ch)).lower().strip()
    v = re.sub(r"^\(?\d{1,3}[.)]\s+", "", v)
    v = re.sub(r"\(\s*\d{1,3}\s*\)\s*\W*$", "", v)
    v = re.sub(r"(?<=\b\w)[./](?=\w\b)", "", v)  # initials: t.d. and t/d -> td
    return " ".join(re.findall(r"[^\W_]+", v))


def deletions(s: str, k: int) -> set[str]:
    """s without any 0 to k of its characters."""
    out = {s}
    for n in range(1, min(k, len(s)) + 1):
        out |= {"".join(ch for i, ch in enumerate(s) if i not in gone) for gone in map(set, combinations(range(len(s)), n))}
    return out


def weighted_distance(a: str, b: str) -> float:
    """Damerau-Levenshtein distance in which likely slips cost less: a doubled or halved letter
    0.6, a swap of neighbours 0.7, a space too many or too few 0.4; other edits cost 1."""
    def drop(s: str, i: int) -> float:
        if s[i] == " ":
            return 0.4
        return 0.6 if i and s[i - 1] == s[i] else 1.0

    rows = [[0.0]]
    for j in range(len(b)):
        rows[0].append(rows[0][-1] + drop(b, j))
    for i in range(len(a)):
        row, new = rows[-1], [rows[-1][0] + drop(a, i)]
        for j in range(len(b)):
            best = min(row[j] + (0.0 if a[i] == b[j] else 1.0), row[j + 1] + drop(a, i), new[j] + drop(b, j))
            if a[i] != b[j] and i and j:  # neighbours swapped, also with one letter lost or added between them
                if a[i] == b[j - 1] and a[i - 1] == b[j]:
                    best = min(best, rows[i - 1][j - 1] + 0.7)
                if i > 1 and a[i] == b[j - 1] and a[i - 2] == b[j]:
                    best = min(best, rows[i - 2][j - 1] + 1.7)
                if j > 1 and a[i] == b[j - 2] and a[i - 1] == b[j]:
                    best = min(best, rows[i - 1][j - 2] + 1.7)
            new.append(best)
        rows.append(new)
    return rows[-1][-1]


def alternatives(form: str) -> set[str]:
    """A form, and if it reads `A or B C`, also A, B C and A C."""
    left, _, right = form.partition(" or ")
    if not right:
        return {form}
    return {form, left, right} | ({f"{left} {right.split(' ', 1)[1]}"} if " " in right else set())


@dataclass(frozen=True)
class Token:
    """A word of a value: marked if written as an abbreviation (`sol.`, `w/d`), aside if it only qualifies the rest."""

    word: str
    marked: bool
    aside: bool


def tokens(value: str) -> list[Token]:
    """The words of a value that are no function words; what stands in brackets or behind a preposition is aside."""
    out, aside = [], False
    for piece in re.findall(r"\(|\)|[^\s()]+", re.sub(r"\s*/\s+|\s+/\s*", " ", value)):
        if piece in "()":
            aside = piece == "("
            continue
        for w in folded(piece).split():
            if w in FUNCTION_WORDS:
                aside = aside or (w in PREPOSITIONS and bool(out))
            else:
                out.append(Token(w, bool(re.search(r"\w[./](\w\b|\W*$)", piece)), aside))
    return out


class Words:
    """The words of all forms of a field: those a value's word may stand for, with what that costs."""

    def __init__(self, words: set[str], most_edits: int):
        self.words, self.most_edits = words, most_edits
        self.index, self.prefixes, self.first = defaultdict(set), defaultdict(set), defaultdict(set)
        for w in words:
            for d in deletions(w, self._edits(w)):
                self.index[d].add(w)
            for n in range(1, len(w)):
                self.prefixes[w[:n]].add(w)
            self.first[w[0]].add(w)
        self.longest = max(map(len, words), default=0)
        self.memo: dict[tuple[str, bool], dict[str, tuple[float, bool]]] = {}

    def _edits(self, w: str) -> int:
        return 0 if len(w) < 5 else min(1 if len(w) < 8 else 2, self.most_edits)

    def __call__(self, t: Token) -> dict[str, tuple[float, bool]]:
        """word -> (cost, whether it needs another word of its form beside it)."""
        got = self.memo.get((t.word, t.marked))
        if got is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            got = self.memo[t.word, t.marked] = self._meant(t.word, t.marked)
        return got

    def _meant(self, w: str, marked: bool) -> dict[str, tuple[float, bool]]:
        out: dict[str, tuple[float, bool]] = {}

        def add(x: str, cost: float, beside: bool = False) -> None:
            if x not in out or (cost, beside) < out[x]:
                out[x] = (cost, beside)

        if len(w) <= self.longest + self.most_edits:
            for d in deletions(w, self.most_edits):
                for x in self.index.get(d, ()):
                    if (edits := weighted_distance(w, x)) <= self._edits(x):
                        add(x, edits / len(x))
            for x in self.prefixes.get(w, ()):  # an abbreviation; a short one needs its dot or a companion
                add(x, 0.2 if len(w) > 2 else 0.3, len(w) < 4 and not (marked and len(w) > 2))
            if 5 < len(w) <= self.longest:  # a clipped word with one letter more or other
                for d in deletions(w, 1):
                    for x in self.prefixes.get(d, ()) if len(d) > 4 else ():
                        add(x, 0.2 + 1 / len(w))
            if 1 < len(w) < 5 and not re.search("[aeiou]", w[1:]):  # letters left out: mbr, w/d
                for x in self.first.get(w[0], ()):
                    if _in_order(w, x):
                        add(x, 0.25, not marked)
        for n in range(4, len(w)):
            if w[n:] in ENDINGS or (w[n - 1] == w[n] and w[n + 1 :] in ENDINGS):
                if w[:n] in self.words:
                    add(w[:n], 0.2)
        return out


def _in_order(letters: str, word: str) -> bool:
    at = iter(word)
    return all(x in at for x in letters)


class Resolver:
    """Resolves the values of one field."""

    def __init__(self, forms: dict[str, list[str]], frequency: dict[str, int], p: ValueMapping):
        self.p, self.labels = p, set(forms)
        most = math.log1p(max(frequency.values(), default=0)) or 1.0
        self.rarity = {label: p.frequency_weight * (1 - math.log1p(frequency.get(label, 0)) / most) for label in forms}
        self.form_labels: dict[str, set[str]] = defaultdict(set)
        self.index: dict[str, set[str]] = defaultdict(set)
        own: dict[str, set[str]] = defaultdict(set)
        self.parts: list[tuple[str, list[str]]] = []  # label, content words of a form
        for label, names in forms.items():
            for n in {x for n in names for x in alternatives(n)}:
                f = folded(n)
                if f:
                    self.form_labels[f].add(label)
                words = [t.word for t in tokens(n)]
                if words and (label, words) not in self.parts:
                    self.parts.append((label, words))
                for w in words:
                    own[w].add(label)
        self.only = {w for w, labels in own.items() if len(labels) == 1}
        self.words = Words(set(own), p.most_edits)
        self.with_word: dict[str, list[int]] = defaultdict(list)
        for k, (_, words) in enumerate(self.parts):
            for w in set(words):
                self.with_word[w].append(k)
        for f in self.form_labels:
            for d in deletions(f, self._edits(f)):
                self.index[d].add(f)
        self.longest = max(map(len, self.form_labels), default=0)
        self.memo: dict[str, str] = {}

    def _edits(self, f: str) -> int:
        return 0 if len(f) <= 3 else min(1, self.p.most_edits) if len(f) <= 5 else self.p.most_edits

    def __call__(self, value: str) -> str:
        got = self.memo.get(value)
        if got is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            got = self.memo[value] = self._resolve(value)
        return got

    def _resolve(self, value: str) -> str:
        tries = [value, re.split(r"\s+[-–]\s+|\s*[*;]", value)[0], value.replace(" ", ""), *re.split(r"\s*/\s*", value)[:1]]
        whole = folded(value)
        if whole in PLACEHOLDERS or not any(ch.isalpha() for ch in whole):
            return UNMATCHED
        for t in dict.fromkeys(folded(t) for t in tries if t):
            label = self._nearest(t)
            if label:
                return label
        return self._by_words(tokens(value)) or UNMATCHED

    def _nearest(self, v: str) -> str | None:
        """The label of the nearest form as a whole. Longer values than any form and its edits have none."""
        if v in self.form_labels:
            return self._often(self.form_labels[v])
        if v.replace(" ", "") in self.form_labels and len(v) <= 5:
            return self._often(self.form_labels[v.replace(" ", "")])
        if len(v) < 4 or len(v) > self.longest + self.p.most_edits:
            return None
        near = {f for d in deletions(v, self.p.most_edits) for f in self.index.get(d, ())}
        ranked = []
        for f in near:
            distance = weighted_distance(v, f)
            if distance <= self._edits(f) and distance <= 0.34 * len(f):
                label = self._often(self.form_labels[f])
                ranked.append((distance + self.rarity[label], distance, label))
        return min(ranked)[2] if ranked else None

    def _often(self, labels: set[str]) -> str:
        return min(labels, key=lambda x: (self.rarity[x], x))

    def _by_words(self, value: list[Token]) -> str | None:
        meant = [self.words(t) for t in value]
        forms = {k for m in meant for w in m for k in self.with_word[w]}
        ranked = []
        for k in forms:
            label, words = self.parts[k]
            distance, matched = self._word_distance(value, meant, words)
            if matched and distance <= self.p.word_limit * matched:
                ranked.append((distance + self.rarity[label], label))
        return min(ranked)[1] if ranked else None

    def _word_distance(self, value: list[Token], meant: list[dict], form: list[str]) -> tuple[float, int]:
        """(weighted Damerau-Levenshtein distance over words, words in common).

        A word too many costs 0.5, 0.2 aside, 0.1 with a digit; a word of the form left out 1, or 0.5 if what
        stands is of this label only; neighbours swapped 0.2; a word that needs another beside it counts only with it.
        """
        best = None
        for alone in (False, True):  # with words that need a companion, and without
            cost = lambda i, j: c[0] if (c := meant[i].get(form[j])) and not (alone and c[1]) else None  # noqa: B023, E731
            extra = [0.1 if any(ch.isdigit() for ch in t.word) else 0.2 if t.aside else 0.5 for t in value]
            rows = [[(float(j), 0, ()) for j in range(len(form) + 1)]]
            for i in range(len(value)):
                row = [(rows[-1][0][0] + extra[i], rows[-1][0][1], rows[-1][0][2])]
                for j in range(len(form)):
                    ways = [(rows[-1][j + 1][0] + extra[i], *rows[-1][j + 1][1:]), (row[j][0] + 1.0, *row[j][1:])]
                    if (c1 := cost(i, j)) is not None:
                        d, n, held = rows[-1][j]
                        ways.append((d + c1, n + 1, (*held, j)))
                    if i and j and (c1 := cost(i, j - 1)) is not None and (c2 := cost(i - 1, j)) is not None:
                        d, n, held = rows[-2][j - 1]
                        ways.append((d + c1 + c2 + 0.2, n + 2, (*held, j - 1, j)))
                    row.append(min(ways, key=lambda x: (x[0], -x[1])))
                rows.append(row)
            d, n, held = rows[-1][-1]
            if n and any(form[j] in self.only for j in held):
                d -= 0.5 * (len(form) - n)
            if n > 1 or alone:
                return d, n
            best = best or (d, n)
        return best


def mapped_values(rows: DataFrame, key: str, fields: list[str], reference: DataFrame, p: ValueMapping = ValueMapping()) -> DataFrame:
    """key, field_name, value, label: each non-blank value that is not exactly a label of its field.

    rows: a key and the named string columns; reference: field_name, label, also_known_as
    (array of strings, may be null). label is the label meant, or UNMATCHED. Null and blank
    values and null keys give no rows; repeated rows are repeated. An empty list gives UNMATCHED throughout.
    """
    spark = rows.sparkSession
    forms: dict[str, dict[str, list[str]]] = {f: {} for f in fields}
    for r in bounded_rows(reference.filter(F.col("field_name").isin(fields) & F.col("label").isNotNull()).select("field_name", "label", "also_known_as"), p.most_forms, "closed list"):
        names = forms[r[0]].setdefault(r[1], [])
        names += [r[1], *(x for x in r[2] or [] if x), *p.other_names.get(r[1], [])]
    as_written = F.lit(False)
    for f in fields:
        as_written = as_written | ((F.col("field_name") == f) & F.col("value").isin(list(forms[f])))
    cells = rows.select(F.col(key).alias("id"), F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields]))).filter("id is not null and value is not null and trim(value) <> ''")
    frequency = {(r[0], r[1]): r[2] for r in cells.filter(as_written).groupBy("field_name", "value").count().collect()}
    shared = spark.sparkContext.broadcast((forms, frequency))

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, freq = shared.value
        known = {f: Resolver(x, {label: freq.get((f, label), 0) for label in x}, p) for f, x in held.items()}
        for b in batches:
            b["label"] = pd.Series([known[f](v) for f, v in zip(b["field_name"], b["value"])], index=b.index, dtype=object)
            yield b

    return cells.filter(~as_written).mapInPandas(resolve, f"id {cells.schema['id'].dataType.simpleString()}, field_name string, value string, label string").withColumnRenamed("id", key)
