"""Texts into packs of fixed token capacity, by vector bin packing.

Each text is a vector: its tokens of a public tokenizer, one segment, and its loss-bearing tokens (those
after the first paragraph, which stands for the instruction). A pack limits all three. Packs are filled one
after another: of the items that still fit, the one whose demand has the greatest dot product
with what is left of the pack (both as shares of the limits, weighted by total demand) is
added. A text is cut only where it alone exceeds a limit: pieces as long as the limits let them be, then the rest.

Texts are packed in the task that reads them, `block` items at a time; items of packs that are
not yet well filled go on to the next block, for `patience` blocks at most. Nothing is shuffled or collected, and a task
leaves at most about one pack per capacity poorly filled for want of items.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedgeline.runtime import bounded_rows

# Fixed value: how the byte-level vocabularies split a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FIRST_BREAK = re.compile(r"[^\S\r\n]*(?:\r\n|\r|\n)[^\S\r\n]*(?:\r\n|\r|\n)")

_ENCODINGS: dict = {}


@dataclass(frozen=True)
class Packing:
    """tokenizer: a file of byte-level BPE ranks, read on the driver. tokens_per_segment: a pack of c tokens holds at most
    c / tokens_per_segment segments. loss_share: and at most this share of c in loss-bearing tokens
    (1.0: no limit beyond c itself).
    block: items that a task packs at a time. full: share of the tokens, the segments or the loss-bearing tokens from which a pack is
    closed in its block. patience: blocks an item waits for a better pack."""

    tokenizer: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    tokens_per_segment: int = 32
    loss_share: float = 1.0
    block: int = 4096
    full: float = 0.97
    patience: int = 3


def ranks_of(path: str) -> dict[bytes, int]:
    """The ranks of a tokenizer, by its file; a few megabytes at most."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encoding(name: str, ranks: Callable[[], dict[bytes, int]] | None = None):
    """The tokenizer of that name; a worker builds it once, from its ranks, by default from the file of that name."""
    if name not in _ENCODINGS:
        import tiktoken

        _ENCODINGS[name] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks() if ranks else ranks_of(name), special_tokens={})
    return _ENCODINGS[name]


def measured(enc, text: str) -> tuple[int, int]:
    """(tokens of a text, tokens of its first paragraph). The break begins a token of its own, so
    the text can be encoded in two parts."""
    cut = FIRST_BREAK.search(text)
    if not cut or not cut.start():
        return len(enc.encode_ordinary(text)), 0
    prompt = len(enc.encode_ordinary(text[: cut.start()]))
    return prompt + len(enc.encode_ordinary(text[cut.start() :])), prompt


def pack_block(demand: np.ndarray, limits: np.ndarray) -> list[np.ndarray]:
    """Items (rows of demand) into packs within limits, by the dot-product heuristic.

    Every item must fit an empty pack. Equal scores go to the earlier item.
    """
    share = demand / limits
    weight = share.sum(axis=0) / max(share.sum(), 1e-12)
    order = np.argsort(-share[:, 0], kind="stable")
    share = share[order]
    left = np.ones(len(share), bool)
    packs: list[np.ndarray] = []
    first = 0
    while first < len(share):
        free, held = np.ones(len(limits)), []
        while True:
            # tokens fall along the order, so what can still fit begins at one place
            at = max(first, int(np.searchsorted(-share[:, 0], -(free[0] + 1e-12))))
            fits = left[at:] & (share[at:] <= free + 1e-12).all(axis=1)
            if not fits.any():
                break
            score = np.where(fits, share[at:] @ (weight * free), -1.0)
            k = at + int(np.argmax(score))
            held.append(k)
            left[k] = False
            free = free - share[k]
        packs.append(order[np.array(held)])
        while first < len(share) and not left[first]:
            first += 1
    return packs


SCHEMA = "pack_id int, capacity_tokens int, pack_no long, position int, doc_id long, piece_no int, first_token long, n_tokens int, n_loss int"


def packed_texts(documents: DataFrame, sizes: DataFrame, p: Packing = Packing()) -> DataFrame:
    """One row per piece and pack size: which pack holds it, where, and which tokens it is.

    documents: doc_id, text. sizes: pack_id, capacity_tokens. Null keys, and texts that are null or have no
    token, are in no pack; sizes that are null or below one token are left out. Repeated rows are
    packed as often as they occur. pack_no is unique within a size, not consecutive.
    """
    capacities = sorted({(r[0], r[1]) for r in bounded_rows(sizes.select("pack_id", "capacity_tokens").filter("pack_id is not null and capacity_tokens > 0"), 1000, "pack sizes")})

    ranks = sizes.sparkSession.sparkContext.broadcast(ranks_of(p.tokenizer))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(p.tokenizer, lambda: ranks.value)
        base = TaskContext.get().partitionId() << 32
        packers = [_Packer(i, c, base, p) for i, c in capacities]
        for b in batches:
            items = [(d, *measured(enc, t)) for d, t in zip(b["doc_id"], b["text"]) if isinstance(t, str) and t]
            for x in packers:
                yield from x.add(items)
        for x in packers:
            yield from x.end()

    return documents.filter("doc_id is not null").select("doc_id", "text").mapInPandas(run, SCHEMA)


def pieces(n: int, prompt: int, capacity: int, most_loss: int) -> Iterator[tuple[int, int, int]]:
    """(first token, tokens, loss-bearing tokens) of the pieces of a text of n tokens, of which the first `prompt` bear no loss."""
    first = 0
    while first < n:
        free = max(0, prompt - first)
        size = min(capacity, n - first, free + most_loss)
        yield first, size, max(0, size - free)
        first += size


class _Packer:
    """Packs the items of one task for one capacity."""

    def __init__(self, pack_id: int, capacity: int, base: int, p: Packing):
        self.pack_id, self.c, self.next, self.p = pack_id, capacity, base, p
        self.limits = np.array([capacity, max(1, capacity // p.tokens_per_segment), max(1, int(p.loss_share * capacity))], float)
        self.fresh = 0  # items since the last block
        self.waiting: list[tuple] = []  # document, piece, first token, tokens, loss-bearing tokens, blocks waited

    def add(self, items: list[tuple[int, int, int]]) -> Iterator[pd.DataFrame]:
        for d, n, prompt in items:
            new = [(d, k, *x, 0) for k, x in enumerate(pieces(n, prompt, self.c, int(self.limits[2])))]
            self.waiting += new
            self.fresh += len(new)
            if self.fresh >= self.p.block:
                self.fresh = 0
                yield self._pack(last=False)

    def end(self) -> Iterator[pd.DataFrame]:
        if self.waiting:
            yield self._pack(last=True)

    def _pack(self, last: bool) -> pd.DataFrame:
        items, self.waiting, out = self.waiting, [], []
        demand = np.array([(n, 1, loss) for _, _, _, n, loss, _ in items], float)
        for held in pack_block(demand, self.limits):
            good = (demand[held].sum(axis=0) >= self.p.full * self.limits).any()
            if not last and not good and all(items[i][5] < self.p.patience for i in held):
                self.waiting += [(*items[i][:5], items[i][5] + 1) for i in held]
                continue
            for position, i in enumerate(held):
                d, piece, first, n, loss, _ = items[i]
                out.append((self.pack_id, self.c, self.next, position, d, piece, first, n, loss))
            self.next += 1
        return pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])


def pack_fill(packed: DataFrame, loss_share: float = 1.0) -> DataFrame:
    """Per size: packs, tokens, share of the space that is filled, the least packs any packing needs by tokens or by
    loss-bearing tokens, and the most tokens, segments and loss-bearing tokens that a pack holds."""
    packs = packed.groupBy("pack_id", "capacity_tokens", "pack_no").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("s"), F.sum("n_loss").alias("l"))
    most_loss = F.floor(F.col("capacity_tokens") * loss_share)
    return packs.groupBy("pack_id", "capacity_tokens").agg(
        F.count(F.lit(1)).alias("n_packs"), F.sum("t").alias("n_tokens"), F.sum("l").alias("n_loss"), F.max("t").alias("most_tokens"), F.max("s").alias("most_segments"), F.max("l").alias("most_loss")
    ).withColumn("fill", F.col("n_tokens") / (F.col("n_packs") * F.col("capacity_tokens"))).withColumn("least_packs", F.greatest(F.ceil(F.col("n_tokens") / F.col("capacity_tokens")), F.ceil(F.col("n_loss") / most_loss)))
