"""Parent-child rows to full trees by tree contraction (leaf raking, chain compression)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedgeline.runtime import cut


def tree_paths(nodes: DataFrame, key: str, parent: str, most_rounds: int = 400, core: int = 2_000) -> DataFrame:
    """Root, depth and path of every node; circles and what hangs below them are marked.

    nodes: one row per key (null keys and repeated rows are dropped; of several parents of a
    key the smallest holds). A parent that is null or not a key makes a root.

    Contraction: each round rakes all leaves and splices out an independent set of the
    nodes with one child (a node is taken when its coin shows heads and its parent's
    tails), so chains shorten by a constant share a round and the rounds are logarithmic in
    the nodes, however deep the trees. Edges carry the ids they pass over and their least
    id. What can't be raked contracts to a node that is its own parent: a circle. Once at most `core` nodes
    with a parent are left, one task contracts these to the end. The
    recorded contractions are then undone in reverse order, each round by one join with its parents.

    Other columns are ignored. An empty table gives no rows.

    Returns key, root, depth, path; on and below a circle root is the least id on the
    circle, depth -1 and path `cycle`.
    """
    ids = nodes.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("v")).agg(F.min(parent).alias("p"))
    known = ids.select(F.col("v").alias("p"), F.lit(True).alias("_known"))
    live = cut(ids.join(known, "p", "left").select(
        "v", F.when(F.col("_known"), F.col("p")).alias("p"), F.col("v").cast("string").alias("label"), F.col("v").alias("least"), F.lit(0).alias("round")
    ))
    recorded: list[DataFrame] = []
    coin = lambda c: F.pmod(F.xxhash64(c, F.col("round")), F.lit(2))
    for _ in range(most_rounds):
        if live.filter("p is not null and p <> v").limit(core + 1).count() <= core:
            break
        children = live.filter("p is not null").groupBy(F.col("p").alias("v")).agg(F.count(F.lit(1)).alias("_n"), F.min("v").alias("_child"))
        spliced = (F.col("_n") == 1) & F.col("p").isNotNull() & (F.col("p") != F.col("v")) & (F.col("_child") != F.col("v")) & (coin(F.col("v")) == 1) & (coin(F.col("p")) == 0)
        marked = live.join(children, "v", "left").select("v", "p", "label", "least", "round", F.when(F.col("p").isNotNull() & F.col("_n").isNull(), "leaf").when(spliced, "spliced").otherwise("live").alias("state"))
        gone = marked.filter("state = 'spliced'").select(F.col("v").alias("p"), F.col("p").alias("_up"), F.col("label").alias("_above"), F.col("least").alias("_least"))
        moved = F.col("_up").isNotNull()  # the parent goes: the node, leaf or not, hangs on the parent's parent
        tagged = cut(marked.join(gone, "p", "left").select(
            "v",
            F.coalesce("_up", "p").alias("p"),
            F.when(moved, F.concat_ws("/", "_above", "label")).otherwise(F.col("label")).alias("label"),
            F.when(moved, F.least("_least", "least")).otherwise(F.col("least")).alias("least"),
            "state",
            (F.col("round") + 1).alias("round"),  # a column, not a literal: all rounds share their generated code
        ))
        recorded.append(tagged.filter("state <> 'live'").select("v", "p", "label"))
        live = tagged.filter("state = 'live'").drop("state")
    else:
        raise RuntimeError(f"contraction did not end within {most_rounds} rounds")
    done = cut(_contracted_core(live))
    for tagged in reversed(recorded):
        above = done.select(F.col("v").alias("p"), "root", F.col("depth").alias("_depth"), F.col("path").alias("_path"))
        good = F.col("_depth") >= 0
        below = tagged.join(above, "p").select(
            "v",
            "root",
            F.when(good, F.col("_depth") + F.size(F.split("label", "/"))).otherwise(-1).cast("int").alias("depth"),
            F.when(good, F.concat_ws("/", "_path", "label")).otherwise(F.lit("cycle")).alias("path"),
        )
        done = cut(done.unionByName(below))
    return done.select(F.col("v").alias(key), "root", "depth", "path")


def _contracted_core(live: DataFrame) -> DataFrame:
    """Root, depth and path of what is left: roots where they lie; the few nodes with a parent, and the roots they
    name, in one task, which splices every chain to its end."""
    kind = live.schema["v"].dataType.simpleString()
    roots = live.filter("p is null").select("v", F.col("v").alias("root"), F.lit(0).alias("depth"), F.col("v").cast("string").alias("path"))

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        rows = pd.concat(parts)
        edge = {v: (p, label, least) for v, p, label, least in zip(rows["v"], rows["p"], rows["label"], rows["least"])}
        found: dict = {}
        for start in edge:
            chain, at = [], start
            while at in edge and at not in found:
                found[at] = None  # on the way
                chain.append(at)
                at = edge[at][0]
            if at in edge and found[at] is None:  # the chain met itself
                ring = chain[chain.index(at) :]
                found[at] = (min(edge[v][2] for v in ring), -1, "cycle")
            root, depth, path = found.get(at) or (at, 0, str(at))
            for v in reversed(chain):
                if depth >= 0:
                    depth, path = depth + edge[v][1].count("/") + 1, f"{path}/{edge[v][1]}"
                found[v] = (root, depth, path)
        yield pd.DataFrame([(v, *x) for v, x in found.items()], columns=["v", "root", "depth", "path"])

    inner = live.filter("p is not null").select("v", "p", "label", "least").coalesce(1).mapInPandas(ends, f"v {kind}, root {kind}, depth int, path string")
    return roots.unionByName(inner)


def tree_descendants(paths: DataFrame, key: str) -> DataFrame:
    """All (ancestor, descendant, distance) pairs, from the paths of tree_paths().

    The rows of a large tree stay spread over the partitions of its descendants. Nodes on or
    below circles have no ancestors here.
    """
    steps = paths.filter("depth > 0").select(F.col(key).alias("descendant"), "depth", F.posexplode(F.split("path", "/")).alias("pos", "ancestor"))
    return steps.filter(F.col("pos") < F.col("depth")).select(F.col("ancestor").cast("bigint").alias("ancestor"), F.col("descendant").cast("bigint").alias("descendant"), (F.col("depth") - F.col("pos")).alias("distance"))
