"""Connected components of a graph given as pairs.

Pairs are united within bounded batches first, a partial sum of a kind: what remains of a batch is one pair for each node that has
a smaller one. Then alternating stars run over the remaining pairs: every step keeps, for each node, only the pair with its smallest neighbour
and hangs the other neighbours on that one; the pairs never outnumber the input's, and no neighbour list is gathered. The number of
steps grows with the logarithm of the size. Once (or if) no more than FEW pairs are left, one batch holds them all and unites
them at once; the components are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import discard, stored

#: Pairs of a batch: 2 MB.
FEW = 1 << 17


def united(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest node reachable, node) of every node that has a smaller one."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[moved]], nodes[moved]


def _unite(few: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0

        def out() -> pa.RecordBatch:
            a, b = united(*(np.concatenate([w[i] for w in waiting]) for i in range(2)))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        for batch in batches:
            if batch.num_rows:
                waiting.append([batch.column(c).to_numpy() for c in ("a", "b")])
                held += batch.num_rows
            if held >= max(few, 1):
                yield out()
                waiting, held = [], 0
        if held:
            yield out()
    return run


def _large_star(pairs: DataFrame) -> DataFrame:
    """Hangs every greater neighbour of a node on the smallest of the node and its neighbours."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")  # repeats go in the small star


def _small_star(pairs: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of them. pairs: a < b."""
    least = pairs.groupBy("b").agg(F.min("a").alias("m"))
    hung = pairs.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a < b")
    return hung.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def _are_stars(pairs: DataFrame) -> bool:
    """No node is both above and below, and none hangs on two."""
    sides = pairs.select(F.col("a").alias("node"), F.lit(0).alias("hung")).unionByName(pairs.select(F.col("b").alias("node"), F.lit(1).alias("hung")))
    seen = sides.groupBy("node").agg(F.sum("hung").alias("n"), F.min("hung").alias("least"))
    return seen.filter("n > 1 or n = 1 and least = 0").isEmpty()


def components(pairs: DataFrame, few: int = FEW) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that occurs in `pairs` (a, b).

    Nulls are no nodes; pairs of a node with itself, either order and repeats are allowed. No pairs: no rows.
    """
    pairs = pairs.filter("a is not null and b is not null and a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    pairs = stored(pairs.mapInArrow(_unite(few), "a long, b long"), "stars")
    while pairs.count() > few:
        if _are_stars(pairs):
            break
        before, pairs = pairs, stored(_small_star(_large_star(pairs)), "stars")
        discard(before)
    else:
        before, pairs = pairs, stored(pairs.coalesce(1).mapInArrow(_unite(few + 1), "a long, b long"), "stars")  # `few` pairs at most
        discard(before)
    out = pairs.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        pairs.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
    out = stored(out, "components")
    discard(pairs)
    return out
