"""Neighbours and running totals in long ordered groups.

A window over one group is one task. These operators give the same results, but a group of more than
`limit` rows (one busy camera, one busy counter) is first cut into consecutive pieces that are handled
by different tasks and then stitched through one small row per piece. The cut points are the order
values with certain hashes, so they depend on the data alone and a recomputed task finds the same ones.

The tables that are broadcast hold a handful of entries per `limit` rows of input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIMIT = 4_000_000
PIECES = 1024
STEP = 32


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for key in keys:
        on = on & left[key].eqNullSafe(right["_r_" + key])
    return on


def _attach(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a small table on null-safe keys; the key columns of the small side are dropped."""
    small = small.withColumnsRenamed({k: "_r_" + k for k in keys})
    return df.join(F.broadcast(small), _same(df, small, keys), how).drop(*["_r_" + k for k in keys])


def split_long_groups(df: DataFrame, keys: Sequence[str], order: str, limit: int = LIMIT,
                      pieces: int = PIECES) -> DataFrame:
    """Add `_long` (group has more than `limit` rows) and `_piece` (0 for other groups).

    Pieces are consecutive ranges of the integer column `order`; rows that share an order value share a piece.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    # four cut points per `limit` rows: pieces between random cut points vary in size
    stride = F.greatest(F.ceil(F.col("_n") / pieces), F.lit(max(1, limit // 4))).cast("long")
    picked = _attach(df.select(*keys, order), counts, keys, "inner").filter(
        F.pmod(F.xxhash64(F.col(order)), stride) == 0)
    cuts = picked.groupBy(*keys).agg(F.sort_array(F.collect_set(order)).alias("_cuts"))
    # counting the cut points up to a value: first by every 32nd of them, then among the next 32
    below = lambda cuts: F.size(F.filter(cuts, lambda c: c <= F.col(order)))
    top = below("_tops") * STEP
    piece = top + below(F.slice("_cuts", top + 1, F.lit(STEP)))
    cuts = cuts.withColumn("_tops", F.filter("_cuts", lambda c, i: i % STEP == STEP - 1))
    return (_attach(df, cuts, keys)
            .withColumn("_long", F.col("_cuts").isNotNull())
            .withColumn("_piece", F.when(F.col("_long"), piece).otherwise(F.lit(0)))
            .drop("_cuts", "_tops"))


def _neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str,
               step: int, limit: int) -> DataFrame:
    split = split_long_groups(df, keys, order[0], limit).withColumn("_value", F.struct(value.alias("v")))
    shift, edge = (F.lag, F.max_by) if step < 0 else (F.lead, F.min_by)
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order)
    edges = (split.filter("_long").groupBy(*keys, "_piece")
             .agg(edge("_value", F.struct(*order)).alias("_edge")))
    edges = edges.select(*keys, "_piece",
                         shift("_edge").over(Window.partitionBy(*keys).orderBy("_piece")).alias("_edge"))
    found = split.withColumn("_near", shift("_value").over(inside))
    return (_attach(found, edges, [*keys, "_piece"])
            .withColumn(out, F.coalesce("_near", "_edge"))
            .drop("_long", "_piece", "_value", "_near", "_edge"))


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str = "prev",
             limit: int = LIMIT) -> DataFrame:
    """Add `out`, a struct with field `v`: `value` of the row before; null on the first row of a group.

    `order` must be unique inside a group; its first column is an integer.
    """
    return _neighbour(df, keys, order, value, out, -1, limit)


def following(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str = "next",
              limit: int = LIMIT) -> DataFrame:
    """Add `out`, a struct with field `v`: `value` of the row after; null on the last row of a group."""
    return _neighbour(df, keys, order, value, out, 1, limit)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: dict[str, tuple[str, Column]],
            backward: bool = False, limit: int = LIMIT, piece: Column | None = None) -> DataFrame:
    """Add running totals up to and including each row: `{name: ("sum" | "max", value)}`.

    `backward` runs from the last row of a group to the first. `piece` is for an order with a known range: an
    integer that grows with it and takes few values; every group is cut by it, and its sizes are not measured.
    """
    combine = {"sum": lambda a, b: a + F.coalesce(b, F.lit(0)), "max": lambda a, b: F.greatest(a, b)}
    agg = {"sum": F.sum, "max": F.max}
    direct = (lambda c: F.col(c).desc()) if backward else (lambda c: F.col(c).asc())
    named = {f"_t{i}": (name, kind, value) for i, (name, (kind, value)) in enumerate(totals.items())}

    split = (split_long_groups(df, keys, order[0], limit) if piece is None else
             df.withColumns({"_piece": piece.cast("int"), "_long": F.lit(True)}))
    split = split.withColumns({t: v for t, (_, _, v) in named.items()})
    edges = (split.filter("_long").groupBy(*keys, "_piece")
             .agg(*[agg[kind](t).alias("_e" + t) for t, (_, kind, _) in named.items()]))
    before = (Window.partitionBy(*keys).orderBy(direct("_piece"))
              .rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.select(*keys, "_piece",
                         *[agg[kind]("_e" + t).over(before).alias("_e" + t) for t, (_, kind, _) in named.items()])
    inside = (Window.partitionBy(*keys, "_piece").orderBy(*[direct(c) for c in order])
              .rowsBetween(Window.unboundedPreceding, 0))
    found = split.withColumns({"_r" + t: agg[kind](t).over(inside) for t, (_, kind, _) in named.items()})
    return (_attach(found, edges, [*keys, "_piece"])
            .withColumns({name: combine[kind](F.col("_r" + t), F.col("_e" + t))
                          for t, (name, kind, _) in named.items()})
            .drop("_long", "_piece", *named, *["_r" + t for t in named], *["_e" + t for t in named]))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "frame_num",
                limit: int = LIMIT) -> DataFrame:
    """Add `out`: 0-based position of each row in its group."""
    ranked = running(df, keys, order, {out: ("sum", F.lit(1).cast("long"))}, limit=limit)
    return ranked.withColumn(out, F.col(out) - 1)


def order_frames(df: DataFrame, camera: str = "camera", order: str = "frame_num",
                 partitions: int | None = None) -> DataFrame:
    """Frames of each camera in order; a busy camera spans several consecutive partitions."""
    cols = [F.col(camera), F.col(order)]
    spread = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return spread.sortWithinPartitions(*cols)
