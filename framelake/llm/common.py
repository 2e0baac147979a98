"""Helpers of the text operators: words, intermediate tables, the query register."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from framelake.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Words are runs of anything but these (ASCII white space).
GAPS = r"[ \t\n\x0B\f\r]+"
#: As bytes: A-Z to lower case, nothing else.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` its test compares it with brute force."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared scratch folder: lineage ends here, and a lost executor costs no recomputation."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Deletes what `stored` has written, once no table still to be computed reads it."""
    for table in tables:
        path = getattr(table, "scratch_path", None)
        if path:
            delete(table.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAPS), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, without an array of the words that the optimizer would have to filter."""
    text = F.coalesce(text, F.lit(""))
    gap = F.array(*[F.lit(c) for c in " \t\n\x0b\x0c\r"])
    edges = F.array_contains(gap, F.left(text, F.lit(1))).cast("int") + F.array_contains(gap, F.right(text, F.lit(1))).cast("int")
    return F.when(text == "", 0).otherwise(F.size(F.split(text, GAPS)) - edges).cast("long")


def hash32(*parts: Column) -> Column:
    """32 bits of a digest, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def prefix_sum(df: DataFrame, group: str, piece: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of `value` over the earlier rows of the group; pieces rise along the order, and only their sums meet."""
    before = W.rowsBetween(W.unboundedPreceding, -1)
    sums = df.groupBy(group, piece).agg(F.sum(value).alias("_sum"))
    base = sums.select(group, piece, F.coalesce(F.sum("_sum").over(before.partitionBy(group).orderBy(piece)), F.lit(0)).alias("_base"))
    within = F.coalesce(F.sum(value).over(before.partitionBy(group, piece).orderBy(*order)), F.lit(0))
    return df.withColumn(out, within).join(base, [group, piece]).withColumn(out, F.col(out) + F.col("_base")).drop("_base")


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Odd multiplier of the polynomial hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2**64; computed once for each length that is a power of two."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(1 << 12, 1 << (n - 1).bit_length()), base, np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


IS_GAP = np.zeros(256, bool)
IS_GAP[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a text in bytes, and where each word begins. Works in pieces, so memory follows the words."""
    out, at, begin, piece = [], [], 0, 1 << 20
    while begin < len(data):
        end = min(len(data), begin + piece)
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":  # up to the end of a word
            stop = [x for g in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (x := data.find(g, end, end + piece)) >= 0]
            end = min(stop) if stop else min(len(data), end + piece)
        b = np.frombuffer(data, np.uint8, end - begin, begin)
        inside = ~IS_GAP[b]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        first, last = edge[::2], edge[1::2]
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(b)), out=total[1:])
        h = (total[last] - total[first]) * powers(INVERSE, len(b) + 1)[first]
        out.append(mix64(h ^ (last - first).astype(np.uint64)))
        at.append(first + begin)
        begin = end
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(at)


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
