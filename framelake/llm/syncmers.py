"""Document fingerprints from closed syncmers.

A k-mer of code points is chosen when the smallest of its inner s-mers stands first or last in it. That depends on nothing
outside the k-mer, so an anchor survives any edit that leaves its own characters alone. A fingerprint lists the anchors in
text order as `hash@gap`, gap being the distance from the anchor before, with a level of 0 in front. The query lists every anchor
at every place, so a fingerprint grows with its text (about one anchor in eight characters) and any passage longer than an anchor
or two shows in it.

With `keep` a fingerprint is a bounded sample instead: the first place of each hash and, of more than `keep`, the hashes with
`level` zero bits, with the smallest level that leaves at most `keep`. Two of them are compared at the higher of their levels.

Likeness: anchors that occur in both, taken in the longest chain that rises in both texts (their longest common subsequence) over the
anchors of either: matched / (a + b - matched). Both empty: 1; one empty: 0.

Null text: empty, its fingerprint is the empty string. A text without any anchor (shorter than k, mostly) has one made of all of
it. Repeated ids are ordered by a hash of their text. Null ids come last. An empty table gives no rows. Other columns are
not carried.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import BASE, mix64, query, read

K, S, KEEP = 24, 9, 256
#: Pairs of equal anchors for an anchor, above which a chain is found by rows of bits.
CROWDED = 32
#: Characters of fingerprints in a batch of rows at most, but for one row.
BATCH_CHARS = 1 << 24


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _gram_hashes(c: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all runs of n values, by doubling."""
    b, have, out = BASE, 0, None
    step, size = c + np.uint64(1), 1
    while True:
        if n & size:
            if out is None:
                out, have = step, size
            else:
                m = len(out) - size
                if m <= 0:
                    return np.zeros(0, np.uint64)
                out = out[:m] if len(out) > m else out
                out = out * np.uint64(pow(b, size, 1 << 64)) + step[have:have + m]
                have += size
        size *= 2
        if size > n:
            return out[:max(0, len(c) - n + 1)]
        half = size // 2
        if len(step) <= half:
            return np.zeros(0, np.uint64)
        step = step[:-half] * np.uint64(pow(b, half, 1 << 64)) + step[half:]


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return x if size == w else np.minimum(x[:len(x) - (w - size)], x[w - size:])


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes of the closed syncmers of a text."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    c = _code_points(text)
    if len(c) >= k:
        inner = mix64(_gram_hashes(c, s))
        least = _sliding_min(inner, k - s + 1)
        at = np.flatnonzero((inner[:len(least)] == least) | (inner[k - s:] == least))
        if len(at):
            h = np.zeros(len(at), np.uint64)
            for j in range(0, k, s):  # the inner s-mers that cover the k-mer
                h = mix64(h ^ inner[at + min(j, k - s)])
            return at, (h >> np.uint64(32)).astype(np.uint32)
    whole = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest()
    return np.zeros(1, np.int64), np.frombuffer(whole, np.uint32)


def thinned(at: np.ndarray, h: np.ndarray, keep: int | None = KEEP) -> tuple[int, np.ndarray, np.ndarray]:
    """The first place of each hash; of more than `keep` hashes those with enough zero bits. Without `keep`, all places of all."""
    if keep is None:
        return 0, at, h
    first = np.sort(np.unique(h, return_index=True)[1])
    at, h, level = at[first], h[first], 0
    while len(h) > keep:
        level += 1
        left = (h & np.uint32((1 << level) - 1)) == 0
        at, h = at[left], h[left]
    return level, at, h


def written(level: int, at: np.ndarray, h: np.ndarray) -> str:
    if not len(h):
        return ""
    gaps = np.diff(at, prepend=at[:1] * 0)
    return f"{level}:" + ",".join([f"{x:08x}@{g}" for x, g in zip(h.tolist(), gaps.tolist())])


def _chain(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    n = min(len(x), len(y))
    other = np.flatnonzero(x[:n] != y[:n])
    begin = int(other[0]) if len(other) else n
    x, y, n = x[begin:], y[begin:], n - begin
    other = np.flatnonzero(x[len(x) - n:][::-1] != y[len(y) - n:][::-1])
    end = int(other[0]) if len(other) else n
    x, y = x[:len(x) - end], y[:len(y) - end]
    x, y = x[np.isin(x, y)], y[np.isin(y, x)]
    if not len(x):
        return begin + end
    values, times = np.unique(y, return_counts=True)
    if times[np.searchsorted(values, x)].sum() <= CROWDED * len(x):
        places: dict[int, list[int]] = {}
        for i, v in enumerate(y.tolist()):
            places.setdefault(v, []).append(i)
        ends: list[int] = []  # the smallest end of a rising chain of each length
        for v in x.tolist():
            for i in reversed(places[v]):
                j = bisect_left(ends, i)
                ends[j:j + 1] = [i]
        return begin + end + len(ends)

    def places_of(v: int) -> int:
        return int.from_bytes(np.packbits(y == v, bitorder="little").tobytes(), "little")
    often = {v: places_of(v) for v in values[times * 256 >= len(y)].tolist()}
    full = row = (1 << len(y)) - 1
    for v in x.tolist():  # a bit of `row` that is 0 is a place at which the longest chain grows
        both = row & (often[v] if v in often else places_of(v))
        row = ((row + both) | (row - both)) & full
    return begin + end + len(y) - row.bit_count()


def likeness(a: tuple[int, np.ndarray, np.ndarray], b: tuple[int, np.ndarray, np.ndarray]) -> float:
    level = max(a[0], b[0])
    mask = np.uint32((1 << level) - 1)
    x, y = (p[2][(p[2] & mask) == 0] if p[0] < level else p[2] for p in (a, b))
    if not len(x) or not len(y):
        return float(len(a[2]) == len(b[2]) == 0)
    if len(x) == len(y) and (x == y).all():
        return 1.0
    matched = _chain(x, y)
    return matched / (len(x) + len(y) - matched)


def fingerprint(text: str | None, k: int = K, s: int = S, keep: int | None = KEEP) -> tuple[int, np.ndarray, np.ndarray]:
    return thinned(*anchors(text or "", k, s), keep)


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _frame(out: list[tuple]) -> pd.DataFrame:
    rows = pd.DataFrame(out, columns=NAMES)
    rows["doc_id"] = rows["doc_id"].astype("Int64")
    return rows


def _compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a bucket come together, in descending order; a guest is the first row of the next bucket."""
    held = None
    for frame in frames:
        out, chars = [], 0
        for bucket, guest, doc, text in zip(frame["bucket"], frame["guest"], frame["doc_id"], frame["text"]):
            text = text or ""
            now = (bucket, doc, text, fingerprint(text, keep=None))
            if held is not None and held[0] == bucket:
                _, d, t, f = held
                changed = _edited(t, text)
                g = fingerprint(changed, keep=None)
                out.append((d, len(t), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), written(*f), written(*g),
                            likeness(f, g), likeness(f, now[3])))
                chars += len(out[-1][3]) + len(out[-1][4])
                if chars > BATCH_CHARS:
                    yield _frame(out)
                    out, chars = [], 0
            held = None if guest else now
        if out:
            yield _frame(out)


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
       "near_next double")


#: Buckets at most; beyond it they hold more rows, which stream through their task all the same.
MOST_BUCKETS = 20_000


def _bucketed(rows: DataFrame, rows_per_bucket: int) -> tuple[DataFrame, int]:
    """Adds `bucket`: how many of the cut points (quantiles of the rank) are below the row's rank, by binary search."""
    n = rows.count()
    pieces = min(MOST_BUCKETS, -(-n // rows_per_bucket))
    cuts: list[int] = []
    if pieces > 1:
        shares = [i / pieces for i in range(1, pieces)]
        cuts = sorted(set(rows.agg(F.percentile_approx("rank", shares, max(10_000, 10 * pieces))).first()[0]))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(cuts).bit_length())))])
    below = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    search = F.aggregate(steps, F.lit(0), lambda low, w: F.when(F.get(below, low + w - 1) < F.col("rank"), low + w).otherwise(low))
    return rows.withColumn("bucket", search), n


def compare_neighbours(docs: DataFrame, rows_per_bucket: int = 4000) -> DataFrame:
    """Every document against its edited text and the next document in descending order of id.

    Ids are cut into buckets at quantiles. One shuffle brings a bucket together, sorted; the first row of a bucket also goes, as
    a guest, to the bucket above it, whose last row needs it. Only cut points and the first key of each bucket pass the driver.
    """
    rows = (docs.select("doc_id", "text").withColumn("rank", F.coalesce("doc_id", F.lit(-(1 << 63))))
            .withColumn("tie", F.xxhash64("text")))
    rows, n = _bucketed(rows, rows_per_bucket)
    if not n:
        return docs.sparkSession.createDataFrame([], OUT)
    first = rows.groupBy("bucket").agg(F.max(F.struct("rank", "tie")).alias("top")).orderBy("bucket").collect()
    above = {r.bucket: first[(i + 1) % len(first)].bucket for i, r in enumerate(first)}
    size = first[-1].bucket + 1
    rank, tie, to = ([0] * size for _ in range(3))
    for r in first:
        rank[r.bucket], tie[r.bucket], to[r.bucket] = r.top.rank, r.top.tie, above[r.bucket]
    at = {k: F.get(F.array(*[F.lit(x).cast(t) for x in v]), F.col("bucket"))
          for k, v, t in (("rank", rank, "long"), ("tie", tie, "long"), ("to", to, "int"))}
    own = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(at["to"].alias("bucket"), F.lit(True).alias("guest"))
    is_top = (F.col("rank") == at["rank"]) & (F.col("tie") == at["tie"])
    placed = (rows.withColumn("place", F.explode(F.when(is_top, F.array(own, guest)).otherwise(F.array(own))))
              .select("place.*", "doc_id", "rank", "tie", "text"))
    return (placed.repartition("bucket").sortWithinPartitions("bucket", "guest", F.desc("rank"), F.desc("tie"))
            .select("bucket", "guest", "doc_id", "text").mapInPandas(_compared, OUT))


@query("op2_fingerprints")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return compare_neighbours(read(spark, sf, "documents"))
