"""Benchmark decontamination with spaced seeds.

Words are lower-cased (A-Z) and lose ASCII punctuation. A seed is the hash of the words at the marked places of a fixed mask, so a
replaced word under an unmarked place doesn't matter. Seeds of the benchmark and of the documents are joined; a hit fixes an
alignment of document and item, and the longest stretch of that alignment with `identity` equal words or more is its overlap.
A document is contaminated by an item if an overlap has `least` words, or all words of a shorter item.

Items shorter than a mask have masks that leave out one place of the item; items of fewer than MIN_ITEM words say too little and
are left out. With these masks any 12 words with two replaced ones hold a hit.
Null texts are empty; empty tables give no rows. Rows with the same id each give their rows; ids may be null. Equal items are
each reported. Other columns are not carried.

The documents' seeds pass a Bloom filter of the benchmark's seeds before anything is moved. The filter's size is bounded; with a
benchmark beyond that bound it lets more through, and the join stays exact.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import discard, lowered, mix64, query, read, stored, word_hashes

#: Places with 1 count.
MASKS = ("1101011", "11010011", "110010101")
MIN_ITEM, LEAST, IDENTITY = 5, 12, 0.8
#: The filter has 2**LEAST_BITS (2 MB) to 2**MOST_BITS bits (32 MB), at best 512 for each seed: then it lets one seed in 65,000
#: through by chance, while a text has some thousands.
LEAST_BITS, MOST_BITS = 24, 28

_PUNCTUATION = string.punctuation.encode()


def tokens(text: str | None) -> np.ndarray:
    return word_hashes(lowered(text).translate(None, _PUNCTUATION))[0]


def seeds(t: np.ndarray, places: tuple[int, ...], family: int) -> np.ndarray:
    """Hash of the words at the places, for every start where they fit."""
    n = len(t) - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, family, np.uint64)
    for p in places:
        out = out * np.uint64(0xD1342543DE82EF95) + t[p:p + n]
    return mix64(out)


def _places(mask: str) -> tuple[int, ...]:
    return tuple(i for i, c in enumerate(mask) if c == "1")


def _families(masks: tuple[str, ...], short: list[int]) -> list[tuple[int, tuple[int, ...]]]:
    """Number and places of every kind of seed: the masks, and for items of n words all but one of them."""
    return [(1000 + i, _places(m)) for i, m in enumerate(masks)] + [
        (100 * n + j, tuple(i for i in range(n) if i != j)) for n in short for j in range(n)]


def _item_seeds(masks: tuple[str, ...]):
    longest = max(map(len, masks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, words, seed, at, short = [], [], [], [], []
            for i, t in zip(batch.column("row").to_pylist(), map(tokens, batch.column("text").to_pylist())):
                if len(t) < MIN_ITEM:
                    continue
                whole = len(t) < longest
                for family, places in _families(() if whole else masks, [len(t)] if whole else []):
                    h = seeds(t, places, family)
                    item += [i] * len(h)
                    seed.append(h)
                    at.append(np.arange(len(h)))
                    short += [len(t) if whole else 0] * len(h)
            if item:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(seed).view(np.int64)), pa.array(item, pa.int64()), pa.array(np.concatenate(at), pa.int64()),
                    pa.array(short, pa.int32())], ["seed", "item", "item_at", "short"])
    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([
            batch.column("row"), batch.column("item_id"), pa.array((tokens(t).tobytes() for t in batch.column("text").to_pylist()), pa.binary())],
            ["item", "item_id", "item_words"])


def _filter(spark: SparkSession, item_seeds: DataFrame) -> tuple[np.ndarray, int]:
    """Two bits for each seed. Spark makes the 64-bit words of the filter; the driver holds no more than its size."""
    n = item_seeds.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (512 * n).bit_length()))
    mask = (1 << bits) - 1
    one = item_seeds.select(F.explode(F.array(F.col("seed").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("seed", 32).bitwiseAND(F.lit(mask)))).alias("bit"))
    cells = (one.groupBy(F.shiftright("bit", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("value")))
    out = np.zeros(1 << (bits - 6), np.uint64)
    for r in cells.toLocalIterator():
        out[r.cell] = np.uint64(r.value & 0xFFFFFFFFFFFFFFFF)
    return out, bits


def _probe(shared, families: list[tuple[int, tuple[int, ...]]], bits: int):
    mask = np.uint64((1 << bits) - 1)

    def passes(h: np.ndarray) -> np.ndarray:
        cells = shared.value

        def bit(x: np.ndarray) -> np.ndarray:
            return (cells[(x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63))) & np.uint64(1)
        at = np.flatnonzero(bit(h & mask))
        return at[bit((h[at] >> np.uint64(32)) & mask) == 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, seed, at, words = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                t = tokens(text)
                found = [(h[p], p) for family, places in families for h in [seeds(t, places, family)] for p in [passes(h)]]
                if any(len(p) for _, p in found):
                    rows.append(i)
                    seed.append(np.concatenate([h for h, _ in found]).view(np.int64))
                    at.append(np.concatenate([p for _, p in found]))
                    words.append(t.tobytes())
            if rows:
                keep = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).take(keep) for c in ("row", "doc_id", "text_key")], pa.array(words, pa.binary()),
                    pa.array(seed, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int64()))],
                    ["row", "doc_id", "text_key", "doc_words", "seed", "doc_at"])
    return run


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, identity: float) -> tuple[int, int, int]:
    """(start in the document, words, equal words) of the longest stretch with enough equal words; item place i meets i + shift."""
    first, last = max(0, -shift), min(len(item), len(doc) - shift)
    same = doc[first + shift:last + shift] == item[first:last]
    gain = np.concatenate(([0.0], np.cumsum(same - identity)))
    low = np.minimum.accumulate(gain)
    begin = np.searchsorted(-low, -gain - 1e-9)  # the first place from which the share up to here is enough
    length = np.arange(len(gain)) - begin
    end = int(length.argmax())
    start = end - int(length[end])
    return first + shift + start, end - start, int(same[start:end].sum())


def _verify(least: int, identity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, out = [], []
            for k, (doc, item, shifts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_words", "item_words", "shifts")))):
                d, i = np.frombuffer(doc, np.uint64), np.frombuffer(item, np.uint64)
                good = [o for o in (overlap(d, i, s, identity) for s in shifts) if o[1] >= min(least, len(i))]
                if good:  # most equal words, then longest, then first
                    keep.append(k)
                    out.append((*max(good, key=lambda o: (o[2], o[1], -o[0])), len(i)))
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(at) for c in ("row", "doc_id", "text_key", "item", "item_id")],
                 *[pa.array([o[j] for o in out], pa.int64()) for j in range(4)]],
                ["row", "doc_id", "text_key", "item", "item_id", "doc_at", "n_words", "n_equal", "item_words"])
    return run


OVERLAPS = "row long, doc_id long, text_key long, item long, item_id long, doc_at long, n_words long, n_equal long, item_words long"


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, least: int = LEAST, identity: float = IDENTITY) -> DataFrame:
    """The longest overlap of every contaminated document (by row) with each item.

    `text_key` tells texts under one id apart; `doc_at` counts words.
    """
    spark = docs.sparkSession
    items = stored(benchmark.select("item_id", "text").withColumn("row", F.monotonically_increasing_id()), "items")
    item_seeds = stored(items.select("row", "text").mapInArrow(_item_seeds(masks), "seed long, item long, item_at long, short int"), "item-seeds")
    # Lengths below the longest mask: a handful.
    short = sorted(r.short for r in item_seeds.select("short").distinct().collect() if r.short)
    cells, bits = _filter(spark, item_seeds)
    shared = spark.sparkContext.broadcast(cells)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_key"), "text")
    suspects = stored(rows.mapInArrow(_probe(shared, _families(masks, short), bits),
                                      "row long, doc_id long, text_key long, doc_words binary, seed array<long>, doc_at array<long>"), "suspects")
    hits = suspects.select("row", F.explode(F.arrays_zip("seed", "doc_at")).alias("x")).select("row", "x.seed", "x.doc_at")
    aligned = hits.join(item_seeds, "seed").select("row", "item", (F.col("doc_at") - F.col("item_at")).alias("shift"))
    words = items.select("row", "item_id", "text").mapInArrow(_item_words, "item long, item_id long, item_words binary")
    # A text meets an item once, with all its alignments: no more than the words of both.
    pairs = aligned.groupBy("row", "item").agg(F.collect_set("shift").alias("shifts"))
    found = (pairs.join(suspects.select("row", "doc_id", "text_key", "doc_words"), "row").join(words, "item")
             .mapInArrow(_verify(least, identity), OVERLAPS))
    out = found.select("row", "doc_id", "text_key", "item_id", "doc_at", "n_words", "n_equal", "item_words")
    out = stored(out, "overlaps")
    discard(items, item_seeds, suspects)
    return out


@query("op5_spaced_seeds")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    found = overlaps(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "doc_at", "n_words", "n_equal", "item_words")
