"""Runs of repeated words, by multi-scale minimizers.

A run is a stretch of words with smallest period q (words q apart are equal) that has `least` words and `times` periods or more and that
neither neighbour extends with that period. Periods of up to SHORT words are found by comparing all words that lie so far apart.
Longer ones are found scale by scale. The scale w covers the periods from w to 2w - 1 (w a power of two): every window of w consecutive
grams of 2w words each has its minimizers, the grams of the least hash. Windows one period apart inside a run are equal, so their
minimizers lie one period apart; and as a gram is no shorter than the period, no equal gram lies between. So each run of three
periods or more shows up as two neighbouring equal minimizers, which are then extended word by word to both sides. Such a pair overlaps itself,
so hardly any pair is no run, and the work stays near a few passes over the text for each scale.

Words are what lies between ASCII white space, told apart by 64 bits. The words of many documents lie in one flat array with a separator
of its own behind each document, so nothing reaches over an end; memory follows the longest text.

Null and empty texts have no words and no runs. Repeated rows each come back, ids may be null, an empty table gives no rows. Other columns are
not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import BASE, INVERSE, mix64, powers, query, read, word_hashes

SHORT, LEAST, TIMES = 7, 6, 4
#: Bytes of text that go through together.
PART = 1 << 22


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the stretches of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).astype(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


def _window(h: np.ndarray, w: int, least: bool) -> np.ndarray:
    """Least or greatest of every w consecutive values; w is a power of two."""
    pick, size = np.minimum if least else np.maximum, 1
    while size < w:
        h = pick(h[:-size], h[size:])
        size *= 2
    return h


def _grams(total: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words; total: running sums of the words times powers of the base."""
    n = len(total) - k
    return mix64((total[k:] - total[:-k]) * powers(INVERSE, n))


def _seeds(total: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of neighbouring equal minimizers whose distance is a period of the scale."""
    h = _grams(total, 2 * w)
    if len(h) < 2 * w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = _window(h, w, True)
    top = _window(np.concatenate((np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64))), w, False)
    at = np.flatnonzero(h == top)  # least in one of the windows that hold it
    value = h[at]
    order = np.argsort(value, kind="stable")
    a, value = at[order], value[order]
    far = np.diff(a)
    good = np.flatnonzero((value[1:] == value[:-1]) & (far >= w) & (far < 2 * w))
    return a[good], far[good]


def _extended(t: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The stretch (start, end) around `at` in which words q apart are equal."""
    first, last, step = at, at, 64
    while last + q < len(t):
        differ = np.flatnonzero(t[last:last + step][:len(t) - last - q] != t[last + q:last + q + step])
        if len(differ):
            last += int(differ[0])
            break
        last, step = min(last + step, len(t) - q), 2 * step
    step = 64
    while first > 0:
        low = max(0, first - step)
        differ = np.flatnonzero(t[low:first] != t[low + q:first + q])
        if len(differ):
            first = low + int(differ[-1]) + 1
            break
        first, step = low, 2 * step
    return first, last + q


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def _smallest(t: np.ndarray, start: int, q: int) -> bool:
    """No part of q is a period, too. The first 2q words tell it."""
    return all((t[start:start + 2 * q - q // p] != t[start + q // p:start + 2 * q]).any() for p in _primes(q))


def runs(t: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) by start, then period. t: words as 64-bit values, `longest` words of a document at most."""
    found: list[tuple[int, int, int]] = []
    for q in range(1, min(SHORT, longest // times) + 1):
        first, size = _stretches(t[:-q] == t[q:])
        size += q
        for s, n in zip(*(x[size >= max(least, times * q)].tolist() for x in (first, size))):
            if q == 1 or _smallest(t, s, q):
                found.append((s, n, q))
    w = SHORT + 1
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((t + np.uint64(1)) * powers(BASE, len(t)), dtype=np.uint64)))
    while times * w <= longest:
        at, far = _seeds(total, w)
        order = np.lexsort((at, far))
        before, end = 0, 0
        for a, q in zip(at[order].tolist(), far[order].tolist()):
            if q == before and a + q < end:
                continue  # of the stretch found last
            s, end = _extended(t, a, q)
            before = q
            if end - s >= max(least, times * q) and _smallest(t, s, q):
                found.append((s, end - s, q))
        w *= 2
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of the texts with a separator behind each, and where each text begins."""
    t, at = word_hashes(b"\n".join(texts))
    begins = np.cumsum([0, *(len(x) + 1 for x in texts)])
    n = np.diff(np.searchsorted(at, begins))
    ends = np.cumsum(n)
    marks = mix64(np.arange(1, len(texts) + 1, dtype=np.uint64) * np.uint64(BASE))
    return np.insert(t, ends, marks), np.concatenate(([0], ends + np.arange(1, len(texts) + 1)))


def _collapsed(text: bytes, found: list[tuple[int, int, int]]) -> bytes:
    """The words without the repeats of any run, one space between."""
    words = text.split()
    if found:
        dropped = np.zeros(len(words), bool)
        for s, n, q in found:
            dropped[s + q:s + n] = True
        words = [words[i] for i in np.flatnonzero(~dropped)]
    return b" ".join(words)


def _parts(texts: list[str | None]) -> Iterator[list[bytes]]:
    part: list[bytes] = []
    size = 0
    for text in texts:
        part.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(part[-1])
        if size >= PART:
            yield part
            part, size = [], 0
    if part:
        yield part


def periodic(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, runs (start, length, period of each, by start and period, words counted from 0), text without the repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            at = 0
            for texts in _parts(batch.column("text").to_pylist()):
                t, begins = _flat(texts)
                found = runs(t, int(np.diff(begins).max()) - 1, least, times)
                owner = np.searchsorted(begins, found[:, 0], side="right") - 1
                own: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                for i, (s, n, q) in zip(owner.tolist(), found.tolist()):
                    own[i].append((s - int(begins[i]), n, q))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(texts)),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in own], kind),
                    pa.array([_collapsed(x, r).decode("utf-8", "surrogatepass") for x, r in zip(texts, own)], pa.string())],
                    ["doc_id", "runs", "text"])
                at += len(texts)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string")


def planted(text: str | None, doc_id: int | None) -> str | None:
    """The text with a repeated stretch up to its end in every tenth document, as the id's checksum says."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not text:
        return text
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return text
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode("utf-8", "surrogatepass")


def plant(docs: DataFrame) -> DataFrame:
    """doc_id and text, with the repeats of `planted`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = map(planted, batch.column("text").to_pylist(), batch.column("doc_id").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string")


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic(plant(read(spark, sf, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("before"), (-r.period).alias("q"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.q")).alias("period"), F.expr("1000 * best.length div -best.q").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
