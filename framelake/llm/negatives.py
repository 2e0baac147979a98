"""Hard negatives from Parquet blocks along a Hilbert curve.

Components are scaled and floored to whole numbers, so scores (inner products) are exact. Rows are ordered by label and, within a label, by their
place on a Hilbert curve through all dimensions, and written as Parquet blocks of BLOCK rows, one row of the table for each: the vectors as
bytes, and a zone map of the least and greatest value of every dimension and of the label. Pages hold neighbouring blocks with a zone map of their own.
Interval arithmetic bounds every score of an anchor with a block: a . x lies between the sums of min and max of (a_d low_d, a_d high_d).

1. Positives: an anchor's own page gives a first bound, the `positives`-th best row of its label there. Pages and blocks whose upper bound is below,
   or which hold no row of the label, aren't read.
2. Negatives: each positive opens a window of scores, low * positive to high * positive. Blocks whose bounds miss every window of an anchor, or
   stay below what the windows already have, aren't read.

Anchors go in chunks; a chunk meets the pages that the bounds of its box let through, by page number, so a page that no window needs isn't
read for it. Each meeting keeps `negatives` rows for each window, and the best of all meetings remain. The bounds are exact: nothing is lost.

Rows with a null label, a null vector, or a null or non-finite component take no part. Missing components of shorter vectors are 0. Values beyond
2**26 in size after scaling count as that. A null id is no anchor and comes last among equal scores. Repeated rows are rows of their own, each an
anchor and a candidate of the other. Labels may be anything whole. An empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from framelake.llm.common import discard, query, read, stored

SCALE, LARGEST = 256, 1 << 26
#: Rows of a block; blocks of a page; pages whose anchors make a chunk; bits of the curve for each dimension.
BLOCK, PAGE, CHUNK, BITS = 256, 16, 16, 2
NO_ID = np.iinfo(np.int64).max


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (whole numbers below 2**bits for every dimension) on the curve, as big-endian bytes."""
    x = cells.T.astype(np.uint32).copy()  # one row for each dimension
    top = np.uint32(1 << (bits - 1))
    q = top
    while q > 1:  # undo the turns of the coarser levels
        low = np.uint32(q - 1)
        for d in range(len(x)):
            flip = (x[d] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low).astype(np.uint32)
            x[0] ^= np.where(flip, low, swap).astype(np.uint32)
            x[d] ^= swap
        q = np.uint32(q >> 1)
    for d in range(1, len(x)):  # Gray code across the dimensions
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    q = top
    while q > 1:
        turn ^= np.where(x[-1] & q, np.uint32(q - 1), np.uint32(0)).astype(np.uint32)
        q = np.uint32(q >> 1)
    x ^= turn
    places = [(x[d] >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1) for d in range(len(x))]
    return np.packbits(np.array(places, np.uint8).T, axis=1)


def _whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """Scaled and floored components, one row for each vector."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.clip(np.floor(SCALE * flat), -LARGEST, LARGEST)
    return out


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, embedding (array of double) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    rows = rows.select("vec_id", F.col("label").cast("long").alias("label"), x.alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)


ZONE = "low array<double>, high array<double>, first_label long, last_label long"
BLOCKS = f"task int, seq long, {ZONE}, ids binary, labels binary, vectors binary"
_ZONE_TYPES = [pa.list_(pa.float64())] * 2 + [pa.int64()] * 2


def _batch(schema: str, kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _keys(dims: int, cuts: np.ndarray):
    """Adds the place on the curve; the cuts part each dimension into about even quarters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _whole(batch.column("embedding"), dims)
            key = hilbert((x[:, :, None] >= cuts).sum(axis=2), BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([k.tobytes() for k in key], pa.binary())], [*batch.schema.names, "key"])
    return run


def _cut(dims: int):
    """Blocks of the sorted rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, seq, waiting, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in _then_end(batches):
            if batch is not None and batch.num_rows:
                waiting.append((np.array(batch.column("vec_id").fill_null(NO_ID)), np.array(batch.column("label")), _whole(batch.column("embedding"), dims)))
                held += batch.num_rows
            if held >= BLOCK or batch is None and held:
                ids, labels, x = (np.concatenate(c) for c in zip(*waiting))
                whole = held if batch is None else held - held % BLOCK
                rows = []
                for at in range(0, whole, BLOCK):
                    part = slice(at, min(at + BLOCK, whole))
                    v, of = x[part], labels[part]
                    rows.append((task, seq, v.min(0).tolist(), v.max(0).tolist(), int(of.min()), int(of.max()), ids[part].tobytes(), of.tobytes(),
                                 v.astype(np.int32).tobytes()))
                    seq += 1
                yield _batch(BLOCKS, [pa.int32(), pa.int64(), *_ZONE_TYPES, *[pa.binary()] * 3], rows)
                waiting, held = [(ids[whole:], labels[whole:], x[whole:])], held - whole
    return run


def _then_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def in_pages(rows: DataFrame) -> tuple[DataFrame, int]:
    """The pages of usable rows (their number, zone map and blocks), and the number of dimensions."""
    dims = rows.agg(F.max(F.size("embedding"))).first()[0] or 1
    cuts = np.zeros((dims, 3))
    for r in rows.select(F.posexplode("embedding").alias("d", "x")).groupBy("d").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).collect():
        cuts[r.d] = SCALE * (r.m + 0.67 * r.s * np.array([-1, 0, 1]))  # one row for each dimension
    keyed = stored(rows.mapInArrow(_keys(dims, cuts), "vec_id long, label long, embedding array<double>, key binary"), "keyed")
    order = ["label", "key", "vec_id"]
    blocks = stored(keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("key").mapInArrow(_cut(dims), BLOCKS), "blocks")
    # Blocks are numbered along the curve: one row for each task that wrote some.
    before = F.coalesce(F.sum("n").over(W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    tasks = blocks.groupBy("task").agg(F.count("*").alias("n")).select("task", before.alias("before"))
    number = (F.col("seq") + F.col("before")).alias("block")
    zone = [f.split()[0] for f in ZONE.split(", ")]
    numbered = blocks.join(F.broadcast(tasks), "task").withColumn("block", number)

    def edge(fn, name: str) -> Column:  # elementwise least or greatest over the blocks of a page
        return F.reduce(F.transform("blocks", lambda b: b[name]), F.element_at("blocks", 1)[name], lambda a, b: F.zip_with(a, b, lambda x, y: fn(x, y))).alias(name)
    pages = numbered.groupBy(F.floor(F.col("block") / PAGE).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("block", *zone, "ids", "labels", "vectors"))).alias("blocks"))
    pages = stored(pages.select("page", edge(F.least, "low"), edge(F.greatest, "high"), F.array_min("blocks.first_label").alias("first_label"),
                                F.array_max("blocks.last_label").alias("last_label"), "blocks"), "pages")
    discard(keyed, blocks)
    return pages, dims


class Best:
    """The k best candidates of every window: higher score first, then the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.bound = k, np.full(n, -np.inf)
        self.of, self.score, self.id, self.uid = (np.zeros(0, t) for t in (np.int64, np.float64, np.int64, np.int64))

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray, uid: np.ndarray) -> None:
        if not len(of):
            return
        of, score, ids, uid = (np.concatenate(p) for p in ((self.of, of), (self.score, score), (self.id, ids), (self.uid, uid)))
        order = np.lexsort((uid, ids, -score, of))
        of = of[order]
        first = np.concatenate(([True], of[1:] != of[:-1]))
        rank = np.arange(len(of)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        keep = order[rank < self.k]
        last = rank == self.k - 1
        self.bound[of[last]] = score[order][last]
        self.of, self.score, self.id, self.uid = of[rank < self.k], score[keep], ids[keep], uid[keep]


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each row of a with anything between low and high, one column for each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def product(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where these hold every sum, else in whole numbers."""
    limit = np.abs(a).max(initial=0) * np.abs(x).max(initial=0) * max(1, a.shape[1])
    return a @ x.T if limit < 2.0 ** 53 else (a.astype(np.int64) @ x.astype(np.int64).T)


def search(a: np.ndarray, labels: np.ndarray, uids: np.ndarray, low: np.ndarray, high: np.ndarray, blocks: list[tuple], same: bool, k: int) -> tuple[Best, int]:
    """The k best rows of the blocks for every anchor and window (low to high, one column each), and how many block reads that took.

    same: rows of the anchor's label but itself, else rows of other labels. Blocks: (first row's place, ids, labels, vectors, zone map).
    """
    n, m = low.shape
    best, reads = Best(n * m, k), 0
    least, most = bounds(a, np.array([b[4] for b in blocks]), np.array([b[5] for b in blocks]))
    only = [(b[6], b[7]) for b in blocks]
    for b in np.argsort(-most.max(axis=0), kind="stable").tolist():
        place, ids, of, x = blocks[b][:4]
        floor = np.maximum(low, best.bound.reshape(n, m))
        need = ((most[:, b, None] >= floor) & (least[:, b, None] <= high)).any(axis=1)
        need &= (labels >= only[b][0]) & (labels <= only[b][1]) if same else (labels != only[b][0]) | (labels != only[b][1])
        rows = np.flatnonzero(need)
        if not len(rows):
            continue
        reads += len(rows)
        score = product(a[rows], x)
        place = place + np.arange(len(ids))
        fits = (of == labels[rows, None]) == same
        if same:
            fits &= place != uids[rows, None]
        for w in range(m):
            r, c = np.nonzero(fits & (score >= floor[rows, w, None]) & (score <= high[rows, w, None]))
            best.add(rows[r] * m + w, score[r, c].astype(np.float64), ids[c], place[c])
    return best, reads


def _opened(blocks: list[dict], dims: int) -> list[tuple]:
    """(first row's place, ids, labels, vectors, zone map) of the blocks of a page."""
    return [(b["block"] * BLOCK, np.frombuffer(b["ids"], np.int64), np.frombuffer(b["labels"], np.int64),
             np.frombuffer(b["vectors"], np.int32).reshape(-1, dims).astype(np.float64), b["low"], b["high"], b["first_label"], b["last_label"]) for b in blocks]


ANCHORS = "chunk long, uid long, anchor_id long, label long, vector binary, floor double"


def _anchors(every: int, k: int, dims: int):
    """The anchors of a page; the k-th best row of their label there is a first bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, blocks in zip(batch.column("page").to_pylist(), batch.column("blocks").to_pylist()):
                blocks = _opened(blocks, dims)
                ids, labels, x, uids = (np.concatenate(c) for c in zip(*[(b[1], b[2], b[3], b[0] + np.arange(len(b[1]))) for b in blocks]))
                at = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                if len(at):
                    open_low, open_high = np.full((len(at), 1), -np.inf), np.full((len(at), 1), np.inf)
                    floor = search(x[at], labels[at], uids[at], open_low, open_high, blocks, True, k)[0].bound
                    rows += [(page // CHUNK, int(uids[i]), int(ids[i]), int(labels[i]), x[i].astype(np.int32).tobytes(), float(f)) for i, f in zip(at, floor)]
            yield _batch(ANCHORS, [*[pa.int64()] * 4, pa.binary(), pa.float64()], rows)
    return run


def _reachable(dims: int, same: bool):
    """Of pairs of a chunk and a page those that the bounds between their boxes let through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            al, ah, pl, ph = (np.array(batch.column(c).to_pylist(), float).reshape(-1, dims) for c in ("box_low", "box_high", "low", "high"))
            corners = [al * pl, al * ph, ah * pl, ah * ph]
            most, least = (pick.reduce(corners).sum(axis=1) for pick in (np.maximum, np.minimum))
            a1, a2, p1, p2, floor, top = (np.array(batch.column(c)) for c in ("box_first", "box_last", "first_label", "last_label", "floor", "top"))
            fits = (a1 <= p2) & (p1 <= a2) if same else (a1 != a2) | (p1 != p2) | (a1 != p1)
            keep = pa.array(np.flatnonzero(fits & (most >= floor) & (least <= top)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in ("chunk", "page")], ["chunk", "page"])
    return run


def _boxes(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for chunk, anchors in zip(batch.column("chunk").to_pylist(), batch.column("anchors").to_pylist()):
                v = np.frombuffer(b"".join(a["vector"] for a in anchors), np.int32).reshape(len(anchors), dims).astype(float)
                low, high = [a["low"] for a in anchors], [a["high"] for a in anchors]
                labels = [a["label"] for a in anchors]
                rows.append((chunk, v.min(0).tolist(), v.max(0).tolist(), min(labels), max(labels), float(np.min(low)), float(np.max(high))))
            yield _batch("chunk, box_low, box_high, box_first, box_last, floor, top", [pa.int64(), *_ZONE_TYPES, pa.float64(), pa.float64()], rows)
    return run


FOUND = "uid long, win int, score long, id long, other long, reads long"


def _meet(dims: int, same: bool, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchors, blocks = batch.column("anchors")[i].as_py(), batch.column("blocks")[i].as_py()
                uids, labels = (np.array([a[c] for a in anchors], np.int64) for c in ("uid", "label"))
                v = np.frombuffer(b"".join(a["vector"] for a in anchors), np.int32).reshape(len(anchors), dims).astype(np.float64)
                low, high = (np.array([a[c] for a in anchors], np.float64) for c in ("low", "high"))
                best, reads = search(v, labels, uids, low, high, _opened(blocks, dims), same, k)
                m = low.shape[1]
                ids = pa.array(best.id, pa.int64(), mask=best.id == NO_ID)
                yield pa.RecordBatch.from_arrays([
                    pa.array(uids[best.of // m]), pa.array((best.of % m).astype(np.int32)), pa.array(best.score.astype(np.int64)), ids, pa.array(best.uid),
                    pa.array(np.full(len(best.of), reads))], ["uid", "win", "score", "id", "other", "reads"])
    return run


def _nearest(pages: DataFrame, anchors: DataFrame, dims: int, same: bool, k: int) -> DataFrame:
    """The k best rows of every window of every anchor: uid, win, score, id, rank. anchors: chunk, uid, label, vector, low and high of the windows."""
    chunks = stored(anchors.groupBy("chunk").agg(F.collect_list(F.struct("uid", "label", "vector", "low", "high")).alias("anchors")), "chunks")
    boxes = chunks.mapInArrow(_boxes(dims), "chunk long, box_low array<double>, box_high array<double>, box_first long, box_last long, floor double, top double")
    n = pages.count()
    zones = pages.drop("blocks")
    pairs = boxes.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n - 1).cast("long")))).join(zones, "page")
    pairs = stored(pairs.mapInArrow(_reachable(dims, same), "chunk long, page long"), "pairs")
    met = pairs.join(chunks, "chunk").join(pages.select("page", "blocks"), "page").select("anchors", "blocks").mapInArrow(_meet(dims, same, k), FOUND)
    met = stored(met, "met")
    order = W.partitionBy("uid", "win").orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
    out = stored(met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("uid", "win", "score", "id", "rank"), "nearest")
    discard(chunks, pairs, met)
    return out


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the best rows of other labels whose score is `low` to `high` per cent of
    the positive's, for the anchors (ids divisible by `every`) and the best `positives` other rows of their label."""
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    pages, dims = in_pages(usable(rows))
    if pages.isEmpty():
        return rows.sparkSession.createDataFrame([], out)
    anchors = stored(pages.select("page", "blocks").mapInArrow(_anchors(every, positives, dims), ANCHORS), "anchors")
    one = anchors.select("chunk", "uid", "label", "vector", F.array("floor").alias("low"), F.array(F.lit(float("inf"))).alias("high"))
    near = _nearest(pages, one, dims, True, positives).select(
        "uid", (F.col("rank") - 1).alias("win"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    least, most = F.expr(f"({low} * positive_score + 99) div 100"), F.expr(f"{high} * positive_score div 100")
    # Below 0 the upper end lies under the lower one: no window.
    windows = near.filter("positive_score >= 0").groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("win", F.struct(
        least.cast("double").alias("low"), most.cast("double").alias("high"))))).alias("windows"))
    at = F.array(*[F.col("windows")[i] for i in range(positives)])
    framed = anchors.join(windows, "uid").select(
        "chunk", "uid", "label", "vector", F.transform(at, lambda w: F.coalesce(w.low, F.lit(float("inf")))).alias("low"),
        F.transform(at, lambda w: F.coalesce(w.high, F.lit(float("-inf")))).alias("high"))
    found = _nearest(pages, framed, dims, False, negatives)
    names = anchors.select("uid", "anchor_id")
    return found.join(near, ["uid", "win"]).join(names, "uid").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


OP13_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q, row_number() OVER () AS r
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_dot_product(a.q, c.q)::BIGINT AS score, c.r AS cr
      FROM v a, v c WHERE a.vec_id % 100 = 0 AND a.r <> c.r),
p AS (SELECT r, anchor_id, id AS positive_id, cr AS pr, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, id NULLS LAST, cr) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.r, p.pr ORDER BY s.score DESC, s.id NULLS LAST, s.cr)::INTEGER AS rank
      FROM p JOIN s ON s.r = p.r AND NOT s.same AND 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(rows.select("vec_id", moved.alias("label"), "embedding"))
