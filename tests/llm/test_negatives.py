import math
import random

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.llm import negatives as g
from framelake.llm.registry import QUERIES, SQL

SCHEMA = "low int, vec_id long, label int, embedding array<float>, page string"


def brute(rows, every=100):
    """Every anchor with every row. rows: (vec_id, label, vector)."""
    rows = [(i, y, [math.floor(256 * float(x)) for x in v]) for i, y, v in rows
            if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = [math.inf if i is None else i for i, _, _ in rows]
    out = []
    for a, (i, y, v) in enumerate(rows):
        if i is None or i % every:
            continue
        score = [sum(p * q for p, q in zip(v, w)) for _, _, w in rows]
        order = sorted((b for b in range(len(rows)) if b != a), key=lambda b: (-score[b], key[b]))
        for p in [b for b in order if rows[b][1] == y][:5]:
            fits = [b for b in order if rows[b][1] != y and 30 * score[p] <= 100 * score[b] <= 90 * score[p]][:10]
            out += [(i, rows[p][0], k + 1, rows[b][0], score[p], score[b]) for k, b in enumerate(fits)]
    return sorted(out, key=repr)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(1, i, y, None if v is None else [None if x is None else float(x) for x in v], "x") for i, y, v in rows], SCHEMA)
    return sorted(map(tuple, g.mine(df, **kw).collect()), key=repr)


def clustered(r, n, labels=4, dims=6):
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(8)]
    rows = []
    for i in range(n):
        c = r.choice(centres)
        rows.append((i, r.randrange(labels), np.float32([x + r.gauss(0, .05) for x in c]).tolist()))
    return rows


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 1)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        key = [k.tobytes() for k in g.hilbert(cells, bits)]
        path = cells[sorted(range(len(cells)), key=lambda i: key[i])]
        assert len(set(key)) == len(cells) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_product():
    r = np.random.default_rng(1)
    a, x = r.integers(-99, 99, (50, 7)).astype(float), r.integers(-99, 99, (40, 7)).astype(float)
    least, most = g.bounds(a, x.min(0)[None], x.max(0)[None])
    s = a @ x.T
    assert (s >= least).all() and (s <= most).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(g, "BLOCK", 16)
    monkeypatch.setattr(g, "PAGE", 3)
    monkeypatch.setattr(g, "CHUNK", 2)
    rows = clustered(random.Random(seed), 900)
    assert mined(spark, rows, every=30) == brute(rows, 30)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    v = [0.5, 0.25]
    rows = [(100, 1, v), (100, 1, v), (200, 1, v), (None, 1, v), (7, None, v), (8, 1, None), (9, 1, [0.1, None]), (10, 1, [math.nan, 1]),
            (11, 2, [math.inf, 1]), (12, 2, [0.25, 0.1]), (13, 2, [0.25, 0.1]), (None, 2, [0.25, 0.1]), (14, 3, [0.3]), (300, 4, []), (301, 4, []),
            (302, 5, []), (-100, 2, [-0.5, 0.1]), (400, 9, [1e30, 1]), (401, 9, [1.0, 0])]
    got = mined(spark, rows)
    small = [r for r in rows if r[0] not in (400, 401)]
    assert [x for x in got if x[0] != 400] == [x for x in brute(rows) if x[0] != 400] and brute(small)
    assert {x[5] <= x[4] for x in got} == {True}
    assert mined(spark, []) == [] == mined(spark, [(100, 1, v)])


def test_a_third_of_the_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(g, "BLOCK", 16)
    rows = [(i, 0 if i % 3 == 0 else 1 + i % 4, [0.5, 0.5] if i % 3 == 0 else [0.1 + i % 7 / 20, 0.3]) for i in range(600)]
    assert mined(spark, rows) == brute(rows)


def test_distant_blocks_are_not_read(spark):
    r = random.Random(7)
    rows = sorted(clustered(r, 4_000, labels=2, dims=4), key=lambda x: x[2])
    x = np.floor(256 * np.array([v for _, _, v in rows], float))
    labels, ids = np.array([y for _, y, _ in rows]), np.array([i for i, _, _ in rows])
    order = sorted(range(len(rows)), key=lambda i: (labels[i], g.hilbert(np.clip((x[i:i + 1] + 700) // 350, 0, 3).astype(int), 2).tobytes()))
    x, labels, ids = x[order], labels[order], ids[order]
    blocks = [(b, ids[b:b + 100], labels[b:b + 100], x[b:b + 100], x[b:b + 100].min(0), x[b:b + 100].max(0), labels[b:b + 100].min(), labels[b:b + 100].max())
              for b in range(0, 4_000, 100)]
    open_low, open_high = np.full((50, 1), -np.inf), np.full((50, 1), np.inf)
    _, reads = g.search(x[::80], labels[::80], np.arange(0, 4_000, 80), open_low, open_high, blocks, True, 5)
    assert reads < 0.25 * 50 * len(blocks)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    assert compare.compare(spark, compare.connect(sf), sf, "op13", QUERIES["op13_hard_negatives"], SQL["op13_hard_negatives"]) is None
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")), "embedding").collect()
    got = sorted(map(tuple, QUERIES["op13_hard_negatives"](spark, sf).collect()), key=repr)
    assert got == brute(map(tuple, rows))
