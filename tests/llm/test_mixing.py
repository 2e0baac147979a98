import random

import pytest
from pyspark.sql import functions as F

from framelake.llm import mixing as m

SCHEMA = "doc_id long, text string, source string, size string, sid int, block string, piece int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, "x", 0, "y", 0) for d, t, s in rows], SCHEMA)


def filled(sizes, weights):
    """Targets by resharing the excess until none is above."""
    left = 1.5 * sum(sizes.values())
    out, free = {}, dict(weights)
    while free:
        total = sum(free.values())
        over = [s for s in free if left * free[s] / total >= 2 * sizes[s]]
        if not over:
            return out | {s: left * w / total for s, w in free.items()}
        for s in over:
            out[s] = 2 * sizes[s]
            del free[s]
        left = 1.5 * sum(sizes.values()) - sum(out.values())
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    out = [(i, " ".join("w" * r.randrange(1, 400)) , r.choice(["hot"] * 8 + ["b", "c", "é", "Z", None])) for i in range(400)]
    return out + [(7, "same words here", "b")] * 3 + [(500, None, "b"), (501, "", "c"), (502, " \n", "empty"), (None, "no id", "c"), (503, "x " * 40_000, "b")]


def test_targets_and_takes(spark, rows):
    got = m.taken(frame(spark, rows), block=16, slots=64).collect()
    assert len(got) == len(rows)
    words = {}
    for d, t, s in rows:
        words[s] = words.get(s, 0) + len((t or "").split())
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    want = filled(words, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    by_size = {(words[s], round(want[s], 6)) for s in order}
    assert {(r.source_size, round(r.target, 6)) for r in got} == by_size
    took = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        took[r.source_size] = took.get(r.source_size, 0) + r.taken
    for s in order:
        assert abs(took[words[s]] - want[s]) <= 0.02 * want[s] + 64
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, m.taken(frame(spark, rows[::-1]).repartition(5), block=16, slots=64).collect()), key=repr)


def test_permutations_meet_every_block(spark):
    sizes = spark.createDataFrame([(1, "a", 64 * 997, 5)], "doc_id long, source string, size long, h long")
    sources = m.targets(sizes)
    blocks = m.mix(sources).groupBy("block").count()
    assert blocks.count() == 997 and {r["count"] for r in blocks.collect()} == {1, 2}


def test_pieces_change_nothing(spark, rows, monkeypatch):
    whole = sorted(map(tuple, m.taken(frame(spark, rows)).collect()), key=repr)
    monkeypatch.setattr(m, "PIECE", 3)
    assert sorted(map(tuple, m.taken(frame(spark, rows)).collect()), key=repr) == whole


def test_nothing_to_mix(spark):
    assert m.taken(frame(spark, [])).count() == 0
    assert [r.taken for r in m.taken(frame(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]
    assert m.taken(frame(spark, [(1, "one two", "a")])).agg(F.sum("taken")).first()[0] in (2, 4)
