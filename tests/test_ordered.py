"""Long groups cut into pieces give the rows of a plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from framelake.operators import ordered


def table(spark, seed, hot=800, cold=60):
    rng = random.Random(seed)
    rows, n = [], 0
    for key, size in (("hot", hot), ("warm", 150), (None, 120), *((f"c{i}", 3) for i in range(cold // 3))):
        for step in rng.sample(range(100_000), size):
            # a burst: most of the hot key's rows lie in a narrow range
            order = step % 9000 if key == "hot" and rng.random() < 0.7 else step
            rows.append((key, order, n, rng.randint(0, 3)))
            n += 1
    return spark.createDataFrame(rows, "k string, o long, tie long, v int").repartition(5).cache()


def same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("limit", [25, 10_000])
def test_neighbours(spark, limit):
    df = table(spark, 1)
    w = Window.partitionBy("k").orderBy("o", "tie")
    got = ordered.previous(df, ["k"], ["o", "tie"], F.col("v"), "p", limit)
    got = ordered.following(got, ["k"], ["o", "tie"], F.col("v"), "n", limit)
    want = df.withColumns({"p": F.lag("v").over(w), "n": F.lead("v").over(w)})
    assert same(got.select("k", "o", "tie", "p.v", "n.v"), want.select("k", "o", "tie", "p", "n"))


@pytest.mark.parametrize("limit", [25, 10_000])
@pytest.mark.parametrize("backward", [False, True])
def test_running(spark, limit, backward):
    df = table(spark, 2)
    cols = [F.col(c).desc() if backward else F.col(c).asc() for c in ("o", "tie")]
    w = Window.partitionBy("k").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    got = ordered.running(df, ["k"], ["o", "tie"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, backward, limit)
    want = df.withColumns({"s": F.sum("v").over(w), "m": F.max("v").over(w)})
    assert same(got.select("k", "o", "tie", "s", "m"), want.select("k", "o", "tie", "s", "m"))


def test_fixed_pieces(spark):
    df = table(spark, 3)
    w = Window.partitionBy("k").orderBy("o", "tie").rowsBetween(Window.unboundedPreceding, 0)
    got = ordered.running(df, ["k"], ["o", "tie"], {"s": ("sum", F.col("v"))}, piece=F.floor(F.col("o") / 5000))
    want = df.withColumn("s", F.sum("v").over(w))
    assert same(got.filter("k is not null").select("k", "o", "tie", "s"), want.filter("k is not null").select("k", "o", "tie", "s"))


def test_hot_group_is_split(spark):
    split = ordered.split_long_groups(table(spark, 4, hot=5000), ["k"], "o", limit=100)
    sizes = split.filter("k = 'hot'").groupBy("_piece").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[1] > 50 and sizes[0] < 1000
    assert split.filter("k like 'c%' and _piece <> 0").count() == 0


def test_numbers_are_dense(spark):
    out = ordered.number_rows(table(spark, 5), ["k"], ["o", "tie"], "pos", 30).groupBy("k").agg(
        F.min("pos"), F.max("pos"), F.count("*"), F.countDistinct("pos")).collect()
    assert all(r[1] == 0 and r[2] + 1 == r[3] == r[4] for r in out)


def test_order_frames(spark):
    df = spark.createDataFrame([(c, n) for c in range(3) for n in random.Random(0).sample(range(500), 200)], "camera int, frame_num int")
    parts = ordered.order_frames(df, partitions=4).rdd.glom().collect()
    flat = [tuple(r) for p in parts for r in p]
    assert flat == sorted(flat) and len(parts) > 2
