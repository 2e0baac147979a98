"""Mixing sources to target weights with blocks of words.

The words of a source, its documents in the order of a hash, are cut into blocks of fixed length. A mix is a number of shards of
`slots` blocks each. A shard's slots are dealt to the sources: the whole part of a source's expected count is its own, and in
every unit of what remains one categorical draw decides (a stratified multinomial: every expectation is kept, at the smallest variance).
The j-th slot of a source takes the block at place j modulo n of a permutation of its n blocks, a new permutation for each round.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and share `share` of all words. A target stops at `most`
times its source; the excess goes to the others by weight until none is above. A source's slot beyond round `most` stays empty.

Null texts have no words. Repeated rows are documents of their own; rows without an id or source count like others. Sources and
documents without words take nothing. An empty table gives no rows. Other columns are not carried.

A source may hold any share of the rows: places in it are prefix sums over pieces of its hash range, joined by one row for each piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from framelake.llm.common import hash32, prefix_sum, query, read, stored, word_count

BLOCK, SLOTS, PIECE = 64, 256, 20_000
#: Multipliers of the permutations. No number of blocks below 10**18 has three of them as factors.
PRIMES = (1_000_003, 999_983, 1_000_033)


def sized(docs: DataFrame) -> DataFrame:
    """What mixing needs of the documents: id, source, number of words, place in the order."""
    return stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), hash32(F.col("doc_id")).alias("h")), "sizes")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source: number, size, weight and target. Only sums of sources meet in a task."""
    one = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("sid") - 1) % len(weights))
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("sid", F.row_number().over(one))
         .withColumn("weight", weight).withColumn("room", F.lit(most) * F.col("source_size")))
    whole, poorest = W.partitionBy(), W.orderBy(F.col("room") / F.col("weight"), "sid").rowsBetween(W.unboundedPreceding, -1)
    s = (s.withColumn("budget", F.lit(share) * F.sum("source_size").over(whole)).withColumn("weights", F.sum("weight").over(whole))
         .withColumn("used", F.coalesce(F.sum("room").over(poorest), F.lit(0)))
         .withColumn("taken_weights", F.coalesce(F.sum("weight").over(poorest), F.lit(0))))
    level = (F.col("budget") - F.col("used")) / (F.col("weights") - F.col("taken_weights"))
    s = s.withColumn("full", F.col("room") <= level * F.col("weight"))
    free = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(whole), F.lit(0))
    rest = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    return s.withColumn("target", F.when(F.col("full"), F.col("room").cast("double")).otherwise(free / rest * F.col("weight"))).select(
        "source", "sid", "source_size", "weight", "target")


def _plan(sources: DataFrame, block: int, slots: int, most: int) -> tuple[DataFrame, int]:
    """Per source with words its number of blocks, its whole slots in a shard and its stretch of what remains; number of shards."""
    s = (sources.filter("source_size > 0").withColumn("n_blocks", F.ceil(F.col("source_size") / block))
         .withColumn("wanted", F.col("target") * F.col("n_blocks") / F.col("source_size")))
    total = s.agg(F.sum("wanted"), F.count("*")).first()
    if not total[0]:
        return s, 0
    slots = max(slots, 8 * total[1])  # rows of (shard, source) stay below the slots
    shards = max(1, round(total[0] / slots))
    s = (s.withColumn("expected", F.col("wanted") / shards).withColumn("own", F.floor("expected"))
         .withColumn("rest", F.col("expected") - F.col("own"))
         .withColumn("high", F.sum("rest").over(W.orderBy("sid"))).withColumn("low", F.col("high") - F.col("rest")))
    return s, shards


def _prime(n: Column, turn: int) -> Column:
    p = PRIMES[turn % 3:] + PRIMES[:turn % 3]
    return F.when(n % p[0] != 0, p[0]).when(n % p[1] != 0, p[1]).otherwise(p[2]).cast("long")


def mix(sources: DataFrame, block: int = BLOCK, slots: int = SLOTS, most: int = 2) -> DataFrame:
    """The mix: shard, sid, slot (place among the shard's slots of the source), block (its number in the source)."""
    plan, shards = _plan(sources, block, slots, most)
    if not shards:
        return sources.sparkSession.createDataFrame([], "shard long, sid int, slot long, block long")
    n = plan.count()
    numbered = plan.withColumn("source_no", F.row_number().over(W.orderBy("sid")).cast("long") - 1)
    dealt = sources.sparkSession.range(shards * n).select(F.floor(F.col("id") / n).alias("shard"), (F.col("id") % n).alias("source_no"))
    rows = dealt.join(numbered, "source_no")

    def hit(unit: Column) -> Column:
        """The draw in this unit of the rest falls to the source."""
        u = unit + (hash32(F.lit("mix"), F.col("shard"), unit.cast("long")) + 0.5) / F.lit(float(1 << 32))
        return ((u >= F.col("low")) & (u < F.col("high"))).cast("long")

    first, last = F.floor("low"), F.floor("high")
    rows = rows.withColumn("n", F.col("own") + hit(first) + F.when(last > first, hit(last)).otherwise(0))
    # Written, as the planner can't see how many rows an explode makes, and would broadcast them.
    rows = stored(rows.select("sid", "shard", "n_blocks", "n", F.floor(F.col("shard") / PIECE).alias("piece")), "counts")
    rows = prefix_sum(rows, "sid", "piece", ["shard"], "n", "begin")
    dealt = (rows.filter("n > 0").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
             .withColumn("j", F.col("begin") + F.col("slot")).withColumn("turn", F.floor(F.col("j") / F.col("n_blocks")))
             .filter(F.col("turn") < most).withColumn("at", F.col("j") % F.col("n_blocks")))
    step = _prime(F.col("n_blocks"), 0)
    for turn in range(1, most):
        step = F.when(F.col("turn") == turn, _prime(F.col("n_blocks"), turn)).otherwise(step)
    shift = hash32(F.lit("start"), F.col("sid"), F.col("turn"))
    return dealt.select("shard", "sid", "slot", ((F.col("at") * step + shift) % F.col("n_blocks")).alias("block"))


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with words, and where their words begin in their source."""
    ids = sources.select(F.col("source").alias("_source"), "sid")
    n = sizes.count()
    pieces = -(-n // PIECE) or 1
    rows = (sizes.filter("size > 0").join(ids, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("piece", F.floor(F.col("h") * pieces / (1 << 32))))
    return prefix_sum(rows, "sid", "piece", ["h", "doc_id", "size"], "size", "begin").drop("piece")


def in_blocks(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each document and block that share words, with their number."""
    end = F.col("begin") + F.col("size")
    rows = documents.withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((end - 1) / block))))
    return rows.withColumn("words", F.least(end, (F.col("block") + 1) * block) - F.greatest(F.col("begin"), F.col("block") * block))


def taken(docs: DataFrame, block: int = BLOCK, slots: int = SLOTS) -> DataFrame:
    """Per document its words and how many the mix takes of them, repeats counted."""
    sizes = sized(docs)
    sources = stored(targets(sizes), "sources")
    times = stored(mix(sources, block, slots).groupBy("sid", "block").agg(F.count("*").alias("times")), "times")
    parts = in_blocks(placed(sizes, sources), block).join(times, ["sid", "block"])
    # A place in a source belongs to one document: the key of a row, also among repeated ones.
    sums = parts.groupBy("sid", "begin").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    own = placed(sizes, sources).join(sums, ["sid", "begin"], "left").select("doc_id", "sid", "size", "taken")
    ids = sources.select(F.col("source").alias("_source"), F.col("sid").alias("sid"))
    empty = (sizes.filter("size = 0").join(ids, F.col("source").eqNullSafe(F.col("_source")))
             .select("doc_id", "sid", "size", F.lit(0).cast("long").alias("taken")))
    return (own.unionByName(empty).join(sources, "sid")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


OP9_SQL = r"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+'))::BIGINT AS size,
           ('0x' || left(md5(doc_id::VARCHAR), 8))::BIGINT AS h
    FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM s0),
s2 AS (SELECT *, [5, 2, 1][((sid - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS room FROM s1),
s3 AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()::BIGINT AS budget, sum(weight) OVER ()::BIGINT AS weights,
              coalesce(sum(room) OVER p, 0)::BIGINT AS used, coalesce(sum(weight) OVER p, 0)::BIGINT AS taken_weights
       FROM s2 WINDOW p AS (ORDER BY room::DOUBLE / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, room <= (budget - used) / (weights - taken_weights) * weight AS is_full FROM s3),
sources AS (SELECT source, sid, source_size,
                   CASE WHEN is_full THEN room::DOUBLE
                        ELSE (budget - coalesce(sum(room) FILTER (is_full) OVER (), 0)::BIGINT) / (sum(weight) FILTER (NOT is_full) OVER ())::BIGINT * weight END AS target
            FROM s4),
p0 AS (SELECT sid, source_size, ceil(source_size / 64.0)::BIGINT AS n_blocks, target FROM sources WHERE source_size > 0),
p1 AS (SELECT *, target * n_blocks / source_size AS wanted FROM p0),
sh AS (SELECT greatest(1, round(sum(wanted) / greatest(256, 8 * count(*))))::BIGINT AS shards FROM p1),
p2 AS (SELECT sid, n_blocks, floor(wanted / shards)::BIGINT AS own, wanted / shards - floor(wanted / shards) AS rest, shards FROM p1, sh),
p3 AS (SELECT *, sum(rest) OVER (ORDER BY sid) AS high FROM p2),
p4 AS (SELECT *, high - rest AS low, unnest(range(0, shards)) AS shard FROM p3),
d0 AS (SELECT *, floor(low)::BIGINT AS u1, floor(high)::BIGINT AS u2 FROM p4),
d1 AS (SELECT *, u1 + (('0x' || left(md5('mix:' || shard || ':' || u1), 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS x1,
              u2 + (('0x' || left(md5('mix:' || shard || ':' || u2), 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS x2 FROM d0),
d2 AS (SELECT sid, n_blocks, shard, own + (x1 >= low AND x1 < high)::BIGINT + CASE WHEN u2 > u1 THEN (x2 >= low AND x2 < high)::BIGINT ELSE 0 END AS n FROM d1),
d3 AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY sid ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_j FROM d2),
d4 AS (SELECT sid, n_blocks, first_j + unnest(range(0, n)) AS j FROM d3),
d5 AS (SELECT sid, n_blocks, j % n_blocks AS place, j // n_blocks AS turn FROM d4 WHERE j // n_blocks < 2),
times AS (SELECT sid, (place * CASE WHEN turn = 0 THEN CASE WHEN n_blocks % 1000003 <> 0 THEN 1000003 WHEN n_blocks % 999983 <> 0 THEN 999983 ELSE 1000033 END
                                 ELSE CASE WHEN n_blocks % 999983 <> 0 THEN 999983 WHEN n_blocks % 1000033 <> 0 THEN 1000033 ELSE 1000003 END END
                        + ('0x' || left(md5('start:' || sid || ':' || turn), 8))::BIGINT) % n_blocks AS block, count(*) AS times
          FROM d5 GROUP BY 1, 2),
docs AS (SELECT doc_id, size, sid, source_size, target,
                coalesce(sum(size) OVER (PARTITION BY sid ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_word
         FROM sizes JOIN sources ON sizes.source IS NOT DISTINCT FROM sources.source),
parts AS (SELECT doc_id, size, sid, first_word, unnest(range(first_word // 64, (first_word + size - 1) // 64 + 1)) AS block FROM docs WHERE size > 0),
sums AS (SELECT sid, first_word, sum((least(first_word + size, (parts.block + 1) * 64) - greatest(first_word, parts.block * 64)) * times)::BIGINT AS taken
         FROM parts JOIN times USING (sid, block) GROUP BY 1, 2)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN coalesce(taken, 0) ELSE 0 END::BIGINT AS taken
FROM docs LEFT JOIN sums USING (sid, first_word)
"""


@query("op9_source_mixing", OP9_SQL)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return taken(read(spark, sf, "documents"))
