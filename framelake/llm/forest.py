"""Near-duplicates by an LSH forest over MinHash signatures.

A document's set are its distinct word shingles; equal sets are one node from the start, so exact copies meet in one sum. Each of
the forest's trees sorts the nodes by their signature in an order of its own. Nodes that share the first `DEPTH` values form a
region; candidates are neighbours in the sorted order of a region, longest common prefix first. A region of more than
`crowd` nodes is descended further: to all of a label's values, and where even these agree, in pieces that also meet the
smallest node of the region. So a node has a fixed number of candidates in each tree, however large a group of copies is.

Candidates are confirmed on the full sets in rounds: first each node's most frequent candidates, then those of the rest that join
different components, until none is left. A candidate between nodes that are connected already can't change the answer.

In a crowd the neighbours in the order aren't all that may link. So nodes are clustered by candidates that two trees agree on, and
what isn't connected within a cluster is joined by prefixes: of a set of n shingles, ordered by how many sets of the cluster
hold them, the rarest n - ceil(0.8 n) + 1 must share one with every set it links to, and the rarest n - ceil(8/9 n) + 1 with every larger
one. Two bounds on what a pair can have in common are part of the join: what stands at and after the shared shingle in either order, and the bits in
which the sets' parities differ, as a shingle that only one of them holds changes one bit. The pairs of different components that fit are
confirmed on the full sets. That is exact within a cluster; copies that have become one component cost nothing.

A link at similarity 0.8 is missed only if no candidate chain that two trees agree on (or one tree names it) brings it into a cluster. Outside
a crowd that takes two sets that share a region in one of the 32 trees at most, 1e-6 at depth 4; the tests measure it in crowds.

Null and blank texts have an empty set and are linked with nothing; a text with fewer words than a shingle has all of them as its one
shingle. Rows with one id are each a document; a row without an id can link others, has the component of its group and isn't
kept (an empty one has none). Ties go to the smaller id. An empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from framelake.llm.common import discard, lowered, mix64, query, read, stored, word_hashes
from framelake.llm.components import components

VALUES, TREES, DEPTH, NEAR, CROWD = 128, 32, 4, 2, 4000
#: Bits of the parity of a set, in longs.
PARITY = 4

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1 << 31, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)
#: Signature places in the order of each tree, as far as its labels go; the first halves have no place in common.
_ORDERS = np.concatenate([_rng.permutation(VALUES).reshape(TREES, DEPTH) for _ in range(2)], axis=1)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-word shingles."""
    h, _ = word_hashes(lowered(text))
    if not len(h):
        return h
    m = max(1, len(h) - n + 1)
    out = np.zeros(m, np.uint64)
    for j in range(min(n, len(h))):
        out = mix64(out * np.uint64(3) + h[j:j + m] + np.uint64(j + 1))
    return np.unique(out)


def signature(s: np.ndarray) -> np.ndarray:
    low = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 2048):
        v = (low[i:i + 2048, None] ^ _SHIFTS) * _FACTORS
        np.minimum(out, v.min(axis=0), out=out)
    return out


def parity(s: np.ndarray) -> np.ndarray:
    """One bit for each residue of a shingle's hash: whether an odd number of shingles has it."""
    odd = np.bincount((s % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _sign(n: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, n) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(_digest, sets), pa.binary()),
                pa.array((signature(s).tobytes() if len(s) else None for s in sets), pa.binary())],
                ["doc_id", "n_shingles", "class", "signature"])
    return sign


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node's place in every tree: two longs of DEPTH 16-bit values each."""
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            node = batch.column("node").slice(i, 1024).to_numpy()
            k = len(node)
            sig = np.frombuffer(b"".join(batch.column("signature").slice(i, 1024).to_pylist()), np.uint32)
            values = sig.reshape(-1, VALUES).astype(np.uint16).astype(np.uint64)[:, _ORDERS]  # nodes x trees x values
            halves = [np.zeros((k, TREES), np.uint64) for _ in range(2)]
            for j in range(2 * DEPTH):
                halves[j // DEPTH] = (halves[j // DEPTH] << np.uint64(16)) | values[:, :, j]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.tile(np.arange(TREES, dtype=np.int32), k)), pa.array(halves[0].view(np.int64).reshape(-1)),
                pa.array(halves[1].view(np.int64).reshape(-1)), pa.array(np.repeat(node, TREES))], ["tree", "high", "low", "node"])


def _neighbours(rows: DataFrame, keys: list[str]) -> DataFrame:
    order = W.partitionBy(*keys).orderBy("low", "node")
    following = F.array(*[F.lead("node", k).over(order) for k in range(1, NEAR + 1)])
    pairs = rows.select("node", following.alias("near")).select(F.col("node").alias("x"), F.explode(F.array_compact("near")).alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def candidates(labels: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b, trees): pairs of nodes and in how many trees they are neighbours."""
    region = ["tree", "high"]
    sizes = labels.groupBy(*region).agg(F.count("*").alias("size")).filter("size > 1")
    rows = labels.join(sizes, region)
    crowded = crowd_rows = stored(rows.filter(F.col("size") > crowd).drop("size"), "crowded")
    deep = [*region, "low"]
    stats = crowded.groupBy(*deep).agg(F.count("*").alias("size"), F.min("node").alias("least"))
    crowded = crowded.join(stats, deep).withColumn("piece", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / crowd)).cast("int"))
    star = (crowded.filter((F.col("size") > crowd) & (F.col("node") > F.col("least")))
            .select(F.col("least").alias("a"), F.col("node").alias("b")))
    pairs = (_neighbours(rows.filter(F.col("size") <= crowd), region)
             .unionByName(_neighbours(crowded, [*deep, "piece"])).unionByName(star))
    out = stored(pairs.groupBy("a", "b").agg(F.count("*").alias("trees")), "candidates")
    discard(crowd_rows)
    return out


def _best(pairs: DataFrame, most: int) -> DataFrame:
    """The pairs that are among the most frequent ones of either node."""
    both = pairs.select("a", "b", "trees", F.col("a").alias("x")).unionByName(pairs.select("a", "b", "trees", F.col("b").alias("x")))
    one = W.partitionBy("x").orderBy(F.desc("trees"), "a", "b")
    return both.withColumn("_n", F.row_number().over(one)).filter(F.col("_n") <= most).select("a", "b").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a, b = (sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab")
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    return pairs.join(a, "a").join(b, "b").filter(100 * both >= percent * either).select("a", "b")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs of nodes that aren't connected yet."""
    for x in "ab":
        pairs = pairs.join(groups.select(F.col("node").alias(x), F.col("component").alias(f"in_{x}")), x, "left")
    return pairs.filter(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).drop("in_a", "in_b")


def _joined(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components with more links: those so far come as one pair for each node."""
    if groups is not None:
        links = links.unionByName(groups.select(F.col("component").alias("a"), F.col("node").alias("b")))
    out = components(links)
    discard(groups)
    return out


def _stragglers(pairs: DataFrame, groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components that meet in a cluster of candidates."""
    clusters = components(pairs.filter("trees > 1")).select("node", F.col("component").alias("cluster"))
    members = (clusters.join(groups, "node", "left").select("node", "cluster", F.coalesce("component", "node").alias("part")))
    members = stored(members, "members")
    parts = members.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    several = (parts.groupBy("cluster").agg(F.max(F.struct("n", "part"))["part"].alias("largest"), F.count("*").alias("parts"))
               .filter("parts > 1").select("cluster", "largest"))
    size = F.size("set").cast("long")
    work = members.join(several, "cluster").join(sets, "node").select("node", "cluster", "part", (F.col("part") != F.col("largest")).alias("outside"), "set", "parity")
    work = stored(work, "work")
    shingles = work.select("cluster", "node", "part", "outside", size.alias("size"), F.explode("set").alias("shingle"))
    # A shingle of one set links nothing, but takes a place in its prefix.
    counts = shingles.groupBy("cluster", "shingle").agg(F.count("*").alias("n"), F.bool_or("outside").alias("any")).filter("n > 1")
    shared = shingles.join(counts, ["cluster", "shingle"]).groupBy("cluster", "node", "part", "outside", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle", "any"))).alias("shared"))
    words = [f"w{i}" for i in range(PARITY)]
    # Of two sets that link, their first common shingle stands in this prefix of the larger, and in a shorter one of the smaller.
    alone = F.col("size") - F.size("shared")
    prefix, shorter = F.expr(f"size - (size * {percent} + 99) div 100 + 1"), F.expr(f"size - (2 * {percent} * size + {99 + percent}) div {100 + percent} + 1")
    room = F.greatest(prefix - alone, F.lit(0)).cast("int")
    prefixes = shared.select("cluster", "node", "part", "outside", "size", alone.alias("alone"), (shorter - alone).alias("early"), F.slice("shared", F.lit(1), room).alias("prefix"))
    parities = work.select("node", *[F.get("parity", F.lit(i)).alias(w) for i, w in enumerate(words)])
    rows = (prefixes.join(parities, "node")
            .select("cluster", "node", "part", "outside", "size", "alone", "early", *words, F.posexplode("prefix").alias("at", "x")).filter("x.any")
            .select("cluster", "node", "part", "outside", "size", (F.col("at") < F.col("early")).alias("early"),
                    (F.col("size") - F.col("alone") - F.col("at")).alias("after"), *words, "x.shingle"))
    rows = stored(rows, "prefixes")
    a, b = (rows.select("cluster", "shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "part", "size", "outside", "early", "after", *words)]) for x in "ab")
    smaller = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("node_a") < F.col("node_b")))
    both, apart = F.col("size_a") + F.col("size_b"), sum(F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in words)
    # The first shared shingle of two sets that link passes the bound on what comes after it.
    fits = ((F.col("part_a") != F.col("part_b")) & (100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
            & ((100 + percent) * F.least("after_a", "after_b") >= percent * both) & ((100 + percent) * (both - apart) >= 2 * percent * both)
            & (~F.col("outside_b") | (F.col("node_a") < F.col("node_b"))) & F.when(smaller, F.col("early_a")).otherwise(F.col("early_b")))
    met = a.filter("outside_a").join(b, ["cluster", "shingle"]).filter(fits).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    out = stored(_confirmed(met, work.select("node", "set"), percent), "stragglers")
    discard(members, work, rows)
    return out


def _sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, n) for t in batch.column("text").to_pylist()]
            digest = [_digest(s) for s in found]
            keep = [i for i, s in enumerate(digest) if s == batch.column("class")[i].as_py() or batch.column("class")[i].as_py() is None]
            yield pa.RecordBatch.from_arrays([
                batch.column("node").take(pa.array(keep, pa.int64())), pa.array([digest[i] for i in keep], pa.binary()),
                pa.array([found[i].view(np.int64) for i in keep], pa.list_(pa.int64())),
                pa.array([parity(found[i]) for i in keep], pa.list_(pa.int64()))], ["node", "class", "set", "parity"])
    return sets


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, set, parity) of the wanted nodes (node, least_id, class), from a document of each; another text may have the same id."""
    kind = "node long, class binary, `set` array<bigint>, parity array<bigint>"
    by_id = (docs.join(wanted.select(F.col("least_id").alias("doc_id"), "node", "class"), "doc_id")
             .select("node", "class", "text").mapInArrow(_sets(words), kind).select("node", "set", "parity"))
    none = F.lit(None).cast("long").alias("node"), F.lit(None).cast("binary").alias("class")
    without = (docs.filter("doc_id is null").select(*none, "text").mapInArrow(_sets(words), kind).drop("node")
               .join(wanted.filter("least_id is null").select("node", "class"), "class").select("node", "set", "parity"))
    return by_id.unionByName(without).dropDuplicates(["node"])


def link(docs: DataFrame, words: int = 5, percent: int = 80, crowd: int = CROWD) -> DataFrame:
    """Per document its set's size, its component (the smallest id reachable) and whether it is the one to keep."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    signed = stored(docs.mapInArrow(_sign(words), "doc_id long, n_shingles long, class binary, signature binary"), "signed")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "signature")
    classes = (signed.filter("class is not null").groupBy("class").agg(F.min(first).alias("first"))
               .select("class", F.col("first.doc_id").alias("least_id"), F.col("first.signature").alias("signature")))
    classes = stored(classes.withColumn("node", F.coalesce("least_id", F.xxhash64("class"))), "classes")
    labels = stored(classes.select("node", "signature").mapInArrow(_label, "tree int, high long, low long, node long"), "labels")
    pairs = candidates(labels, crowd)
    discard(labels)
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = stored(_sets_of(docs, classes.select("node", "least_id", "class").join(nodes, "node"), words), "sets")

    found, groups = pairs, None
    for most in (2, None):
        left = pairs if groups is None else stored(_apart(pairs, groups), "left")
        chosen = left.select("a", "b") if most is None else stored(_best(left, most), "chosen")
        confirmed = stored(_confirmed(chosen, sets, percent), "links")
        pairs = left.join(chosen, ["a", "b"], "left_anti")
        groups = _joined(groups, confirmed)
        discard(confirmed)
    groups = _joined(groups, _stragglers(found, groups, sets, percent))
    discard(sets, found)

    reached = classes.join(groups, "node", "left").select("class", "least_id", F.coalesce("component", "node").alias("component"))
    least = reached.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = reached.join(least, "component").select("class", "component_id")
    out = signed.select("doc_id", "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = stored(out.withColumn("component_id", component).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")), "linked")
    discard(signed, classes, groups)
    return out


@query("op3_lsh_forest")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return link(read(spark, sf, "documents"), words=2)
