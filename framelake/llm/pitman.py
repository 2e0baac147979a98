"""Language model scores from a hierarchical Pitman-Yor process.

Every word is a restaurant that seats the words which follow it; all these share one parent, the restaurant of all words, whose base
gives each of the V known words and the class of all unknown ones the same probability. A table of a word's restaurant sends a
customer to the parent. Seating is sampled by Gibbs sweeps from the minimal one (a table for each kind of pair): given the sums of the
sweep before, the tables of a kind are drawn anew, customer by customer (beyond EXACT customers in growing steps, by their
expectation rounded at random). Random numbers depend on the pair and the sweep alone, so whoever draws gets the same. The score
averages the predictive probabilities over the sweeps. Discounts come from the counts of kinds seen once and twice.

Words are lower-cased (A-Z); every text ends with an end token and begins after a start, which isn't scored. Learned from are all
documents but the held out ones. An unknown word is the unknown class. A null text has only its end. Rows with a null id are
learned from. Repeated rows count each. With nothing to learn from every token has probability 1. An empty table gives no rows. Other
columns are not carried.

Documents go into blocks of bounded size, so that what tasks exchange are arrays of hashes, each kind once for a block: no word or
pair, however frequent, weighs more than one number per block. Pairs are looked up by 32 bits within a part of bounded
size, where one in some thousands meets another; words by 64 bits. Blocks are bucketed tables, and stay where they are.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import delete, discard, lowered, mix64, query, read, stored, word_hashes
from framelake.session import scratch_dir

BLOCK_TOKENS, PART_KEYS, SWEEPS, STRENGTH, EXACT = 1_500_000, 2_000_000, 2, 1.0, 64
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
_PAIR = np.uint64(0xD1342543DE82EF95)


def _bucketed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows as a table whose blocks are joined where they are, and its name in the catalog."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", f"{scratch_dir(spark)}/{table}").option("compression", "zstd").bucketBy(n, "block").saveAsTable(table)
    return spark.table(table), table


# Blocks

BLOCK = ("block long, doc_ids array<long>, held array<boolean>, lengths array<long>, n_tokens long, n_words long, words binary, trained binary, "
         "low binary, high binary")


def _block(number: int, docs: list[tuple]) -> pa.RecordBatch:
    """One row: the distinct words by falling frequency with their counts in training, and the texts as places in that list."""
    ids, held, hashes = zip(*docs)
    lengths = np.array([len(h) for h in hashes])
    words, at, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    at = rank[at]
    learned = ~np.repeat(np.array(held, bool), lengths)
    trained = np.bincount(at[learned], minlength=len(words))
    words = np.append(words[order], START)
    trained = np.append(trained, len(held) - sum(held)).astype(np.uint32)
    values = [pa.array([number]), pa.array([list(ids)], pa.list_(pa.int64())), pa.array([list(held)], pa.list_(pa.bool_())),
              pa.array([lengths.tolist()], pa.list_(pa.int64())), pa.array([len(at)]), pa.array([len(words)]),
              *[pa.array([x.tobytes()], pa.binary()) for x in (words, trained, (at & 0xFFFF).astype(np.uint16), (at >> 16).astype(np.uint16))]]
    return pa.RecordBatch.from_arrays(values, [c.split()[0] for c in BLOCK.split(", ")])


def _blocks(most: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, size, number = [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            for doc, held, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text")]):
                h = np.append(word_hashes(lowered(text))[0], END)
                docs.append((doc, held, h))
                size += len(h)
                if size >= most:
                    yield _block(number, docs)
                    docs, size, number = [], 0, number + 1
        if docs:
            yield _block(number, docs)
    return run


class Block:
    """A row of the blocks with its kinds of pairs."""

    def __init__(self, row: dict) -> None:
        self.words = np.frombuffer(row["words"], np.uint64)
        self.trained = np.frombuffer(row["trained"], np.uint32)
        self.tokens = np.frombuffer(row["low"], np.uint16).astype(np.int64) | np.frombuffer(row["high"], np.uint16).astype(np.int64) << 16
        self.lengths = np.array(row["lengths"])
        self.held = np.array(row["held"], bool)
        self.ends = np.cumsum(self.lengths)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.ends - self.lengths] = len(self.words) - 1
        pairs, self.kind = np.unique(before * len(self.words) + self.tokens, return_inverse=True)
        self.before, self.word = np.divmod(pairs, len(self.words))
        self.keys = pair_keys(self.words, self.before, self.word)


def pair_keys(words: np.ndarray, before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(words[before] * _PAIR + words[word])


# Looking up arrays of keys: a block sends them part by part and gets values back in the same order.

def _packed(x: np.ndarray) -> bytes:
    """Counts, mostly small, as compressed planes of bytes."""
    return zlib.compress(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _sent(block: int, keys: np.ndarray, parts: int, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
    part = ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    for p in range(parts):
        at = order[edges[p]:edges[p + 1]]
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([p], pa.int32()), pa.array([keys[at].tobytes()], pa.binary()),
                 *[pa.array([_packed(x[at])], pa.binary()) for x in values]],
                ["block", "part", "keys", *[f"v{i}" for i in range(len(values))]])


def _restored(keys: np.ndarray, parts: int, got: list[dict], name: str, kind: type) -> np.ndarray:
    part = ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
    out = np.empty(len(keys), kind)
    got = sorted(got, key=lambda r: r["part"])
    if got:
        out[np.argsort(part, kind="stable")] = np.concatenate([_unpacked(r[name], kind) for r in got])
    return out


def _keys(rows: list[dict], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(r["keys"] for r in rows), kind)


def _joined(rows: list[dict], name: str, kind: type) -> np.ndarray:
    return np.concatenate([_unpacked(r[name], kind) for r in rows])


def _answer(rows: list[dict], values: dict[str, np.ndarray], sums: dict[str, int]) -> pa.Table:
    """Each sender's part of the values, and the part's sums in the first row."""
    sizes = np.cumsum([0] + [len(r["keys"]) for r in rows]) // rows[0]["_width"]
    cols = {"block": pa.array([r["block"] for r in rows], pa.int64()), "part": pa.array([r["part"] for r in rows], pa.int32())}
    for name, x in values.items():
        cols[name] = pa.array([_packed(x[a:b]) for a, b in zip(sizes[:-1], sizes[1:])], pa.binary())
    for name, x in sums.items():
        cols[name] = pa.array([int(x)] + [0] * (len(rows) - 1), pa.int64())
    return pa.table(cols)


def _received(table: pa.Table, width: int) -> list[dict]:
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    for r in rows:
        r["_width"] = width
    return rows


# Pairs

def _send_pairs(parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                learned = ~np.repeat(b.held, b.lengths)
                n = np.bincount(b.kind[learned], minlength=len(b.keys)).astype(np.uint32)
                for out in _sent(row["block"], b.keys, parts, n):
                    # The part says the upper bits, 32 lower ones tell its keys apart.
                    low = np.frombuffer(out.column("keys")[0].as_py(), np.uint64).astype(np.uint32)
                    yield out.set_column(2, "keys", pa.array([low.tobytes()], pa.binary()))
    return run


PAIRS = "block long, part int, n binary, once long, twice long"


def _count_pairs(table: pa.Table) -> pa.Table:
    """Training count of each key, doubled, plus 1 for the first block that learned from it."""
    rows = _received(table, 4)
    kinds, at = np.unique(_keys(rows, np.uint32), return_inverse=True)
    own = _joined(rows, "v0", np.uint32)
    n = np.bincount(at, own, len(kinds)).astype(np.int64)
    learned = np.flatnonzero(own)
    first = np.zeros(len(own), np.int64)
    first[learned[np.unique(at[learned], return_index=True)[1]]] = 1
    return _answer(rows, {"n": (2 * n[at] + first).astype(np.int32)}, {"once": (n == 1).sum(), "twice": (n == 2).sum()})


# Words

WORDS = ("block long, part int, n binary, tables binary, customers binary, root_tables binary, sum_n long, sum_words long, sum_customers long, "
         "sum_root_tables long, once long, twice long")


def _count_words(sweep: int, weight: float | None, discount: float) -> Callable:
    """Per word its training count, tables in its own restaurant, customers and tables in the parent."""
    def run(table: pa.Table) -> pa.Table:
        rows = _received(table, 8)
        words, at = np.unique(_keys(rows, np.uint64), return_inverse=True)
        n, tables, customers = (np.bincount(at, _joined(rows, f"v{i}", np.uint32), len(words)).astype(np.int64) for i in range(3))
        seated = np.minimum(customers, 1) if weight is None else seat(words, customers, np.full(len(words), weight), discount, sweep)
        real = (words != START) & (n > 0)
        return _answer(rows, {k: x[at].astype(np.uint32) for k, x in (("n", n), ("tables", tables), ("customers", customers), ("root_tables", seated))},
                       {"sum_n": n[real].sum(), "sum_words": real.sum(), "sum_customers": customers.sum(), "sum_root_tables": seated.sum(),
                        "once": (customers == 1).sum(), "twice": (customers == 2).sum()})
    return run


def seat(keys: np.ndarray, customers: np.ndarray, weight: np.ndarray, discount: float, sweep: int) -> np.ndarray:
    """Number of tables of each dish, drawn customer by customer; weight: that of a new table."""
    tables = np.minimum(customers, 1).astype(float)
    at = np.flatnonzero(customers > 1)
    n = 1
    while len(at):
        step = 1 if n < EXACT else n // 16
        m = np.minimum(step, customers[at] - n)
        u = (mix64(keys[at] ^ mix64(np.array([sweep * 0x1F123BB5 + n * 0x9E3779B1], np.uint64))) >> np.uint64(11)) * 2.0 ** -53
        p = weight[at] / (n - discount * tables[at] + weight[at])
        tables[at] += u < p if step == 1 else np.floor(np.minimum(m * p + u, m))
        n += step
        at = at[customers[at] > n]
    return tables.astype(np.int64)


def _discount(once: int | None, twice: int | None) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once and twice else 0.5


class Model:
    """What all blocks need to know: sums and discounts of the sweeps."""

    def __init__(self, parts: int, word_parts: int, discount: float) -> None:
        self.parts, self.word_parts, self.discount = parts, word_parts, discount
        self.n = self.words = 0
        self.root_discount = 0.5
        self.sweeps: list[tuple[int, int]] = []  # customers and tables in the parent

    def weight(self) -> float:
        """Weight of a new table for a word in the parent."""
        return (STRENGTH + self.root_discount * self.sweeps[-1][1]) / (self.words + 1)

    def root(self, sweep: int, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probability of words in the parent."""
        all_customers, all_tables = self.sweeps[sweep]
        new = (STRENGTH + self.root_discount * all_tables) / (self.words + 1)
        return (customers - self.root_discount * tables + new) / (STRENGTH + all_customers)


def _of_round(words: np.ndarray, model: Model, got: list[dict]) -> dict[str, np.ndarray]:
    return {k: _restored(words, model.word_parts, got, k, np.uint32).astype(np.int64) for k in ("n", "tables", "customers", "root_tables")}


def _seated(keys: np.ndarray, n: np.ndarray, before: np.ndarray, word: np.ndarray, model: Model, sweep: int, seen: dict[str, np.ndarray]) -> np.ndarray:
    """Tables of kinds of pairs in a sweep, given what was seen after the one before."""
    root = model.root(sweep - 1, seen["customers"], seen["root_tables"])
    weight = (STRENGTH + model.discount * seen["tables"][before]) * root[word]
    return seat(keys, n, weight, model.discount, sweep)


STATE = "block long, words binary, trained binary, base_tables binary, base_customers binary, before binary, word binary, n binary"


def _begin(model: Model) -> Callable:
    """The part of a block that sweeps work on: kinds it owns, those of one customer as sums."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            b = Block(row)
            n = _restored(b.keys, model.parts, right.to_pylist(), "n", np.int32)
            own, n = (n & 1) == 1, n >> 1
            single, many = own & (n == 1), own & (n > 1)
            out.append([row["block"], row["words"], row["trained"]] + [x.astype(np.uint32).tobytes() for x in (
                np.bincount(b.before[single], minlength=len(b.words)), np.bincount(b.word[single], minlength=len(b.words)), b.before[many], b.word[many], n[many])])
        return _table(out, STATE)
    return run


def _table(rows: list, schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


SENT = "block long, part int, keys binary, v0 binary, v1 binary, v2 binary"


def _sums(row: dict, model: Model, tables: np.ndarray) -> Iterator[pa.RecordBatch]:
    words = np.frombuffer(row["words"], np.uint64)
    base = [np.frombuffer(row[k], np.uint32) for k in ("base_tables", "base_customers")]
    own = [(b + np.bincount(np.frombuffer(row[k], np.uint32), tables, len(words))).astype(np.uint32) for b, k in zip(base, ("before", "word"))]
    return _sent(row["block"], words, model.word_parts, np.frombuffer(row["trained"], np.uint32), *own)


def _send_first(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _sums(row, model, np.ones(len(row["n"]) // 4))
    return run


def _sweep(model: Model, sweep: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            words = np.frombuffer(row["words"], np.uint64)
            before, word, n = (np.frombuffer(row[k], np.uint32).astype(np.int64) for k in ("before", "word", "n"))
            seen = _of_round(words, model, right.to_pylist())
            out += list(_sums(row, model, _seated(pair_keys(words, before, word), n, before, word, model, sweep, seen)))
        return pa.Table.from_batches(out) if out else _table([], SENT)
    return run


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _score(model: Model) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got: dict[int, list[dict]] = {}
        for r in right.to_pylist():
            got.setdefault(r["round"], []).append(r)
        out = []
        for row in left.to_pylist():
            b = Block(row)
            n = _restored(b.keys, model.parts, got[-1], "n", np.int32).astype(np.int64) >> 1
            rounds = [_of_round(b.words, model, got[s]) for s in range(len(model.sweeps))]
            many = np.flatnonzero(n > 1)
            p = np.zeros(len(n))
            for s in range(1, len(rounds)):
                tables = np.minimum(n, 1)
                tables[many] = _seated(b.keys[many], n[many], b.before[many], b.word[many], model, s, rounds[s - 1])
                r = rounds[s]
                root = model.root(s, r["customers"], r["root_tables"])
                p += (n - model.discount * tables + (STRENGTH + model.discount * r["tables"][b.before]) * root[b.word]) / (STRENGTH + r["n"][b.before])
            count = rounds[0]["n"]
            base = np.log10((count + 0.5) / (model.n + 0.5 * (model.words + 1)))
            score = np.log10(p / (len(rounds) - 1))[b.kind]
            first = b.ends - b.lengths
            sums = [np.add.reduceat(x, first) for x in ((count[b.tokens] > 0).astype(np.int64), base[b.tokens], score)]
            out += zip(row["doc_ids"], row["held"], row["lengths"], sums[0].tolist(), [model.n] * len(first), sums[1].tolist(), sums[2].tolist())
        return _table(out, SCORES)
    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def score(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, part_keys: int = PART_KEYS, sweeps: int = SWEEPS) -> DataFrame:
    """Base and model scores of all documents; learns from those that aren't held out."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    blocks, blocks_name = _bucketed(rows.mapInArrow(_blocks(block_tokens), BLOCK), "blocks")
    size = blocks.agg(F.sum("n_tokens"), F.sum("n_words")).first()
    parts, word_parts = (max(1, -(-(x or 0) // part_keys)) for x in size)
    sent = blocks.mapInArrow(_send_pairs(parts), "block long, part int, keys binary, v0 binary")
    pairs = stored(sent.groupBy("part").applyInArrow(_count_pairs, PAIRS), "pairs")
    model = Model(parts, word_parts, _discount(*pairs.agg(F.sum("once"), F.sum("twice")).first()))

    begun = blocks.groupBy("block").cogroup(pairs.select("block", "part", "n").groupBy("block")).applyInArrow(_begin(model), STATE)
    state, state_name = _bucketed(begun, "state")
    sent, rounds, tables = state.mapInArrow(_send_first(model), SENT), [], []
    for sweep in range(sweeps + 1):
        count = _count_words(sweep, None if sweep == 0 else model.weight(), model.root_discount)
        got = stored(sent.groupBy("part").applyInArrow(count, WORDS), "words")
        s = got.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sum_n", "sum_words", "sum_customers", "sum_root_tables", "once", "twice")]).first()
        if sweep == 0:
            model.n, model.words, model.root_discount = s.sum_n, s.sum_words, _discount(s.once, s.twice)
        model.sweeps.append((s.sum_customers, s.sum_root_tables))
        tables.append(got)
        values = got.select("block", "part", "n", "tables", "customers", "root_tables")
        rounds.append(values)
        if sweep < sweeps:
            sent = state.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(_sweep(model, sweep + 1), SENT)

    answers = pairs.select("block", F.lit(-1).alias("round"), "part", "n")
    for i, r in enumerate(rounds):
        answers = answers.unionByName(r.withColumn("round", F.lit(i)), allowMissingColumns=True)
    scored = stored(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(model), SCORES), "scores")
    for name in (blocks_name, state_name):
        docs.sparkSession.sql(f"DROP TABLE {name}")
        delete(docs.sparkSession, f"{scratch_dir(docs.sparkSession)}/{name}")
    discard(pairs, *tables)
    return scored


@query("op4_pitman_yor")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return score(read(spark, sf, "documents"))
