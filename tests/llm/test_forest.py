import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.llm import forest as f
from framelake.llm.components import components

SCHEMA = "node string, text string, doc_id long, class int, signature string"


def plain(rows, words, percent=80):
    """Component of each row by comparing all sets."""
    sets = []
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(s), c, d is not None and d == c) for i, ((d, _), s) in enumerate(zip(rows, sets))
            for c in [least.get(root(i)) if s else d]]


def frame(spark, rows):
    return spark.createDataFrame([("n", t, d, 0, "s") for d, t in rows], SCHEMA)


def corpus(seed, n, copies, change):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for _ in range(n):
        out.append([r.choice(words) for _ in range(r.choice((1, 2, 8, 30, 80)))])
        for _ in range(copies):
            t = list(out[r.randrange(len(out))])
            for _ in range(r.randrange(change + 1)):
                t[r.randrange(len(t))] = r.choice(words)
            out.append(t)
    return [(i * 3, " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("words,crowd", [(2, 4000), (2, 8), (5, 4000)])
def test_components_by_brute_force(spark, words, crowd):
    rows = corpus(1, 60, 4, 3) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "One"), (1004, "one"), (None, "one"), (None, "w1 w2 w3 only here"),
                                  (None, "W1 w2 w3 only here"), (1005, "same id"), (1005, "same id"), (1005, "another text"), (1006, "long " * 50_000)]
    got = f.link(frame(spark, rows), words, crowd=crowd).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows, words), key=repr)


def test_one_large_group(spark):
    r = random.Random(3)
    base = [f"w{r.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(400):
        t = list(base)
        for _ in range(r.randrange(6)):
            t[r.randrange(len(t))] = f"x{r.randrange(10_000)}"
        rows.append((i, " ".join(t)))
    rows += [(1000 + i, " ".join(base)) for i in range(200)]
    for crowd in (10, 4000):
        got = f.link(frame(spark, rows), 2, crowd=crowd).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(plain(rows, 2), key=repr)


def test_signature_estimates_similarity():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 1 << 63, 5000).astype(np.uint64))
    b = np.concatenate([a[:4500], r.integers(0, 1 << 63, 500).astype(np.uint64)])
    assert abs((f.signature(a) == f.signature(b)).mean() - 4500 / 5500) < 0.12
    assert len(np.unique(f._ORDERS[:, :f.DEPTH])) == f.VALUES


@pytest.mark.parametrize("likeness,crowd", [(0.76, 40), (0.78, 4000)])
def test_links_within_families_of_look_alikes(spark, likeness, crowd):
    """Documents of a family share most words, too few to link; planted pairs among them do link."""
    r = random.Random(likeness)
    base = [f"w{i}" for i in range(400)]
    changed = round(len(base) * (1 - (2 * likeness / (1 + likeness)) ** .5))

    def altered(words, n, mark):
        out = list(words)
        at = r.randrange(len(out) - n)
        out[at:at + n] = [f"{mark}x{i}" for i in range(n)]
        return out
    rows, planted = [], []
    for i in range(600):
        own = altered(base, changed, f"d{i}")
        rows.append((2 * i, " ".join(own)))
        if i % 6 == 0:
            planted.append((2 * i, 2 * i + 1))
            rows.append((2 * i + 1, " ".join(altered(own, 40, f"p{i}"))))
    want = dict((x[0], x[2]) for x in plain(rows, 2))
    got = {x.doc_id: x.component_id for x in f.link(frame(spark, rows), 2, crowd=crowd).collect()}
    assert got == want
    assert sum(want[a] == want[b] for a, b in planted) > 50


@pytest.mark.parametrize("few", [1 << 17, 100, 0])
def test_components(spark, few):
    r = random.Random(5)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(r.randrange(2000, 3000), r.randrange(2000, 3000)) for _ in range(600)]
    pairs += [(5000, 5000), (None, 3), (4, 3), (4, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long"), few).collect()))
    group = {}
    for a, b in pairs:
        if a is not None and a != b:
            x, y = group.setdefault(a, {a}), group.setdefault(b, {b})
            if x is not y:
                x |= y
                for n in y:
                    group[n] = x
    assert got == {n: min(g) for n, g in group.items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_documents(spark):
    assert f.link(frame(spark, [])).count() == 0
    assert f.link(frame(spark, [(1, "alone")])).select(F.col("kept")).first().kept


def test_parities_bound_what_two_sets_share():
    r = np.random.default_rng(2)
    for n in (1, 7, 200, 5000):
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.concatenate([a[n // 3:], r.integers(0, 1 << 63, n // 4).astype(np.uint64)])
        apart = sum(int(x).bit_count() for x in (f.parity(a) ^ f.parity(b)).view(np.uint64))
        assert f.parity(a).shape == (f.PARITY,) and apart <= len(np.setxor1d(a, b))
