import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from framelake.llm import pitman as p
from framelake.llm.common import word_hashes

SCHEMA = "block string, doc_id long, text string, words int, held string"


def frame(spark, rows):
    return spark.createDataFrame([("x", d, t, 0, "y") for d, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    out = [(i, " ".join(r.choice(words[:r.randrange(1, 41)]) for _ in range(r.randrange(30)))) for i in range(60)]
    return out + [(100, "of the " * 400), (101, None), (102, " \n"), (None, "No id"), (5, out[5][1]), (5, out[5][1]), (103, "unseen one"), (104, "Ünseen W1")]


def tokens(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split() + ["</s>"]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def brute(rows, sweeps):
    """The model with dictionaries; only the draws are the module's."""
    learned = [tokens(t) for d, t in rows if not held(d)]
    c = Counter(w for t in learned for w in t)
    total, v = sum(c.values()), len(c)
    n = Counter(x for t in learned for x in zip(["<s>", *t], t))
    of = Counter(u for t in learned for u in ["<s>", *t[:-1]])
    h = {w: p.END if w == "</s>" else p.START if w == "<s>" else word_hashes(w.encode())[0][0] for w in [*c, "<s>"]}

    def discount(x):
        once, twice = (sum(y == k for y in x) for k in (1, 2))
        return min(0.95, max(0.05, once / (once + 2 * twice))) if once and twice else 0.5
    d = discount(n.values())
    tables, history, d0 = {x: 1 for x in n}, [], None
    for s in range(sweeps + 1):
        if s:
            keys = p.pair_keys(np.array([h[w] for x in n for w in x], np.uint64), np.arange(0, 2 * len(n), 2), np.arange(1, 2 * len(n), 2))
            prior = history[-1]
            weight = np.array([(1 + d * prior["tables"][u]) * prior["root"](w) for u, w in n])
            tables = dict(zip(n, p.seat(keys, np.array(list(n.values())), weight, d, s).tolist()))
        at_parent, in_own = Counter(), Counter()
        for (u, w), k in tables.items():
            at_parent[w] += k
            in_own[u] += k
        d0 = d0 or discount(at_parent.values())
        names = list(at_parent)
        if s:
            new = (1 + d0 * history[-1]["root_tables"]) / (v + 1)
            root_tables = dict(zip(names, p.seat(np.array([h[w] for w in names]), np.array([at_parent[w] for w in names]), np.full(len(names), new), d0, s).tolist()))
        else:
            root_tables = {w: 1 for w in names}
        customers, seats = sum(at_parent.values()), sum(root_tables.values())

        def root(w, a=at_parent, r=root_tables, customers=customers, seats=seats):
            return (a[w] - d0 * r.get(w, 0) + (1 + d0 * seats) / (v + 1)) / (1 + customers)
        history.append({"tables": in_own, "root": root, "root_tables": seats, "of": dict(tables)})

    def probability(u, w):
        return sum((n[u, w] - d * x["of"].get((u, w), 0) + (1 + d * x["tables"][u]) * x["root"](w)) / (1 + of[u]) for x in history[1:]) / sweeps
    for u in ["<s>", "of", "w1", "never"]:
        assert abs(sum(probability(u, w) for w in [*c, "unknown"]) - 1) < 1e-9
    out = []
    for doc, t in rows:
        w = tokens(t)
        out.append((doc, held(doc), len(w), sum(c[x] > 0 for x in w), total, sum(math.log10((c[x] + 0.5) / (total + 0.5 * (v + 1))) for x in w),
                    sum(math.log10(probability(a, b)) for a, b in zip(["<s>", *w], w))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_tokens,part_keys", [(10 ** 6, 10 ** 6), (60, 100)])
def test_scores_by_brute_force(spark, rows, block_tokens, part_keys):
    got = sorted(map(tuple, p.score(frame(spark, rows).repartition(3), block_tokens, part_keys).collect()), key=repr)
    for a, b in zip(got, brute(rows, p.SWEEPS), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 1e-6


def test_seating_follows_the_restaurant_process():
    r = random.Random(2)
    for customers, weight, discount in ((5, 0.3, 0.4), (60, 2.0, 0.7), (3000, 1.5, 0.5)):
        plain = []
        for _ in range(300):
            t = 1
            for n in range(1, customers):
                t += r.random() < weight / (n - discount * t + weight)
            plain.append(t)
        k = 3000
        drawn = p.seat(np.arange(k, dtype=np.uint64), np.full(k, customers), np.full(k, weight), discount, 1)
        assert abs(np.mean(plain) - drawn.mean()) < 0.12 * np.mean(plain)
        assert drawn.min() >= 1 and drawn.max() <= customers


def test_held_out_texts_are_predicted_better_than_by_the_base(spark):
    got = [r for r in p.op4(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 0.9


def test_nothing_to_learn_from(spark):
    ids = [d for d in range(100) if held(d)][:2]
    got = p.score(frame(spark, [(d, "some text") for d in ids])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0)] * 2
    assert p.score(frame(spark, [])).count() == 0
