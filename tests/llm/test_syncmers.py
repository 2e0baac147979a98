import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from framelake.llm import syncmers as s

SCHEMA = "bucket string, doc_id long, text string, rank int"


def brute(text, k=s.K, inner=s.S):
    h = s.mix64(s._gram_hashes(s._code_points(text), inner)).tolist()
    at = []
    for i in range(len(text) - k + 1):
        w = h[i:i + k - inner + 1]
        if min(w) in (w[0], w[-1]):
            at.append(i)
    return at


def test_gram_hashes_depend_on_their_characters_only():
    c = np.array([3, 1, 4, 1, 5, 9, 2, 6, 3, 1, 4, 1, 5, 9], np.uint64)
    for n in range(1, 15):
        want = [sum((int(x) + 1) * pow(s.BASE, n - 1 - j, 1 << 64) for j, x in enumerate(c[i:i + n])) % (1 << 64) for i in range(len(c) - n + 1)]
        got = s._gram_hashes(c, n).tolist()
        assert len(got) == len(want)
        assert [a == got[0] for a in got] == [a == want[0] for a in want]


def test_closed_syncmers_match_their_definition():
    r = random.Random(1)
    for n in (24, 25, 40, 400):
        text = "".join(r.choice("abcd é😀") for _ in range(n))
        at, h = s.anchors(text)
        assert at.tolist() == (brute(text) or [0]) and len(h) == len(at)


def test_anchors_survive_edits_elsewhere():
    r = random.Random(2)
    text = "".join(r.choice("abcdefgh ") for _ in range(2000))
    moved = "xyz" + text
    a, b = s.anchors(text), s.anchors(moved)
    inner = {(p + 3, v) for p, v in zip(*map(np.ndarray.tolist, a))}
    assert inner <= {(p, v) for p, v in zip(*map(np.ndarray.tolist, b))}


def test_likeness():
    r = random.Random(3)
    a = "".join(r.choice("abcdefgh ") for _ in range(30_000))
    b = "".join(r.choice("abcdefgh ") for _ in range(30_000))
    f = s.fingerprint
    assert s.likeness(f(a), f(a)) == 1 and s.likeness(f(""), f("")) == 1 and s.likeness(f(""), f(a)) == 0
    assert s.likeness(f(a), f(b)) < 0.02
    assert 0.2 < s.likeness(f(a), f(a[:15_000] + b[:15_000])) < 0.5
    assert s.likeness(f(a), f(a[:100] + "#" + a[100:])) > 0.95
    assert len(f(a)[2]) <= s.KEEP and f(a)[0] > 0
    assert len(f("ab" * 100_000)[2]) > 0


def test_neighbours_by_brute_force(spark):
    r = random.Random(4)
    rows = [("x", i * 7 - 50, "".join(r.choice("abc \n") for _ in range(r.choice((0, 1, 2, 23, 24, 300)))), 0) for i in range(60)]
    rows += [("x", 6, None, 0), ("x", 6, "same", 0), ("x", 6, "same", 0), ("x", None, "no id", 0), ("x", 10**12, "far", 0)]
    tie = {x.text: x.h for x in spark.createDataFrame(rows, SCHEMA).select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda x: (-(1 << 63) if x[1] is None else x[1], tie[x[2]]), reverse=True)
    want = []
    for i, (_, d, t, _) in enumerate(order):
        t, n = t or "", order[(i + 1) % len(order)][2] or ""
        e = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), s.written(*s.fingerprint(t)), s.written(*s.fingerprint(e)),
                     s.likeness(s.fingerprint(t), s.fingerprint(e)), s.likeness(s.fingerprint(t), s.fingerprint(n))))
    for size in (7, 1000):
        got = [tuple(x) for x in s.compare_neighbours(spark.createDataFrame(rows, SCHEMA), size).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_one_document_and_none(spark):
    one = s.compare_neighbours(spark.createDataFrame([("x", 1, "abcdef", 0)], SCHEMA)).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1
    assert s.compare_neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


def longest(x, y):
    row = [0] * (len(y) + 1)
    for v in x:
        new = [0]
        for j, w in enumerate(y):
            new.append(row[j] + 1 if v == w else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_chains_with_repeated_anchors():
    r = random.Random(5)
    for few in (2, 5, 40, 10_000):
        for n in (1, 7, 150, 400):
            x, y = ([r.randrange(few) for _ in range(r.randrange(n + 1))] for _ in range(2))
            for a, b in ((x, y), (x, x), ([1, *x, 2], [1, *y, 2])):
                assert s._chain(np.array(a, np.uint32), np.array(b, np.uint32)) == longest(a, b)


def test_every_anchor_of_a_long_text_counts(spark):
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9))) for _ in range(5000)]
    text = " ".join(r.choice(words) for _ in range(20_000))
    sentence = " ".join(r.choice(words) for _ in range(12))
    at = len(text) * 2 // 5
    other = text[:at] + sentence + text[at + len(sentence):]
    twice = text[:6000] * 2
    got = {x.doc_id: x for x in s.compare_neighbours(spark.createDataFrame(
        [("x", 3, text, 0), ("x", 2, other, 0), ("x", 1, twice, 0)], SCHEMA)).collect()}
    assert got[3].fingerprint != got[2].fingerprint and 0.99 < got[3].near_next < 1
    for d, t in ((3, text), (2, other), (1, twice)):
        places, found = s.anchors(t)
        listed = [x.split("@") for x in got[d].fingerprint.removeprefix("0:").split(",")]
        assert np.cumsum([int(gap) for _, gap in listed]).tolist() == places.tolist()
        assert [int(v, 16) for v, _ in listed] == found.tolist()
    assert len(set(s.anchors(twice)[1].tolist())) < 0.6 * len(s.anchors(twice)[1])
