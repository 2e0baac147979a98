import hashlib
import random
import zlib

from framelake.llm import periodic as g
from framelake.llm.registry import QUERIES

SCHEMA = "runs string, doc_id long, text string, period int"


def all_runs(t):
    """Every lag and every stretch."""
    out = []
    for q in range(1, len(t) // 4 + 1):
        i = 0
        while i + q < len(t):
            j = i
            while j + q < len(t) and t[j] == t[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(6, 4 * q) and not any(t[s:e - p] == t[s + p:e] for p in range(1, q)):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(t, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(t) if i not in dropped)


def invented(r):
    t = []
    for _ in range(r.randrange(1, 6)):
        t += [r.randrange(3) for _ in range(r.randrange(20))]
        u = [r.randrange(r.choice([2, 3, 50])) for _ in range(r.randrange(1, r.choice([4, 12, 60])))]
        if r.random() < .5:  # a period that nearly repeats within itself
            u = u * r.randrange(1, 4) + u[:r.randrange(len(u) + 1)]
        t += [u[i % len(u)] for i in range(int(len(u) * r.uniform(0.5, 7)))]
    return [str(x) for x in t]


def test_all_runs_are_found(spark):
    r = random.Random(4)
    texts = [invented(r) for _ in range(500)] + [["a"] * n for n in range(12)] + [["a", "b"] * 4 + ["a"], ["x"] * 5_000]
    rows = spark.createDataFrame([("x", i, r.choice([" ", "\n ", "\t"]).join(t) + " ", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {row.doc_id: row for row in g.periodic(rows).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = all_runs(t)
        assert [tuple(x) for x in got[i].runs] == want, t
        assert got[i].text == collapsed(t, want)


def test_long_texts_and_long_periods():
    r = random.Random(5)
    t = [str(r.randrange(10 ** 9)) for _ in range(50_000)]
    t[7_000:47_000] = [t[7_000 + i % 9_001] for i in range(40_000)]
    flat, begins = g._flat([" ".join(t).encode(), b"a b", ("q " * 300_000).encode()])
    found = [tuple(x) for x in g.runs(flat, 300_000).tolist()]
    assert (7_000, 40_000, 9_001) in found and (int(begins[2]), 300_000, 1) in found and len(found) == 2


def test_parts_and_neighbouring_documents(monkeypatch):
    monkeypatch.setattr(g, "PART", 10)
    assert [len(p) for p in g._parts(["a" * 11, "b", None, "c" * 9])] == [1, 3]
    flat, begins = g._flat([b"a a a", b"a a a", b"", b"a"])
    assert not len(g.runs(flat, 3)) and begins.tolist() == [0, 4, 8, 9, 11]


def test_nulls_repeats_and_other_columns(spark):
    rows = [("x", None, None, 1), ("x", 1, "", 1), ("x", 1, "a " * 6, 1), ("x", 1, "a " * 6, 1), ("x", 2, " \t", 1)]
    got = sorted((str(r.doc_id), len(r.runs), r.text) for r in g.periodic(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("1", 0, ""), ("1", 1, "a"), ("1", 1, "a"), ("2", 0, ""), ("None", 0, "")]
    assert g.periodic(spark.createDataFrame([], SCHEMA)).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = {}
    for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        t = [w for w in (row.text or "").translate({c: 32 for c in (9, 10, 11, 12, 13)}).split(" ") if w]
        h, n = zlib.crc32(str(row.doc_id).encode()), len(t)
        if h % 10 == 0 and n:
            x = h // 10
            a = x % n
            p = 1 + (n - a) // (3 + x % 8)
            t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
        found = all_runs(t)
        s, size, q = min(found, key=lambda f: (-f[1], f[0], f[2])) if found else (None, None, None)
        want[row.doc_id] = (len(found), s, size, q, 1000 * size // q if found else None,
                            sha("".join("%d,%d,%d\n" % f for f in found)), sha(collapsed(t, found)))
    df = QUERIES["op12_periodic_runs"](spark, sf)
    got = {r[0]: tuple(r)[1:] for r in df.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    assert got == want and sum(w[0] for w in want.values()) > 10
    assert {t for c, t in df.dtypes if c not in ("runs_sha256", "collapsed_sha256")} == {"bigint"}
