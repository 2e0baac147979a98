import collections
import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from framelake.llm import disclosure as d

SCHEMA = "start string, doc_id long, text string, row int"
PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            n = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 14 <= len(n) <= 19 and sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(n[::-1])) % 10 == 0,
                  "phone": 10 <= len(n) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def test_spans_are_those_of_the_patterns():
    r = random.Random(1)
    for i in range(30_000):
        text = "".join(r.choice("a@.1- +(2)A@.5é_") for _ in range(r.randrange(60)))
        assert d.base_spans(text) == plain_spans(text), text
    text = "4111 1111 1111 1111, +44 (20) 7946-0958, a@b.c@d.e.f, 1.2.3.4.5.6.7.8, 256.1.1.1, 0255.0.0.1, 4111-1111-1111-1112"
    assert d.base_spans(text) == plain_spans(text) and len(d.base_spans(text)) == 6


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "+1" + " " * 300_000, "@" * 300_000, "1." * 150_000, "a@b" * 100_000, "1 " * 150_000):
        d.base_spans(text)


def docs(spark):
    rows = [("s", i, "the of and to", 0) for i in range(40)]
    rows += [("s", 100 + i, f"met Zorblax near a{i}b with x@y.org the tower of Qum{i}", 0) for i in range(4)]
    rows += [("s", 200, None, 0), ("s", 201, "", 0), ("s", None, "mail x@y.org", 0), ("s", 103, "met Zorblax", 0), ("s", 103, "met Zorblax", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def plain_terms(rows, support=3, generalise=0.6, remove=0.9):
    """Per row (start, end, disclosure, action). rows: texts."""
    def beside(text):
        spans = plain_spans(text)
        return [(m[0].translate(d._LOWER), *m.span()) for m in re.finditer(r"[^ \t-\r]+", text) if all(m.end() <= a or b <= m.start() for a, b, _ in spans)]
    texts = [t or "" for t in rows]
    entities = [{k + ":" + t[a:b].translate(d._LOWER) for a, b, k in plain_spans(t)} for t in texts]
    words = [set(re.split(r"[ \t-\r]+", t.translate(d._LOWER))) for t in texts]
    terms = [beside(t) if e else [] for t, e in zip(texts, entities)]
    together, of_entity = collections.Counter(), collections.Counter()
    for e, t in zip(entities, terms):
        of_entity.update(e)
        together.update((x, y) for x in e for y in {w for w, _, _ in t})
    of_term = collections.Counter(w for ws in words for w in ws)
    n, out = len(texts), []

    def share(e, t):
        if together[e, t] < support or of_entity[e] == n:
            return 0.0
        return min(1.0, math.log(together[e, t] * n / (of_term[t] * of_entity[e])) / -math.log(of_entity[e] / n))
    for e, ts in zip(entities, terms):
        best = {t: max(share(x, t) for x in e) for t, _, _ in ts}
        out.append([(a, b, round(best[t], 9), "remove" if best[t] >= remove else "generalise") for t, a, b in ts if best[t] >= generalise])
    return out


def test_disclosing_terms(spark):
    rows = docs(spark).collect()
    want = sorted((str(r.doc_id), t) for r, t in zip(rows, plain_terms([r.text for r in rows])))
    out = d.sanitise(docs(spark)).collect()
    assert sorted((str(r.doc_id), [(t.start, t.end, round(t.disclosure, 9), t.action) for t in r.terms]) for r in out) == want
    text = "met Zorblax near a0b with x@y.org the tower of Qum0"
    told = {text[a:b] for i, t in want for a, b, *_ in t if i == "100"}
    assert told == {"Zorblax", "met", "near", "with", "tower"}
    by_id = {r.doc_id: r for r in out}
    assert len(out) == 49 and by_id[200].spans == [] and by_id[None].spans[0].kind == "email"
    assert d.sanitise(docs(spark).limit(0)).count() == 0


def test_terms_go_from_the_whole_document(spark):
    far = " ".join(f"w{i}" for i in range(30))
    texts = [f"zanzibarclub sits with joe@x.org now {far} then zanzibarclub again" for _ in range(5)]
    texts += [f"umbracafe {far} and ann@x.org" for _ in range(5)] + [far + " then now with and sits again" for _ in range(60)]
    rows = spark.createDataFrame([("s", i, t, 0) for i, t in enumerate(texts)], SCHEMA)
    out = {r.doc_id: r for r in d.sanitise(rows).collect()}
    for i in range(10):
        assert {texts[i][t.start:t.end] for t in out[i].terms} == {"zanzibarclub" if i < 5 else "umbracafe"} and len(out[i].terms) == (2 if i < 5 else 1)
    got = rows.join(d.sanitise(rows).select("doc_id", "spans", "terms"), "doc_id").select(d.cleaned(F.col("text"), F.col("spans"), F.col("terms")).alias("t"))
    assert not any("zanzibar" in r.t or "umbra" in r.t or "@" in r.t for r in got.collect())


def test_cleaned_text(spark):
    rows = docs(spark).filter("doc_id = 100").drop("row", "start").join(d.sanitise(docs(spark)).drop("n_chars"), "doc_id")
    text = rows.select(d.cleaned(F.col("text"), F.col("spans"), F.col("terms")).alias("t")).first().t
    assert text == "[TERM] [NAME]  a0b  [EMAIL] the  of Qum0"


def test_query_against_the_patterns(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    terms = dict(zip(texts, plain_terms(list(texts.values()))))
    got = d.op1(spark, sf).collect()
    assert len(got) == len(texts) and sum(map(len, terms.values())) == sum(r.n_terms for r in got)
    for r in got:
        assert [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("term")] == [t[:2] for t in terms[r.doc_id]]
        want = plain_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for *_, k in want) for x in d.KINDS]
        assert [x for x in r.spans.split(",") if x and not x.startswith("term")] == joined.split(",") * bool(joined)
