import random
import zlib

import numpy as np

from framelake.llm import language as g

SCHEMA = "score string, doc_id long, text string, lang string, rank int"


def plain_grams(text):
    s = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    s = " " + " ".join(s.split()) + " "
    return {s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)} - {" "} if s.strip() else set()


def test_grams_are_a_blended_spectrum():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choice("abCD é1. \n") for _ in range(r.randrange(30)))
        assert len(np.unique(g.grams(text))) == len(plain_grams(text)), repr(text)
    for text in ("\U000e0100 \U000f0000 12", "\U0010ffff", "\U0001f600 7"):
        assert len(g.grams(text)) == 0
    assert len(g.grams("\U00031350")) > 0 and len(g.grams("\U000320aa a\U000320ab")) == len(plain_grams("\U000320aa a\U000320ab"))
    assert len(g.grams(None)) == len(g.grams("12 %%")) == 0 and len(g.grams("x" * 500_000)) > 0


def test_scores_are_those_of_the_kernel():
    r = random.Random(2)
    words = {"a": ["the", "of", "and", "thing"], "b": ["der", "und", "nicht", "über"], "c": ["los", "el", "ción", "ñu"]}
    texts = [(lang, " ".join(r.choice(w) for _ in range(12))) for _ in range(30) for lang, w in words.items()]
    model = g.fit([(lang, np.unique(g.grams(t))) for lang, t in texts], 8)
    marks = [t for i, (lang, t) in enumerate(texts) if i < 24]
    k = np.array([[len(plain_grams(x) & plain_grams(z)) / (len(plain_grams(x)) * len(plain_grams(z))) ** 0.5 for z in marks] for _, x in texts])
    kz = k[:24]
    values, vectors = np.linalg.eigh(kz)
    good = values > 1e-6 * values.max()
    x = np.hstack((k @ vectors[:, good] * values[good] ** -0.5, np.ones((len(texts), 1))))
    y = np.array([[1.0 if lang == m else -1.0 for m in "abc"] for lang, _ in texts])
    p = g.RIDGE * len(texts) * np.eye(x.shape[1])
    p[-1, -1] = 0
    assert np.allclose(x @ np.linalg.solve(x.T @ x + p, x.T @ y), g.scores([t for _, t in texts], model), atol=2e-3)


def test_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = g.op7(spark, sf).collect()
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    rows = [("s", i, "the and of it" if i % 2 else "und der nicht", "en" if i % 2 else "de", 0) for i in range(40)]
    rows += [("s", None, "the of", "xx", 0), ("s", 50, None, "en", 0), ("s", 51, "", None, 0), ("s", 52, "123 %%", "de", 0), ("s", 3, "the", "en", 0),
             ("s", (1 << 62) + 1, "und nicht " * 30_000, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = g.predict(df, g.train(df, 10, 4)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[None][0] == "en" and by[(1 << 62) + 1][0] == "de" and by[50] == by[51] == by[52] == ("und", 0.0)
    none = g.train(df.filter("lang = 'no such'"))
    assert {(r.lang_pred, r.score) for r in g.predict(df, none).collect()} == {("und", 0.0)}
    assert g.predict(df.limit(0), none).count() == 0


def test_what_is_known(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for lang in ("de", "es", "fr"):  # English is also in texts of the other languages
        learned = g.train(docs.filter(docs.lang != lang))
        got = g.predict(docs, learned, "doc_id long, lang string, n_chars long").collect()
        assert all(r.known for r in got if r.lang != lang)
        unlearned = [r.known for r in got if r.lang == lang and r.n_chars > 500]
        assert len(unlearned) > 20 and sum(unlearned) <= 0.1 * len(unlearned)
