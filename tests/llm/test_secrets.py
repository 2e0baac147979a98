import random

from pyspark.sql import functions as F

from framelake.llm import secrets as s

SCHEMA = "label string, doc_id long, text string, place int, features string"


def frame(spark, rows):
    return spark.createDataFrame([("x", d, t, 0, "y") for d, t in rows], SCHEMA)


def corpus(seed=1, n=120):
    r = random.Random(seed)
    parts = ["ing", "ent", "tion", "the", "and", "ver", "ble", "est", "ous", "ion"]
    rows, truth = [], {}
    for i in range(n):
        words = ["".join(r.choice(parts) for _ in range(r.choice((1, 1, 2, 7)))) for _ in range(60)]
        if i % 4 == 0:
            key = "".join(r.choice("0123456789abcdef") for _ in range(40))
            truth[key] = i
            words[30:30] = [r.choice(("token", "api_key", "password")), "=", f'"{key}"']
        elif i % 4 == 1:
            words[20:20] = [f"someone.{i}@mail{i}.example.com", "4111111111111111"]
        rows.append((i, " ".join(words)))
    return rows, truth


def test_secrets_are_told_from_words(spark):
    rows, truth = corpus()
    odd = [(900, None), (901, ""), (None, 'secret = "00aa11bb22cc33dd44ee55ff"'), (5, rows[5][1]), (5, rows[5][1]), (902, "a" * 200_000), (903, "é " * 100_000)]
    got = s.scan(frame(spark, rows + odd)).collect()
    kept = {r.value: r.doc_id for r in got if r.is_secret}
    assert kept == truth | {"00aa11bb22cc33dd44ee55ff": None}
    assert {"4111111111111111", "a" * 200_000} <= {r.value for r in got if not r.is_secret}
    assert all(rows[r.doc_id][1].split()[r.place].strip('"') == r.value for r in got if r.doc_id is not None and r.doc_id < 120)
    assert sum(r.doc_id == 5 for r in got) % 3 == 0


def test_features_by_hand(spark):
    known = spark.createDataFrame([("abc",), ("bcd",)], "trigram string")
    rows = s.candidates(frame(spark, [(1, 'my token = "abcd12EFabcdabcdabcd" ends. /usr/local/share/thing.txt')]))
    by = {r.value: r for r in s.features(rows, known).collect()}
    one, two = by["abcd12EFabcdabcdabcd"], by["/usr/local/share/thing.txt"]
    assert (one.n_chars, one.transitions, one.digits, one.capitals, one.quoted, one.assigned, one.named, one.after_plain) == (20, 3, 0.1, 0.1, 1, 1, 1, 1)
    assert abs(one.coverage - 8 / 18) < 1e-9 and one.path == 0
    assert (two.path, two.dots, two.named, two.assigned) == (1, 1, 0, 0)


def test_short_values_after_an_assignment(spark):
    rows = ['password = "hunter2hunter2" here', 'my api_key: abcd1234 is', 'login password="short1234" ends', 'a container of something = nothing']
    got = s.candidates(frame(spark, list(enumerate(rows)))).collect()
    assert sorted((r.doc_id, r.place, r.value) for r in got) == [(0, 2, "hunter2hunter2"), (1, 2, "abcd1234"), (2, 1, "short1234")]


def test_dictionary_among_random_keys(spark):
    """Words of the corpus stand out among keys of letters, those of copied documents as well."""
    r = random.Random(7)
    words = ["".join(r.choice(("ing", "ent", "ion", "the", "ver", "ble")) for _ in range(4)) for _ in range(900)]
    rows = [(i, " ".join(words[i % 30::30])) for i in range(60)]
    keys = [(1000 + i // 2, "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(32))) for i in range(0, 20000)]
    found = {x.trigram for x in s.dictionary(frame(spark, rows + keys + [(k + 100_000, t) for k, t in keys])).collect()}
    own = {w[i:i + 3] for w in words for i in range(len(w) - 2)}
    assert {"ing", "ent", "ion", "the", "ver", "ble"} <= found and len(found - own) < 20


def test_given_labels(spark):
    rows, truth = corpus(2)
    docs = frame(spark, rows)
    found = s.candidates(docs).select("doc_id", "place", "value")
    labels = found.withColumn("label", F.col("value").contains("@").cast("int"))  # here addresses are what is looked for
    got = s.scan(docs, labels).collect()
    assert {r.value for r in got if r.is_secret} == {r.value for r in got if "@" in r.value}


def test_without_labels_or_rows(spark):
    got = s.scan(frame(spark, [(1, "nothing but anextremelylongwordinhere")])).collect()
    assert [(r.value, r.probability, r.is_secret) for r in got] == [("anextremelylongwordinhere", None, True)]
    assert s.scan(frame(spark, [])).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = s.op8(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    import hashlib
    import re
    want = {(d, hashlib.sha256(m.encode()).hexdigest()) for d, t in texts.items() for m in re.findall(r'(?i)token = "([0-9a-f]{40})"', t)}
    assert {(r.doc_id, r.value_sha256) for r in got if r.is_secret} == want
