import random

import corpus_pipeline as c
import pytest
from test_forest import plain as near_plain
from test_mixing import filled
from test_spaced import plain as leak_plain

def ids(docs):
    return sorted(-1 if d is None else d for d in docs)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"
WORDS = {"en": "the of and thing with that for hand been other then which".split(), "de": "der und nicht über schön eine sich auch nach wird mehr zeit".split()}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r = random.Random(1)
    sf = str(tmp_path_factory.mktemp("sf"))

    def text(lang, n):
        return " ".join(r.choice(WORDS[lang]) + r.choice(("", "", "s", "ing", "ung")) for _ in range(n))
    items = [(i, text("en", 25)) for i in range(5)]
    rows = []
    for i in range(120):
        lang = r.choice(("en", "de"))
        rows.append([i, "\n".join(text(lang, r.randrange(8, 30)) for _ in range(3)), lang, f"s{i % 3}"])
    shared = text("en", 60)
    for i in range(0, 20, 4):
        rows[i][1] += "\n" + shared
    rows[30][1] += " " + items[2][1] + " " + text("en", 5)
    rows[31][1] = rows[32][1].replace("\n", " ") + " more"
    rows[33][1] = rows[32][1].replace("\n", " ")
    rows += [[200, None, "en", "s0"], [201, "", None, None], [202, "12 %% 34", "de", "s1"], [203, rows[40][1], "en", None], [None, text("en", 40), "en", "s0"]]
    docs = spark.createDataFrame([(d, t, lang, s, len(t or ""), "x") for d, t, lang, s in rows], SCHEMA)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, rows, items, shared


def test_stages_by_brute_force(spark, tables):
    sf, rows, items, shared = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = c.identify_language(spark, docs, sf)
    assert one.columns == c.COLUMNS
    assert ids(r.doc_id for r in one.collect()) == ids(d for d, t, *_ in rows if any(x.isalpha() for x in t or ""))
    two = c.drop_repeated_lines(spark, one, sf)
    lines = {r.doc_id: r for r in two.collect()}
    assert 203 not in lines and shared in lines[0].text and all(shared not in lines[i].text for i in range(4, 20, 4))
    assert all(r.n_chars == len(r.text) for r in lines.values()) and lines[50].text == rows[50][1]
    three = c.drop_near_copies(spark, two, sf)
    want = near_plain([(r.doc_id, r.text) for r in two.collect()], 5)
    assert ids(r.doc_id for r in three.collect()) == ids(d for d, _, _, kept in want if kept or d is None)
    assert not {31, 33} <= {r.doc_id for r in three.collect()}
    four = c.drop_benchmark_passages(spark, three, sf)
    clean = [r for r in three.collect() if not any(leak_plain(r.text, x) for _, x in items)]
    assert sorted(map(tuple, four.collect()), key=repr) == sorted(map(tuple, clean), key=repr)
    assert 30 not in {r.doc_id for r in clean}
    sizes, sources = {}, {}
    for r in clean:
        sources[r.source] = sources.get(r.source, 0) + len(r.text.split())
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    sizes = filled(sources, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    five = c.mix_sources(spark, four, sf).collect()
    assert {(r.source_size, round(r.target, 6)) for r in five} == {(sources[s], round(sizes[s], 6)) for s in order}
    assert sorted(map(tuple, c.run(spark, sf).collect()), key=repr) == sorted(map(tuple, five), key=repr)


def test_no_documents(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").limit(0)
    for _, stage in c.STAGES:
        assert stage(spark, docs, tables[0]).count() == 0


def test_only_learned_languages_stay(spark):
    r = random.Random(2)
    other = "hän ei ollut kyllä missään vaan tuli takaisin hyvää yötä kaikki myös jälkeen".split()

    def text(words, n):
        return " ".join(r.choice(words) + r.choice(("", "", "s", "ing", "ung")) for _ in range(n))
    clean = [(i, text(WORDS[lang], r.choice((1, 2, 10, 60, 400))), lang) for i in range(160) for lang in [r.choice(("en", "de"))]]
    clean += [(200 + i, text(WORDS["de"], n), None) for i, n in enumerate((1, 3, 30, 3000))]
    dirty = [" ".join(r.choice(other) for _ in range(n)) for n in (10, 100, 2000)]
    dirty += [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 10))) for _ in range(n)) for n in (5, 50, 5000)]
    dirty += ["\n".join("".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(50)), "Привет как дела сегодня вечером"]
    rows = clean + [(1000 + i, t, None) for i, t in enumerate(dirty)]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t), "x") for d, t, lang in rows], SCHEMA)
    assert ids(x.doc_id for x in c.identify_language(spark, docs, "").collect()) == ids(d for d, *_ in clean)
