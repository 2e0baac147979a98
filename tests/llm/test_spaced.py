import random

import numpy as np

from framelake.llm import spaced as s

DOCS, ITEMS = "seed string, doc_id long, text string, item_id int", "text string, row string, item_id long"


def frames(spark, docs, items):
    return (spark.createDataFrame([("x", d, t, 0) for d, t in docs], DOCS), spark.createDataFrame([(t, "x", i) for i, t in items], ITEMS))


def plain(doc, item, least=s.LEAST, identity=s.IDENTITY):
    """Longest good stretch over all alignments, by trying all of them."""
    d, i = s.tokens(doc).tolist(), s.tokens(item).tolist()
    best = 0
    for shift in range(-len(i) + 1, len(d)):
        same = [0 <= k + shift < len(d) and d[k + shift] == i[k] for k in range(len(i))]
        inside = [0 <= k + shift < len(d) for k in range(len(i))]
        for a in range(len(i)):
            n = 0
            for b in range(a, len(i)):
                if not inside[b]:
                    break
                n += same[b]
                if n >= identity * (b - a + 1) - 1e-9:
                    best = max(best, b - a + 1)
    return best >= min(least, len(i)) if len(i) >= s.MIN_ITEM else False


def test_planted_passages_and_clean_texts(spark):
    r = random.Random(1)
    vocabulary = [f"word{i}" for i in range(300)] + ["the", "of"] * 40

    def text(n):
        return [r.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(r.choice((4, 5, 6, 8, 14, 30, 60))))) for i in range(24)] + [(90, None), (91, ""), (None, " ".join(text(20))), (3, " ".join(text(20)))]
    docs = []
    for k in range(90):
        t, item = text(r.randrange(5, 80)), (items[r.randrange(len(items))][1] or "").split()
        how = r.randrange(4)
        if how == 1:
            t[len(t) // 2:len(t) // 2] = [w.upper() + "," for w in item]
        elif how == 2 and item:
            t[3:3] = [w if i % 7 != 3 else "changed" for i, w in enumerate(item)]
        elif how == 3:
            t += item[:r.randrange(1, len(item) + 1)] if item else []
        docs.append((k, " ".join(t)))
    docs += [(1000, None), (1001, ""), (None, items[5][1]), (7, "same id " + (items[6][1])), (7, "same id " + (items[6][1])), (1002, "a " * 60_000)]
    got = s.overlaps(*frames(spark, docs, items)).collect()
    pairs = sorted(((g.doc_id, g.item_id) for g in got), key=repr)
    want = sorted(((d, i) for d, t in docs for i, x in items if t and len(t) < 100_000 and plain(t, x)), key=repr)
    assert pairs == want
    assert all(g.n_equal >= s.IDENTITY * g.n_words for g in got)


def test_overlap():
    a = np.arange(1, 31, dtype=np.uint64)
    b = a.copy()
    b[[4, 9, 14]] = 99
    assert s.overlap(np.concatenate([a[:3], b]), a, 3, 0.8) == (3, 30, 27)
    assert s.overlap(a[:10], a, 0, 0.8) == (0, 10, 10)
    assert s.overlap(a, a[5:10], 5, 0.8) == (5, 5, 5)


def test_repeated_words_in_text_and_item(spark):
    got = s.overlaps(*frames(spark, [(1, "go " * 5_000 + "stop " * 300), (2, "go stop " * 500)], [(1, "go " * 80), (2, "stop go " * 20)])).collect()
    assert sorted((r.doc_id, r.item_id, r.doc_at, r.n_words, r.n_equal) for r in got) == [(1, 1, 0, 80, 80), (2, 2, 1, 40, 40)]


def test_long_overlap_beside_one_with_more_equal_words(spark):
    item = [f"i{k}" for k in range(40)]
    better = item[29:]  # 11 equal words between the start of the text and the end of the item: too short
    longer = [w if k not in (5, 9) else "other" for k, w in enumerate(item[:12])]  # 12 words, 10 equal
    got = s.overlaps(*frames(spark, [(1, " ".join([*better, *["x"] * 30, *longer, *["y"] * 30]))], [(1, " ".join(item))])).collect()
    assert [(r.doc_at, r.n_words, r.n_equal) for r in got] == [(41, 12, 10)]


def test_empty_tables(spark):
    assert s.overlaps(*frames(spark, [], [(1, "a b c d e f g h i j")])).count() == 0
    assert s.overlaps(*frames(spark, [(1, "a b c d e f g h i j")], [])).count() == 0
