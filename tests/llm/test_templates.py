import random

import duckdb
import pyarrow as pa
import pytest

from framelake.llm import templates as t

SCHEMA = "doc_id long, dropped string, text string, row int, n_lines string, `a b` int"


def compared(spark, rows):
    con = duckdb.connect()
    table = pa.table({"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([x for _, x in rows], pa.string())})
    con.register("documents", table)
    want = {d: (n, k, x) for d, n, k, x in con.execute(t.OP10_SQL).fetchall()}
    got = t.deduplicate(spark.createDataFrame([(d, "x", x, 1, "y", 2) for d, x in rows], SCHEMA)).collect()
    assert got[0].row == 1 and got[0]["a b"] == 2
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in got} == want
    return want


@pytest.mark.parametrize("seed", [1, 2])
def test_against_sql(spark, seed):
    r = random.Random(seed)
    words = [f"w{c}" for c in "abcdefghijklmnopqrst"]
    shapes = [[r.choice(words) for _ in range(r.choice((1, 2, 3, 7, 8, 9, 20)))] for _ in range(25)]

    def line():
        w = list(r.choice(shapes))
        for _ in range(r.choice((0, 0, 0, 1, 2, 8))):
            w[r.randrange(len(w))] = r.choice((*words, "id7", "9"))
        return r.choice((" ", " ", "  ", "\t")).join(w) + r.choice(("", " ", "\r"))
    rows = [(i, "\n".join(line() for _ in range(r.randrange(12)))) for i in range(80)]
    compared(spark, rows + [(100, None), (101, ""), (102, "\n\n"), (103, "x" * 200_000 + "\n" + "1" * 200_000 + "\n" + "a b " * 50_000)])


def test_variable_fields(spark):
    lines = [f"connection from host {n} was closed after {i} seconds by peer {n}" for i, n in enumerate(["ab", "cd", "ef", "gh"])]
    got = compared(spark, [(i, x + f"\nonly here in document number {'abcd'[i]} of all") for i, x in enumerate(lines)])
    assert [got[i][1] for i in range(4)] == [0, 2, 2, 2]


def test_many_templates_of_one_leaf(spark):
    names = [a + b for a in "abcde" for b in "fghi"]
    lines = [f"the same start {' '.join(f'kind{c}' + w for w in 'pqrstu')} for {n} here" for c in "vwxyz" for n in names]
    got = compared(spark, list(enumerate(lines)))
    assert sum(k for _, k, _ in got.values()) == 95


def test_short_lines(spark):
    names = ["ann", "bob", "cyd", "dee", "eva", "flo"]
    got = compared(spark, [(i, f"user {n} left room\nuser {n} stays") for i, n in enumerate(names)])
    assert [got[i][1] for i in range(6)] == [0, 1, 1, 1, 1, 1]
    # Two different lines are too few for a short template, and no template comes from lines that share half of their words.
    got = compared(spark, [(1, "the cat sat down"), (2, "the dog sat down"), (3, "a b c d e f g h i j k l"), (4, "a b c d e f q r s t u v")])
    assert [k for _, k, _ in got.values()] == [0, 0, 0, 0]


def test_crowded_leaf(spark):
    """A third of all lines in one leaf, many templates and lines that belong to none."""
    r = random.Random(3)
    bodies = [[f"b{r.randrange(10**6):x}".translate(str.maketrans("0123456789", "ghijklmnop")) for _ in range(7)] for _ in range(40)]
    name = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    lines = [" ".join(["all", "start", "so", *[w if i != 3 else name() for i, w in enumerate(r.choice(bodies))]]) for _ in range(1200)]
    lines += [" ".join(["all", "start", "so", *[name() for _ in range(7)]]) for _ in range(300)]
    got = compared(spark, list(enumerate(lines)))
    assert sum(k for _, k, _ in got.values()) >= 1160


def test_lines_of_one_document_and_short_ones_stay(spark):
    got = compared(spark, [(1, "a b c d\na b c d"), (2, "yes\nx y"), (3, "yes\nx y"), (4, "a b c d\nnew words come here")])
    assert got == {1: (2, 0, "a b c d\na b c d"), 2: (2, 0, "yes\nx y"), 3: (2, 0, "yes\nx y"), 4: (2, 1, "new words come here")}


def test_rows_without_or_with_the_same_id(spark):
    rows = [(None, "p q r s"), (None, "p q r s"), (1, "p q r s\nfirst text of the id"), (1, "other text of it\np q r s"), (1, "other text of it\np q r s")]
    got = t.deduplicate(spark.createDataFrame([(d, "x", x, 1, "y", 2) for d, x in rows], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [
        (0, "p q r s"), (0, "p q r s"), (1, "first text of the id"), (1, "other text of it"), (1, "other text of it")]
    assert t.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0
