import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from framelake.llm import pieces as g
from framelake.llm.registry import QUERIES

PATH = public_tokenizers.path(g.MODEL)
SCHEMA = "ids string, doc_id long, text string, pieces int"
ALPHABETS = ["abc", "aeinrst ", "lo wer", "0123456789abcdef", "▁ a<s>0x41", "é日本語中文😀̀\x00\n\t ", "=-_*# /\n", "аеионрст "]


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return g.Vocabulary(PATH)


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_same_ids_as_the_library(lib, vocabulary):
    r = random.Random(1)
    texts = ["", None, " ", "   ", "▁", "<s></s><unk>", "<0x41>", "a" * 5000, " " * 3000, "日" * 3000]
    texts += ["".join(r.choice(a) for _ in range(r.randrange(1, 60))) for a in ALPHABETS for _ in range(300)]
    texts += [p * r.randrange(1, 6) + r.choice(vocabulary.pieces) * 2 + p for p in r.sample(vocabulary.pieces, 1500)]
    texts += ["".join(r.choice(a) for _ in range(20_000)) for a in ALPHABETS]
    for text, data in zip(texts, g.Encoder(vocabulary).encode(texts), strict=True):
        want = lib.encode(text or "", add_bos=True, add_eos=True)
        assert ids_of(data) == want, repr(text)[:80]
        assert g.decoded(vocabulary, data) == lib.decode(want)


def test_decodes_any_ids_as_the_library_does(lib, vocabulary):
    r = random.Random(2)
    space = vocabulary.pieces.index("▁")
    for _ in range(10_000):
        ids = [r.choice([0, 1, 2, space, r.randrange(32000), r.randrange(3, 259), r.randrange(3, 259)]) for _ in range(r.randrange(7))]
        assert g.decoded(vocabulary, np.array(ids, "<u4").tobytes()) == lib.decode(ids), ids


def test_parts_and_the_bound_of_kept_words_change_nothing(lib, vocabulary, monkeypatch):
    r = random.Random(3)
    texts = [" ".join("".join(r.choice("abcdeXYZ  ") for _ in range(r.randrange(1, 12))) for _ in range(r.randrange(400))) for _ in range(60)]
    monkeypatch.setattr(g, "PART", 97)
    monkeypatch.setattr(g, "KEPT", 5)
    assert [ids_of(d) for d in g.Encoder(vocabulary).encode(texts)] == [lib.encode(t, add_bos=True, add_eos=True) for t in texts]


def test_repeats_nulls_and_other_columns(spark):
    rows = [("x", 1, "ab", 1), ("x", 1, "ab", 1), ("x", None, None, 1), ("x", 2, "", 1), ("x", 3, "w " * 100_000, 1)]
    coded = g.encode(spark.createDataFrame(rows, SCHEMA), PATH)
    got = {(r.doc_id, r.text) for r in g.decode(coded, PATH).collect()}
    assert coded.count() == 5 and got == {(1, "ab"), (None, ""), (2, ""), (3, "w " * 100_000)}
    assert g.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    assert [r.text for r in g.decode(nothing, PATH).collect()] == ["", ""]


def test_query(spark, lib):
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for row in texts:
        ids = lib.encode(row.text or "", add_bos=True, add_eos=True)
        want.add((row.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    got = QUERIES["op11_sentence_pieces"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(got) == len(texts) and {tuple(r) for r in got} == want
