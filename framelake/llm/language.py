"""Language identification with string kernels.

A text is the set of its letter n-grams of one to three places (a blended spectrum, presence only): lower case, every run of other
characters one boundary. The kernel is |x and z| / sqrt(|x| |z|). Nystroem landmarks, some training texts of each language, span
the feature space; kernel ridge regression learns each language against the rest. What the landmarks and the weights come to is
one matrix from n-grams to languages, so a batch of texts is scored by one matrix product.

Training takes at most `per_language` labelled rows of each language, those with the smallest hash of the id, `landmarks` of them as
landmarks; only their sets of n-grams come to the driver (at most 2**18 + 2**12 + 2**6 numbers each). All rows are predicted.

The scores of a row sum to 2 - k over k languages, so the best of them says which language is nearest, not whether the text is in
it. `known` says that: trigrams that two training texts of one language have are learned, and a text (which may mix languages) is
known if the share of its distinct trigrams that are learned isn't below the least share of the predicted language, by more than
the chance of its number of trigrams allows (CHANCE deviations). The least share lies halfway between what all but one in a
hundred training texts of the language reach, each held out from the trigrams it is measured by, and what a language mostly reaches
in the trigrams of the others, for the nearest one. A text of a few letters is known for want of evidence; an unlearned language
nearer to the learned ones than those are to each other may be.

A null text, or one without a letter, is `und` with score 0, as is everything if there is no training row. Null languages are
not learned from. Rows with a null id are predicted, not learned from and not held out. Repeated rows count each; ties go to the
language that comes first by code point. An empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from framelake.llm.common import query, read

PER_LANGUAGE, LANDMARKS, RIDGE = 500, 48, 1e-4
TRIGRAMS = 64 + 64 ** 2
SIZE = TRIGRAMS + 64 ** 3
#: Share of the training texts that may lie below what counts as reached; how near to that other languages may bring the least share.
RARE, NEAREST, CHANCE = 0.01, 0.8, 3


def _letters() -> np.ndarray:
    """Class of every code point: a to z are 1 to 26, other letters one of 27 to 63, all else 0."""
    out = np.zeros(0x110000, np.int8)
    for c in range(len(out)):
        if chr(c).isalpha():
            out[c] = c - 96 if 97 <= c <= 122 else 27 + c % 37
    return out


_LETTERS: list[np.ndarray] = []


def grams(text: str | None) -> np.ndarray:
    """Numbers of the n-grams of a text, with repeats; none for a text without letters."""
    if not _LETTERS:
        _LETTERS.append(_letters())
    table = _LETTERS[0]
    p = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.zeros(len(p) + 2, np.int32)
    c[1:-1] = table[p]
    c = c[np.concatenate(([True], (c[1:] > 0) | (c[:-1] > 0)))]
    if len(c) < 3:
        return c[:0]
    two = c[:-1] * 64 + c[1:]
    three = two[:-1] * 64 + c[2:]
    return np.concatenate((c[c > 0], two + 64, three + (64 + 64 ** 2)))


def _gram_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.unique(grams(t)).astype(np.int32).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("rank"), pa.array(sets, pa.binary())], ["lang", "rank", "grams"])


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    vocabulary: np.ndarray  # numbers of the n-grams of the landmarks
    weights: np.ndarray  # n-grams of the vocabulary x languages
    bias: np.ndarray
    trigrams: np.ndarray  # numbers of the trigrams learned
    least: np.ndarray  # share of them in a text that each language asks for


def _recognition(sample: list[tuple[str, np.ndarray]], languages: tuple[str, ...], n_others: int) -> tuple[np.ndarray, np.ndarray]:
    """The last two parts of a model; `n_others` texts of a language are measured by the others."""
    texts: dict[str, list[np.ndarray]] = {lang: [] for lang in languages}
    for lang, s in sample:
        texts[lang].append(s[s >= TRIGRAMS])

    def counts(lang: str) -> np.ndarray:
        count = np.zeros(SIZE, np.int32)
        for s in texts[lang]:
            count[s] += 1
        return count
    having = np.zeros(SIZE, np.int32)  # languages that a trigram is learned from
    for lang in languages:
        having += counts(lang) >= 2
    reached, foreign = [], [0.0]
    for lang in languages:
        count = counts(lang)
        elsewhere = having > (count >= 2)
        reached.append(np.quantile([np.mean(elsewhere[s] | (count[s] >= 3)) for s in texts[lang]], RARE))  # two other texts have it
        foreign.append(np.median([np.mean(elsewhere[s]) for s in texts[lang][:n_others]]))
    least = [r - (r - min(max(foreign), NEAREST * r)) / 2 for r in reached]
    return np.flatnonzero(having), np.array(least)


def fit(sample: list[tuple[str, np.ndarray]], n_landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """sample: (language, set of n-grams), the landmarks of each language first."""
    sample = [(lang, s) for lang, s in sample if len(s)]
    languages = tuple(sorted({lang for lang, _ in sample}))
    if not languages:
        return Model((), np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0, np.float32), np.zeros(0, np.int64), np.zeros(0))
    seen: dict[str, int] = {}
    landmarks = []
    for lang, s in sample:
        seen[lang] = seen.get(lang, 0) + 1
        if seen[lang] <= n_landmarks:
            landmarks.append(s)
    vocabulary = np.unique(np.concatenate(landmarks))
    z = np.zeros((len(vocabulary), len(landmarks)), np.float32)
    for j, s in enumerate(landmarks):
        z[np.searchsorted(vocabulary, s), j] = len(s) ** -0.5
    kernel = np.empty((len(sample), len(landmarks)))
    for i, (_, s) in enumerate(sample):
        at = np.searchsorted(vocabulary, s)
        at = at[vocabulary[np.minimum(at, len(vocabulary) - 1)] == s]
        kernel[i] = z[at].sum(axis=0) * len(s) ** -0.5
    values, vectors = np.linalg.eigh(np.stack([z[:, j] @ z for j in range(len(landmarks))]).astype(float))
    good = values > 1e-6 * values.max()
    to_features = vectors[:, good] * values[good] ** -0.5
    x = np.hstack((kernel @ to_features, np.ones((len(sample), 1))))
    y = np.array([[1.0 if lang == other else -1.0 for other in languages] for lang, _ in sample])
    penalty = ridge * len(sample) * np.eye(x.shape[1])
    penalty[-1, -1] = 0
    w = np.linalg.lstsq(x.T @ x + penalty, x.T @ y, rcond=None)[0]
    return Model(languages, vocabulary, (z @ (to_features @ w[:-1])).astype(np.float32), w[-1].astype(np.float32),
                 *_recognition(sample, languages, n_landmarks))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, n_landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Learns from text and language of the rows that aren't held out."""
    labelled = docs.select("doc_id", "lang").filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    one = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.withColumn("rank", F.row_number().over(one)).filter(F.col("rank") <= per_language)
    ids = chosen.groupBy("doc_id").agg(F.min("rank").alias("rank"))  # at most per_language rows for a language
    texts = docs.select("doc_id", "lang", "text").filter("lang is not null").join(F.broadcast(ids), "doc_id")
    rows = (texts.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("rank", F.xxhash64("text")))).filter(F.col("n") <= per_language)
            .select("lang", F.col("n").alias("rank"), "text").mapInArrow(_gram_sets, "lang string, rank int, grams binary").collect())
    rows.sort(key=lambda r: (r.rank, r.lang, r.grams))
    return fit([(r.lang, np.frombuffer(r.grams, np.int32)) for r in rows], n_landmarks, ridge)


def scores(texts: list[str | None], model: Model) -> np.ndarray:
    """Texts x languages; rows of texts without a letter are NaN."""
    return judged(texts, model)[0]


def judged(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scores, and whether each language knows each text; texts x languages. Texts without a letter have NaN and False."""
    present = np.zeros(SIZE, bool)
    out = np.full((len(texts), len(model.languages)), np.nan, np.float32)
    known = np.zeros(out.shape, bool)
    for begin in range(0, len(texts), 128):
        part = texts[begin:begin + 128]
        x = np.zeros((len(part), len(model.vocabulary)), np.float32)
        size, n, learned = np.zeros(len(part)), np.zeros((len(part), 1)), np.zeros((len(part), 1))
        for i, text in enumerate(part):
            g = grams(text)
            if len(g):
                present[g] = True
                size[i] = np.count_nonzero(present)
                x[i] = present[model.vocabulary]
                n[i] = np.count_nonzero(present[TRIGRAMS:])
                learned[i] = np.count_nonzero(present[model.trigrams])
                present[g] = False
        y = x @ model.weights * np.maximum(size, 1)[:, None] ** -0.5 + model.bias
        out[begin:begin + 128][size > 0] = y[size > 0]
        enough = learned + CHANCE * np.sqrt(n * model.least * (1 - model.least)) >= n * model.least
        known[begin:begin + 128] = enough & (size > 0)[:, None]
    return out, known


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.columns[-1].to_pylist()
            lang, score, known = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            if model.languages:
                y, by_language = judged(texts, model)
                lettered = np.flatnonzero(~np.isnan(y[:, 0]))
                best = y[lettered].argmax(axis=1)
                score[lettered] = np.clip((y[lettered, best] + 1) / 2, 0, 1)
                known[lettered] = by_language[lettered, best]
                for i, b in zip(lettered.tolist(), best.tolist()):
                    lang[i] = model.languages[b]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(known)],
                                             [*batch.schema.names[:-1], "lang_pred", "score", "known"])
    return run


def predict(docs: DataFrame, model: Model, keep: str = "doc_id long") -> DataFrame:
    """`lang_pred`, `score` and `known` beside the columns named in `keep` (a schema)."""
    names = [c.split()[0] for c in keep.split(",")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(*names, F.col("text").alias("_")).mapInArrow(_predict(shared), f"{keep}, lang_pred string, score double, known boolean")


@query("op7_language_id")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, train(docs), "doc_id long, held_out boolean").drop("known")
