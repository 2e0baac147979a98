"""From raw documents to a training mix: five stages, each a text operator at work on what the one before has kept.

Every stage reads all its documents, takes no column beyond those of `documents`, and gives an empty table for an empty one.
Rows with one id are one document: they stay or go together, unless their texts decide otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import forest, language, mixing, spaced, templates
from framelake.llm.common import read, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language learned; those without a letter, of letter noise or in another language go (`language`: `known`)."""
    docs = docs.select(*COLUMNS)
    known = language.predict(docs, language.train(docs), "doc_id long, text string, lang string, source string, n_chars long")
    return known.filter("known").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines whose template an earlier document has; a document of which nothing else is left goes."""
    out = templates.deduplicate(docs.select(*COLUMNS))
    blank = F.coalesce("text", F.lit("")).rlike(r"^[ \t\n\x0B\f\r]*$")
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.filter((F.col("n_dropped") == 0) | ~blank).withColumn("n_chars", length).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8) stays, the one with the smallest id."""
    linked = forest.link(docs, words=5, percent=80)
    alone = F.col("doc_id").isNull() & F.col("component_id").isNull()
    kept = linked.filter(F.col("kept") | alone).select("doc_id").distinct()
    docs = docs.select(*COLUMNS)
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a passage with an item of the benchmark go."""
    found = spaced.overlaps(docs, read(spark, sf_dir, "benchmark")).select("doc_id", "text_key").distinct()
    docs = docs.select(*COLUMNS)
    same = docs["doc_id"].eqNullSafe(found["doc_id"]) & (F.xxhash64(docs["text"]) == found["text_key"])
    return docs.join(found, same, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.taken(docs)


STAGES = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark_passages),
    ("mix", mix_sources),
]

#: A learned language decides about rows: no SQL says which. The tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each stage's rows written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
