"""Personal data, and the terms that give it away.

Base spans are e-mail and IP addresses, card and phone numbers, found by pattern and checked; what they hold are entities. The words of a
document beside its base spans are its terms. Over the whole corpus, p(entity | term) is the share of the documents with the term that
hold the entity, p(entity) the entity's share of all documents. The term's disclosure is the part of the entity's information that it
gives away, PMI(entity, term) / -log p(entity): 1 if the term occurs with that entity only, 0 if it is independent. Terms
seen with an entity in `support` documents or more are generalised to their shape from `generalise` on and removed from `remove` on,
wherever they stand in a document that holds the entity; their spans are of kind `term`.

Null texts are empty. A document row is a document, so repeated rows count each and come back each; rows with a null id are
documents too. An empty table gives no rows. Spans are code points, end exclusive. Other columns are not carried, so their
names don't matter.

Python reads a text once for its base spans, and those with some once more for the terms told. Only entities of `support` documents or more can
have a term, so only their documents' words are paired. Pairs and words are counted by Spark with partial sums before the shuffle, the words
by 64 bits, and nothing is gathered but the terms of one document.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import GAPS, lower_ascii, query, read, stored

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^ \t\n\x0b\f\r]+")
_DIGITS = {c: None for c in map(ord, " -")}
_LOWER = {c: c + 32 for c in range(65, 91)}


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start, then kind in the order of KINDS. Time follows the length of the text."""
    out = []
    done = 0
    for m in _DOMAIN.finditer(text):
        # The longest local part before the @, not reaching into the match before.
        low = max(done, text.rfind("@", done, m.start()) + 1)
        back = _LOCAL.match(text[low:m.start()][::-1]).end()
        if back:
            out.append((m.start() - back, m.end(), 0))
            done = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = m[0].translate(_DIGITS)
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((m.start(), m.end(), 3))
    out.sort(key=lambda x: (x[0], x[2]))
    return [(a, b, KINDS[k]) for a, b, k in out]


def _beside(text: str, spans: list[tuple[int, int, str]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of the words that no base span touches."""
    starts, ends = [a for a, _, _ in spans], list(accumulate((b for _, b, _ in spans), max))  # the furthest end up to each
    for m in _WORD.finditer(text):
        a, b = m.span()
        if not (i := bisect_left(starts, b)) or ends[i - 1] <= a:
            yield m[0].translate(_LOWER), a, b


SPANS = "array<struct<start:int,end:int,kind:string>>"
FOUND = f"row long, doc_id long, n_chars long, spans {SPANS}, entities array<string>, terms array<string>, text string"


def _find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Base spans of every text; entities, distinct terms and the text itself where there are some."""
    for frame in frames:
        out = []
        for row, doc, text in zip(frame["row"], frame["doc_id"], frame["text"]):
            text = text or ""
            spans = base_spans(text)
            entities = list(dict.fromkeys(f"{k}:{text[a:b].translate(_LOWER)}" for a, b, k in spans))
            terms = list(dict.fromkeys(t for t, _, _ in _beside(text, spans))) if spans else []
            out.append((row, doc, len(text), [{"start": a, "end": b, "kind": k} for a, b, k in spans], entities, terms, text if spans else None))
        result = pd.DataFrame(out, columns=["row", "doc_id", "n_chars", "spans", "entities", "terms", "text"])
        result["doc_id"] = result["doc_id"].astype("Int64")
        yield result


TERMS = "array<struct<start:int,end:int,kind:string,disclosure:double,action:string>>"


def _place(remove: float):
    """Every place of the terms told in a text."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row, text, spans, told in zip(frame["row"], frame["text"], frame["spans"], frame["told"]):
                share = {t["term"]: t["disclosure"] for t in told}
                spans = [(s["start"], s["end"], s["kind"]) for s in spans]
                out.append((row, [{"start": a, "end": b, "kind": "term", "disclosure": share[t], "action": "remove" if share[t] >= remove else "generalise"}
                                  for t, a, b in _beside(text, spans) if t in share]))
            yield pd.DataFrame(out, columns=["row", "terms"])
    return run


def _pairs(found: DataFrame, entities: DataFrame) -> DataFrame:
    """(row, entity, term) of the documents that hold one of the entities."""
    holders = found.select("row", F.explode("entities").alias("entity"), "terms").join(entities.select("entity"), "entity")
    return holders.select("row", "entity", F.explode("terms").alias("term"))


def disclosure(docs: DataFrame, found: DataFrame, entities: DataFrame, support: int) -> DataFrame:
    """(entity, term, disclosure) of the pairs seen together in `support` documents or more. entities: (entity, with_entity)."""
    n = docs.count()
    pairs = _pairs(found, entities).groupBy("entity", "term").agg(F.count("*").alias("together")).filter(F.col("together") >= support)
    pairs = stored(pairs.withColumn("key", F.xxhash64("term")), "pairs")
    # The words of all documents, added up before they meet the terms: one row for each word there is.
    said = docs.select(F.explode_outer(F.array_distinct(F.split(lower_ascii(F.col("text")), GAPS))).alias("term"))
    counts = said.groupBy(F.xxhash64("term").alias("key")).agg(F.count("*").alias("with_term"))
    of_terms = stored(pairs.select("key").distinct().join(counts, "key"), "term-counts")
    information = -F.log(F.col("with_entity") / F.lit(n))
    gain = F.log(F.col("together") * F.lit(n) / (F.col("with_term") * F.col("with_entity")))
    share = F.when(information > 0, gain / information).otherwise(F.lit(0.0))
    return (pairs.join(entities, "entity").join(of_terms, "key")
            .select("entity", "term", F.least(share, F.lit(1.0)).alias("disclosure")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, support: int = 3, generalise: float = 0.6, remove: float = 0.9) -> DataFrame:
    """Per document its base spans and `terms` (start, end, kind `term`, disclosure, action), both by start; and `row`, a row number."""
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    found = stored(rows.select("row", "doc_id", "text").mapInPandas(_find, FOUND), "personal")
    entities = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("with_entity"))
    entities = stored(entities.filter(F.col("with_entity") >= support), "entities")
    told = disclosure(docs, found, entities, support).filter(F.col("disclosure") >= generalise)
    of_row = (_pairs(found, entities).join(told, ["entity", "term"]).groupBy("row", "term").agg(F.max("disclosure").alias("disclosure"))
              .groupBy("row").agg(F.collect_list(F.struct("term", "disclosure")).alias("told")))
    placed = found.select("row", "text", "spans").join(of_row, "row").mapInPandas(_place(remove), f"row long, terms {TERMS}")
    return (found.select("row", "doc_id", "n_chars", "spans").join(placed, "row", "left")
            .select("row", "doc_id", "n_chars", "spans", F.coalesce("terms", F.expr(f"cast(array() as {TERMS})")).alias("terms")))


def cleaned(text: Column, spans: Column, terms: Column) -> Column:
    """The text with base spans as [KIND], generalised terms as their shape and removed terms gone. Overlaps: the first span counts."""
    text = F.coalesce(text, F.lit(""))
    both = F.array_sort(F.concat(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by"))),
        F.transform(terms, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                              F.when(s["action"] == "remove", F.lit("")).otherwise(shape(F.substring(text, s["start"] + 1, s["end"] - s["start"]))).alias("by")))))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    done = F.aggregate(both, begin, lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
        s["end"].alias("at"), F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), s["by"])).alias("parts"))),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return done


def shape(word: Column) -> Column:
    """What a term is generalised to."""
    return (F.when(word.rlike("[0-9]"), F.lit("[NUMBER]")).when(word.rlike("^[A-Z]"), F.lit("[NAME]")).otherwise(F.lit("[TERM]")))


@query("op1_disclosure")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    rows = sanitise(read(spark, sf, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    rank = F.create_map(*[F.lit(x) for k in zip((*KINDS, "term"), range(5)) for x in k])
    pick = [F.transform(c, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
            for c in ("spans", "terms")]
    return rows.select("doc_id", *[number(k) for k in KINDS], F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"),
                       _joined(F.array_sort(F.concat(*pick))).alias("spans"), F.size("terms").cast("long").alias("n_terms"))
