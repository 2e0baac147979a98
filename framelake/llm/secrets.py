"""Secret scans whose false positives a random forest removes.

Candidates are runs of MIN_LENGTH or more of the characters that keys and tokens are made of, and runs of SHORT or more that are assigned
to something and quoted, or assigned to a name like token. Each has features: its length, how
often the kind of character changes, shares of digits and capitals, how much of it the corpus's dictionary covers (its letter
trigrams that stand out among those of the words that several documents hold), whether it looks like a path, an address or a host, quotes,
and the words around it (an assignment, a word like token or password). The forest is trained from labelled findings, `per_label` at most of
either label, those with the smallest hash; every candidate gets the forest's probability, and those below `least` are false positives.

Where no labelled findings are given, plain ones stand in: quoted values assigned to a name like token are secrets; addresses, numbers
and words of the dictionary aren't; the rest is left to the forest. With labels of one kind only there is no forest: the
probability is null and every candidate is kept.

Null and empty texts have no candidates; repeated rows give repeated findings; ids may be null; empty tables give no rows. Other columns are
not carried. A candidate in a text of any length is found; `place` counts words from 0.

Words are counted by partial sums; the dictionary has at most 26**3 trigrams, which is what is broadcast.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from framelake.llm.common import GAPS, lower_ascii, query, read, stored

MIN_LENGTH, SHORT, PER_LABEL, TREES, DEPTH = 16, 8, 5000, 20, 6
#: A trigram of the dictionary occurs in IN_WORDS words, and in OUTSTANDING times as many as the mean of all 26**3; a word is in IN_DOCS documents.
IN_WORDS, OUTSTANDING, IN_DOCS = 20, 2, 2
RUN = rf"[A-Za-z0-9_/+=.@-]{{{MIN_LENGTH},}}"
SHORT_RUN = rf"[A-Za-z0-9_/+=.@-]{{{SHORT},}}"
NAMED = r"(?i)(token|secret|passw|pwd|api_?-?key|apikey|auth|credential|bearer|private|access)"
FEATURES = ["n_chars", "transitions", "digits", "capitals", "coverage", "path", "dots", "address", "quoted", "assigned", "named", "after_plain"]


def _assigned(word: Column, before: Column) -> Column:
    return F.coalesce(before.rlike(r"[=:]$"), F.lit(False)) | word.rlike(r"^[A-Za-z_-]+[=:]")


def _named(word: Column, before: Column, before2: Column) -> Column:
    return F.coalesce(before.rlike(NAMED), F.lit(False)) | F.coalesce(before2.rlike(NAMED), F.lit(False)) | word.rlike(NAMED)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, place, value and the words around it) of every candidate."""
    quote = """["'`]"""

    def at(words: Column, i: Column) -> tuple[Column, Column, Column]:
        return F.get(words, i), F.get(words, i - 1), F.get(words, i - 2)

    def short(word: Column, before: Column, before2: Column) -> Column:
        return word.rlike(SHORT_RUN) & _assigned(word, before) & (word.rlike(quote) | _named(word, before, before2))

    def around(words: Column) -> Column:
        found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).rlike(RUN) | short(*at(words, i)))
        return F.transform(found, lambda i: F.struct(i.alias("place"), F.get(words, i).alias("word"), F.get(words, i - 1).alias("before"),
                                                     F.get(words, i - 2).alias("before2"), F.get(words, i + 1).alias("after")))
    # As a lambda's argument the array of words is made once, not for each of them.
    # The explodes are outer ones, as Spark would make their array twice, for a filter before any other.
    some = F.col("text").rlike(rf"{RUN}|[=:]")
    rows = docs.filter(some).select("doc_id", F.explode_outer(F.transform(F.array(F.split("text", GAPS)), around)[0]).alias("c"))
    rows = rows.select("doc_id", "c.*", F.explode(F.regexp_extract_all("c.word", F.lit(SHORT_RUN), 0)).alias("value"))
    rows = rows.withColumn("value", F.regexp_replace("value", r"^[=.]+|[=.]+$", ""))
    name = F.col("word").startswith(F.concat("value", F.lit("="))) | F.col("word").startswith(F.concat("value", F.lit(":")))
    return rows.filter((F.length("value") >= MIN_LENGTH) | ((F.length("value") >= SHORT) & ~name & short(F.col("word"), F.col("before"), F.col("before2"))))


def dictionary(docs: DataFrame, in_words: int = IN_WORDS, outstanding: float = OUTSTANDING, in_docs: int = IN_DOCS) -> DataFrame:
    """Letter trigrams of the words that `in_docs` documents or more hold, if they occur in `in_words` different ones or more and in
    `outstanding` times as many as the mean of all trigrams, which letter noise doesn't reach however much of it there is."""
    words = docs.select(F.explode_outer(F.array_distinct(F.split(lower_ascii(F.col("text")), "[^a-z]+"))).alias("word")).filter(F.length("word") >= 3)
    each = words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= in_docs)
    trigrams = each.select(F.explode_outer(F.array_distinct(_windows(F.col("word")))).alias("trigram"))
    counts = trigrams.groupBy("trigram").agg(F.count("*").alias("n"))
    mean = F.sum("n").over(W.partitionBy()) / 26 ** 3  # of at most 26**3 rows
    return counts.withColumn("mean", mean).filter((F.col("n") >= in_words) & (F.col("n") >= outstanding * F.col("mean"))).select("trigram")


def _windows(text: Column) -> Column:
    """Every run of three letters, overlapping ones too."""
    return F.regexp_extract_all(text, F.lit("(?=([a-z]{3}))"), 1)


def features(rows: DataFrame, known: DataFrame) -> DataFrame:
    """`rows` of candidates with their features. known: the dictionary's trigrams."""
    values = rows.select("value").distinct()
    parts = values.select("value", F.explode(_windows(lower_ascii(F.col("value")))).alias("trigram"))
    covered = (parts.join(F.broadcast(known.withColumn("hit", F.lit(1))), "trigram", "left").groupBy("value")
               .agg((F.count("hit") / (F.length("value") - 2)).alias("coverage")))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        F.col("value"), "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A"), "[^0aA]", "-")
    n = F.length("value")

    def share(kind: str) -> Column:
        return F.length(F.regexp_replace("value", f"[^{kind}]", "")) / n
    flag = {"path": F.col("value").contains("/"), "address": F.col("value").contains("@"),
            "quoted": F.col("word").rlike("""["'`]"""),
            "assigned": _assigned(F.col("word"), F.col("before")),
            "named": _named(F.col("word"), F.col("before"), F.col("before2")),
            "after_plain": F.col("after").rlike(r"^[a-z]+[.,]?$")}
    out = rows.join(covered, "value", "left").withColumns({
        "coverage": F.coalesce("coverage", F.lit(0.0)),
        "n_chars": n.cast("double"), "transitions": (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1).cast("double"),
        "digits": share("0-9"), "capitals": share("A-Z"), "dots": (n - F.length(F.replace("value", F.lit("."), F.lit("")))).cast("double")})
    return out.withColumns({name: F.coalesce(c, F.lit(False)).cast("double") for name, c in flag.items()})


def plain_label() -> Column:
    """What needs no judgement: 1 a quoted value assigned to a name like token, 0 an address, number or word, else null."""
    secret = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 1) & (F.col("digits") > 0) & (F.col("digits") < 1)
    harmless = (F.col("assigned") == 0) & (F.col("named") == 0) & ((F.col("address") == 1) | (F.col("digits") == 1) | ((F.col("digits") == 0) & (F.col("coverage") > 0.8)))
    return F.when(secret, 1.0).when(harmless, 0.0)


def train(rows: DataFrame, per_label: int = PER_LABEL, seed: int = 1) -> RandomForestClassificationModel | None:
    """A forest from featured candidates with a `label` of 0 or 1; None if one of them is missing."""
    one = W.partitionBy("label").orderBy(F.xxhash64("doc_id", "place", "value"), "doc_id", "place", "value")
    chosen = rows.filter("label is not null").withColumn("n", F.row_number().over(one)).filter(F.col("n") <= per_label)
    # At most 2 * per_label rows, in a fixed order, so that a rerun draws the same trees.
    chosen = stored(chosen.select("label", *FEATURES).repartition(1).sortWithinPartitions("label", *FEATURES), "labelled")
    if chosen.select("label").distinct().count() < 2:
        return None
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt").fit(ready)


def scan(docs: DataFrame, labelled: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """Every candidate with its features, `probability` and `is_secret`. labelled: (doc_id, place, value, label) of known findings."""
    docs = docs.select("doc_id", "text")
    rows = stored(candidates(docs), "findings")
    rows = stored(features(rows, dictionary(docs)), "features")
    if labelled is None:
        known = rows.withColumn("label", plain_label())
    else:
        known = rows.join(labelled.select("doc_id", "place", "value", F.col("label").cast("double").alias("label")), ["doc_id", "place", "value"])
    model = train(known)
    if model is None:
        return rows.withColumn("probability", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    judged = model.transform(ready).withColumn("p", vector_to_array("probability")[1])
    return judged.drop("features", "rawPrediction", "prediction", "probability").withColumnRenamed("p", "probability").withColumn(
        "is_secret", F.col("probability") >= least)


@query("op8_secret_forest")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    found = scan(read(spark, sf, "documents"))
    return found.select("doc_id", "place", F.sha2("value", 256).alias("value_sha256"), F.col("n_chars").cast("long").alias("n_chars"),
                        F.col("transitions").cast("long").alias("transitions"), "coverage", "probability", "is_secret")
