"""Line dedup with a log-template tree.

A line's words with a digit become `<*>`. The tree has a fixed depth: number of words, then the first LEAD words (only the first one of
lines below `general` words); what shares them is a leaf. Lines of a leaf make templates by the same step until none is left:
a place is fixed if more than half of the lines (and two or more) have one word there, and lines that have the fixed words in `same` of
their places or more belong to the group's template, its other places being variable. The rest is split by the words
of the place that has fewest different ones, and every part goes through the step by itself. So a leaf holds any number of templates, and
as each split fixes a place, the steps end. A line alone in its part is a template of its own, and so are lines too short to have a
variable place (three words at `same` 0.7). Below `general` words a template with variable places needs SUPPORT different lines.

A template that occurs in two documents or more recurs: its lines are dropped in all but the first document (smallest id) that has
it. Lines of fewer than `least` words are always kept.

Null texts are empty. Rows with one id are one document, whose lines don't recur by themselves; rows without an id are one document
before all others. Lines end at a line feed; other white space counts only between words. Empty tables give no rows. Other
columns are carried by `deduplicate` as they are, but for `n_lines` and `n_dropped`, which are replaced.

Counts are partial sums by hashes of the words. Only the words of lines in leaves with several lines are moved: a filter of fixed
size, joined by broadcast, keeps the others back (it may let others through, which changes nothing).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import discard, query, read, stored

LEAD, LEAST, GENERAL, SAME, SUPPORT = 3, 3, 8, 0.7, 3
#: Bits of the filter; 64 to a row.
FILTER_BITS = 22

KEY = ["n_words", "leaf", "t1", "t2"]


def _lead(general: int) -> Column:
    """How many leading words a leaf shares."""
    return F.when(F.col("n_words") < general, 1).otherwise(LEAD)


def _needed(general: int) -> Column:
    """How many different lines a template with variable places needs."""
    return F.when(F.col("n_words") < general, SUPPORT).otherwise(2)


def _lines(docs: DataFrame, least: int, general: int) -> DataFrame:
    """(doc, text_key, line_no, KEY, masked) of the lines of `least` words or more.

    What is used more than once goes through an explode of one value, so that it is made once; an outer one, as Spark would
    make it twice for a filter before any other.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64(text).alias("text_key"), F.split(text, "\n").alias("lines"))
    rows = rows.select("doc", "text_key", F.posexplode_outer("lines").alias("line_no", "line"))
    one_space = F.when(F.col("line").rlike(r"[\t\x0B\f\r]|  "), F.regexp_replace("line", r"[\t\x0B\f\r ]+", " ")).otherwise(F.col("line"))
    rows = rows.select("doc", "text_key", "line_no", F.explode_outer(F.array(F.trim(one_space))).alias("line"))
    hidden = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", "<*>")).otherwise(F.col("line"))
    rows = rows.select("doc", "text_key", "line_no", F.explode_outer(F.array(hidden)).alias("masked")).filter(F.col("masked") != "")
    n = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    rows = rows.select("*", F.explode_outer(F.array(n)).alias("n_words")).filter(F.col("n_words") >= least)
    return rows.select("*", F.when(F.col("n_words") < general, F.xxhash64("n_words", F.substring_index("masked", " ", 1))).otherwise(
        F.xxhash64("n_words", F.substring_index("masked", " ", LEAD))).alias("leaf"),
                       F.xxhash64("masked").alias("t1"), F.xxhash64("masked", F.lit(1)).alias("t2"))


def _cell(leaf: Column) -> tuple[Column, Column]:
    """Row of the filter and bit in it."""
    slot = F.pmod(leaf, F.lit(1 << FILTER_BITS))
    return F.shiftright(slot, 6).cast("int"), F.expr("shiftleft(1L, cast(pmod(leaf, 64) as int))")


def _step(left: DataFrame, same: float, general: int) -> DataFrame:
    """Lines of groups (`node`) with whether they belong to their group's template; the others have the node of their part."""
    cells = left.select("node", "n_words", F.posexplode("words").alias("place", "word")).filter(F.col("place") >= _lead(general))
    counts = cells.groupBy("node", "n_words", "place", "word").agg(F.count("*").alias("n"))
    places = counts.groupBy("node", "n_words", "place").agg(F.max(F.struct("n", "word")).alias("top"), F.count("*").alias("different"), F.sum("n").alias("size"))
    fixed = F.when((F.col("top.n") > 1) & (2 * F.col("top.n") > F.col("size")), F.struct("place", F.col("top.word").alias("word")))
    split = F.min(F.when(F.col("different") > 1, F.struct("different", "place")))["place"]
    groups = (places.filter(F.col("size") >= _needed(general)).groupBy("node").agg(F.collect_list(fixed).alias("fixed"), split.alias("split"))
              .filter("split is not null"))
    agree = F.size(F.filter("fixed", lambda c: F.get(F.col("words"), c["place"]) == c["word"])) + _lead(general)
    rows = left.join(groups, "node").select("*", (agree >= same * F.col("n_words")).alias("belongs"))
    part = F.xxhash64("node", "split", F.get("words", F.col("split")))
    return rows.select(*KEY, F.when(F.col("belongs"), F.col("node")).otherwise(part).alias("node"), "belongs",
                       F.when(~F.col("belongs"), F.col("words")).alias("words"))


def _generalised(lines: DataFrame, same: float, general: int) -> list[DataFrame]:
    """(KEY, node), a table for each step: the distinct lines that belong to a template of several, and its node."""
    hashes = F.transform(F.split("masked", " "), lambda w: F.xxhash64(w))
    left = lines.groupBy(*KEY).agg(F.any_value("masked").alias("masked")).select(*KEY, F.col("leaf").alias("node"), hashes.alias("words"))
    out = []
    while True:
        done = stored(_step(left, same, general), "templates")
        out.append(done)
        left = done.filter("not belongs").drop("belongs")
        if left.isEmpty():
            return out


def repeats(docs: DataFrame, least: int = LEAST, general: int = GENERAL, same: float = SAME) -> DataFrame:
    """(doc, text_key, line_no) of the lines to drop."""
    lines = stored(_lines(docs.select("doc_id", "text"), least, general), "lines")
    exact = stored(lines.groupBy(*KEY).agg(F.min("doc").alias("first"), F.max("doc").alias("last")), "exact")
    varies = F.ceil(same * F.col("n_words")) < F.col("n_words")
    several = exact.filter(varies).groupBy("n_words", "leaf").agg(F.count("*").alias("n")).filter(F.col("n") >= _needed(general))
    cell, bit = _cell(F.col("leaf"))
    cells = several.select(cell.alias("cell"), bit.alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    # At most 2**FILTER_BITS / 64 rows of 12 bytes.
    wordy = lines.filter(varies).withColumn("cell", cell).join(F.broadcast(cells), "cell").filter(F.col("bits").bitwiseAND(bit) != 0)
    steps = _generalised(wordy.select(*KEY, "masked"), same, general)
    of_line = reduce(DataFrame.unionByName, [t.filter("belongs").select(*KEY, "node") for t in steps])
    groups = (exact.join(of_line, KEY).groupBy("n_words", "node").agg(
        F.min("first").alias("all_first"), F.max("last").alias("all_last"), F.count("*").alias("n")).filter(F.col("n") >= _needed(general)))
    wide = of_line.join(groups, ["n_words", "node"]).select(*KEY, "all_first", "all_last")
    span = exact.join(wide, KEY, "left").select(
        *KEY, F.coalesce("all_first", "first").alias("first"), F.coalesce("all_last", "last").alias("last")).filter("first < last")
    dropped = lines.drop("masked").join(span, KEY).filter(F.col("doc") > F.col("first")).select("doc", "text_key", "line_no")
    dropped = stored(dropped, "dropped")
    discard(lines, exact, *steps)
    return dropped


def deduplicate(docs: DataFrame, **how: float) -> DataFrame:
    """The documents without the dropped lines in `text`, and `n_lines` and `n_dropped`. Rows stay, even if no line is left."""
    dropped = repeats(docs, **how).groupBy("doc", "text_key").agg(F.collect_set("line_no").alias("dropped"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64(text).alias("text_key"), F.struct("*").alias("row"))
    rows = rows.join(dropped, ["doc", "text_key"], "left")
    lines = F.split(F.coalesce("row.text", F.lit("")), "\n")

    def kept(all_lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("dropped"))
        return F.array_join(F.transform(places, lambda i: F.get(all_lines, i)), "\n")

    # As a lambda's argument the array of lines is made once, not for each of them.
    left = F.transform(F.array(lines), kept)[0]
    # The new columns before the carried ones, among which may be one of any name.
    rows = rows.select("row", F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(left).alias("text"),
                       F.size(lines).alias("n_lines"), F.coalesce(F.array_size("dropped"), F.lit(0)).alias("n_dropped"))
    new = ("text", "n_lines", "n_dropped")
    names = [c for c in docs.columns if c not in new[1:]]
    return rows.select(*[F.col(c) if c in new else F.col(f"row.`{c}`") for c in (*names, *new[1:])])


OP10_SQL = r"""
WITH RECURSIVE lines AS (SELECT doc_id, generate_subscripts(a, 1) - 1 AS line_no, unnest(a) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
plain AS (SELECT doc_id, line_no, line, trim(regexp_replace(line, '[\t\x0B\f\r ]+', ' ', 'g'), ' ') AS p FROM lines),
masks AS (SELECT doc_id, line_no, line, regexp_replace(p, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked FROM plain),
rows AS (SELECT *, string_split(masked, ' ') AS words, CASE WHEN masked = '' THEN 0 ELSE len(string_split(masked, ' ')) END AS n_words FROM masks),
exact AS (SELECT masked, n_words, words, CASE WHEN n_words < 8 THEN 1 ELSE 3 END AS lead, CASE WHEN n_words < 8 THEN 3 ELSE 2 END AS needed,
                 min(doc_id) AS first, max(doc_id) AS last FROM rows WHERE n_words >= 3 GROUP BY ALL),
tree AS (
    SELECT masked, n_words, words, lead, needed, n_words || ' ' || array_to_string(words[1:lead], ' ') AS node, false AS belongs FROM exact WHERE n_words > 3
    UNION ALL
    (WITH lines_left AS (SELECT * FROM tree WHERE NOT belongs),
    counts AS (SELECT node, needed, place, word, count(*) AS n FROM (SELECT node, needed, unnest(range(lead + 1, n_words + 1)) AS place,
               words[unnest(range(lead + 1, n_words + 1))] AS word FROM lines_left) GROUP BY ALL),
    places AS (SELECT node, place, max(n) AS most, arg_max(word, n) AS word, count(*) AS different, sum(n) AS size FROM counts GROUP BY node, needed, place HAVING sum(n) >= needed),
    split AS (SELECT node, min(struct_pack(different, place)).place AS place FROM places WHERE different > 1 GROUP BY node),
    agree AS (SELECT masked, count(*) AS n FROM lines_left JOIN places USING (node) WHERE most > 1 AND 2 * most > size AND words[place] = word GROUP BY masked),
    judged AS (SELECT lines_left.* EXCLUDE (belongs), place, coalesce(agree.n, 0) + lead >= 0.7 * n_words AS belongs
               FROM lines_left JOIN split USING (node) LEFT JOIN agree USING (masked))
    SELECT masked, n_words, words, lead, needed, CASE WHEN belongs THEN node ELSE node || chr(10) || place || ' ' || words[place] END, belongs FROM judged)),
belong AS (SELECT masked, node FROM tree WHERE belongs),
groups AS (SELECT node, min(first) AS all_first, max(last) AS all_last FROM exact JOIN belong USING (masked) GROUP BY node, needed HAVING count(*) >= needed),
span AS (SELECT masked, coalesce(all_first, first) AS first, coalesce(all_last, last) AS last
         FROM exact LEFT JOIN belong USING (masked) LEFT JOIN groups USING (node)),
judged AS (SELECT rows.doc_id, line_no, line, coalesce(span.first < span.last AND rows.doc_id > span.first, false) AS gone FROM rows LEFT JOIN span USING (masked))
SELECT doc_id, count(*)::INTEGER AS n_lines, count(*) FILTER (gone)::INTEGER AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text
FROM judged GROUP BY doc_id
"""


@query("op10_line_templates", OP10_SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return deduplicate(read(spark, sf, "documents").select("doc_id", "text"))
