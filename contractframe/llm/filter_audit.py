"""What corpus filters do to each other: every order of five filters, step by step, per source.

A document fails some of the filters whatever their order, so its failures are one mask of five bits and all
documents of a source are at most 32 cells: a mask, how many documents have it, how many of those are labelled
good or toxic. A recursive query extends the empty prefix by every letter not yet used and carries the bits
applied so far; at each level a mask tells whether the new filter finds such a document still there (removed),
already gone (redundant) or lets it through. Joining the cells by mask gives the counts of the step. The orders
are read off the longest prefixes; orders that begin alike share the steps of their common prefix.

The filters, by their failure conditions (words: maximal runs without ASCII white space, case-sensitive):

A. fewer than 200 words;
B. 100 * distinct words < 50 * words;
C. 100 * capital letters A-Z > 2 * code points;
D. any of ``# $ % & * |``;
E. the text equals that of a document with a smaller id, removed or not.

At scale: texts meet in one scan without Python and leave it as a digest, a mask and their keys. Copies are met by
digest after a partial aggregation, so a text that a third of all rows share is one row per task, source and
label. Only the enumeration is broadcast: 32 masks times 326 prefixes, whatever the data.

Null texts are empty; null sources are the part ''. A null id has no label, no smaller and no larger id: it never
fails E and makes no other row fail. Rows of one id and text count as often as they occur and don't fail E for each
other; rows of one id with different texts are different documents. Labels of a repeated id count as 1 if any row says 1.
An empty table has no parts and gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contractframe.llm.common import ground

#: White space between words, capitals, marks of filter D, least number of words.
_SPACE, _CAPITALS, _MARKS, _LEAST_WORDS = " \t\n\x0b\x0c\r", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "#$%&*|", 200
FILTERS = "ABCDE"
_COPY = 1 << FILTERS.index("E")


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and the mask of the filters A to D that it fails."""
    docs = ground(docs, doc_id=F.col("doc_id"), part=F.coalesce("source", F.lit("")), text=F.coalesce("text", F.lit("")))
    blank = F.translate("text", _SPACE[1:], " " * (len(_SPACE) - 1))
    docs = docs.select("doc_id", "part", "text", F.array_remove(F.split(blank, " "), "").alias("words"))
    n_words, n_chars = F.size("words"), F.char_length("text")
    fails = [
        n_words < _LEAST_WORDS,
        100 * F.size(F.array_distinct("words")) < 50 * n_words,
        100 * (n_chars - F.char_length(F.translate("text", _CAPITALS, ""))).cast("bigint") > 2 * n_chars,
        n_chars != F.char_length(F.translate("text", _MARKS, "")),
    ]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return docs.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask of all five filters, documents, and those labelled good or toxic."""
    rows = failures(docs).groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    told = ground(labels, doc_id=F.col("doc_id"), quality=F.col("quality"), toxic=F.col("toxic")).where("doc_id IS NOT NULL")
    told = told.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        F.lit(0).alias("deal"),
    )
    # Missing ids find no label; dealt by their texts they don't meet in one task either.
    rows = rows.withColumn("deal", F.when(F.col("doc_id").isNull(), F.hash("digest")).otherwise(0))
    rows = rows.join(told, ["doc_id", "deal"], "left").select(
        "doc_id", "part", "digest", "mask", "n",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    known = F.col("doc_id").isNotNull()
    groups = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_unknown"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("least"),
    )
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))  # a row per part and label, not per copy
    original = F.col("n_unknown") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    groups = groups.withColumn("first", first).withColumn("original", original)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("original").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(_COPY)).alias("mask"), (F.col("n") - F.col("original")).alias("n")),
    )
    cells = groups.select("part", "good", "toxic", F.inline(both))
    counted = lambda of: F.coalesce(F.sum(F.when(F.col(of), F.col("n"))), F.lit(0))
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), counted("good").alias("n_good"), counted("toxic").alias("n_toxic"))


def _enumeration(letters: str) -> str:
    """Every prefix of letters, for every mask: recursion from the empty prefix, one unused letter a level."""
    filters = ", ".join(f"struct('{c}' AS letter, {1 << i} AS bit)" for i, c in enumerate(letters))
    return f"""
    WITH RECURSIVE walk (mask, step, prefix, before, bit) AS (
        SELECT m, 0, '', 0, 0 FROM (SELECT explode(sequence(0, {(1 << len(letters)) - 1})) AS m)
        UNION ALL
        SELECT mask, step + 1, concat(prefix, f.letter), before | bit, f.bit
        FROM walk LATERAL VIEW explode(filter(array({filters}), x -> (before | bit) & x.bit = 0)) unused AS f
    )
    SELECT mask, step, prefix, (mask & (before | bit)) = 0 AS kept, (mask & bit) <> 0 AND (mask & before) = 0 AS removed,
           (mask & bit) <> 0 AND (mask & before) <> 0 AS redundant, mask = bit AS alone
    FROM walk WHERE step > 0
    """


def audit_orders(cells: DataFrame, letters: str = FILTERS) -> DataFrame:
    """Per part, order and step what the step's filter keeps, removes and finds gone already.

    ``cells`` has part, mask (bit i: fails letters[i]), n, n_good and n_toxic. The enumeration has
    2 ** n masks times all arrangements of n letters; it is meant for a handful of filters.
    """
    spark, size = cells.sparkSession, len(letters)
    walk = spark.sql(_enumeration(letters))
    total = lambda n, when: F.sum(F.when(F.col(when), F.col(n)).otherwise(0))
    steps = cells.join(F.broadcast(walk), "mask").groupBy("part", "prefix", "step").agg(  # a fixed number of rows
        total("n", "kept").alias("kept"), total("n", "removed").alias("removed"), total("n", "redundant").alias("redundant"),
        total("n", "alone").alias("unique_fails"), total("n_good", "removed").alias("good_lost"), total("n_toxic", "removed").alias("toxic_lost"),
    )
    # A prefix begins (size - step)! orders, in each of which its last filter removes the same documents.
    orders_with = F.factorial(F.lit(size) - F.col("step"))
    one_filter = Window.partitionBy("part", F.substring("prefix", -1, 1))
    steps = steps.withColumn("shapley", F.sum(F.col("removed") * orders_with).over(one_filter)).drop("step")
    orders = spark.sql(
        f"WITH walk AS ({_enumeration(letters)}) SELECT prefix AS filter_order, step, substring(prefix, 1, step) AS prefix "
        f"FROM (SELECT prefix FROM walk WHERE step = {size} AND mask = 0) LATERAL VIEW explode(sequence(1, {size})) s AS step"
    )
    return steps.join(F.broadcast(orders), "prefix").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All 120 orders of the five filters over the documents of each source."""
    return audit_orders(mask_cells(docs, labels))
