"""License scans by diagonal voting (operator 9); DataFrame functions only.

Every position of every text gives the hash of its K words, and these hashes
are joined to the positions of the templates' K-grams.  A hit at word p of a
text and word q of a template votes for the diagonal p - q.  Diagonals that
lie within MERGE words of each other (words put in or left out) are merged,
and a template is found where the merged hits cover enough of its words.  On
one diagonal a template has at most as many hits as words, so no group grows
with the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.components import stored

K = 3
#: Diagonals this close are merged, and the share of a template's words that must be covered.
MERGE, COVER = 2, 0.8
#: Phrases whose places are counted as they stand.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Words of well-known license statements, and their labels.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("under the terms of the gnu general public license", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("all rights reserved", "reserved"),
)
_SPLIT = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text: A-Z lower-cased, runs of letters, digits and all beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _SPLIT), "")


def _kgram(row: str = "g") -> Column:
    return F.xxhash64(f"{row}.w0", f"{row}.w1", f"{row}.w2")


def templates(spark: SparkSession, given=TEMPLATES) -> DataFrame:
    """(kgram, at): each K-gram of the templates with all its places (template, label, word, size)."""
    rows = []
    for n, (text, label) in enumerate(given):
        w = text.split()
        rows += [(w[i], w[i + 1], w[i + 2], n, label, i, len(w)) for i in range(len(w) - K + 1)]
    grams = spark.createDataFrame(rows, "w0 string, w1 string, w2 string, template int, label string, word int, size int")
    return (grams.select(F.xxhash64("w0", "w1", "w2").alias("kgram"), F.struct("template", "label", "word", "size").alias("at"))
            .groupBy("kgram").agg(F.collect_list("at").alias("at")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", given=TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of ``docs``.

    score: the largest share of a template's words that is covered, 1 where a
    phrase stands, 0 where nothing was found.  Nulls: a null text counts as
    empty; a row without id is scanned all the same.  Repeated rows give a row
    each; other columns are left aside; an empty table gives no rows.  Texts
    are taken whole.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), words(F.col(text_col).cast("string")).alias("w"),
                      F.monotonically_increasing_id().alias("row"))
    n = F.size("w")
    grams = own.select("row", "doc_id", n.cast("long").alias("n_words"), F.posexplode_outer(
        F.arrays_zip(F.col("w").alias("w0"), F.slice("w", 2, n).alias("w1"), F.slice("w", 3, n).alias("w2"))).alias("p", "g"))
    phrase = F.lit(None).cast("string")
    for text, label in PHRASES:
        phrase = F.when(_stands(text.split()), F.lit(label)).otherwise(phrase)
    found = (grams.withColumn("kgram", F.when(F.col("g.w2").isNotNull(), _kgram()))
             .join(F.broadcast(templates(spark, given)), "kgram", "left")
             .withColumn("phrase", phrase)
             .where("p IS NULL OR p = 0 OR at IS NOT NULL OR phrase IS NOT NULL")
             .select("row", "doc_id", "n_words", F.col("p").cast("long").alias("p"), "phrase", "at"))
    found = stored(found, spark, "license-hits")

    key = ["row", "doc_id", "n_words"]
    votes = (found.where("at IS NOT NULL").select(*key, "p", F.explode("at").alias("t"))
             .groupBy(*key, "t.template", "t.label", "t.size", (F.col("p") - F.col("t.word")).alias("diagonal"))
             .agg(F.collect_set("t.word").alias("hits")))
    line = Window.partitionBy("row", "template").orderBy("diagonal")
    merged = (votes.withColumn("new", (F.col("diagonal") - F.lag("diagonal", 1, -(1 << 40)).over(line) > MERGE).cast("int"))
              .withColumn("span", F.sum("new").over(line))
              .groupBy(*key, "template", "label", "size", "span")
              .agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits")))
    covered = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h, h + K - 1)))))
    spans = (merged.select(*key, "label", (covered / F.col("size")).alias("cover")).where(F.col("cover") >= COVER)
             .select(*key, F.lit(None).cast("long").alias("p"), F.lit(None).cast("string").alias("phrase"), "label", "cover"))
    rows = (found.withColumn("p", F.when(F.col("phrase").isNotNull(), F.col("p")))
            .select(*key, "p", "phrase", F.col("phrase").alias("label"),
                    F.when(F.col("phrase").isNotNull(), F.lit(1.0)).otherwise(0.0).alias("cover")))
    names = lambda c: F.concat_ws(",", F.sort_array(F.collect_set(c)))
    return (rows.unionByName(spans).groupBy(*key)
            .agg(F.count("phrase").alias("n_base"), F.min("p").alias("first_word"), F.max("p").alias("last_word"),
                 names("phrase").alias("base_labels"), names("label").alias("labels"), F.max("cover").alias("score"))
            .drop("row"))


def _stands(phrase: list[str]) -> Column:
    test = F.col("g.w0") == phrase[0]
    for i, w in enumerate(phrase[1:], 1):
        test &= F.col(f"g.w{i}") == w
    return F.coalesce(test, F.lit(False))
