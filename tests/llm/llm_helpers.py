"""Small inputs with everything odd that a table can hold."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use inside; their values must never be read.
CLASHING = ("id", "body", "row", "mark", "at", "n", "word", "label", "start", "ids", "digest", "sketch", "carried", "group", "held", "packed", "marks", "place")


def documents(spark, rows, clashing=True):
    """A frame of (doc_id, text[, lang]) with columns of clashing names beside the usual ones."""
    from pyspark.sql import functions as F

    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1])) for r in rows]
    frame = spark.createDataFrame(full, DOCUMENTS)
    return frame.select("*", *(F.lit("clash").alias(c) for c in CLASHING)) if clashing else frame


def prose(seed, n, vocabulary=400):
    """``n`` words drawn by the seed from as many made-up ones as ``vocabulary`` says."""
    made = random.Random(0)
    words = ["".join(made.choice("abdeginorst") for _ in range(2 + k % 7)) for k in range(vocabulary)]
    r = random.Random(seed)
    return " ".join(r.choice(words) for _ in range(n))


def odd_rows():
    """Null and empty texts, null and repeated ids, repeated rows, ties, a very long text, one very long word."""
    long_text = prose(7, 30_000)
    return [(1, None), (2, ""), (3, " \t\n "), (4, "One"), (4, "One"), (5, "two words"), (None, "no id here at all"), (None, "no id here at all"),
            (6, prose(1, 120)), (7, prose(1, 120)), (6, prose(2, 90)), (8, long_text), (9, "x" * 50_000), (10, "é ß İ 日本   \x1c ok")]


def hot_rows(spark, copies=12_000, others=8_000):
    """A table of which more than half is one row without an id."""
    from pyspark.sql import functions as F

    hot = documents(spark, [(None, prose(5, 30))], clashing=False).crossJoin(spark.range(copies)).drop("id")
    rest = spark.range(others).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.concat(F.lit(prose(6, 25) + " "), F.col("id").cast("string")).alias("text"))
    return hot.select("doc_id", "text").unionByName(rest)
