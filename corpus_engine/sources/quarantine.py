"""Landed rows that cannot be read: kept with file, text and reason instead of turning into nulls.

The rows that can be read are the same as :func:`corpus_engine.sources.pages.read_landing` gives, less those that it would
leave without all or some of their values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = "_text"
# A cut line still begins with its identity more often than not.
RUN, SEQ = r'"run_id"\s*:\s*"((?:[^"\\]|\\.)*)"', r'"seq"\s*:\s*(-?\d+)'


def _with_text(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(TEXT, T.StringType())])


def _file() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), "[^/]*/[^/]*$", 0).alias("file")


def read_checked(spark: SparkSession, path: str, envelope: T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON-lines pages that could be read, and the quarantine: ``run_id``, ``seq``, ``file``, ``text`` and ``reason`` of the others.

    Reasons: ``no json`` for a line that is cut or garbled, ``wrong type`` for one with a value that does not fit its column,
    ``no response`` for a page whose response is text, no error, and cannot be read. Run and number of a line that is no JSON are read
    from its text as far as they are there.
    """
    # Read as text and then parsed as a whole: a reader of JSON files looks only at the columns asked for and would miss wrong values in others.
    found = spark.read.text(path).select("value", _file()).where(F.trim("value") != "")
    parsed = F.from_json("value", _with_text(envelope), {"columnNameOfCorruptRecord": TEXT})
    lines = found.select(parsed.alias("_line"), "file").select("_line.*", "file")
    unreadable = F.col(TEXT).isNotNull()
    reason = F.when(unreadable & F.try_parse_json(TEXT).isNull(), "no json").when(unreadable, "wrong type")
    names = envelope.fieldNames()
    text = F.col(TEXT)
    if "response" in names and isinstance(envelope["response"].dataType, T.StringType):
        text = F.coalesce(TEXT, F.col("response"))
        failed = F.col("error").isNotNull() if "error" in names else F.lit(False)
        reason = reason.when(~failed & F.col("response").isNotNull() & F.try_parse_json("response").isNull(), "no response")
    judged = lines.withColumn("reason", reason)
    told_run = F.nullif(F.regexp_extract(TEXT, RUN, 1), F.lit(""))
    told_seq = F.regexp_extract(TEXT, SEQ, 1).try_cast("bigint")
    bad = judged.where("reason is not null").select(
        (F.coalesce("run_id", told_run) if "run_id" in names else told_run).alias("run_id"),
        (F.coalesce("seq", told_seq) if "seq" in names else told_seq).alias("seq"),
        "file", text.alias("text"), "reason")
    return judged.where("reason is null").select(*names), bad


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """CSV rows that fit the schema, and ``file``, ``text`` and ``reason`` of those that do not.

    Arrays, maps and structs stand in the file as JSON text. Reasons: ``wrong cell`` for a row with too many or too few cells or one that is not of its
    column's type, and ``wrong json`` for a nested cell that cannot be read.
    """
    def nested(f: T.StructField) -> bool:
        return isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))

    flat = T.StructType([T.StructField(f.name, T.StringType() if nested(f) else f.dataType) for f in schema.fields])
    raw = spark.read.schema(_with_text(flat)).csv(
        path, header=True, multiLine=True, escape='"', enforceSchema=True, columnNameOfCorruptRecord=TEXT).select("*", _file())
    # The reader converts only cells that are asked for, so all are, whatever columns are used later.
    raw = raw.where(F.length(F.concat_ws("", *[F.col(f.name).cast("string") for f in flat.fields])) >= 0)
    cells = [f.name for f in schema.fields if nested(f)]
    broken = F.lit(False)
    for f in schema.fields:
        if nested(f):
            broken = broken | (F.col(f.name).isNotNull() & F.from_json(f.name, f.dataType).isNull())
    judged = raw.withColumn("reason", F.when(F.col(TEXT).isNotNull(), "wrong cell").when(broken, "wrong json"))
    text = F.coalesce(TEXT, F.to_json(F.struct(*cells))) if cells else F.col(TEXT)
    good = judged.where("reason is null").select(*[
        F.from_json(f.name, f.dataType).alias(f.name) if nested(f) else F.col(f.name) for f in schema.fields])
    return good, judged.where("reason is not null").select("file", text.alias("text"), "reason")


def still_quarantined(bad: DataFrame, good: DataFrame, keys: Sequence[str] = ("run_id", "seq")) -> DataFrame:
    """Quarantined rows with ``taken_up``: whether a row of the same identity has been read since; one without identity never has.

    Only the quarantine's identities are asked for, and pages of an identity that lands often count once.
    """
    asked = bad.select(*keys).distinct()
    read = good.join(asked, list(keys), "left_semi").select(*keys).distinct().withColumn("_read", F.lit(True))
    return bad.join(read, list(keys), "left").withColumn("taken_up", F.coalesce("_read", F.lit(False))).drop("_read")


def quarantine_counts(good: DataFrame, judged: DataFrame) -> DataFrame:
    """Per run: pages read, quarantined rows by reason, and how many of them were taken up since."""
    read = good.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_read"))
    reasons = ["no json", "wrong type", "no response"]
    kept = judged.groupBy("run_id").agg(
        *[F.count_if(F.col("reason") == r).alias(r.replace(" ", "_")) for r in reasons], F.count_if("taken_up").alias("n_taken_up"))
    names = ["n_read", *[r.replace(" ", "_") for r in reasons], "n_taken_up"]
    both = read.withColumnRenamed("run_id", "_run").join(kept, F.col("_run").eqNullSafe(F.col("run_id")), "full")
    return both.select(F.coalesce("run_id", "_run").alias("run_id"), *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
