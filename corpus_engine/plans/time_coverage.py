"""Which times the searches of a study have covered, query by query, and which are missing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_engine.operators.intervals import gaps, united

SEARCH = ("query", "search_order", "published_after", "published_before")
ORIGIN = "timestamp_ntz'1970-01-01 00:00:00'"


def _micros(text: Column) -> Column:
    """Microseconds since 1970; null where the text is no time."""
    return F.unix_micros(F.try_to_timestamp(text))


def _iso(micros: str) -> Column:
    """UTC text, to the second if it is a whole one, whatever the session's zone."""
    moment = F.expr(f"{ORIGIN} + make_dt_interval(0, 0, 0, {micros} / 1000000)")
    return F.concat(F.translate(moment.cast("string"), " ", "T"), F.lit("Z"))


def complete_searches(pages: DataFrame) -> DataFrame:
    """Searches of which every landed page was read, be it in a later run.

    Of a page that landed more than once the latest outcome counts.
    """
    latest = pages.groupBy(*SEARCH, "page_number").agg(
        F.max_by(F.col("error").isNull(), F.struct("run_id", "seq")).alias("_read"))
    return latest.groupBy(*SEARCH).agg(F.bool_and("_read").alias("_read")).where("_read").drop("_read")


def time_coverage(pages: DataFrame, start: str, stop: str) -> DataFrame:
    """``query``, ``kind`` (covered or missing), ``begin`` and ``end``: the merged windows of complete searches, and the rest of the study's time.

    ``start`` and ``stop`` (exclusive) are times in ISO form. A window without a beginning or an end is open there and counts from the
    study's start or to its stop; one whose text is no time covers nothing. Windows are cut to the study's time.
    """
    session = pages.sparkSession
    first, last = session.range(1).select(_micros(F.lit(start)), _micros(F.lit(stop))).first()
    if first is None or last is None or first >= last:
        raise ValueError("the study's time needs a start before its stop")

    def edge(text: str, outermost: int, clip: Callable[..., Column]) -> Column:
        found = F.when(F.col(text).isNull(), F.lit(outermost)).otherwise(_micros(F.col(text)))
        return F.when(found.isNotNull(), clip(found, F.lit(outermost)))

    windows = complete_searches(pages).select(
        "query", edge("published_after", first, F.greatest).alias("begin"), edge("published_before", last, F.least).alias("end"))
    covered = united(windows, ["query"], "begin", "end")
    missing = gaps(covered, ["query"], "begin", "end", pages, first, last)
    both = covered.withColumn("kind", F.lit("covered")).unionByName(missing.withColumn("kind", F.lit("missing")))
    return both.select("query", "kind", _iso("begin").alias("begin"), _iso("end").alias("end"))
