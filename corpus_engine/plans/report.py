"""Run metrics and the audit report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _rows(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


def discovery_metrics(new_hits: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows of this run, rows overall, distinct videos overall."""
    totals = hits.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("video_id").alias("unique_videos"))
    return totals.select(_rows(new_hits).alias("new_rows"), "total_rows", "unique_videos")


def row_metrics(requested: DataFrame, new_rows: DataFrame, total: DataFrame) -> DataFrame:
    """Requested ids, new rows and total rows of a stage; one row."""
    return total.agg(F.count(F.lit(1)).alias("total_rows")).select(
        _rows(requested).alias("requested"), _rows(new_rows).alias("new_rows"), "total_rows")


def transcript_metrics(new_transcripts: DataFrame) -> DataFrame:
    """New rows, successes and failures."""
    status = F.col("transcript_status")
    return new_transcripts.agg(
        F.count(F.lit(1)).alias("new_rows"),
        F.count_if(status == "success").alias("successes"),
        F.count_if(status == "failed").alias("failures"),
    )


def method_histogram(new_transcripts: DataFrame) -> DataFrame:
    """Rows per transcript method, a null method included."""
    return new_transcripts.groupBy("transcript_method").agg(F.count(F.lit(1)).alias("n_rows"))


TOP = 100
TRACKED = 10_000
# Fixed value: a frequent-items sketch that tracks n items misses none with a share above this part of 1 / n.
MISSES = 3.5


def top_sketch(column: str, k: int = TOP, tracked: int = TRACKED) -> Column:
    """The likely ``k`` most frequent values as an aggregate that merges: an array of ``item`` and ``count``, a null counted like a value."""
    return F.expr(f"approx_top_k(cast({column} as string), {k + 1}, {tracked})")


def exact_from_sketch(found: list, k: int = TOP) -> dict[str | None, int] | None:
    """The sketch's counts, if there were so few values that it holds all of them exactly, else None."""
    return {r["item"]: r["count"] for r in found} if len(found) <= k else None


def top_values(df: DataFrame, column: str, k: int = TOP, tracked: int = TRACKED) -> DataFrame:
    """``kind``, ``value`` and ``n_rows``: the ``k`` most frequent values with exact counts, all others as one row, nulls as one row.

    A sketch names candidates and a second pass counts them; at most ``2 k`` values come to the driver. Where the sketch cannot prove that it
    missed none, as when all values are about as rare, values are counted in full and the top ones taken. Of equally frequent values
    the first by name count; rows of kind other and null are absent when they count nothing.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).cast("string").alias("value"))
    wide = min(2 * k, tracked) - 1
    found = values.agg(top_sketch("value", wide, tracked).alias("top")).first()["top"] or []
    named = [r["item"] for r in found if r["item"] is not None]
    label = F.when(F.col("value").isin(named), F.col("value")) if named else F.lit(None).cast("string")
    counts = values.groupBy(label.alias("value"), F.col("value").isNull().alias("missing")).agg(F.count(F.lit(1)).alias("n")).collect()
    exact = sorted(((r["n"], r["value"]) for r in counts if r["value"] is not None), key=lambda r: (-r[0], r[1]))
    rest = sum(r["n"] for r in counts if r["value"] is None and not r["missing"])
    missing = sum(r["n"] for r in counts if r["missing"])
    total = sum(n for n, _ in exact) + rest
    # What the sketch did not name can be as frequent as the last that it did, and by its error more.
    if rest and (len(exact) < k or exact[k - 1][0] <= found[-1]["count"] + MISSES * total / tracked):
        top = values.where("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(k)
        exact = [(r["n"], r["value"]) for r in top.collect()]
    rows = [("value", v, n) for n, v in exact[:k]]
    other = total - sum(n for *_, n in rows)
    rows += [("other", None, other)] * (other > 0) + [("null", None, missing)] * (missing > 0)
    return spark.createDataFrame(rows, "kind string, value string, n_rows bigint")


def method_summary(new_transcripts: DataFrame, sketch: list | None = None) -> dict:
    """What a report tells of the methods: the most frequent ones as a map, the nulls and all others as counts of their own.

    ``sketch`` is a :func:`top_sketch` taken while the rows were written; rows are read only if it saw more values than fit.
    """
    found = exact_from_sketch(sketch or []) if sketch is not None else None
    if found is not None:
        rows = [("null" if v is None else "value", v, n) for v, n in found.items()]
    else:
        rows = [tuple(r) for r in top_values(new_transcripts, "transcript_method").collect()]
    totals = {kind: sum(n for k, _, n in rows if k == kind) for kind in ("null", "other")}
    return {"methods": {v: n for kind, v, n in rows if kind == "value"}, "methods_null": totals["null"], "methods_other": totals["other"]}


def _literal(value) -> Column:
    """A count, or a map of counts, as a column."""
    if isinstance(value, Mapping):
        pairs = [F.lit(x) for k, v in value.items() for x in (k, v)]
        return F.create_map(*pairs).cast("map<string,bigint>") if pairs else F.create_map().cast("map<string,bigint>")
    return F.lit(value).cast("bigint")


def run_report(
    spark: SparkSession,
    run_id: str,
    project: str,
    started_at: str,
    ended_at: str,
    stages: Mapping[str, Mapping[str, object]],
    outputs: Mapping[str, str],
    config: str = "",
) -> DataFrame:
    """One row: run identity, one struct of metrics per stage, settings and output paths.

    A stage contributes the counts taken while its tables were written.
    """
    def text(value: str) -> Column:
        return F.lit(value)

    staged = [F.struct(*[_literal(v).alias(name) for name, v in counts.items()]).alias(stage) for stage, counts in stages.items()]
    return spark.range(1).select(
        text(run_id).alias("run_id"),
        text(project).alias("project"),
        text(started_at).alias("started_at"),
        F.struct(*staged).alias("stages"),
        text(config).alias("config"),
        text(ended_at).alias("ended_at"),
        F.struct(*[text(p).alias(name) for name, p in outputs.items()]).alias("outputs"),
    )


def transcript_stage_metrics(
    requested: DataFrame, new_transcripts: DataFrame, total: DataFrame
) -> DataFrame:
    """The transcript stage's counts plus its method histogram, as one row."""
    methods = [_literal(v).alias(name) for name, v in method_summary(new_transcripts).items()]
    return transcript_metrics(new_transcripts).select(
        _rows(requested).alias("requested"), "new_rows", "successes", "failures", *methods, _rows(total).alias("total_rows"))
