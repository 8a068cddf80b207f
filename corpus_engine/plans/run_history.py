"""What the runs of a study achieved, over all of them: reports side by side, recovery of failures, bursts and peaks of calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR = 60 * 60 * 1_000_000  # microseconds
DAY = 24 * HOUR
# A stage's metrics differ from stage to stage and from release to release, so they are read as texts by name.
REPORTS = "run_id string, project string, started_at string, ended_at string, stages map<string, map<string, string>>"


def stored_reports(spark: SparkSession, root: str) -> DataFrame:
    """A row for each metric of each stage of every report below a study's folder: ``run_id``, ``stage``, ``metric`` and ``value`` as text.

    Reports of any release are one table here: what one does not have is no row, and what it has besides is a row like any other. Runs
    without stages have none. Lines that are no report are left out.
    """
    found = spark.read.schema(REPORTS).option("recursiveFileLookup", "true").json(f"{root.rstrip('/')}/audit/runs")
    stages = found.where("run_id is not null").select("run_id", "started_at", F.explode("stages").alias("stage", "metrics"))
    return stages.select("run_id", "started_at", "stage", F.explode("metrics").alias("metric", "value"))


def stage_history(reports: DataFrame) -> DataFrame:
    """``run_id``, ``stage`` and the counts that every release reports under some name; null where a report lacks one."""
    counts = {"requested": "requested", "new_rows": "new_rows", "total_rows": "total_rows", "failures": "failures"}
    return reports.groupBy("run_id", "stage").agg(*[
        F.max(F.when(F.col("metric") == metric, F.expr("try_cast(value as bigint)"))).alias(name) for name, metric in counts.items()])


def recovery(attempts: DataFrame) -> DataFrame:
    """Per stage and run: items ``attempted``, ``failed``, of those ``recovered`` by a later run, and the ``rate``.

    ``attempts`` has ``stage``, ``run_id``, ``item`` and ``ok``. An item fails in a run when no attempt of that run succeeded. A failure is
    recovered when any later run succeeded. The rate is null where nothing failed.
    """
    tried = attempts.where(F.col("item").isNotNull()).groupBy("stage", "item", "run_id").agg(F.bool_or(F.coalesce("ok", F.lit(False))).alias("_ok"))
    # One row for each run of an item: the window holds no more than there are runs.
    later = Window.partitionBy("stage", "item").orderBy(F.col("run_id").desc()).rowsBetween(Window.unboundedPreceding, -1)
    judged = tried.withColumn("_later", F.coalesce(F.bool_or("_ok").over(later), F.lit(False)))
    failed = ~F.col("_ok")
    return judged.groupBy("stage", "run_id").agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(failed).alias("failed"), F.count_if(failed & F.col("_later")).alias("recovered"),
    ).withColumn("rate", F.when(F.col("failed") > 0, F.col("recovered") / F.col("failed")))


def study_history(reports: DataFrame, attempts: DataFrame) -> DataFrame:
    """Reports and recovery side by side; a stage or run that only one of them knows is kept."""
    return stage_history(reports).join(recovery(attempts), ["run_id", "stage"], "full")


def call_sessions(calls: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Bursts of calls per run: ``run_id``, ``begin``, ``end`` (of the last call), ``calls`` and ``failed``.

    ``calls`` has ``run_id``, ``at`` (timestamp) and ``ok``. Calls of one instant are counted together first, so a run with very many calls
    sorts one row per instant.
    """
    counted = calls.where(F.col("at").isNotNull()).groupBy("run_id", "at").agg(
        F.count(F.lit(1)).alias("_calls"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("_failed"))
    bursts = counted.groupBy("run_id", F.session_window("at", gap)).agg(
        F.min("at").alias("begin"), F.max("at").alias("end"), F.sum("_calls").alias("calls"), F.sum("_failed").alias("failed"))
    return bursts.drop("session_window")


def peak_calls(calls: DataFrame, keys: tuple[str, ...] = ("stage",), span: int = DAY) -> DataFrame:
    """Per key the most calls within any 24 hours (``calls``), and when the first such stretch ended (``until``).

    A stretch ends with a call and is open at its beginning. So a call counts from its instant until ``span`` later, and the calls within a stretch
    are a running total of those that begin and end to count. Totals per hour are summed first, one row for each hour of a key, and carried into
    a window per hour: each row is looked at once however many lie within a stretch, and a key with very many calls is as many tasks as it has hours.
    """
    if isinstance(calls.schema["at"].dataType, T.TimestampNTZType):
        calls = calls.withColumn("at", F.col("at").cast("timestamp"))
    counted = calls.where(F.col("at").isNotNull()).groupBy(*keys, F.unix_micros("at").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    changes = counted.select(*keys, F.explode(F.array(
        F.struct("_at", "_n"), F.struct((F.col("_at") + span).alias("_at"), (-F.col("_n")).alias("_n")))).alias("_change")).select(*keys, "_change.*")
    dealt = changes.withColumn("_hour", F.col("_at") - F.expr(f"pmod(_at, {HOUR}L)"))
    before = Window.partitionBy(*keys).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*keys, "_hour").agg(F.sum("_n").alias("_total"))
    carried = totals.select(*keys, (F.col("_hour") - 1).alias("_at"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_n"), "_hour", F.lit(False).alias("_call"))
    running = Window.partitionBy(*keys, "_hour").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = dealt.withColumn("_call", F.col("_n") > 0).unionByName(carried).withColumn("_calls", F.sum("_n").over(running)).where("_call")
    best = rolled.groupBy(*keys).agg(F.max(F.struct("_calls", (-F.col("_at")).alias("_at"))).alias("_best"))
    return best.select(*keys, F.col("_best._calls").alias("calls"), F.timestamp_micros(-F.col("_best._at")).alias("until"))
