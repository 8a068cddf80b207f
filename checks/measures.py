"""Queries of mergeable counts and of membership bits, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import study_tables as st
from checks.oracle import HITS, VIDEOS
from corpus_engine.operators.membership import absent, bit_table, marked
from corpus_engine.operators.ordering import first_seen
from corpus_engine.plans.distinct import RunDistincts, relative_error
from corpus_engine.plans.report import top_values
from corpus_engine.session import scratch_path


def distinct_over_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Videos per query over three runs, each of which stores only what it saw."""
    hits = st.hits(spark, sf)
    stored = RunDistincts(spark, scratch_path(spark, "distincts"), ["theme", "query"], "video_id")
    years = F.expr("cast(left(_run_id, 4) as int)")
    for run, (first, last) in enumerate(((1900, 1996), (1997, 1998), (1999, 2200))):
        stored.store(hits.where(years.between(first, last)), f"r{run}")
    off = 5 * relative_error() * F.col("n") + 1
    both = stored.exact().join(stored.estimated(), ["theme", "query"]).select("query", "n", (F.abs(F.col("estimate") - F.col("n")) <= off).alias("close"))
    theme = stored.exact(["theme"]).select(F.col("theme").alias("query"), "n", F.lit(True).alias("close"))
    return both.unionByName(theme).unionByName(stored.exact([]).select(F.lit("all").alias("query"), "n", F.lit(True).alias("close")))


def top_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The five largest sources among documents, all others, and those without one."""
    named = st.table(spark, sf, "documents").withColumn("source", F.expr("if(doc_id % 11 = 0, null, source)"))
    return top_values(named, "source", 5)


def top_names(spark: SparkSession, sf: str) -> DataFrame:
    """The ten most frequent of very many and about as frequent names."""
    return top_values(st.table(spark, sf, "lineitem").withColumn("name", F.expr("concat('part ', l_partkey)")), "name", 10, 64)


def pending_by_bits(spark: SparkSession, sf: str) -> DataFrame:
    """Discovered videos that are not stored, by the stored ones' bits."""
    stored = st.videos(spark, sf).where("p_type <> 'PROMO'")
    return absent(first_seen(st.hits(spark, sf), "video_id"), stored, bit_table(stored, "video_id", 4096), "video_id").select("video_id")


def known_by_bits(spark: SparkSession, sf: str) -> DataFrame:
    """Orders' customers, marked by whether any customer of their segment is stored."""
    stored = st.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("cast(c_custkey as string) as customer")
    orders = st.table(spark, sf, "orders").selectExpr("o_orderkey", "if(o_orderkey % 7 = 0, null, cast(o_custkey as string)) as customer")
    return marked(orders, stored, bit_table(stored, "customer"), "customer", "known")


QUERIES = {f.__name__: f for f in (distinct_over_runs, top_sources, top_names, pending_by_bits, known_by_bits)}


def _top(values: str, k: int) -> str:
    return f"""WITH named AS ({values}), counts AS (SELECT value, count(*) AS n FROM named WHERE value IS NOT NULL GROUP BY value),
        placed AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS place FROM counts)
        SELECT 'value' AS kind, value, n AS n_rows FROM placed WHERE place <= {k}
        UNION ALL SELECT 'other', NULL, CAST(sum(n) AS BIGINT) FROM placed WHERE place > {k} HAVING count(*) > 0
        UNION ALL SELECT 'null', NULL, count(*) FROM named WHERE value IS NULL HAVING count(*) > 0"""


ORACLE = {
    "distinct_over_runs": f"""WITH {HITS}
        SELECT query, count(DISTINCT video_id) AS n, true AS close FROM hits GROUP BY query
        UNION ALL SELECT theme, count(DISTINCT video_id), true FROM hits GROUP BY theme
        UNION ALL SELECT 'all', count(DISTINCT video_id), true FROM hits""",
    "top_sources": _top("SELECT CASE WHEN doc_id % 11 <> 0 THEN source END AS value FROM documents", 5),
    "top_names": _top("SELECT 'part ' || l_partkey AS value FROM lineitem", 10),
    "pending_by_bits": f"""WITH {HITS}, {VIDEOS}
        SELECT DISTINCT video_id FROM hits WHERE video_id NOT IN (SELECT video_id FROM videos WHERE p_type <> 'PROMO')""",
    "known_by_bits": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer,
               o_orderkey % 7 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS known FROM orders""",
}
