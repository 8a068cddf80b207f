"""Queries of fields that drift, of rows that cannot be read, and of files in order, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import study_tables as st
from checks.oracle import BEST, CASCADE, EXPANSION, HITS, VIDEOS, squash
from checks.queries import channel_expansion, discovery_review
from corpus_engine import schemas
from corpus_engine.operators.ordering import first_seen
from corpus_engine.plans.expansion import write_expansion
from corpus_engine.plans.review import write_review
from corpus_engine.plans.study import Study, StudyOptions, run_study
from corpus_engine.session import scratch_path
from corpus_engine.sources import drift
from corpus_engine.sources.ordered import read_ordered
from corpus_engine.sources.quarantine import quarantine_counts, read_checked, still_quarantined


def drifting_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A channel page per customer: counts that become numbers, new objects and fields, an object that becomes a text, and cut pages."""
    return st.table(spark, sf, "customer").selectExpr(
        "'r1' as run_id", "c_custkey as seq",
        """concat('{"etag":"e', c_custkey, '","items":[{"id":"', c_custkey, '","snippet":', if(c_custkey % 13 = 0, '"gone"', concat(
             '{"title":"', c_name, '"', if(c_custkey % 5 = 0, ',"localized":{"title":"x","rank":1}', ''), if(c_custkey % 3 = 0, ',"country":null', ''), '}')),
             ',"statistics":{"viewCount":', if(c_custkey % 4 = 0, '12', '"12"'), if(c_custkey % 6 = 0, ',"shares":[1,2]', ''), '}',
             if(c_custkey % 7 = 0, ',"branding":{"colour":"red"}', ''), if(c_custkey % 11 = 0, '', '}]}')) as response""")


def channel_field_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return drift.field_inventory(drifting_pages(spark, sf), "channels")


def channel_unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    items = drift.variant_items(drifting_pages(spark, sf))
    rest = F.col("unknown")
    return drift.unknown_fields(items, "channels").select(
        "seq", F.coalesce(F.size(rest), F.lit(0)).cast("bigint").alias("n_unknown"), *[
            F.try_element_at(rest, F.lit(path)).alias(path.replace(".", "_")) for path in ("snippet.localized", "statistics.shares", "branding")])


def _land_orders(spark: SparkSession, sf: str, root: str) -> None:
    """Video pages from orders: some lines are cut, some have a number as text, some hold a cut response; a second landing brings a part again."""
    response = "concat('{\"items\": [{\"id\": \"', o_custkey, '\"}]', {end})"
    line = "to_json(named_struct('run_id', concat('r', year(o_orderdate)), 'seq', {seq}, 'response', {response}))"
    good = line.format(seq="o_orderkey", response=response.replace("{end}", "'}'"))
    typed = line.format(seq="concat('n', o_orderkey)", response=response.replace("{end}", "'}'"))
    cut = line.format(seq="o_orderkey", response=response.replace("{end}", "''"))
    orders = st.table(spark, sf, "orders")
    orders.selectExpr(f"case o_orderkey % 10 when 0 then left({good}, length({good}) - 5) when 1 then {typed} when 2 then {cut} else {good} end as value").write.text(f"{root}/first")
    orders.where("o_orderkey % 20 in (0, 2)").selectExpr(f"{good} as value").write.text(f"{root}/second")


def quarantined_pages(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "quarantine")
    _land_orders(spark, sf, root)
    good, bad = read_checked(spark, f"{root}/*", schemas.DETAIL_ENVELOPE)
    return quarantine_counts(good, still_quarantined(bad, good))


def review_file(spark: SparkSession, sf: str) -> DataFrame:
    """The review as its files say it, from top to bottom."""
    path, review = scratch_path(spark, "review"), discovery_review(spark, sf)
    write_review(review, path, files=5)
    return read_ordered(spark, path, review.schema).select("place", "query", "result_position", "video_id", "title")


def expansion_file(spark: SparkSession, sf: str) -> DataFrame:
    path, rows = scratch_path(spark, "expansion"), channel_expansion(spark, sf)
    write_expansion(rows, first_seen(st.expansion_hits(spark, sf), "channel_id"), path, files=3)
    return read_ordered(spark, path, rows.schema).select("place", "channel_id", "page_number", "position_in_page", "video_id", "new_vs_search")


def study_run_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The transcripts that a run publishes from captions, failed subtitle calls and speech."""
    root = scratch_path(spark, "sources")
    st.land_sources(spark, sf, f"{root}/landing")
    options = StudyOptions(max_pages_per_query=10**9, languages=st.LANGUAGES, stages=["discovery", "videos", "transcripts"])
    run_study(spark, f"{root}/data", "study", f"{root}/landing", options, "r1", st.CAPTURED)
    rows = Study(spark, f"{root}/data", "study").read("transcripts")
    errors = {f"error_{name}": F.try_element_at("transcript_error", F.lit(strategy))["type"]
              for name, strategy in (("captions", "youtube_transcript_api"), ("subtitles", "yt_dlp_subtitle"), ("speech", "whisper"))}
    return rows.withColumns(errors).select("video_id", "transcript_status", "transcript_method", "transcript_language", "transcript_text", *errors)


QUERIES = {f.__name__: f for f in (channel_field_inventory, channel_unknown_fields, quarantined_pages, review_file, expansion_file, study_run_sources)}

_KEPT = "kept AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 11 <> 0)"

ORACLE = {
    "channel_field_inventory": f"""WITH {_KEPT}, told AS (
          SELECT unnest([
            {{'path': 'id', 'type': 'STRING', 'declared': true, 'here': true}},
            {{'path': 'snippet', 'type': CASE WHEN k % 13 = 0 THEN 'STRING' WHEN k % 5 = 0 AND k % 3 = 0 THEN 'OBJECT<country: VOID, localized: OBJECT<rank: BIGINT, title: STRING>, title: STRING>'
                WHEN k % 5 = 0 THEN 'OBJECT<localized: OBJECT<rank: BIGINT, title: STRING>, title: STRING>' WHEN k % 3 = 0 THEN 'OBJECT<country: VOID, title: STRING>'
                ELSE 'OBJECT<title: STRING>' END, 'declared': true, 'here': true}},
            {{'path': 'snippet.title', 'type': 'STRING', 'declared': true, 'here': k % 13 <> 0}},
            {{'path': 'snippet.localized', 'type': 'OBJECT<rank: BIGINT, title: STRING>', 'declared': false, 'here': k % 13 <> 0 AND k % 5 = 0}},
            {{'path': 'snippet.country', 'type': 'VOID', 'declared': true, 'here': k % 13 <> 0 AND k % 3 = 0}},
            {{'path': 'statistics', 'type': 'OBJECT<' || CASE WHEN k % 6 = 0 THEN 'shares: ARRAY<BIGINT>, ' ELSE '' END || 'viewCount: ' ||
                CASE WHEN k % 4 = 0 THEN 'BIGINT' ELSE 'STRING' END || '>', 'declared': true, 'here': true}},
            {{'path': 'statistics.viewCount', 'type': CASE WHEN k % 4 = 0 THEN 'BIGINT' ELSE 'STRING' END, 'declared': true, 'here': true}},
            {{'path': 'statistics.shares', 'type': 'ARRAY<BIGINT>', 'declared': false, 'here': k % 6 = 0}},
            {{'path': 'branding', 'type': 'OBJECT<colour: STRING>', 'declared': false, 'here': k % 7 = 0}}]) AS f FROM kept)
        SELECT f.path AS path, f.type AS type, f.declared AS declared, count(*) AS n_items FROM told WHERE f.here GROUP BY ALL""",
    "channel_unknown_fields": f"""WITH {_KEPT}, parts AS (
          SELECT k, CASE WHEN k % 13 <> 0 AND k % 5 = 0 THEN '{{"rank":1,"title":"x"}}' END AS a, CASE WHEN k % 6 = 0 THEN '[1,2]' END AS b,
                 CASE WHEN k % 7 = 0 THEN '{{"colour":"red"}}' END AS c FROM kept)
        SELECT k AS seq, CAST(a IS NOT NULL AS BIGINT) + CAST(b IS NOT NULL AS BIGINT) + CAST(c IS NOT NULL AS BIGINT) AS n_unknown,
               a AS snippet_localized, b AS statistics_shares, c AS branding FROM parts""",
    "quarantined_pages": """WITH o AS (SELECT 'r' || year(o_orderdate) AS run_id, o_orderkey AS k FROM orders)
        SELECT run_id, count(*) FILTER (k % 10 > 2) + count(*) FILTER (k % 20 IN (0, 2)) AS n_read, count(*) FILTER (k % 10 = 0) AS no_json,
               count(*) FILTER (k % 10 = 1) AS wrong_type, count(*) FILTER (k % 10 = 2) AS no_response, count(*) FILTER (k % 20 IN (0, 2)) AS n_taken_up
        FROM o GROUP BY run_id""",
    "review_file": f"""WITH {HITS}, {VIDEOS}, {BEST}
        SELECT row_number() OVER (ORDER BY query, s.result_position, s.video_id) AS place, query, s.result_position, s.video_id, title
        FROM sample s LEFT JOIN videos v ON s.video_id = v.video_id""",
    "expansion_file": f"""WITH {EXPANSION}, seen AS (SELECT channel_id, min((conv_id, turn, pos)) AS first FROM hits GROUP BY channel_id)
        SELECT row_number() OVER (ORDER BY first, page_number, position_in_page, video_id) AS place, e.channel_id, page_number, position_in_page, video_id, new_vs_search
        FROM expansion e JOIN seen s ON e.channel_id = s.channel_id""",
    "study_run_sources": f"""WITH {CASCADE}, won AS (
          SELECT *, CASE WHEN by_track THEN method WHEN by_speech THEN 'faster_whisper_small' ELSE 'failed' END AS how FROM decided)
        SELECT video_id, CASE WHEN how = 'failed' THEN 'failed' ELSE 'success' END AS transcript_status, how AS transcript_method,
               CASE WHEN how <> 'failed' THEN lang END AS transcript_language, CASE WHEN how <> 'failed' THEN {squash('text')} END AS transcript_text,
               CASE WHEN how = 'failed' THEN CASE WHEN quality IS NULL AND n_chars < 1000 THEN 'TranscriptsDisabled'
                    WHEN quality IS NULL THEN 'NoMatchingTranscript' ELSE 'EmptyTranscript' END END AS error_captions,
               CASE WHEN how = 'failed' THEN CASE WHEN n_chars >= 10000 THEN 'YtDlpSubtitleError' WHEN lang = 'en' THEN 'DownloadError' ELSE 'HTTPError' END END AS error_subtitles,
               CASE WHEN how = 'failed' THEN CASE WHEN n_chars < 200 THEN 'RuntimeError' ELSE 'AudioDownloadError' END END AS error_speech
        FROM won""",
}
