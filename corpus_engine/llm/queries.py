"""The registered queries of this subpackage: thin calls of the operators with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_engine.llm.centroid_clusters import Settings as ClusterSettings
from corpus_engine.llm.centroid_clusters import centroid_clusters
from corpus_engine.llm.common import held_out_remainder, table
from corpus_engine.llm.curve_packing import pack
from corpus_engine.llm.fill_in_middle import fill_in_middle, restored
from corpus_engine.llm.language_id import language_id
from corpus_engine.llm.lm_scoring import default_vocabulary, lm_scores
from corpus_engine.llm.near_duplicates import Settings as NearSettings
from corpus_engine.llm.near_duplicates import near_duplicates
from corpus_engine.llm.neighbour_graph import nearest_neighbours
from corpus_engine.llm.page_text import main_text
from corpus_engine.llm.quality_rules import quality_rules
from corpus_engine.llm.repeated_passages import remove_repeats
from corpus_engine.llm.template_leaks import template_leaks
from corpus_engine.llm.token_files import read_token_files, write_token_files
from corpus_engine.llm.warc_archive import read_archive, write_archive
from corpus_engine.llm.word_tokens import default_tokenizer
from corpus_engine.session import scratch_path


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), held_out_remainder(F.col("doc_id"), 7) == 2, default_vocabulary())


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearSettings(shingle=3, percent=85)).drop("mark", "stays")


def op3_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("mark")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "archive")
    records = read_archive(write_archive(table(spark, sf_dir, "pages"), folder), folder, with_data=False)
    return records.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"), held_out_remainder(F.col("doc_id"), 3) == 1)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), folder, default_tokenizer()), folder)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    sha256 = lambda c: F.sha2(c.cast("binary"), 256)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha256(F.col("output")).alias("output_sha256"),
                      sha256(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clusters(table(spark, sf_dir, "embeddings"), ClusterSettings(clusters=40, rounds=5))
    return found.withColumn("centroid_sha256", F.sha2(F.col("centroid").cast("binary"), 256)).drop("centroid")


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_template_leaks": op3_template_leaks,
    "op4_warc": op4_warc,
    "op5_language_id": op5_language_id,
    "op6_packing": op6_packing,
    "op7_page_text": op7_page_text,
    "op8_token_files": op8_token_files,
    "op9_quality_rules": op9_quality_rules,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

def _cluster_sql(clusters: int, rounds: int) -> str:
    """Each round as two common table expressions: vectors with their nearest centroid, and the centroids after it."""
    nearest = """
        a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM (
          SELECT vec_id, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - w[i]) * (v[i] - w[i]))) AS d FROM vectors, c{r}) GROUP BY vec_id)"""
    moved = """
        m{r} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS w FROM (
          SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY cluster, i) GROUP BY cluster),
        c{next} AS MATERIALIZED (SELECT c, coalesce(m{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN m{r} ON c = cluster)"""
    steps = ",".join(nearest.format(r=r) + "," + moved.format(r=r, next=r + 1) for r in range(rounds))
    return f"""
        WITH vectors AS MATERIALIZED (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
          WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
        c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INTEGER AS c, v AS w FROM vectors
                            ORDER BY sha256('2:' || vec_id) LIMIT {clusters}),
        {steps},{nearest.format(r=rounds)},
        t AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY cluster)
        SELECT vec_id, cluster, distance, cluster_inertia, (SELECT sum(distance)::BIGINT FROM a{rounds}) AS inertia,
               sha256(array_to_string(w, ',')) AS centroid_sha256
        FROM a{rounds} JOIN t USING (cluster) JOIN c{rounds} ON c = cluster"""


ORACLE: dict[str, str] = {
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to, true AS valid
        FROM d LEFT JOIN f USING (payload_digest)""",
    "op10_repeated_passages": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k FROM w, unnest(range(1, len(ws) - 18)) AS t(i)),
        placed AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS place FROM windows),
        covered AS (SELECT DISTINCT doc_id, i + j AS spot FROM placed, unnest(range(20)) AS t(j) WHERE place > 1),
        words AS (SELECT doc_id, spot, ws[spot] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(spot)),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY spot) AS said FROM words ANTI JOIN covered USING (doc_id, spot) GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op11_fill_in_middle": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS body, sha256('7:' || doc_id) AS h FROM documents),
        u AS (SELECT *, regexp_extract_all(body, '[^\n]*\n|[^\n]+') AS units,
                     CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
        c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
                     greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
        f AS (SELECT *, array_to_string(units[1:a], '') AS head, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS tail,
                     CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') THEN 'plain'
                          WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(head) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || middle
                                WHEN 'spm' THEN '<S>' || tail || '<P>' || head || '<M>' || middle ELSE body END) AS output_sha256,
               sha256(body) AS restored_sha256
        FROM f""",
    "op12_centroid_clusters": _cluster_sql(clusters=40, rounds=5),
}
