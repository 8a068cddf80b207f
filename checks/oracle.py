"""DuckDB SQL for the registered queries, written against the driver's tables."""

from __future__ import annotations

CAPTURED = "'2026-01-01T00:00:00Z'"

HITS = """
hits AS (
  SELECT substr(sha256(concat_ws('|', theme, query, search_order, search_published_after, search_published_before)), 1, 20)
           AS search_id, * FROM (
    SELECT l_returnflag AS theme,
           l_returnflag || '-' || l_linenumber AS query,
           CASE WHEN l_linestatus = 'O' THEN 'relevance' ELSE 'date' END AS search_order,
           strftime(DATE '1995-01-01' + CAST(30 * win AS INTEGER), '%Y-%m-%dT00:00:00Z') AS search_published_after,
           strftime(DATE '1995-01-01' + CAST(30 * win + 30 AS INTEGER), '%Y-%m-%dT00:00:00Z') AS search_published_before,
           CAST(CASE WHEN l_tax > 0.04 THEN 2 ELSE 1 END AS BIGINT) AS page_number,
           CAST(l_quantity AS BIGINT) + CASE WHEN l_tax > 0.04 THEN 50 ELSE 0 END AS result_position,
           CAST(l_partkey AS VARCHAR) AS video_id,
           CAST(l_suppkey AS VARCHAR) AS channel_id,
           strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS published,
           strftime(l_shipdate, '%Y%m%d') AS run_id,
           l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM (SELECT *, floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 30) AS win FROM lineitem)
  )
)"""

SEQ = "run_id, l_orderkey, l_linenumber, l_partkey, l_suppkey"
SEQ_DESC = ", ".join(f"{c} DESC" for c in SEQ.split(", "))

VIDEOS = """
videos AS (
  SELECT CAST(p_partkey AS VARCHAR) AS video_id, CAST(p_size AS VARCHAR) AS channel_id, p_brand AS channel_title, p_name AS title,
         p_type || ' ' || p_name AS description,
         strftime(DATE '2020-01-01' + p_size, '%Y-%m-%dT00:00:00Z') AS published_at,
         CAST(p_size * 60 + floor(p_retailprice / 100) AS BIGINT) AS duration_seconds,
         CAST(floor(p_retailprice) AS BIGINT) AS view_count,
         'https://www.youtube.com/watch?v=' || p_partkey AS video_url, p_type
  FROM part
)"""

BEST = f"""
best AS (
  SELECT query, video_id, result_position, row_number() OVER (
           PARTITION BY query ORDER BY result_position, {SEQ}) AS place
  FROM (SELECT *, row_number() OVER (PARTITION BY query, video_id ORDER BY result_position, {SEQ}) AS rn FROM hits)
  WHERE rn = 1
), sample AS (SELECT query, video_id, result_position FROM best WHERE place <= 20)"""


def lines(source: str, columns: str, name: str = "lines") -> str:
    """A CTE with one row per text line: ``pos`` and ``line``."""
    return f"""
{name} AS (
  SELECT {columns}, i AS pos, parts[i + 1] AS line
  FROM (SELECT *, string_split(text, chr(10)) AS parts FROM {source}), unnest(range(len(parts))) AS t(i)
)"""


DOC_LINES = lines("documents", "doc_id, lang, source, n_chars")


def squash(text: str) -> str:
    return rf"nullif(trim(regexp_replace({text}, '\s+', ' ', 'g')), '')"


FLAT_SEARCH = f"""
tagged AS (
  SELECT d.*, CASE WHEN toxic = 1 AND quality = 0 THEN 'quota' WHEN toxic = 1 THEN 'other' END AS error
  FROM documents d LEFT JOIN labels l USING (doc_id)
), cuts AS (SELECT source, min(doc_id) AS cut FROM tagged WHERE error = 'quota' GROUP BY source),
kept AS (
  SELECT t.* FROM tagged t LEFT JOIN cuts c ON t.source = c.source
  WHERE error IS NULL AND (cut IS NULL OR doc_id < cut)
), {lines("kept", "doc_id, lang, source")}, items AS (
  SELECT *, regexp_extract(line, '[A-Za-z]{{10,}}') AS video_id FROM lines
), flat AS (
  SELECT substr(sha256(lang || '|' || source || '|relevance||'), 1, 20) AS search_id,
         lang AS theme, source AS query, 'relevance' AS search_order,
         CAST(NULL AS VARCHAR) AS search_published_after, CAST(NULL AS VARCHAR) AS search_published_before,
         doc_id AS page_number,
         row_number() OVER (PARTITION BY lang, source ORDER BY doc_id, pos) AS result_position,
         video_id, source AS channel_id, line AS search_title,
         CAST(NULL AS VARCHAR) AS search_description, '2024-01-01T00:00:00Z' AS search_published_at,
         CASE WHEN lang <> 'de' THEN 'http://m/' || doc_id END AS thumbnail_url,
         {CAPTURED} AS captured_at
  FROM items WHERE video_id <> ''
)"""

VIDEO_ROWS = f"""
rows AS (
  SELECT CAST(p_partkey AS VARCHAR) AS video_id, CAST(p_size AS VARCHAR) AS channel_id, p_brand AS channel_title,
         p_name AS title, p_type || ' ' || p_name AS description,
         strftime(DATE '2020-01-01' + p_size, '%Y-%m-%dT00:00:00Z') AS published_at,
         CASE WHEN p_size > 40 THEN '[]' ELSE '["' || p_type || '","' || p_brand || '"]' END AS tags,
         CAST(p_size AS VARCHAR) AS category_id, 'pt' AS default_language,
         CAST(NULL AS VARCHAR) AS default_audio_language, 'none' AS live_broadcast_content,
         CASE WHEN p_type = 'PROMO' THEN NULL
              WHEN p_size <= 25 THEN 'http://i/' || p_partkey || '/max.jpg'
              WHEN p_size <= 45 THEN 'http://i/' || p_partkey || '/std.jpg'
              ELSE 'http://i/' || p_partkey || '/high.jpg' END AS thumbnail_url,
         CASE p_type WHEN 'ECONOMY' THEN 'P' || p_size || 'DT2H' WHEN 'SMALL' THEN 'P' || p_size || 'W'
              WHEN 'LARGE' THEN 'PT' || CAST(p_retailprice AS VARCHAR) || 'S' WHEN 'MEDIUM' THEN 'P'
              ELSE 'PT' || p_size || 'M' || CAST(floor(p_retailprice / 100) AS INTEGER) || 'S' END AS duration_iso8601,
         CASE p_type WHEN 'ECONOMY' THEN p_size * 86400 + 7200 WHEN 'SMALL' THEN NULL WHEN 'LARGE' THEN NULL WHEN 'MEDIUM' THEN 0
              ELSE p_size * 60 + CAST(floor(p_retailprice / 100) AS BIGINT) END AS duration_seconds,
         '2d' AS dimension, 'hd' AS definition, CASE WHEN p_size > 10 THEN 'true' ELSE 'false' END AS caption,
         p_size > 20 AS licensed_content, 'rectangular' AS projection,
         CAST(floor(p_retailprice) AS BIGINT) AS view_count,
         CAST(CASE WHEN p_size < 15 THEN 1000 + p_size + 10 END AS BIGINT) AS like_count,
         CAST(CASE WHEN p_size > 30 THEN NULL ELSE p_size END AS BIGINT) AS comment_count,
         'public' AS privacy_status, p_size > 30 AS made_for_kids, CAST(NULL AS BOOLEAN) AS self_declared_made_for_kids,
         '["' || p_type || '"]' AS topic_categories,
         'https://www.youtube.com/watch?v=' || p_partkey AS video_url, {CAPTURED} AS captured_at
  FROM part
  UNION ALL BY NAME
  SELECT 'x' || p_partkey AS video_id, '[]' AS tags, '[]' AS topic_categories,
         'https://www.youtube.com/watch?v=x' || p_partkey AS video_url, {CAPTURED} AS captured_at
  FROM part
)"""

COMMENTS = f"""
{DOC_LINES}, cut AS (
  SELECT *, string_split(line, ', ') AS pieces FROM lines
), tops AS (
  SELECT doc_id || '-' || pos AS comment_id, 'v' || (doc_id // 4) AS video_id, 't' || doc_id || '-' || pos AS thread_id,
         CAST(NULL AS VARCHAR) AS parent_comment_id, false AS is_reply, source AS author_name, lang AS author_channel_id,
         line AS text, CASE WHEN lang = 'de' THEN NULL ELSE length(line) END AS like_count,
         len(pieces) - 1 AS total_reply_count, doc_id, pos, -1 AS k
  FROM cut
), answers AS (
  SELECT doc_id || '-' || pos || '.' || (j - 1) AS comment_id, 'v' || (doc_id // 4) AS video_id,
         't' || doc_id || '-' || pos AS thread_id, doc_id || '-' || pos AS parent_comment_id, true AS is_reply,
         source AS author_name, CAST(NULL AS VARCHAR) AS author_channel_id, pieces[j + 1] AS text,
         CASE WHEN j <= 3 THEN j - 1 ELSE j - 4 END AS like_count, CAST(NULL AS BIGINT) AS total_reply_count, doc_id, pos, j - 1 AS k
  FROM cut, unnest(range(1, len(pieces))) AS t(j)
), both_kinds AS (SELECT * FROM tops UNION ALL SELECT * FROM answers)"""

STATUSES = """
counted AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id),
statuses AS (
  SELECT CAST(user_id AS VARCHAR) AS video_id,
         CASE event_type WHEN 'click' THEN 'comments_disabled' WHEN 'signup' THEN 'video_not_found'
              WHEN 'purchase' THEN 'quota_exceeded' WHEN 'error' THEN 'error'
              ELSE CASE WHEN coalesce(n, 0) > 0 THEN 'completed' ELSE 'no_comments' END END AS status,
         coalesce(n, 0) AS rows_collected,
         CASE WHEN event_type <> 'view' THEN 'HttpError' END AS error_type,
         CASE event_type WHEN 'click' THEN 'HttpError 403: CommentsDisabled for this video'
              WHEN 'signup' THEN 'HttpError 404: videoNotFound' WHEN 'purchase' THEN 'HttpError 403: quotaExceeded'
              WHEN 'error' THEN 'HttpError 500: backendError' END AS error_message,
         strftime(ts, '%Y%m%d') AS run_id, event_id AS attempt
  FROM events LEFT JOIN counted ON conv_id = user_id
), latest_status AS (
  SELECT * FROM statuses QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY run_id DESC, attempt DESC) = 1
)"""

TRANSCRIPTS = """
transcripts AS (
  SELECT 'd' || doc_id AS video_id, CASE WHEN quality = 1 THEN 'success' ELSE 'failed' END AS transcript_status,
         CASE WHEN quality = 1 THEN source ELSE 'failed' END AS transcript_method,
         CASE WHEN quality = 1 THEN lang END AS transcript_language,
         CASE WHEN quality = 1 THEN text END AS transcript_text, doc_id
  FROM (SELECT d.*, coalesce(l.quality, 1) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        WHERE l.quality IS NOT NULL OR lang <> 'es')
)"""

CASCADE = f"""
resolved AS (
  SELECT 'd' || d.doc_id AS video_id, d.doc_id, lang, n_chars, text, quality,
         coalesce(quality, 0) = 1 AS by_track,
         lang IN ('en', 'de') AS by_file,
         n_chars >= 1000 AS by_speech
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
), decided AS (
  SELECT *, CASE WHEN by_track THEN CASE WHEN lang = 'es' THEN 'youtube_transcript_api_any_language'
                                         WHEN n_chars % 2 = 1 THEN 'youtube_transcript_api_generated'
                                         ELSE 'youtube_transcript_api_manual' END
                 WHEN by_file THEN 'yt_dlp_subtitle' WHEN by_speech THEN 'faster_whisper_small' ELSE 'failed' END AS method
  FROM resolved
)"""

EXPANSION = f"""
{lines("conversations", "conv_id, turn", "said")}, found AS (
  SELECT 'src' || (conv_id // 5) AS channel_id, regexp_extract(line, '[A-Za-z]{{5,}}') AS video_id, conv_id, turn, pos FROM said
), hits AS (SELECT * FROM found WHERE video_id <> ''),
chosen AS (
  SELECT channel_id FROM (SELECT channel_id, min((conv_id, turn, pos)) AS first FROM hits GROUP BY channel_id) ORDER BY first LIMIT 10
), channels AS (
  SELECT 'src' || s_suppkey AS channel_id, s_name AS channel_title, 'UU' || s_suppkey AS uploads_playlist_id
  FROM supplier WHERE s_acctbal >= 0 AND 'src' || s_suppkey IN (SELECT channel_id FROM chosen)
), {DOC_LINES}, playlist AS (
  SELECT source AS channel_id, doc_id AS page_number, pos + 1 AS position_in_page,
         regexp_extract(line, '[A-Za-z]{{5,}}') AS video_id, line AS title, CAST(NULL AS VARCHAR) AS description,
         strftime(DATE '2024-01-01' + CAST(n_chars // 10 AS INTEGER), '%Y-%m-%d') ||
           CASE WHEN lang = 'fr' THEN 'T08:00:00Z' ELSE 'T09:00:00Z' END AS published_at
  FROM lines
), uploads AS (SELECT * FROM playlist WHERE video_id <> ''),
expansion AS (
  SELECT u.channel_id, channel_title, uploads_playlist_id, page_number, position_in_page, video_id, title, description, published_at,
         video_id IN (SELECT video_id FROM hits) AS already_in_search,
         video_id NOT IN (SELECT video_id FROM hits) AS new_vs_search,
         '' AS relevance_label, '' AS relevance_reason
  FROM uploads u JOIN channels c ON u.channel_id = c.channel_id
  WHERE substr(published_at, 1, 10) BETWEEN '2024-03-01' AND '2024-12-31'
  QUALIFY row_number() OVER (PARTITION BY u.channel_id, video_id ORDER BY page_number, position_in_page) = 1
)"""

GRID = """
themes AS (SELECT DISTINCT p_type AS theme, p_name, p_brand FROM part),
grid AS (
  SELECT theme, query, search_order, published_after, published_before,
         substr(sha256(concat_ws('|', theme, query, search_order, published_after, published_before)), 1, 20) AS search_id
  FROM (SELECT theme, unnest(list_distinct([trim(p_name), p_brand])) AS query FROM themes),
       (VALUES ('relevance'), ('viewCount')) AS o(search_order),
       (VALUES ('2026-01-01T00:00:00Z', '2026-01-31T00:00:00Z'), ('2026-01-31T00:00:00Z', '2026-03-02T00:00:00Z'),
               ('2026-03-02T00:00:00Z', '2026-03-17T00:00:00Z')) AS w(published_after, published_before)
)"""

LATEST_HITS = "SELECT {columns} FROM hits QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY " + SEQ_DESC + ") = 1"

ORACLE: dict[str, str] = {
    "discovery_review": f"""WITH {HITS}, {VIDEOS}, {BEST}
        SELECT s.query, s.result_position, s.video_id, channel_title, title, description, published_at, duration_seconds,
               view_count, video_url, '' AS relevance_label, '' AS relevance_reason
        FROM sample s LEFT JOIN videos v ON s.video_id = v.video_id""",
    "review_counts": f"""WITH {HITS}, {BEST} SELECT query, count(video_id) AS n_videos FROM sample GROUP BY query""",
    "channel_expansion": f"WITH {EXPANSION} SELECT * FROM expansion",
    "expansion_counts": f"""WITH {EXPANSION}
        SELECT count(*) AS candidates, count(*) FILTER (already_in_search) AS already_found,
               count(*) FILTER (new_vs_search) AS new_videos FROM expansion""",
    "search_grid": f"WITH {GRID} SELECT * FROM grid",
    "plan_requests_json": f"""WITH {GRID}
        SELECT search_id, '{{"part":"snippet","q":"' || query || '","type":"video","maxResults":50,"order":"' || search_order ||
               '","publishedAfter":"' || published_after || '","publishedBefore":"' || published_before ||
               '","relevanceLanguage":"pt"}}' AS request FROM grid""",
    "stable_ids": f"WITH {HITS} SELECT search_id, query, count(*) AS n_hits FROM hits GROUP BY search_id, query",
    "upsert_hits": f"WITH {HITS} " + LATEST_HITS.format(
        columns="search_id, video_id, result_position, page_number, channel_id, published AS captured_at",
        keys="search_id, video_id, result_position"),
    "upsert_by_query_and_video": f"WITH {HITS} " + LATEST_HITS.format(
        columns="query, video_id, result_position, channel_id, published AS captured_at", keys="query, video_id"),
    "upsert_missing_columns": f"""WITH {VIDEOS}
        SELECT video_id, CASE WHEN p_type = 'PROMO' THEN upper(title) ELSE title END AS title,
               CASE WHEN p_type <> 'PROMO' THEN view_count END AS view_count,
               CASE WHEN p_type = 'PROMO' THEN duration_seconds END AS duration_seconds FROM videos""",
    "discovered_videos": f"""WITH {HITS}
        SELECT video_id, run_id AS first_run, l_orderkey AS first_order FROM hits
        QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY {SEQ}) = 1""",
    "pending_videos": f"""WITH {HITS}, {VIDEOS}
        SELECT DISTINCT video_id FROM hits WHERE video_id NOT IN (SELECT video_id FROM videos WHERE p_type <> 'PROMO')""",
    "pending_channels": """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS channel_id FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
    "pending_transcripts": f"""WITH {TRANSCRIPTS}
        SELECT 'd' || doc_id AS video_id FROM documents
        WHERE 'd' || doc_id NOT IN (SELECT video_id FROM transcripts WHERE transcript_status = 'success')""",
    "pending_comments": f"""WITH {STATUSES} SELECT video_id FROM latest_status
        WHERE status NOT IN ('completed', 'no_comments', 'comments_disabled', 'video_not_found')""",
    "refresh_transcripts": f"""WITH {TRANSCRIPTS}
        SELECT 'd' || d.doc_id AS video_id, transcript_status, transcript_method, transcript_language, transcript_text
        FROM documents d LEFT JOIN transcripts t ON t.doc_id = d.doc_id""",
    "id_batches": f"""WITH {HITS}, seen AS (
          SELECT video_id, min(({SEQ})) AS first FROM hits GROUP BY video_id),
        placed AS (SELECT video_id, row_number() OVER (ORDER BY first) - 1 AS place FROM seen)
        SELECT place // 50 AS batch, count(*) AS n_ids, string_agg(video_id, ',' ORDER BY place) AS ids
        FROM placed GROUP BY place // 50""",
    "flatten_search_pages": f"WITH {FLAT_SEARCH} SELECT * FROM flat",
    "flatten_videos": f"WITH {VIDEO_ROWS} SELECT * FROM rows",
    "flatten_channels": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS channel_id, s_name AS channel_title, CAST(NULL AS VARCHAR) AS channel_description,
               CAST(NULL AS VARCHAR) AS channel_published_at, n_name AS country, '@' || s_name AS custom_url,
               CASE WHEN s_acctbal < 0 THEN 'http://d/' ELSE 'http://h/' END || s_suppkey AS thumbnail_url,
               CAST(floor(abs(s_acctbal)) AS BIGINT) AS subscriber_count, s_acctbal < 0 AS hidden_subscriber_count,
               CAST(NULL AS BIGINT) AS channel_view_count, CAST(s_nationkey AS BIGINT) AS video_count,
               CASE WHEN s_acctbal >= 0 THEN 'UU' || s_suppkey END AS uploads_playlist_id, 'public' AS privacy_status,
               false AS made_for_kids, '[]' AS topic_categories,
               'https://www.youtube.com/channel/' || s_suppkey AS channel_url, {CAPTURED} AS captured_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "flatten_playlists": f"WITH {EXPANSION} SELECT * FROM uploads",
    "comment_threads_capped": f"""WITH {COMMENTS}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY doc_id, pos, k) AS place FROM both_kinds)
        SELECT comment_id, video_id, thread_id, parent_comment_id, is_reply, author_name, author_channel_id,
               CAST(NULL AS VARCHAR) AS author_channel_url, text, like_count, CAST(NULL AS VARCHAR) AS published_at,
               CAST(NULL AS VARCHAR) AS updated_at, total_reply_count, {CAPTURED} AS captured_at
        FROM ranked WHERE place <= 20""",
    "comment_threads_all": f"""WITH {COMMENTS}
        SELECT video_id, count(*) AS n_comments, count(*) FILTER (is_reply) AS n_replies,
               CAST(sum(total_reply_count) AS BIGINT) AS announced_replies, CAST(sum(length(text)) AS BIGINT) AS n_chars
        FROM both_kinds GROUP BY video_id""",
    "comment_status": f"WITH {STATUSES} SELECT *, {CAPTURED} AS captured_at FROM statuses",
    "quota_cut": f"""WITH {STATUSES}, cuts AS (
          SELECT run_id, min(attempt) AS cut FROM statuses WHERE status = 'quota_exceeded' GROUP BY run_id)
        SELECT s.run_id, attempt, video_id, status FROM statuses s LEFT JOIN cuts c ON s.run_id = c.run_id
        WHERE cut IS NULL OR attempt <= cut""",
    "pick_caption": """SELECT video_id, language, is_generated, list_pos, method FROM (
          SELECT 'v' || (doc_id // 4) AS video_id, lang AS language, n_chars % 2 = 1 AS is_generated, doc_id AS list_pos,
                 CASE WHEN lang IN ('es', 'fr') AND n_chars % 2 = 0 THEN 'youtube_transcript_api_manual'
                      WHEN lang IN ('es', 'fr') THEN 'youtube_transcript_api_generated'
                      ELSE 'youtube_transcript_api_any_language' END AS method
          FROM documents)
        QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY
          CASE method WHEN 'youtube_transcript_api_manual' THEN 1 WHEN 'youtube_transcript_api_generated' THEN 2
                      ELSE CASE WHEN is_generated THEN 4 ELSE 3 END END,
          CASE language WHEN 'es' THEN 1 WHEN 'fr' THEN 2 ELSE 0 END, list_pos) = 1""",
    "assemble_transcripts": f"""WITH {DOC_LINES}
        SELECT doc_id, {squash("string_agg(line, ' ' ORDER BY pos)")} AS transcript_text
        FROM lines GROUP BY doc_id""",
    "caption_segments": f"""WITH {DOC_LINES}
        SELECT 'v' || (doc_id // 4) AS video_id, 2 * pos AS segment_index, CAST(2 * pos AS DOUBLE) AS start_seconds,
               CAST(2 AS DOUBLE) AS duration_seconds, line AS text, lang || '-' || doc_id AS source_method
        FROM lines WHERE line <> ''""",
    "cleaned_documents": f"SELECT doc_id, {squash('text')} AS cleaned FROM documents",
    "parse_subtitles": f"""SELECT 'd' || doc_id AS video_id, 'd' || doc_id || '.' || lang || '.vtt' AS file_name, lang AS language,
               {squash('text')} AS text FROM documents""",
    "parse_json3": f"""SELECT 'c' || conv_id || '-' || turn AS video_id, 'c' || conv_id || '-' || turn || '.en.json3' AS file_name,
               'en' AS language, {squash('text')} AS text FROM conversations""",
    "cascade_transcripts": f"""WITH {CASCADE}
        SELECT video_id, CASE WHEN method = 'failed' THEN 'failed' ELSE 'success' END AS transcript_status,
               method AS transcript_method, CASE WHEN method <> 'failed' THEN lang END AS transcript_language,
               CASE WHEN method <> 'failed' THEN {squash('text')} END AS transcript_text, {CAPTURED} AS transcript_captured_at,
               CASE WHEN method = 'failed' THEN CASE WHEN quality IS NULL AND n_chars < 1000 THEN 'TranscriptsDisabled'
                    WHEN quality IS NULL THEN 'NoMatchingTranscript' ELSE 'EmptyTranscript' END END AS error_captions,
               CASE WHEN method = 'failed' THEN CASE WHEN lang = 'fr' THEN 'EmptySubtitle'
                    WHEN n_chars < 10000 THEN 'HTTPError' ELSE 'YtDlpSubtitleError' END END AS error_subtitles,
               CASE WHEN method = 'failed' THEN CASE WHEN n_chars < 200 THEN 'RuntimeError' ELSE 'AudioDownloadError' END END AS error_speech,
               CASE WHEN method = 'failed' THEN CASE WHEN lang = 'fr' THEN 'Legenda baixada sem texto útil.'
                    WHEN n_chars < 10000 THEN right(text || text || text || text, 4000) ELSE 'Nenhuma legenda encontrada.' END END AS subtitles_message,
               CASE WHEN method = 'failed' THEN CASE WHEN n_chars < 200 THEN 'no audio' ELSE 'Falha ao baixar áudio.' END END AS speech_message,
               CASE WHEN method = 'failed' THEN CASE WHEN quality IS NULL AND n_chars < 1000 THEN right(text, 4000) WHEN quality IS NULL
                    THEN 'Nenhuma legenda disponível nos idiomas [''en'', ''fr'', ''de-DE'', ''de''].'
                    ELSE 'Legenda encontrada sem texto útil.' END END AS captions_message
        FROM decided""",
    "cascade_segments": f"""WITH {CASCADE}, {lines("(SELECT * FROM decided WHERE method NOT IN ('failed', 'yt_dlp_subtitle'))", "video_id, method")}
        SELECT video_id, pos AS segment_index,
               CASE WHEN method = 'faster_whisper_small' THEN CAST(pos AS DOUBLE) ELSE CAST(2 * pos AS DOUBLE) END AS start_seconds,
               CASE WHEN method = 'faster_whisper_small' THEN 0.5::DOUBLE ELSE 2::DOUBLE END AS duration_seconds,
               CASE WHEN method = 'faster_whisper_small' THEN {squash('line')} ELSE line END AS text, method AS source_method
        FROM lines WHERE CASE WHEN method = 'faster_whisper_small' THEN {squash('line')} IS NOT NULL ELSE line <> '' END""",
    "transcript_preview": f"""WITH {TRANSCRIPTS}, n AS (SELECT doc_id, len(string_split(text, chr(10))) AS c FROM documents)
        SELECT video_id, transcript_status, transcript_method, transcript_language, left(transcript_text, 1000) AS transcript_preview,
               length(transcript_text) AS text_length, c AS segment_count FROM transcripts JOIN n USING (doc_id)""",
    "discovery_metrics": """SELECT count(*) FILTER (l_shipdate >= DATE '1999-01-01') AS new_rows, count(*) AS total_rows,
               count(DISTINCT l_partkey) AS unique_videos FROM lineitem""",
    "stage_metrics": f"""WITH {TRANSCRIPTS}
        SELECT (SELECT count(*) FROM documents) - count(*) FILTER (transcript_status = 'success') AS requested,
               count(*) AS new_rows, count(*) FILTER (transcript_status = 'success') AS successes,
               count(*) FILTER (transcript_status = 'failed') AS failures, count(*) AS total_rows,
               count(DISTINCT transcript_method) AS n_methods FROM transcripts""",
    "method_histogram": f"""WITH {TRANSCRIPTS}
        SELECT transcript_method, count(*) AS n_rows FROM documents LEFT JOIN transcripts USING (doc_id) GROUP BY transcript_method""",
    "strategy_coverage": """SELECT l_returnflag || '-' || l_linenumber AS query, count(*) AS n_hits,
               count(DISTINCT l_partkey) AS n_videos, count(DISTINCT l_suppkey) AS n_channels FROM lineitem GROUP BY 1""",
    "strategy_overlap": f"""WITH {HITS}, pairs AS (SELECT DISTINCT query, video_id FROM hits),
        finders AS (SELECT video_id, count(*) AS f FROM pairs GROUP BY video_id)
        SELECT query, count(*) AS n_videos, count(*) FILTER (f = 1) AS exclusive_videos, count(*) FILTER (f > 1) AS shared_videos,
               CAST(sum(f) AS BIGINT) AS finder_total, count(*) FILTER (f = 1) / count(*) AS exclusive_share
        FROM pairs JOIN finders USING (video_id) GROUP BY query""",
    "overlap_with_baseline": f"""WITH {HITS}, pairs AS (SELECT DISTINCT query, video_id FROM hits),
        base AS (SELECT video_id FROM pairs WHERE query = 'A-1'), counted AS (
          SELECT query, count(*) AS n_videos, count(*) FILTER (video_id IN (SELECT video_id FROM base)) AS shared_videos,
                 (SELECT count(*) FROM base) AS baseline_videos
          FROM pairs WHERE query <> 'A-1' GROUP BY query)
        SELECT *, shared_videos / (n_videos + baseline_videos - shared_videos) AS jaccard FROM counted""",
    "corpus_profile": f"""WITH {TRANSCRIPTS}
        SELECT 'hits' AS measure, CAST((SELECT count(*) FROM lineitem) AS DOUBLE) AS value
        UNION ALL SELECT 'videos', (SELECT count(*) FROM part)
        UNION ALL SELECT 'channels', (SELECT count(*) FROM supplier)
        UNION ALL SELECT 'comments', (SELECT count(*) FROM conversations)
        UNION ALL SELECT 'transcripts', (SELECT count(*) FROM transcripts)
        UNION ALL SELECT 'hit_videos_without_details', (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
        UNION ALL SELECT 'hit_channels_without_details', (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier))
        UNION ALL SELECT 'video_channels_without_details', (SELECT count(DISTINCT p_size) FROM part WHERE p_size NOT IN (SELECT s_suppkey FROM supplier))
        UNION ALL SELECT 'comment_videos_without_details', (SELECT count(DISTINCT conv_id) FROM conversations WHERE conv_id NOT IN (SELECT p_partkey FROM part))
        UNION ALL SELECT 'transcript_success_rate', (SELECT avg(CASE WHEN transcript_status = 'success' THEN 1 ELSE 0 END) FROM transcripts)""",
    "study_manifest": f"""WITH {HITS}, {STATUSES}, {TRANSCRIPTS}, found AS (
          SELECT query, video_id, count(*) AS n, min(published) AS a, max(published) AS b FROM hits GROUP BY query, video_id)
        SELECT query, CAST(sum(n) AS BIGINT) AS n_hits, count(f.video_id) AS n_videos, min(a) AS first_published, max(b) AS last_published,
               count(p_partkey) AS videos_recovered,
               count(*) FILTER (transcript_status = 'success') AS transcripts_ok,
               count(*) FILTER (transcript_status = 'failed') AS transcripts_failed,
               count(*) FILTER (status = 'quota_exceeded') AS quota_failures,
               count(*) FILTER (status = 'error') AS other_failures,
               count(p_partkey) / count(f.video_id) AS recovery_rate
        FROM found f LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = f.video_id
        LEFT JOIN transcripts t ON CAST(t.doc_id AS VARCHAR) = f.video_id
        LEFT JOIN latest_status s ON s.video_id = f.video_id
        GROUP BY query""",
    "csv_roundtrip": f"WITH {VIDEO_ROWS} SELECT * FROM rows",
    "ingest_stream": f"WITH {FLAT_SEARCH} SELECT * FROM flat",
}
ORACLE["upsert_into_settled"] = ORACLE["upsert_by_query_and_video"]

LANDED = f"""
{FLAT_SEARCH}, wanted AS (SELECT DISTINCT video_id FROM flat),
{lines("documents", "doc_id, lang, source", "every_line")}, worded AS (
  SELECT *, regexp_extract(line, '[A-Za-z]{{10,}}') AS video_id FROM every_line
), details AS (
  SELECT w.* FROM worded w JOIN wanted USING (video_id)
), stored AS (
  SELECT * FROM details QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY doc_id DESC, pos DESC) = 1
), caption AS (
  SELECT video_id, lang, line FROM details WHERE lang IN ('en', 'fr')
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY CASE lang WHEN 'en' THEN 0 ELSE 1 END, doc_id, pos) = 1
)"""

ORACLE["study_run"] = f"""WITH {LANDED}
    SELECT (SELECT count(*) FROM flat) AS new_hits, (SELECT count(*) FROM wanted) AS unique_videos,
           (SELECT count(*) FROM wanted) AS videos_requested, (SELECT count(*) FROM stored) AS videos_total,
           (SELECT count(DISTINCT source) FROM stored) AS channels_requested,
           (SELECT count(*) FROM supplier WHERE 'src' || s_suppkey IN (SELECT source FROM stored)) AS channels_total,
           (SELECT count(*) FROM stored) AS transcripts_requested, (SELECT count(*) FROM caption) AS successes,
           (SELECT count(*) FROM stored) - (SELECT count(*) FROM caption) AS failures,
           (SELECT count(*) FROM stored) AS comments_requested,
           (SELECT CAST(sum(least(n, 500)) AS BIGINT) FROM (SELECT count(*) AS n FROM details GROUP BY video_id)) AS comments_total"""
ORACLE["study_run_videos"] = f"""WITH {LANDED}
    SELECT s.video_id, source AS channel_id, s.line AS title, 'https://www.youtube.com/watch?v=' || s.video_id AS video_url,
           CASE WHEN c.line IS NULL THEN 'failed' ELSE 'success' END AS transcript_status,
           CASE WHEN c.line IS NULL THEN 'failed' WHEN c.lang = 'en' THEN 'youtube_transcript_api_manual'
                ELSE 'youtube_transcript_api_any_language' END AS transcript_method,
           c.lang AS transcript_language, {squash("c.line")} AS transcript_text, {CAPTURED} AS captured_at
    FROM stored s LEFT JOIN caption c ON s.video_id = c.video_id"""

FLAWED = f"""
{DOC_LINES}, page AS (
  SELECT d.doc_id, d.doc_id // 8 AS v, d.doc_id // 100 * 2 + d.doc_id // 4 % 2 AS run, d.doc_id // 2 AS pg,
         CASE WHEN toxic = 1 AND quality = 0 THEN 'HttpError 403 quotaExceeded'
              WHEN toxic = 1 THEN 'HttpError 403 commentsDisabled' END AS error
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
), lost AS (
  SELECT * FROM page p WHERE error IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM page o WHERE o.run = p.run AND o.v = p.v AND o.pg = p.pg AND o.error IS NULL AND o.doc_id > p.doc_id)
), stops AS (SELECT run, v, min(pg) AS stop FROM lost GROUP BY run, v),
healthy AS (
  SELECT l.*, string_split(line, ', ') AS pieces, v, run, pg FROM lines l JOIN page p ON l.doc_id = p.doc_id WHERE error IS NULL
), cut AS (
  SELECT h.* FROM healthy h LEFT JOIN stops s ON h.run = s.run AND h.v = s.v WHERE stop IS NULL OR pg < stop
), broken AS (SELECT run, v, min((pg, pos, doc_id)) AS place FROM cut WHERE len(pieces) >= 20 GROUP BY run, v),
placed AS (SELECT c.*, (pg, pos, doc_id) AS here, place FROM cut c LEFT JOIN broken b ON c.run = b.run AND c.v = b.v),
said AS (
  SELECT doc_id, pos, pg, v, run, doc_id || '-' || pos AS comment_id, CAST(NULL AS VARCHAR) AS parent_comment_id, false AS is_reply, line AS text, -1 AS k
  FROM placed WHERE place IS NULL OR here <= place
  UNION ALL
  SELECT doc_id, pos, pg, v, run, doc_id || '-' || pos || '.' || (j - 1), doc_id || '-' || pos, true, pieces[j + 1], j - 1
  FROM placed, unnest(range(1, len(pieces))) AS t(j) WHERE place IS NULL OR here < place
), kept AS (
  SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY run, v ORDER BY pg, pos, doc_id, k) <= 500
)"""
RUN = "'r' || lpad(CAST(run AS VARCHAR), 12, '0')"

ORACLE["comments_until_failure"] = f"""WITH {FLAWED}
    SELECT {RUN} AS run_id, comment_id, 'v' || v AS video_id, 't' || doc_id || '-' || pos AS thread_id, parent_comment_id, is_reply, text FROM kept"""
ORACLE["comment_run_outcomes"] = f"""WITH {FLAWED}, errors AS (
      SELECT run, v, arg_min(error, doc_id) AS error FROM (
        SELECT run, v, doc_id, error FROM lost
        UNION ALL SELECT run, v, doc_id, 'HttpError 500 backendError' FROM healthy WHERE len(pieces) >= 20) GROUP BY run, v),
    attempted AS (SELECT run, v, min(doc_id) AS seq FROM page GROUP BY run, v),
    n AS (SELECT run, v, count(*) AS c FROM kept GROUP BY run, v),
    outcome AS (
      SELECT a.v, a.run, seq, coalesce(c, 0) AS rows_collected, error,
             CASE WHEN error LIKE '%quota%' THEN 'quota_exceeded' WHEN error LIKE '%Disabled%' THEN 'comments_disabled'
                  WHEN error IS NOT NULL THEN 'error' WHEN coalesce(c, 0) > 0 THEN 'completed' ELSE 'no_comments' END AS status
      FROM attempted a LEFT JOIN errors e ON a.v = e.v AND a.run = e.run LEFT JOIN n ON a.v = n.v AND a.run = n.run),
    ends AS (SELECT run, min(seq) AS last FROM outcome WHERE status = 'quota_exceeded' GROUP BY run)
    SELECT {RUN.replace("run AS", "o.run AS")} AS run_id, 'v' || v AS video_id, status, rows_collected, CASE WHEN error IS NOT NULL THEN 'HttpError' END AS error_type,
           error AS error_message, {CAPTURED} AS captured_at
    FROM outcome o LEFT JOIN ends ON o.run = ends.run WHERE last IS NULL OR seq <= last"""

ORACLE["page_accounting"] = """SELECT 'r' || year(o_orderdate) AS run_id, count(*) AS pages,
           count(*) FILTER (err IS NULL AND o_orderstatus = 'O') AS pages_read, count(*) FILTER (err IS NULL AND o_orderstatus = 'F') AS pages_empty,
           count(*) FILTER (err = 'quota') AS pages_quota, count(*) FILTER (err = 'other') AS pages_failed,
           count(*) FILTER (err IS NULL AND o_orderstatus = 'P') AS pages_unreadable
    FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'quota' WHEN '5-LOW' THEN 'other' END AS err FROM orders) GROUP BY 1"""
ORACLE["versions_and_reruns"] = """SELECT c_custkey, c_mktsegment, 'r10' AS version, true AS refused FROM customer"""

ORACLE["search_pages_within_depth"] = f"WITH {FLAT_SEARCH} SELECT * FROM flat WHERE page_number <= 500"
ORACLE["csv_cells"] = f"""WITH {VIDEO_ROWS} SELECT video_id, replace(tags, '","', '", "') AS tags_cell,
    '{{"a": ' || coalesce(CAST(view_count AS VARCHAR), 'null') || ', "b": ' || coalesce('"' || title || '"', 'null') || ', "c": ' || replace(tags, '","', '", "') || '}}' AS struct_cell
    FROM rows"""
ORACLE["csv_only_table"] = """SELECT CAST(s_suppkey AS VARCHAR) AS channel_id, s_name AS channel_title, 'r1' AS run_id, s_suppkey AS page, 0 AS pos
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

FIRST = LANDED.replace("documents", "first_docs")
BOTH = LANDED.replace("SELECT DISTINCT video_id FROM flat)", "SELECT video_id FROM flat UNION SELECT video_id FROM before)")
ORACLE["study_run_resumed"] = f"""WITH first_docs AS (SELECT * FROM documents WHERE lang IN ('es', 'fr')),
    earlier AS (WITH {FIRST} SELECT s.video_id, s.source, s.line, c.line AS said FROM stored s LEFT JOIN caption c ON s.video_id = c.video_id),
    before AS (WITH {FIRST} SELECT DISTINCT video_id FROM flat), {BOTH}, both_runs AS (
      SELECT e.video_id, e.source, e.line, coalesce(said, c.line) AS said, '2026-01-01T00:00:00Z' AS captured_at
      FROM earlier e LEFT JOIN caption c ON e.video_id = c.video_id
      UNION ALL
      SELECT s.video_id, s.source, s.line, c.line, '2026-02-01T00:00:00Z'
      FROM stored s LEFT JOIN caption c ON s.video_id = c.video_id WHERE s.video_id NOT IN (SELECT video_id FROM earlier))
    SELECT video_id, source AS channel_id, line AS title, CASE WHEN said IS NULL THEN 'failed' ELSE 'success' END AS transcript_status,
           {squash("said")} AS transcript_text, captured_at FROM both_runs"""
