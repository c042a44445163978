"""The same results in SQL for an independent engine."""

from __future__ import annotations

_MEDIA = """media AS (
  SELECT doc_id, '/input/' || source || '/' || doc_id || '.mp4' AS media_path, source AS subset,
    n_chars * 37 AS size_bytes, CAST(n_chars AS DOUBLE) / 50e0 AS duration_s,
    CASE WHEN doc_id % 14 = 0 THEN 60e0 WHEN doc_id % 3 = 0 THEN 25e0 ELSE 30e0 END AS fps,
    CASE doc_id % 4 WHEN 0 THEN 256 WHEN 1 THEN 640 WHEN 2 THEN 1280 ELSE 1920 END AS width,
    CASE doc_id % 4 WHEN 0 THEN 144 WHEN 1 THEN 360 WHEN 2 THEN 720 ELSE 1080 END AS height,
    n_chars * 8 + (doc_id % 4) * 1000 AS bitrate
  FROM documents)"""

_PROCESSED = """processed AS (
  SELECT '/input/' || d.source || '/' || d.doc_id || '.mp4' AS media_path
  FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels)),
flagged AS (SELECT m.*, m.media_path IN (SELECT media_path FROM processed) AS done FROM media m)"""

_SPANS = """counted AS (
  SELECT *, CASE WHEN duration_s >= 2 THEN CAST(floor((duration_s - 2) / 10) AS BIGINT) + 1 ELSE 0 END AS n_spans FROM media),
spans AS (
  SELECT *, CAST(k AS INTEGER) AS clip_index, k * 10e0 AS start_s, least(k * 10e0 + 10e0, duration_s) AS end_s
  FROM (SELECT *, unnest(range(0, n_spans)) AS k FROM counted))"""

_WINDOWS = """framed AS (SELECT *, CAST(round((end_s - start_s) * fps) AS BIGINT) AS frames FROM spans),
sized AS (
  SELECT *, CASE WHEN frames > 0 THEN greatest(frames // 256 + CASE WHEN frames % 256 >= 128 THEN 1 ELSE 0 END, 1) ELSE 0 END AS n_windows
  FROM framed),
windows AS (
  SELECT *, CAST(w AS INTEGER) AS window_index, CAST(w * 256 AS INTEGER) AS start_frame,
    CAST(CASE WHEN w = n_windows - 1 THEN frames ELSE w * 256 + 256 END AS INTEGER) AS end_frame
  FROM (SELECT *, unnest(range(0, n_windows)) AS w FROM sized))"""

_CAPTIONS = r"""captions AS (
  SELECT doc_id, text AS caption, lang AS subset, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS n_tokens,
    regexp_replace(text, '\s+$', '') AS trimmed FROM documents),
flags AS (
  SELECT *, trimmed = '' AS is_empty, n_tokens >= 256 AS at_cap, right(trimmed, 1) IN ('.', '?', '!') AS has_terminal,
    contains(caption, '###') AS has_heading, contains(caption, 'The video appears') AS has_template,
    regexp_matches(caption, '(?i)\bI cannot\b|\bI can''t\b|\bI am unable\b|\bI''m sorry\b|\bI apologi[sz]e\b') AS has_refusal
  FROM captions)"""

_GATE = """reasons AS (
  SELECT *, array_to_string(list_filter([
    CASE WHEN is_empty THEN 'empty' END, CASE WHEN at_cap THEN 'at_token_cap' END,
    CASE WHEN NOT has_terminal AND NOT is_empty THEN 'no_terminal' END, CASE WHEN has_template THEN 'template' END,
    CASE WHEN has_heading THEN 'heading' END, CASE WHEN has_refusal THEN 'refusal' END], lambda r: r IS NOT NULL), ',') AS why
  FROM flags),
gated AS (SELECT *, why = '' AS accepted FROM reasons)"""

_CLIPS = """turns AS (
  SELECT conv_id || '-' || (turn // 8) AS clip_id, conv_id AS clip_no, CAST(turn % 8 AS INTEGER) AS place,
    CASE WHEN role = 'system' THEN 'system_note' ELSE role || '_caption' END AS caption_key, text
  FROM conversations),
positions AS (SELECT *, CAST(row_number() OVER (PARTITION BY clip_id ORDER BY place) - 1 AS INTEGER) AS window_index FROM turns),
docs AS (
  SELECT clip_id AS span_uuid, clip_no, '/input/' || (clip_no % 20) || '.mp4' AS source_video,
    CAST(clip_no * 10 AS DOUBLE) AS start_s, CAST(clip_no * 10 + 10 AS DOUBLE) AS end_s,
    '/run/clips/' || clip_id || '.mp4' AS clip_location, count(*) AS n_windows, clip_no % 5 <> 0 AS valid,
    bool_and(caption_key <> 'system_note' AND trim(text) <> '') AS all_text,
    CASE clip_no % 3 WHEN 0 THEN 'transcode' WHEN 1 THEN 'caption' ELSE 'write' END AS stage, 'code ' || (clip_no % 7) AS message
  FROM turns GROUP BY clip_id, clip_no),
clip_files AS (SELECT '/run/clips/' || span_uuid || '.mp4' AS path, clip_no * 100 + 7 AS size_bytes FROM docs WHERE clip_no % 10 <> 0)"""

_ITEMS = """items AS (
  SELECT span_uuid AS id, source_video, start_s, end_s, 1280 AS width, 720 AS height, 30e0 AS framerate,
    n_windows AS window_count, valid, '/assets/clips/' || span_uuid || '.mp4' AS video_url,
    '/assets/metas/v0/' || span_uuid || '.json' AS metadata_url
  FROM docs WHERE clip_location IN (SELECT path FROM clip_files))"""

_LISTING = """listing AS (
  SELECT substr(path, 6) AS relative_path, size_bytes FROM clip_files
  UNION ALL SELECT 'metas/v0/' || clip_id || '.json', CAST(sum(length(text)) AS BIGINT) FROM turns GROUP BY clip_id
  UNION ALL SELECT p || n || s, 2 FROM (SELECT DISTINCT clip_no % 20 AS n FROM turns),
    (VALUES ('processed_videos/', '.json'), ('processed_clip_chunks/', '_0.json'), ('logs/run', '')) v(p, s))"""

_STATE = """hours AS (
  SELECT date_trunc('hour', ts) AS ts, event_type AS stage_short, count(*) AS finished, count(DISTINCT user_id) AS actors_ready,
    count(DISTINCT CASE WHEN value >= 50 THEN user_id END) AS actors_running, count(*) FILTER (WHERE value < 20) AS input_queue
  FROM events GROUP BY 1, 2),
state AS (
  SELECT *, CAST(sum(finished) OVER (PARTITION BY stage_short ORDER BY ts) AS BIGINT) AS tasks_completed,
    'Stage 0' || CASE stage_short WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END || ' - ' || stage_short AS stage,
    CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 'main' ELSE 'resume' END AS phase, actors_ready - actors_running AS actors_idle,
    input_queue * 2 AS output_queue, CAST(finished AS DOUBLE) / 3600e0 AS tasks_per_actor_s
  FROM hours)"""

_LINES = """frame AS (
  SELECT DISTINCT ts FROM state),
raw_lines AS (
  SELECT ts, 10 + CAST(substr(stage, 7, 2) AS INTEGER) AS k,
    '│ ' || stage || '  │ 0 │ 0 │ ' || actors_ready || ' │ ' || actors_running || ' │ ' || actors_idle || ' │ ' || tasks_completed ||
    ' │ 0 │ ' || input_queue || ' │ ' || output_queue || ' │ 1 │  │ ' || printf('%.5f', tasks_per_actor_s) || ' │' AS line FROM state
  UNION ALL SELECT ts, 0, strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000000 | INFO | monitor' FROM frame
  UNION ALL SELECT ts, 1, 'Stage state:' FROM frame
  UNION ALL SELECT ts, 2, '╒═════════╤════════╕' FROM frame
  UNION ALL SELECT ts, 3, '│ Stage   │ Target │' FROM frame
  UNION ALL SELECT ts, 20, '╘═════════╧════════╛' FROM frame
  UNION ALL SELECT ts, 21, '│ Stage 99 - Noise │ 1 │ 2 │ 3 │ 4 │ 5 │ 6 │ 7 │ 8 │ 9 │ 10 │ 11 │ 12 │' FROM frame
  UNION ALL SELECT ts, 22, CASE hour(ts) WHEN 5 THEN 'ERROR worker lost' WHEN 6 THEN 'Caption for clip ready' ELSE 'idle' END FROM frame
  UNION ALL SELECT ts, 23, 'Generated ' || hour(ts) || ' captions for video' FROM frame),
lines AS (
  SELECT 'log-' || strftime(ts, '%Y-%m-%d') AS file, CAST(epoch_us(ts) // 1000000 * 100 + k AS BIGINT) AS line_no, ts, k, line FROM raw_lines)"""

_GAPS = """wide AS (
  SELECT ts, max(tasks_completed) FILTER (WHERE stage_short = 'signup') AS s0, max(tasks_completed) FILTER (WHERE stage_short = 'view') AS s1,
    max(tasks_completed) FILTER (WHERE stage_short = 'click') AS s2, max(tasks_completed) FILTER (WHERE stage_short = 'purchase') AS s3
  FROM state GROUP BY ts),
gaps AS (
  SELECT ts, 'signup>view' AS link, greatest(s0 - s1, 0) AS gap FROM wide WHERE s0 IS NOT NULL AND s1 IS NOT NULL
  UNION ALL SELECT ts, 'view>click', greatest(s1 - s2, 0) FROM wide WHERE s1 IS NOT NULL AND s2 IS NOT NULL
  UNION ALL SELECT ts, 'click>purchase', greatest(s2 - s3, 0) FROM wide WHERE s2 IS NOT NULL AND s3 IS NOT NULL)"""

_CAPTION_EVENTS = """caption_events AS (
  SELECT '10.0.0.' || (user_id % 4) AS ip, ts, CAST(user_id % 7 + 1 AS INTEGER) AS n_captions, '/input/' || user_id || '.mp4' AS media_path
  FROM events WHERE event_type = 'click')"""

_RUNS = """days AS (
  SELECT date_trunc('day', ts) AS day, count(*) FILTER (WHERE event_type = 'purchase') AS videos, count(*) FILTER (WHERE event_type = 'view') AS clips,
    count(*) FILTER (WHERE event_type = 'click') AS windows, count(*) FILTER (WHERE event_type = 'error') AS failures,
    min(ts) AS start_ts, max(ts) AS end_ts FROM events GROUP BY 1),
runs AS (
  SELECT strftime(day, '%Y-%m-%d') AS run_id, 'input-' || (day(day) % 2) AS input_id, CASE WHEN day(day) <= 20 THEN 'main' ELSE 'resume' END AS phase,
    CAST(CASE day(day) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END AS INTEGER) AS batch_size, videos, clips, windows, failures, start_ts, end_ts,
    epoch_us(end_ts) // 1000000 - epoch_us(start_ts) // 1000000 AS seconds
  FROM days)"""

_GPU = """scaled AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS v FROM events),
samples AS (
  SELECT ts, CAST(user_id % 4 AS INTEGER) AS gpu, 'host-' || (user_id % 3) AS host, v % 100 AS utilization, v % 4600 AS memory_used,
    CAST(4600 AS BIGINT) AS memory_total, v % 350 AS power, v % 1000 AS disk_free, v % 300 AS store_used FROM scaled)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _rank(value: str, p: float) -> str:
    """Nearest rank over the table ``ranked`` with row position i and count n."""
    return f"max({value}) FILTER (WHERE i = CAST(round_even((n - 1) * {p}e0, 0) AS BIGINT))"


def _ranked(source: str, keys: str, value: str, where: str = "true") -> str:
    by = f"PARTITION BY {keys}" if keys else ""
    return (
        f"(SELECT *, row_number() OVER ({by} ORDER BY {value}) - 1 AS i, count(*) OVER ({by}) AS n "
        f"FROM {source} WHERE {where} AND {value} IS NOT NULL) ranked"
    )


def _text(ts: str, micros: bool = False) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S{'.%f' if micros else ''}')"


_UUID = (
    "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || "
    "lower(to_hex((instr('0123456789abcdef', substr(h, 17, 1)) - 1) & 3 | 8)) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"
)
_SPAN_HASH = (
    "sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(media_path || '_' || CAST(round(start_s * 1000) AS BIGINT) "
    "|| '_' || CAST(round(end_s * 1000) AS BIGINT)))"
)
_SUFFIX = "CASE doc_id % 7 WHEN 0 THEN '.mp4' WHEN 1 THEN '.MOV' WHEN 2 THEN '.avi' WHEN 3 THEN '.txt' WHEN 4 THEN '' WHEN 5 THEN '.webm' ELSE '.tar.mkv' END"
_LAST_SUFFIX = "CASE doc_id % 7 WHEN 0 THEN '.mp4' WHEN 1 THEN '.mov' WHEN 2 THEN '.avi' WHEN 5 THEN '.webm' ELSE '.mkv' END"
_UNIT_RATES = ", ".join(
    f"round(CAST({u} AS DOUBLE) * 60 / seconds, 6) AS {u}_per_min, round(CAST({u} AS DOUBLE) / seconds, 6) AS {u}_per_s"
    for u in ("videos", "clips", "windows")
)
_UNIT_TOTALS = ", ".join(
    f"CAST({u} AS BIGINT) AS {u}, round(CAST({u} AS DOUBLE) * 60 / seconds, 3) AS {u}_per_min"
    for u in ("videos", "clips", "windows")
)
_MINUTES = "CAST(epoch_us({0}) - epoch_us({1}) AS DOUBLE) / 6e7"

ORACLE: dict[str, str] = {
    "media_inventory": f"""SELECT source || '/' || doc_id || {_SUFFIX} AS media_path, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes, {_LAST_SUFFIX} AS suffix
        FROM documents WHERE doc_id % 7 NOT IN (3, 4)""",
    "input_list": _with(_MEDIA) + "SELECT media_path FROM media",
    "tar_members": f"""SELECT CASE WHEN doc_id % 10 = 9 THEN '../' ELSE '60s/' END || doc_id || {_SUFFIX} AS member_path, {_LAST_SUFFIX} AS suffix,
        CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes, doc_id % 10 = 9 AS is_unsafe, CASE WHEN doc_id % 10 <> 9 THEN sha256(text) END AS checksum
        FROM documents WHERE doc_id % 7 NOT IN (3, 4)""",
    "clip_meta_read": _with(_CLIPS) + """SELECT span_uuid, source_video, start_s, end_s, n_windows,
        (SELECT string_agg(place * 256 || ':' || (place + 1) * 256 || ':' || caption_key || ':' || md5(text), ' ' ORDER BY place) FROM turns t WHERE t.clip_id = span_uuid) AS windows_text, valid,
        CASE WHEN clip_no % 6 = 0 THEN stage END AS error_stages,
        CASE WHEN clip_no % 12 = 0 THEN 'none' WHEN clip_no % 6 = 0 THEN message END AS error_messages FROM docs""",
    "processed_read": _with(_MEDIA, _PROCESSED) + "SELECT DISTINCT media_path FROM processed",
    "probe_json": _with(_MEDIA) + """SELECT doc_id, CASE WHEN doc_id % 7 = 4 THEN 0 ELSE width END AS width, CASE WHEN doc_id % 7 = 4 THEN 0 ELSE height END AS height,
        CASE WHEN doc_id % 7 = 4 THEN NULL WHEN fps = 30 THEN round(30000e0 / 1001e0, 6) ELSE fps END AS fps,
        CASE WHEN doc_id % 7 = 3 THEN 0 WHEN doc_id % 7 IN (2, 5) THEN bitrate ELSE bitrate + 1 END AS bitrate, duration_s,
        CASE doc_id % 7 WHEN 1 THEN size_bytes WHEN 5 THEN size_bytes WHEN 6 THEN 0 ELSE size_bytes + 3 END AS probed_bytes FROM media""",
    "stage_log_parse": _with(_STATE) + f"""SELECT {_text('ts')} || '.000000' AS timestamp, stage, stage_short, {_text('ts')} AS ts, CAST(0 AS BIGINT) AS actors_target, actors_ready,
        actors_running, actors_idle, tasks_completed, input_queue, output_queue, CAST(1 AS BIGINT) AS slots_used, CAST(0 AS BIGINT) AS slots_empty,
        CAST(printf('%.5f', tasks_per_actor_s) AS DOUBLE) AS tasks_per_actor_s FROM state""",
    "caption_event_parse": _with(_CAPTION_EVENTS) + f"SELECT ip, {_text('ts', True)} AS ts, n_captions, media_path FROM caption_events",
    "stage_metrics_csv": _with(_STATE) + f"""SELECT {_text('ts')} AS ts, stage_short, CAST(0 AS BIGINT) AS actors_pending, actors_ready, tasks_completed, input_queue,
        CAST(0 AS BIGINT) AS slots_empty, round(tasks_per_actor_s, 6) AS tasks_per_actor_s FROM state""",
    "gpu_samples_csv": _with(_GPU) + f"""SELECT {_text('ts', True)} AS ts, gpu, CAST(utilization AS DOUBLE) AS utilization, CAST(memory_used AS DOUBLE) AS memory_used,
        CAST(memory_total AS DOUBLE) AS memory_total, CAST(power AS DOUBLE) AS power FROM samples""",
    "run_report_write": _with(_CLIPS) + """, n AS (SELECT count(*) AS metas, count(*) FILTER (WHERE clip_no % 10 <> 0) AS clips, count(*) FILTER (WHERE clip_no % 10 <> 0 AND clip_no % 9 <> 0) AS videos,
        count(DISTINCT source_video) FILTER (WHERE clip_no % 4 <> 0) AS markers, coalesce(sum(length(span_uuid)) FILTER (WHERE clip_no % 10 <> 0), 0) AS chars FROM docs)
        SELECT run_id, CASE WHEN ok THEN 'succeeded' ELSE 'failed' END AS status, CASE WHEN NOT ok THEN 'RuntimeError: worker lost' END AS error,
        'artifacts,config,' || CASE WHEN ok THEN '' ELSE 'error,' END || 'execution_mode,output_tasks,run_id,stage_metrics,status,throughput_clips_per_s,throughput_videos_per_s,wall_time_s' AS report_keys,
        videos AS clip_files, metas + clips + CASE WHEN ok THEN markers ELSE 0 END AS file_count, videos AS clips_written, CASE WHEN ok THEN markers ELSE 0 END AS videos_done,
        clips AS clips_rows, CAST(chars AS BIGINT) AS clips_chars, metas AS metas_rows, CASE WHEN ok THEN markers END AS markers_rows FROM n, (VALUES ('whole', true), ('broken', false)) v(run_id, ok)""",
    "run_report_read": _with(_RUNS) + """SELECT run_id, CASE WHEN failures > windows THEN 'failed' ELSE 'succeeded' END AS status, CAST(seconds AS DOUBLE) AS wall_time_s,
        videos AS output_tasks, 'clip_files,windows' AS artifact_names, CASE WHEN failures > windows THEN failures || ' failures' END AS error,
        round(CAST(videos AS DOUBLE) / seconds, 6) AS videos_per_s, round(CAST(clips AS DOUBLE) / seconds, 6) AS clips_per_s FROM runs""",
    "idempotent_write": """SELECT 'docs/' || doc_id AS path, sha256(text) AS checksum FROM documents
        UNION ALL SELECT 'bench/' || item_id, sha256(text) FROM benchmark""",
    "safe_member_path": """SELECT page_id, member_path, starts_with(member_path, '/') OR list_contains(string_split(member_path, '/'), '..') AS is_unsafe
        FROM (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '../' WHEN 1 THEN '/' ELSE '' END || regexp_replace(url, '^[a-z]+://', '') AS member_path FROM pages)""",
    "stage_short": _with(_STATE) + f"SELECT {_text('ts')} AS ts, stage, stage_short FROM state",
    "strip_ansi": f"""SELECT event_id AS line_no, '(CaptionGenerationStage pid=' || user_id || ', ip=10.0.0.' || (user_id % 4) || ') ' || {_text('ts', True)} || ' | INFO | ' ||
        CASE WHEN event_type = 'click' THEN 'Generated ' || (user_id % 7 + 1) || ' captions for video /input/' || user_id || '.mp4 chunk-0' ELSE event_type END AS line
        FROM events""",
    "clip_uuid5": _with(_MEDIA, _SPANS) + f"SELECT media_path, clip_index, {_UUID} AS clip_id FROM (SELECT *, {_SPAN_HASH} AS h FROM spans)",
    "resolution_pixels": _with(_MEDIA) + "SELECT doc_id, width || 'x' || height AS resolution, CAST(width AS BIGINT) * height AS pixels FROM media",
    "elapsed_minutes": _with(_STATE) + f"""SELECT phase, stage_short, {_text('ts')} AS ts,
        round({_MINUTES.format('ts', 'min(ts) OVER (PARTITION BY phase)')}, 6) AS minute FROM state""",
    "clamp_series": _with(_STATE) + f"SELECT {_text('ts')} AS ts, stage_short, least(actors_ready, 3) AS ready_clamped, greatest(actors_running - input_queue, 0) AS spare FROM state",
    "caption_key_flags": _with(_CLIPS) + """SELECT clip_id AS span_uuid, window_index, caption_key <> 'system_note' AS has_key,
        caption_key <> 'system_note' AND trim(text) <> '' AS has_text FROM positions""",
    "caption_text_flags": _with(_CAPTIONS) + "SELECT doc_id, n_tokens, is_empty, at_cap, has_terminal, has_heading, has_template, has_refusal FROM flags",
    "log_line_markers": _with(_STATE, _LINES) + """SELECT file, line_no, substr(line, 1, 260) AS line, regexp_matches(line, 'Pipeline execution failed|Traceback|ERROR') AS is_failure,
        contains(line, 'Caption for clip') AS is_caption, regexp_matches(line, 'Generated .* captions for video') AS is_generated FROM lines""",
    "artifact_urls": _with(_CLIPS) + "SELECT span_uuid, '/assets/clips/' || span_uuid || '.mp4' AS video_url, '/assets/metas/v0/' || span_uuid || '.json' AS metadata_url FROM docs",
    "plan_totals": _with(_MEDIA, _SPANS, _WINDOWS) + """SELECT m.subset, count(*) AS n_media, CAST(sum(c.n) AS BIGINT) AS n_clips, CAST(sum(c.w) AS BIGINT) AS n_windows
        FROM media m LEFT JOIN (SELECT doc_id, count(DISTINCT clip_index) AS n, count(*) AS w FROM windows GROUP BY doc_id) c ON c.doc_id = m.doc_id GROUP BY m.subset""",
    "plan_run": _with(_MEDIA, _SPANS, _WINDOWS) + f"""SELECT {_UUID} AS clip_id, media_path, clip_index, CAST(clip_index // 4 AS INTEGER) AS chunk_index, window_index, start_frame, end_frame
        FROM (SELECT *, {_SPAN_HASH} AS h FROM windows)""",
    "fixed_stride_spans": _with(_MEDIA, _SPANS) + "SELECT media_path, clip_index, start_s, end_s FROM spans",
    "limit_clips": _with(_MEDIA, _SPANS) + "SELECT media_path, clip_index, start_s, end_s FROM spans WHERE clip_index < 2",
    "caption_windows": _with(_MEDIA, _SPANS, _WINDOWS) + "SELECT media_path, clip_index, window_index, start_frame, end_frame FROM windows",
    "frame_samples": _with(_MEDIA, _SPANS, _WINDOWS) + """SELECT doc_id, clip_index, window_index, sample_index, frame FROM (SELECT doc_id, clip_index, window_index, CAST(i AS INTEGER) AS sample_index,
          start_frame + CAST(round(i * (fps / 2e0)) AS INTEGER) AS frame, end_frame AS e
        FROM (SELECT *, unnest(range(0, CAST(ceil((end_frame - start_frame) * 2e0 / fps) AS BIGINT) + 1)) AS i FROM windows)) WHERE frame < e""",
    "clip_chunks": _with(_MEDIA, _SPANS) + "SELECT media_path, CAST(clip_index // 32 AS INTEGER) AS chunk_index, count(*) AS n_clips FROM spans GROUP BY 1, 2",
    "windows_explode": _with(_CLIPS) + """SELECT clip_id AS span_uuid, window_index, place * 256 AS start_frame, (place + 1) * 256 AS end_frame,
        CASE WHEN caption_key < 'end_frame' THEN caption_key || ',end_frame,start_frame' WHEN caption_key < 'start_frame' THEN 'end_frame,' || caption_key || ',start_frame'
        ELSE 'end_frame,start_frame,' || caption_key END AS window_keys FROM positions""",
    "errors_explode": _with(_CLIPS) + "SELECT span_uuid, source_video, stage, message FROM docs WHERE clip_no % 6 = 0",
    "pending_inputs": _with(_MEDIA, _PROCESSED) + "SELECT media_path, size_bytes FROM flagged WHERE NOT done",
    "done_flag": _with(_MEDIA, _PROCESSED) + "SELECT media_path, done FROM flagged",
    "gallery_items": _with(_CLIPS, _ITEMS) + "SELECT * FROM items",
    "missing_outputs": _with(_CLIPS) + "SELECT span_uuid, source_video, clip_location FROM docs WHERE clip_location NOT IN (SELECT path FROM clip_files)",
    "stage_gap": _with(_STATE) + f"""SELECT a.phase, {_text('a.ts')} AS ts, 'signup>view' AS link, greatest(a.tasks_completed - v.tasks_completed, 0) AS gap
        FROM state a JOIN state v ON a.ts = v.ts AND a.stage_short = 'signup' AND v.stage_short = 'view'""",
    "conservation_audit": """SELECT source_id, expected_items, expected_sources, written_items, written_sources, n_errors, expected_items - written_items AS missing_items,
        expected_sources - written_sources AS missing_sources,
        CASE WHEN expected_items = written_items AND expected_sources = written_sources THEN 'closed'
          WHEN expected_items - written_items BETWEEN 0 AND n_errors AND expected_sources - written_sources BETWEEN 0 AND n_errors THEN 'explained' ELSE 'unexplained' END AS status
        FROM (SELECT coalesce(o.o_orderkey, l.l_orderkey) AS source_id, CAST(CASE WHEN o.o_orderkey IS NULL THEN 0 ELSE 4 END AS BIGINT) AS expected_items,
          CAST(CASE WHEN o.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS expected_sources, coalesce(l.n, 0) AS written_items,
          CAST(CASE WHEN l.n IS NULL THEN 0 ELSE 1 END AS BIGINT) AS written_sources, CAST(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS n_errors
        FROM orders o FULL OUTER JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey)""",
    "rerun_manifest_diff": """SELECT 'docs/' || doc_id AS path, CASE doc_id % 50 WHEN 1 THEN 'removed' WHEN 0 THEN 'changed' ELSE 'same' END AS change, sha256(text) AS old_checksum,
        CASE doc_id % 50 WHEN 1 THEN NULL WHEN 0 THEN sha256(text || '!') ELSE sha256(text) END AS new_checksum FROM documents
        UNION ALL SELECT 'bench/' || item_id, 'added', NULL, sha256(text) FROM benchmark""",
    "run_compare": _with(_RUNS) + "SELECT r.run_id, r.input_id, round(CAST(r.seconds AS DOUBLE) / o.seconds, 6) AS wall_ratio, "
        + ", ".join(f"round(CAST(r.{u} AS DOUBLE) * 60 / r.seconds - CAST(o.{u} AS DOUBLE) * 60 / o.seconds, 6) AS {u}_per_min_delta" for u in ("videos", "clips", "windows"))
        + " FROM runs r JOIN runs o ON r.input_id = o.input_id AND o.run_id = '2024-01-01' WHERE r.run_id <> '2024-01-01'",
    "trailing_rates": _with(_CAPTION_EVENTS) + """SELECT CAST(m AS INTEGER) AS minutes, round(CAST(count(*) AS DOUBLE) / m, 6) AS videos_per_min, round(CAST(sum(n_captions) AS DOUBLE) / m, 6) AS captions_per_min
        FROM caption_events, (VALUES (60), (360), (1440), (10080)) v(m)
        WHERE epoch_us((SELECT max(ts) FROM caption_events)) - epoch_us(ts) <= CAST(m AS BIGINT) * 60000000 GROUP BY m""",
    "artifact_metrics": _with(_CLIPS, _LISTING) + """, s AS (SELECT regexp_extract(relative_path, '[^/](\\.[^./]+)$', 1) AS suffix FROM listing)
        SELECT 'files_by_suffix' AS metric, CASE WHEN suffix = '' THEN '<none>' ELSE suffix END AS suffix, count(*) AS value FROM s GROUP BY suffix
        UNION ALL SELECT 'file_count', NULL, count(*) FROM listing UNION ALL SELECT 'total_bytes', NULL, CAST(sum(size_bytes) AS BIGINT) FROM listing
        UNION ALL SELECT 'clip_files', NULL, count(*) FROM listing WHERE relative_path LIKE 'clips/%.mp4'
        UNION ALL SELECT 'metadata_files', NULL, count(*) FROM listing WHERE relative_path LIKE 'metas/v0/%.json'
        UNION ALL SELECT 'valid_clips', NULL, count(*) FROM docs WHERE valid
        UNION ALL SELECT 'captioned_windows', NULL, count(*) FROM turns WHERE caption_key <> 'system_note'
        UNION ALL SELECT 'windows_with_text', NULL, count(*) FROM turns WHERE caption_key <> 'system_note' AND trim(text) <> ''""",
    "stage_perf": """SELECT event_type AS stage, count(*) AS n_tasks, count(*) AS items, CAST(sum(p) AS BIGINT) AS process_s_sum, round(avg(p), 4) AS process_s_mean, round(stddev_pop(p), 4) AS process_s_std,
        CAST(sum(user_id) AS BIGINT) AS idle_s_sum, round(avg(user_id), 4) AS idle_s_mean, round(stddev_pop(user_id), 4) AS idle_s_std
        FROM (SELECT event_type, user_id, CAST(round(value * 100) AS BIGINT) AS p FROM events) GROUP BY 1""",
    "stage_summary": _with(_STATE) + f"""SELECT s.stage_short, round(avg(actors_ready), 6) AS ready_mean, round(avg(actors_running), 6) AS running_mean, max(tasks_completed) AS completed,
        max(input_queue) AS max_input_queue, max(output_queue) AS max_output_queue, {_text('min(ts)')} AS first_ts, {_text('max(ts)')} AS last_ts, count(DISTINCT ts) AS snapshots,
        round({_MINUTES.format('max(ts)', 'min(ts)')}, 6) AS duration_min, max(p50) AS speed_p50, max(p90) AS speed_p90
        FROM state s JOIN (SELECT stage_short, round({_rank('tasks_per_actor_s', 0.5)}, 6) AS p50, round({_rank('tasks_per_actor_s', 0.9)}, 6) AS p90
          FROM {_ranked('state', 'stage_short', 'tasks_per_actor_s', 'tasks_per_actor_s > 0')} GROUP BY stage_short) r ON r.stage_short = s.stage_short GROUP BY s.stage_short""",
    "nearest_rank_percentile": f"""SELECT l_returnflag, l_linestatus, {_rank('l_extendedprice', 0.5)} AS price_p50, {_rank('l_extendedprice', 0.9)} AS price_p90, {_rank('l_extendedprice', 0.95)} AS price_p95
        FROM {_ranked('lineitem', 'l_returnflag, l_linestatus', 'l_extendedprice')} GROUP BY 1, 2""",
    "ready_histogram": _with(_STATE) + """SELECT stage_short, actors_ready AS ready, count(*) AS n,
        round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY stage_short), 6) AS share FROM state GROUP BY 1, 2""",
    "actor_utilisation": _with(_STATE) + """SELECT stage_short, round(avg(actors_running), 6) AS running_mean, round(avg(actors_ready), 6) AS ready_mean,
        round(avg(actors_running) / avg(actors_ready), 6) AS utilisation FROM state GROUP BY 1""",
    "gap_stats": _with(_STATE, _GAPS) + f"""SELECT g.link, count(*) AS n, round(avg(gap), 6) AS gap_mean, max(gap) AS gap_max, max(p95) AS gap_p95
        FROM gaps g JOIN (SELECT link, {_rank('gap', 0.95)} AS p95 FROM {_ranked('gaps', 'link', 'gap')} GROUP BY link) r ON r.link = g.link GROUP BY g.link""",
    "events_by_host": _with(_CAPTION_EVENTS) + f"""SELECT ip, count(*) AS n_events, CAST(sum(n_captions) AS BIGINT) AS n_captions, {_text('min(ts)', True)} AS first_ts, {_text('max(ts)', True)} AS last_ts
        FROM caption_events GROUP BY ip""",
    "run_throughput": _with(_RUNS) + f"SELECT run_id, seconds, videos, clips, windows, {_UNIT_RATES} FROM runs",
    "throughput_total": _with(_RUNS) + f""", t AS (SELECT phase AS scope, sum(videos) AS videos, sum(clips) AS clips, sum(windows) AS windows, CAST(sum(seconds) AS DOUBLE) AS seconds FROM runs GROUP BY 1
        UNION ALL SELECT 'active_total', sum(videos), sum(clips), sum(windows), CAST(sum(seconds) AS DOUBLE) FROM runs
        UNION ALL SELECT 'wall_clock', sum(videos), sum(clips), sum(windows), CAST(epoch_us(max(end_ts)) - epoch_us(min(start_ts)) AS DOUBLE) / 1e6 FROM runs)
        SELECT scope, {_UNIT_TOTALS}, round(seconds / 60, 2) AS minutes FROM t""",
    "windows_per_clip": _with(_MEDIA, _SPANS, _WINDOWS) + """SELECT n_windows, count(*) AS n_clips, count(*) FILTER (WHERE fps >= 50) AS n_high_fps FROM sized WHERE n_windows > 0 GROUP BY 1""",
    "size_stats": _with(_MEDIA) + """SELECT subset, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS total_bytes, round(avg(size_bytes), 6) AS mean_bytes, min(size_bytes) AS min_bytes, max(size_bytes) AS max_bytes,
        CAST(median(size_bytes) AS DOUBLE) AS median_bytes, CAST(round(CAST(sum(size_bytes) * 100000 AS DOUBLE) / count(*)) AS BIGINT) AS full_bytes FROM media GROUP BY subset""",
    "subset_completion": _with(_MEDIA, _PROCESSED) + """SELECT subset, count(*) FILTER (WHERE done) AS n_done, count(*) AS n_total,
        round(CAST(count(*) FILTER (WHERE done) AS DOUBLE) / count(*), 6) AS done_share FROM flagged GROUP BY 1""",
    "distribution_by_group": _with(_MEDIA, _PROCESSED) + f""", placed AS (SELECT *, (row_number() OVER (ORDER BY media_path) - 1) // 58 + 1 AS g FROM flagged),
        long AS (SELECT 'position_group' AS kind, CAST(g AS VARCHAR) AS label, * FROM placed UNION ALL SELECT 'done', CASE WHEN done THEN 'true' ELSE 'false' END, * FROM placed UNION ALL SELECT 'all', 'all', * FROM placed)
        SELECT l.kind, l.label, count(*) AS n, round(avg(size_bytes), 6) AS size_mean, round(avg(bitrate), 6) AS bitrate_mean, round(avg(CAST(width AS BIGINT) * height), 6) AS pixels_mean,
          max(size_p50) AS size_p50, max(bitrate_p50) AS bitrate_p50 FROM long l
        JOIN (SELECT kind, label, {_rank('size_bytes', 0.5)} AS size_p50 FROM {_ranked('long', 'kind, label', 'size_bytes')} GROUP BY 1, 2) a ON a.kind = l.kind AND a.label = l.label
        JOIN (SELECT kind, label, {_rank('bitrate', 0.5)} AS bitrate_p50 FROM {_ranked('long', 'kind, label', 'bitrate')} GROUP BY 1, 2) c ON c.kind = l.kind AND c.label = l.label GROUP BY l.kind, l.label""",
    "top_resolutions": _with(_MEDIA) + """SELECT subset, resolution, n, CAST(r AS INTEGER) AS rank FROM (SELECT subset, resolution, n, row_number() OVER (PARTITION BY subset ORDER BY n DESC, f) AS r
        FROM (SELECT subset, width || 'x' || height AS resolution, count(*) AS n, min(media_path) AS f FROM media GROUP BY 1, 2)) WHERE r <= 3""",
    "caption_stats": _with(_CAPTIONS) + f"""SELECT f.subset, count(*) AS n, count(*) FILTER (WHERE is_empty) AS n_empty, count(caption) - count(DISTINCT caption) AS n_duplicates, round(avg(n_tokens), 6) AS tokens_mean,
        count(*) FILTER (WHERE at_cap) AS n_at_cap, round(CAST(count(*) FILTER (WHERE at_cap) * 100 AS DOUBLE) / count(*), 6) AS at_cap_pct, count(*) FILTER (WHERE at_cap AND NOT has_terminal) AS n_cut_off,
        max(p50) AS tokens_p50, max(p75) AS tokens_p75, max(p90) AS tokens_p90, max(p95) AS tokens_p95
        FROM flags f JOIN (SELECT subset, {_rank('n_tokens', 0.5)} AS p50, {_rank('n_tokens', 0.75)} AS p75, {_rank('n_tokens', 0.9)} AS p90, {_rank('n_tokens', 0.95)} AS p95
          FROM {_ranked('flags', 'subset', 'n_tokens')} GROUP BY 1) r ON r.subset = f.subset GROUP BY f.subset""",
    "error_rollup": _with(_CLIPS) + """SELECT stage, source_video, CAST(grouping_id(stage, source_video) AS INTEGER) AS level, count(*) AS n_errors
        FROM docs WHERE clip_no % 6 = 0 GROUP BY CUBE (stage, source_video)""",
    "duplicate_ids": f"""SELECT {_UUID} AS clip_id, n
        FROM (SELECT sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(text)) AS h, n FROM (SELECT text, count(*) AS n FROM documents GROUP BY 1) WHERE n > 1)""",
    "progress_snapshot": _with(_CLIPS, _LISTING, _STATE, _LINES) + """SELECT (SELECT count(*) FROM listing WHERE relative_path LIKE 'clips/%.mp4') AS n_clips,
        (SELECT count(*) FROM listing WHERE relative_path LIKE 'metas/v0/%.json') AS n_metas, (SELECT count(*) FROM listing WHERE relative_path LIKE 'processed_videos/%.json') AS n_videos,
        (SELECT count(*) FROM listing WHERE relative_path LIKE 'processed_clip_chunks/%.json') AS n_chunks,
        (SELECT count(*) FROM lines WHERE regexp_matches(line, 'Pipeline execution failed|Traceback|ERROR')) AS n_failures,
        (SELECT count(*) FROM lines WHERE contains(line, 'Caption for clip')) AS n_caption_lines, (SELECT count(*) FROM lines WHERE regexp_matches(line, 'Generated .* captions for video')) AS n_generated""",
    "input_volume": _with(_MEDIA) + """, m AS (SELECT *, CAST(round(duration_s * 1000) AS BIGINT) AS ms FROM media)
        SELECT count(*) AS n_files, CAST(sum(size_bytes) AS BIGINT) AS total_bytes, CAST(sum(ms) AS BIGINT) AS total_ms, round(CAST(sum(ms) AS DOUBLE) / count(*) / 1000, 6) AS mean_s,
        round(CAST(sum(ms) AS DOUBLE) / 1000 / 3600, 6) AS source_s_per_s, round(CAST(sum(size_bytes) AS DOUBLE) / 1048576 / 3600, 6) AS mib_per_s FROM m""",
    "eta_projection": _with(_RUNS) + """, p AS (SELECT phase, CAST(sum(videos) AS BIGINT) AS done, CAST(sum(seconds) AS BIGINT) AS seconds FROM runs GROUP BY 1)
        SELECT phase, done, seconds, done * 2 + 10 AS total, done + 10 AS remaining, round(CAST(done AS DOUBLE) * 60 / seconds, 6) AS per_min,
        round((done + 10) * (CAST(seconds AS DOUBLE) / done) / 60, 4) AS eta_min, round((done * 2 + 10) * (CAST(seconds AS DOUBLE) / done) / 60, 4) AS full_min FROM p""",
    "log_line_order": _with(_STATE, _LINES) + "SELECT file, line_no, row_number() OVER (PARTITION BY file ORDER BY line_no) - 1 AS line_index FROM lines",
    "timestamp_carry": _with(_STATE, _LINES) + f"SELECT file, line_no, {_text('ts')} || '.000000' AS timestamp FROM lines",
    "table_block_state": _with(_STATE, _LINES) + "SELECT file, line_no, k > 1 AND k < 20 AS in_table FROM lines",
    "ready_transitions": _with(_STATE) + f"""SELECT stage_short, {_text('ts')} AS ts, ready, ready_before FROM (SELECT stage_short, ts, actors_ready AS ready,
        lag(actors_ready) OVER (PARTITION BY stage_short ORDER BY ts) AS ready_before FROM state) WHERE ready_before IS NULL OR ready_before <> ready""",
    "position_groups": _with(_MEDIA) + "SELECT media_path, p AS position, p // 58 + 1 AS position_group FROM (SELECT media_path, row_number() OVER (ORDER BY media_path) - 1 AS p FROM media)",
    "latest_per_stage": _with(_STATE, _LINES) + """SELECT file, stage, CAST(r AS INTEGER) AS recency, substr(line, 1, 300) AS line FROM (SELECT file, stage, line, row_number() OVER (PARTITION BY file, stage ORDER BY line_no DESC) AS r
        FROM lines, (VALUES ('signup'), ('view'), ('click'), ('purchase'), ('error')) v(stage) WHERE contains(line, stage) AND contains(line, '│')) WHERE r <= 2""",
    "cumulative_completed": _with(_STATE) + f"SELECT stage_short, {_text('ts')} AS ts, finished, tasks_completed AS cumulative FROM state",
    "tail_overshoot": _with(_STATE) + f""", marked AS (SELECT *, epoch_us(max(ts) OVER (PARTITION BY phase)) - epoch_us(ts) <= CAST(1440 AS BIGINT) * 60000000 AS tail FROM state),
        t AS (SELECT phase, stage_short, max(actors_ready) AS tail_peak, round(CAST(sum(actors_ready - actors_running) AS DOUBLE) / sum(actors_ready), 6) AS tail_idle_share FROM marked WHERE tail GROUP BY 1, 2)
        SELECT t.phase, t.stage_short, tail_peak, tail_idle_share, steady_median, coalesce(tail_peak > steady_median AND tail_idle_share > 0.5, false) AS overshoot
        FROM t LEFT JOIN (SELECT phase, stage_short, {_rank('actors_ready', 0.5)} AS steady_median FROM {_ranked('marked', 'phase, stage_short', 'actors_ready', 'NOT tail')} GROUP BY 1, 2) s
          ON s.phase = t.phase AND s.stage_short = t.stage_short""",
    "queue_boundedness": _with(_STATE, _GAPS) + """, placed AS (SELECT *, ntile(3) OVER (PARTITION BY link ORDER BY ts) AS third, CAST(epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY link)) AS DOUBLE) / 6e7 / 60 AS h FROM gaps)
        SELECT link, round(regr_slope(CAST(gap AS DOUBLE), h), 4) AS slope_per_hour, max(gap) FILTER (WHERE third = 1) AS peak_first, max(gap) FILTER (WHERE third = 2) AS peak_middle,
        max(gap) FILTER (WHERE third = 3) AS peak_last, NOT (max(gap) FILTER (WHERE third = 3) > 2 * max(gap) FILTER (WHERE third = 1)) AS bounded FROM placed GROUP BY link""",
    "gallery_index": _with(_CLIPS, _ITEMS) + "SELECT *, 'run' AS run_id, (SELECT count(*) FROM items) AS item_count, 10 AS page_size FROM items",
    "gallery_search": _with(_CLIPS, _ITEMS) + "SELECT * FROM items WHERE contains(lower(id), '/input/1') OR contains(lower(source_video), '/input/1')",
    "gallery_page": _with(_CLIPS, _ITEMS) + """, f AS (SELECT *, row_number() OVER (ORDER BY source_video, start_s, end_s, id) - 1 AS position, count(*) OVER () AS filtered_count
          FROM items WHERE contains(source_video, '/input/1')), g AS (SELECT *, greatest((filtered_count + 9) // 10, 1) AS pages FROM f)
        SELECT *, least(2, pages) AS page FROM g WHERE position // 10 = least(2, pages) - 1""",
    "video_limit": _with(_MEDIA) + "SELECT media_path, size_bytes FROM media ORDER BY media_path LIMIT 100",
    "largest_pending": _with(_MEDIA, _PROCESSED) + "SELECT media_path, size_bytes FROM flagged WHERE NOT done ORDER BY size_bytes DESC, media_path LIMIT 8",
    "log_tail": _with(_STATE, _LINES) + """SELECT file, CAST(r AS INTEGER) AS recency, substr(line, 1, 260) AS line FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY line_no DESC) AS r FROM lines) WHERE r <= 12""",
    "stratified_review_sample": _with(_MEDIA, _CAPTIONS) + """SELECT doc_id, subset, at_cap, high_fps, CAST(r AS INTEGER) AS sample_rank FROM (SELECT f.doc_id, f.subset, f.at_cap, m.fps >= 50 AS high_fps,
        row_number() OVER (PARTITION BY m.fps >= 50, f.at_cap, f.subset ORDER BY sha1(CAST(f.doc_id AS VARCHAR)), f.doc_id) AS r FROM flags f JOIN media m ON m.doc_id = f.doc_id) WHERE r <= 5""",
    "phase_timeline": _with(_STATE) + f""", p AS (SELECT phase, min(ts) AS a, max(ts) AS z FROM state GROUP BY 1)
        SELECT s.phase, stage_short, {_text('ts')} AS ts, round({_MINUTES.format('ts', 'p.a')} + CASE WHEN s.phase = 'main' THEN 0
          ELSE (SELECT {_MINUTES.format('z', 'a')} + 4 FROM p q WHERE q.phase = 'main') END, 6) AS minute FROM state s JOIN p ON p.phase = s.phase""",
    "input_identity": _with(_MEDIA, _PROCESSED) + """, j AS (SELECT m.media_path AS a, p.media_path AS b FROM (SELECT DISTINCT media_path FROM media) m FULL OUTER JOIN (SELECT DISTINCT media_path FROM processed) p ON m.media_path = p.media_path)
        SELECT count(*) FILTER (WHERE b IS NULL) AS only_first, count(*) FILTER (WHERE a IS NULL) AS only_second, count(*) FILTER (WHERE a = b) AS in_both,
        count(*) FILTER (WHERE b IS NULL OR a IS NULL) = 0 AS identical FROM j""",
    "source_coverage": "SELECT DISTINCT o_orderkey AS source_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "batched_map": _with(_CAPTIONS) + """SELECT doc_id, CASE WHEN doc_id % 97 <> 0 THEN n_tokens END AS n_words, CASE WHEN doc_id % 97 = 0 THEN 'ValueError: planned failure' END AS error FROM captions""",
    "caption_gate": _with(_CAPTIONS, _GATE) + "SELECT doc_id, accepted, why AS reasons FROM gated",
    "gate_report": _with(_CAPTIONS, _GATE) + """, long AS (SELECT subset, unnest(string_split(CASE WHEN accepted THEN 'accepted' ELSE why END, ',')) AS reason FROM gated),
        rolled AS (SELECT reason, subset, CAST(grouping_id(reason, subset) AS INTEGER) AS level, count(*) AS n_rows FROM long GROUP BY ROLLUP (reason, subset)),
        totals AS (SELECT subset, CAST(grouping_id(subset) AS INTEGER) AS level, count(*) AS n_captions FROM gated GROUP BY ROLLUP (subset))
        SELECT r.reason, r.subset, r.level, n_rows, n_captions, round(CAST(n_rows AS DOUBLE) / n_captions, 6) AS share FROM rolled r
        JOIN totals t ON t.level = r.level AND t.subset IS NOT DISTINCT FROM r.subset WHERE r.level < 3""",
    "gate_precision": _with(_CAPTIONS, _GATE) + """SELECT accepted, count(*) AS n_labelled, count(*) FILTER (WHERE quality = 1) AS n_good, round(CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) / count(*), 6) AS good_share
        FROM gated g JOIN labels l ON l.doc_id = g.doc_id GROUP BY 1""",
    "validity_rules": _with(_CLIPS) + "SELECT span_uuid, n_windows, all_text AS accepted, valid, all_text = valid AS flag_agrees FROM docs",
    "batch_sweep_select": _with(_RUNS) + """, s AS (SELECT batch_size, count(*) AS n_runs, count(*) FILTER (WHERE failures > windows * 2) AS n_oom,
          max(CAST(failures AS DOUBLE) / (failures + windows)) AS peak, 0e0 AS peak_growth, CAST(sum(windows) AS DOUBLE) / sum(seconds) AS rate FROM runs GROUP BY 1),
        j AS (SELECT *, coalesce(rate >= lag(rate) OVER (ORDER BY batch_size), true) AS not_slower FROM s), q AS (SELECT *, n_runs >= 2 AND n_oom = 0 AND peak < 0.9 AND not_slower AS qualifies FROM j)
        SELECT batch_size, n_runs, n_oom, round(peak, 6) AS peak_memory, peak_growth, not_slower, qualifies,
          coalesce(batch_size = (SELECT max(batch_size) FROM q WHERE qualifies), false) AS selected, round(rate, 6) AS captions_per_s FROM q""",
    "resource_alerts": _with(_GPU) + f""", fired AS (SELECT *, 'disk_low' AS alert FROM samples WHERE disk_free < 50 UNION ALL SELECT *, 'gpu_memory_high' FROM samples WHERE memory_used >= 4140)
        SELECT host, alert, count(*) AS n_samples, {_text('min(ts)', True)} AS first_ts, max(round(CAST(store_used AS DOUBLE) / 300, 6)) AS store_share_max,
        {_text("date_trunc('hour', ts)")} AS window_start FROM fired GROUP BY host, alert, date_trunc('hour', ts)""",
    "gpu_window_stats": _with(_GPU) + f"""SELECT gpu, count(*) AS n_samples, round(avg(utilization), 4) AS utilization_mean, max(utilization) AS utilization_max, round(avg(memory_used), 4) AS memory_used_mean,
        max(memory_used) AS memory_used_max, round(avg(power), 4) AS power_mean, max(power) AS power_max, {_text("date_trunc('hour', ts)")} AS window_start FROM samples GROUP BY gpu, date_trunc('hour', ts)""",
    "hypothesis_verdict": _with(_STATE) + """, m AS (SELECT stage_short AS hypothesis, CASE WHEN stage_short <> 'error' THEN round(avg(actors_running) / avg(actors_ready), 6) END AS value, 0.3e0 AS threshold,
          CASE WHEN stage_short = 'view' THEN 'below' ELSE 'above' END AS direction FROM state GROUP BY 1)
        SELECT *, CASE WHEN value IS NULL THEN 'inconclusive' WHEN direction = 'above' AND value > threshold OR direction = 'below' AND value < threshold THEN 'supported' ELSE 'rejected' END AS verdict FROM m""",
    "preflight_gate": _with(_MEDIA) + """SELECT 'parameters' AS check, true AS ok, '' AS detail UNION ALL SELECT 'gpu_capacity', false, 'needs 4, has 2'
        UNION ALL SELECT 'inputs', count(*) > 0, count(*) || ' files, ' || CAST(sum(size_bytes) AS BIGINT) || ' bytes' FROM media""",
    "stream_clip_plan": _with(_MEDIA, _SPANS) + "SELECT media_path, clip_index, start_s, end_s FROM spans",
    "stream_dedup_media": _with(_CAPTION_EVENTS) + "SELECT DISTINCT media_path FROM caption_events",
    "stream_tumbling_rates": _with(_CAPTION_EVENTS) + f""", w AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS s, ip, count(*) AS n_videos, CAST(sum(n_captions) AS BIGINT) AS n_captions FROM caption_events GROUP BY 1, 2)
        SELECT ip, n_videos, n_captions, round(n_videos / 10e0, 6) AS videos_per_min, round(n_captions / 10e0, 6) AS captions_per_min, {_text('s', True)} AS window_start, {_text("s + INTERVAL '10 minutes'", True)} AS window_end
        FROM w""",
    "stream_sliding_rates": _with(_CAPTION_EVENTS) + f""", e AS (SELECT time_bucket(INTERVAL '5 minutes', ts) - k * INTERVAL '5 minutes' AS s, n_captions FROM caption_events, (VALUES (0), (1), (2), (3), (4), (5)) v(k)),
        w AS (SELECT s, count(*) AS n_videos, CAST(sum(n_captions) AS BIGINT) AS n_captions FROM e GROUP BY 1)
        SELECT n_videos, n_captions, round(n_videos / 30e0, 6) AS videos_per_min, round(n_captions / 30e0, 6) AS captions_per_min, {_text('s', True)} AS window_start, {_text("s + INTERVAL '30 minutes'", True)} AS window_end
        FROM w""",
    "stream_idle_sessions": _with(_CAPTION_EVENTS) + f""", g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY ip ORDER BY ts) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM caption_events),
        n AS (SELECT *, sum(fresh) OVER (PARTITION BY ip ORDER BY ts) AS session FROM g),
        s AS (SELECT ip, count(*) AS n_videos, CAST(sum(n_captions) AS BIGINT) AS n_captions, min(ts) AS a, max(ts) + INTERVAL '30 minutes' AS z FROM n GROUP BY ip, session)
        SELECT ip, n_videos, n_captions, {_text('a', True)} AS window_start, {_text('z', True)} AS window_end FROM s""",
    "stream_stage_gap": """SELECT CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 'main' ELSE 'resume' END AS run_id, count(*) FILTER (WHERE event_type = 'signup') AS up_completed,
        count(*) FILTER (WHERE event_type = 'view') AS down_completed, greatest(count(*) FILTER (WHERE event_type = 'signup') - count(*) FILTER (WHERE event_type = 'view'), 0) AS gap FROM events GROUP BY 1""",
    "stream_idempotent_sink": _with(_CAPTION_EVENTS) + f"SELECT ip, {_text('ts', True)} AS ts, n_captions, media_path FROM caption_events",
    "stream_late_drop": f"""WITH p AS (SELECT ts, least(2, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) AS part FROM events WHERE ts IS NOT NULL),
        m AS (SELECT a.part, max(b.ts) - INTERVAL '10 minutes' AS mark FROM (SELECT DISTINCT part FROM p) a JOIN p b ON b.part < a.part GROUP BY 1),
        w AS (SELECT date_trunc('hour', ts) AS w, coalesce(date_trunc('hour', ts) + INTERVAL '1 hour' <= mark, false) AS late FROM p LEFT JOIN m USING (part))
        SELECT {_text('w')} AS window_start, count(*) FILTER (WHERE NOT late) AS n, count(*) FILTER (WHERE late) AS n_late FROM w GROUP BY w""",
}
ORACLE["tar_members_split"] = ORACLE["tar_members"]
ORACLE["stream_transitions"] = ORACLE["ready_transitions"]
ORACLE["stream_stage_log"] = ORACLE["stage_log_parse"]
ORACLE["gallery_search_indexed"] = ORACLE["gallery_search"]
ORACLE["replaced_documents"] = "SELECT doc_id, md5(CASE WHEN doc_id % 3 = 0 THEN text || '!' ELSE text END) AS digest FROM documents"
