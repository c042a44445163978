"""Registered batch queries: one per operator, over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.functions import numeric, paths, text
from reelgauge.functions.ids import uuid5
from reelgauge.operators import audit, batched, captions, gallery, inventory, planning, ranking, resources, runs, stages
from reelgauge.plans import bindings as b
from reelgauge.plans import fixtures, run_folder
from reelgauge.session import scratch_path
from reelgauge.sources import commits, files, ranked, sinks, tar, trigram

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def when_text(ts: str | Column, micros: bool = False) -> Column:
    """Timestamps leave a query as text, the same in every engine."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss" + (".SSSSSS" if micros else ""))


def _big(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


# ---- sources and sinks --------------------------------------------------------------


@query
def media_inventory(spark, sf):
    folder = scratch_path(spark, "media")
    fixtures.write_media(spark, sf, folder)
    found = files.media_inventory(spark, folder)
    relative = F.substring("media_path", F.length(paths.plain_path(F.lit(folder))) + 2, F.length("media_path"))
    return found.select(relative.alias("media_path"), "size_bytes", F.lower(paths.suffix(F.col("media_path"))).alias("suffix"))


@query
def input_list(spark, sf):
    folder = scratch_path(spark, "input-list")
    fixtures.write_input_list(spark, sf, folder)
    return files.input_list(spark, folder).select("media_path")


@query
def tar_members(spark, sf):
    folder = scratch_path(spark, "shards")
    fixtures.write_shards(spark, sf, folder)
    members = tar.tar_members(spark, folder)
    return members.select(
        "member_path", "suffix", "size_bytes", "is_unsafe", F.sha2("payload", 256).alias("checksum")
    )


def _window_text(window: Column) -> Column:
    """Frames, caption key and the digest of the caption text of a window."""
    captions = F.map_filter(window, lambda k, _: ~k.isin("start_frame", "end_frame"))
    key, caption = F.map_keys(captions)[0], F.map_values(captions)[0]
    return F.concat_ws(":", window["start_frame"], window["end_frame"], key, F.md5(caption.cast("binary")))


@query
def tar_members_split(spark, sf):
    """The same members out of shards that many tasks share."""
    folder = scratch_path(spark, "shards")
    fixtures.write_shards(spark, sf, folder)
    members = tar.split_members(tar.tar_index(spark, folder), split_bytes=1 << 20)
    return members.select("member_path", "suffix", "size_bytes", "is_unsafe", F.sha2("payload", 256).alias("checksum"))


@query
def clip_meta_read(spark, sf):
    folder = scratch_path(spark, "metas")
    fixtures.write_clip_docs(spark, sf, folder)
    docs = files.clip_meta_read(spark, folder, lines=True)
    failures = audit.errors_map(F.col("errors"))
    return docs.select(
        "span_uuid",
        "source_video",
        F.col("duration_span")[0].alias("start_s"),
        F.col("duration_span")[1].alias("end_s"),
        F.size("windows").cast("bigint").alias("n_windows"),
        F.array_join(F.transform("windows", _window_text), " ").alias("windows_text"),
        F.coalesce("valid", F.lit(False)).alias("valid"),
        F.array_join(F.map_keys(failures), ",").alias("error_stages"),
        F.array_join(F.map_values(failures), ",", "none").alias("error_messages"),
    )


@query
def processed_read(spark, sf):
    folder = scratch_path(spark, "processed")
    fixtures.write_markers(spark, sf, folder)
    return files.processed_read(spark, folder, lines=True)


@query
def probe_json(spark, sf):
    probed = inventory.probe_json(fixtures.probe_documents(spark, sf), "document")
    return probed.select(
        "doc_id", "width", "height", F.round("fps", 6).alias("fps"), "bitrate", "duration_s", "probed_bytes"
    )


def parsed_stages(rows: DataFrame) -> DataFrame:
    rows = stages.typed_stage_state(rows)
    return rows.select(
        "timestamp", "stage", "stage_short", when_text("ts").alias("ts"),
        *[_big(n) for n in ("actors_target", "actors_ready", "actors_running", "actors_idle", "tasks_completed")],
        *[_big(n) for n in ("input_queue", "output_queue", "slots_used", "slots_empty")],
        "tasks_per_actor_s",
    )


@query
def stage_log_parse(spark, sf):
    folder = scratch_path(spark, "stage-log")
    fixtures.write_log(b.stage_log_lines(spark, sf), folder)
    return parsed_stages(stages.stage_log_parse(files.read_log_lines(spark, folder)))


@query
def caption_event_parse(spark, sf):
    events = stages.caption_event_parse(b.caption_log_lines(spark, sf))
    return events.select("ip", when_text("ts", micros=True).alias("ts"), "n_captions", "media_path")


@query
def stage_metrics_csv(spark, sf):
    folder = scratch_path(spark, "stage-csv")
    sinks.stage_metrics_write(fixtures.stage_text(spark, sf), folder)
    rows = stages.typed_stage_state(files.stage_metrics_read(spark, folder))
    return rows.select(
        when_text("ts").alias("ts"), "stage_short",
        *[_big(n) for n in ("actors_pending", "actors_ready", "tasks_completed", "input_queue", "slots_empty")],
        F.round("tasks_per_actor_s", 6).alias("tasks_per_actor_s"),
    )


@query
def gpu_samples_csv(spark, sf):
    folder = scratch_path(spark, "gpu-csv")
    fixtures.write_gpu_csv(spark, sf, folder)
    samples = files.gpu_samples_csv(spark, folder)
    return samples.select(when_text("ts", micros=True).alias("ts"), "gpu", "utilization", "memory_used", "memory_total", "power")


@query
def run_report_write(spark, sf):
    """Two runs write the files of a run folder by stages; the second one fails before its last stage."""
    reports, tables = scratch_path(spark, "reports"), fixtures.run_tables(spark, sf)
    for run_id in ("whole", "broken"):
        folder = scratch_path(spark, "run")
        try:
            with run_folder.recorded_run(spark, folder, reports, run_id, "batch") as stages_:
                for stage, rows in tables.items():
                    if run_id == "broken" and stage == "markers":
                        raise RuntimeError("worker lost")
                    stages_.run(stage, rows, lambda df, at=folder: fixtures.write_files(df, at), chars=F.sum(F.length("body")))
        except RuntimeError:
            pass
    line = F.col("value")
    number = lambda path, name: F.get_json_object(line, f"$.{path}").cast("double").cast("bigint").alias(name)
    return spark.read.text(reports).select(
        F.get_json_object(line, "$.run_id").alias("run_id"),
        F.get_json_object(line, "$.status").alias("status"),
        F.get_json_object(line, "$.error").alias("error"),
        F.array_join(F.json_object_keys(line), ",").alias("report_keys"),
        number("artifacts.clip_files", "clip_files"),
        number("artifacts.file_count", "file_count"),
        number("stage_metrics.clips_written", "clips_written"),
        number("stage_metrics.videos_done", "videos_done"),
        number("stage_metrics.clips_rows", "clips_rows"),
        number("stage_metrics.clips_chars", "clips_chars"),
        number("stage_metrics.metas_rows", "metas_rows"),
        number("stage_metrics.markers_rows", "markers_rows"),
    )


@query
def run_report_read(spark, sf):
    folder = scratch_path(spark, "reports")
    sinks.run_report_write(fixtures.run_reports(spark, sf), folder)
    reports = files.run_report_read(spark, folder, lines=True)
    overview = files.report_overview(reports)
    speeds = files.report_throughput(reports)
    return overview.join(speeds, "run_id").select(
        "run_id", "status", "wall_time_s", "output_tasks",
        F.array_join("artifact_names", ",").alias("artifact_names"), "error",
        F.round("videos_per_s", 6).alias("videos_per_s"), F.round("clips_per_s", 6).alias("clips_per_s"),
    )


@query
def replaced_documents(spark, sf):
    """All documents, then a third of them in a new form: what readers see after the second commit."""
    target, docs = scratch_path(spark, "replaced"), b.table(spark, sf, "documents").select("doc_id", "text")
    commits.replace(docs, "doc_id", target)
    commits.replace(docs.where("doc_id % 3 = 0").withColumn("text", F.concat("text", F.lit("!"))), "doc_id", target)
    return commits.committed(spark, target, "doc_id").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query
def idempotent_write(spark, sf):
    target = scratch_path(spark, "artifacts")
    before, after = fixtures.rerun_sides(spark, sf)
    sinks.idempotent_write(before, "path", target)
    sinks.idempotent_write(after, "path", target)
    return spark.read.parquet(target).select("path", F.sha2("content", 256).alias("checksum"))


# ---- projections ----------------------------------------------------------------------


@query
def safe_member_path(spark, sf):
    member = fixtures.member_paths(spark, sf)
    return member.withColumn("is_unsafe", paths.unsafe_member(F.col("member_path")))


@query
def stage_short(spark, sf):
    state = b.stage_state(spark, sf)
    return state.select(when_text("ts").alias("ts"), "stage", text.stage_short(F.col("stage")).alias("stage_short"))


@query
def strip_ansi(spark, sf):
    return b.caption_log_lines(spark, sf).select("line_no", text.strip_ansi(F.col("line")).alias("line"))


@query
def clip_uuid5(spark, sf):
    spans = planning.fixed_stride_spans(b.media(spark, sf))
    return planning.with_clip_id(spans).select("media_path", "clip_index", "clip_id")


@query
def resolution_pixels(spark, sf):
    w, h = F.col("width"), F.col("height")
    return b.media(spark, sf).select(
        "doc_id", numeric.resolution(w, h).alias("resolution"), numeric.pixels(w, h).alias("pixels")
    )


@query
def elapsed_minutes(spark, sf):
    timed = stages.elapsed_minutes(b.stage_state(spark, sf), ["phase"])
    return timed.select("phase", "stage_short", when_text("ts").alias("ts"), F.round("minute", 6).alias("minute"))


@query
def clamp_series(spark, sf):
    state = b.stage_state(spark, sf)
    return state.select(
        when_text("ts").alias("ts"), "stage_short",
        numeric.clamp(F.col("actors_ready"), high=3).alias("ready_clamped"),
        numeric.clamp(F.col("actors_running") - F.col("input_queue"), low=0).alias("spare"),
    )


@query
def caption_key_flags(spark, sf):
    windows = planning.windows_explode(b.clip_docs(spark, sf).select("span_uuid", "windows"))
    return windows.select(
        "span_uuid", "window_index",
        text.has_caption_key(F.col("window")).alias("has_key"),
        text.has_caption_text(F.col("window")).alias("has_text"),
    )


@query
def caption_text_flags(spark, sf):
    flagged = captions.with_caption_flags(b.captions(spark, sf), cap=b.TOKEN_CAP)
    return flagged.drop("caption", "subset")


@query
def log_line_markers(spark, sf):
    marked = stages.marked_lines(stages.clean_lines(b.stage_log_lines(spark, sf)))
    return marked.select("file", "line_no", "line", "is_failure", "is_caption", "is_generated")


@query
def artifact_urls(spark, sf):
    run = F.lit("/run")
    return b.clip_docs(spark, sf).select(
        "span_uuid",
        paths.artifact_url(F.col("clip_location"), run).alias("video_url"),
        paths.artifact_url(F.col("metadata_path"), run).alias("metadata_url"),
    )


# ---- generators -----------------------------------------------------------------------


@query
def plan_totals(spark, sf):
    return planning.plan_totals(b.media(spark, sf))


@query
def plan_run(spark, sf):
    plan = planning.plan_run(b.media(spark, sf), planning.PlanRule(chunk=4, windows=(256, 128)))
    return plan.select("clip_id", "media_path", "clip_index", "chunk_index", "window_index", "start_frame", "end_frame")


@query
def fixed_stride_spans(spark, sf):
    spans = planning.fixed_stride_spans(b.media(spark, sf))
    return spans.select("media_path", "clip_index", "start_s", "end_s")


@query
def limit_clips(spark, sf):
    spans = planning.fixed_stride_spans(b.media(spark, sf), limit_clips=2)
    return spans.select("media_path", "clip_index", "start_s", "end_s")


@query
def caption_windows(spark, sf):
    windows = planning.caption_windows(planning.fixed_stride_spans(b.media(spark, sf)))
    return windows.select("media_path", "clip_index", "window_index", "start_frame", "end_frame")


@query
def frame_samples(spark, sf):
    windows = planning.caption_windows(planning.fixed_stride_spans(b.media(spark, sf)))
    return planning.frame_samples(windows).select("doc_id", "clip_index", "window_index", "sample_index", "frame")


@query
def clip_chunks(spark, sf):
    return planning.chunk_sizes(planning.fixed_stride_spans(b.media(spark, sf)))


@query
def windows_explode(spark, sf):
    windows = planning.windows_explode(b.clip_docs(spark, sf).select("span_uuid", "windows"))
    keys = F.array_sort(F.map_keys("window"))
    return windows.select(
        "span_uuid", "window_index",
        F.col("window")["start_frame"].cast("int").alias("start_frame"),
        F.col("window")["end_frame"].cast("int").alias("end_frame"),
        F.array_join(keys, ",").alias("window_keys"),
    )


@query
def errors_explode(spark, sf):
    return audit.errors_explode(b.clip_docs(spark, sf), keep=["span_uuid", "source_video"])


# ---- joins ----------------------------------------------------------------------------


def _flagged(spark, sf):
    return inventory.done_flag(b.media(spark, sf), b.processed(spark, sf))


@query
def pending_inputs(spark, sf):
    return inventory.pending_inputs(b.media(spark, sf), b.processed(spark, sf)).select("media_path", "size_bytes")


@query
def done_flag(spark, sf):
    return _flagged(spark, sf).select("media_path", "done")


def _items(spark, sf):
    return gallery.gallery_items(b.clip_docs(spark, sf), b.clip_files(spark, sf), "/run")


def _flat_items(items):
    return items.withColumns(
        {"start_s": F.col("duration_span")[0], "end_s": F.col("duration_span")[1]}
    ).drop("duration_span")


@query
def gallery_items(spark, sf):
    return _flat_items(_items(spark, sf))


@query
def missing_outputs(spark, sf):
    lost = audit.missing_outputs(b.clip_docs(spark, sf), b.clip_files(spark, sf))
    return lost.select("span_uuid", "source_video", "clip_location")


@query
def stage_gap(spark, sf):
    state = b.stage_state(spark, sf).withColumn("line_no", F.lit(1))
    # Every sample comes twice; the earlier one has a larger count and must lose.
    earlier = state.withColumns({"line_no": F.lit(0), "tasks_completed": F.col("tasks_completed") + 1000})
    gaps = stages.stage_gap(earlier.unionByName(state), "signup", "view", ["phase"], order=["line_no"])
    return gaps.withColumn("ts", when_text("ts"))


@query
def conservation_audit(spark, sf):
    orders = b.table(spark, sf, "orders")
    key = F.col("o_orderkey").alias("source_id")
    expected = orders.select(key, F.lit(4).alias("items"), F.lit(1).alias("sources"))
    written = (
        b.table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("source_id"))
        .agg(F.count(F.lit(1)).alias("items"), F.lit(1).alias("sources"))
    )
    failures = orders.where(F.col("o_orderstatus") == "F").select(key)
    return audit.conservation_audit(expected, written, failures, ["source_id"], ["items", "sources"])


@query
def rerun_manifest_diff(spark, sf):
    before, after = fixtures.rerun_sides(spark, sf)
    diff = audit.rerun_manifest_diff(
        audit.manifest(before, "path", "content"), audit.manifest(after, "path", "content")
    )
    return diff


@query
def run_compare(spark, sf):
    return runs.run_compare(b.runs(spark, sf), "2024-01-01")


@query
def trailing_rates(spark, sf):
    return stages.trailing_rates(b.caption_events(spark, sf), (60, 360, 1440, 10080))


# ---- aggregations ---------------------------------------------------------------------


@query
def artifact_metrics(spark, sf):
    return audit.artifact_metrics(b.artifact_listing(spark, sf), b.clip_docs(spark, sf))


@query
def stage_perf(spark, sf):
    perf = b.table(spark, sf, "events").select(
        F.col("event_type").alias("stage"),
        F.round(F.col("value") * 100).cast("bigint").alias("process_s"),
        F.col("user_id").alias("idle_s"),
        F.lit(1).alias("items"),
    )
    return runs.stage_perf(perf)


@query
def stage_summary(spark, sf):
    summary = stages.stage_summary(b.stage_state(spark, sf))
    return summary.withColumns({"first_ts": when_text("first_ts"), "last_ts": when_text("last_ts")})


@query
def nearest_rank_percentile(spark, sf):
    lines = b.table(spark, sf, "lineitem")
    levels = {"price_p50": 0.5, "price_p90": 0.9, "price_p95": 0.95}
    return ranking.nearest_rank(lines, "l_extendedprice", ["l_returnflag", "l_linestatus"], levels)


@query
def ready_histogram(spark, sf):
    return stages.ready_histogram(b.stage_state(spark, sf))


@query
def actor_utilisation(spark, sf):
    return stages.actor_utilisation(b.stage_state(spark, sf))


def _gaps(spark, sf):
    return stages.stage_gaps(b.stage_state(spark, sf), b.LINKS, order=["tasks_completed"])


@query
def gap_stats(spark, sf):
    return stages.gap_stats(_gaps(spark, sf))


@query
def events_by_host(spark, sf):
    hosts = stages.events_by_host(b.caption_events(spark, sf))
    return hosts.withColumns({n: when_text(n, micros=True) for n in ("first_ts", "last_ts")})


@query
def run_throughput(spark, sf):
    return runs.run_throughput(b.runs(spark, sf))


@query
def throughput_total(spark, sf):
    return runs.throughput_total(b.runs(spark, sf))


@query
def windows_per_clip(spark, sf):
    windows = planning.caption_windows(planning.fixed_stride_spans(b.media(spark, sf)))
    return planning.windows_per_clip(windows)


@query
def size_stats(spark, sf):
    return inventory.size_stats(b.media(spark, sf), "subset", full_count=100_000)


@query
def subset_completion(spark, sf):
    return inventory.subset_completion(_flagged(spark, sf))


@query
def distribution_by_group(spark, sf):
    placed = inventory.position_groups(_flagged(spark, sf), n=58)
    return inventory.distribution_by_group(placed, ["position_group", "done"])


@query
def top_resolutions(spark, sf):
    return inventory.top_resolutions(b.media(spark, sf), "subset", k=3)


@query
def caption_stats(spark, sf):
    return captions.caption_stats(b.captions(spark, sf), ["subset"], cap=b.TOKEN_CAP)


@query
def error_rollup(spark, sf):
    return audit.error_rollup(audit.errors_explode(b.clip_docs(spark, sf), keep=["source_video"]))


@query
def duplicate_ids(spark, sf):
    named = b.captions(spark, sf).select(uuid5(F.col("caption")).alias("clip_id"))
    return audit.duplicate_ids(named, "clip_id")


@query
def progress_snapshot(spark, sf):
    lines = stages.clean_lines(b.stage_log_lines(spark, sf))
    return stages.progress_snapshot(b.artifact_listing(spark, sf), lines)


@query
def input_volume(spark, sf):
    return inventory.input_volume(b.media(spark, sf), wall_seconds=3600)


@query
def eta_projection(spark, sf):
    done = b.runs(spark, sf).groupBy("phase").agg(F.sum("videos").alias("done"), F.sum("seconds").alias("seconds"))
    return runs.eta_projection(done.withColumn("total", F.col("done") * 2 + 10))


# ---- ordered analytics ----------------------------------------------------------------


@query
def log_line_order(spark, sf):
    return stages.log_line_order(b.stage_log_lines(spark, sf)).select("file", "line_no", "line_index")


@query
def timestamp_carry(spark, sf):
    lines = stages.clean_lines(b.stage_log_lines(spark, sf))
    return stages.timestamp_carry(lines).select("file", "line_no", "timestamp")


@query
def table_block_state(spark, sf):
    lines = stages.clean_lines(b.stage_log_lines(spark, sf))
    return stages.table_block_state(lines).select("file", "line_no", "in_table")


@query
def ready_transitions(spark, sf):
    return stages.ready_transitions(b.stage_state(spark, sf)).withColumn("ts", when_text("ts"))


@query
def position_groups(spark, sf):
    return inventory.position_groups(b.media(spark, sf)).select("media_path", "position", "position_group")


@query
def latest_per_stage(spark, sf):
    lines = stages.clean_lines(b.stage_log_lines(spark, sf))
    latest = stages.latest_per_stage(lines, sorted(b.STAGE_NUMBERS))
    return latest.select("file", "stage", "recency", "line")


@query
def cumulative_completed(spark, sf):
    total = stages.cumulative_completed(b.stage_increments(spark, sf), "finished")
    return total.select("stage_short", when_text("ts").alias("ts"), "finished", "cumulative")


@query
def tail_overshoot(spark, sf):
    return stages.tail_overshoot(b.stage_state(spark, sf), ["phase", "stage_short"], minutes=1440)


@query
def queue_boundedness(spark, sf):
    return stages.queue_boundedness(_gaps(spark, sf))


# ---- sorts, limits, pages -------------------------------------------------------------


@query
def gallery_index(spark, sf):
    return _flat_items(gallery.gallery_index(_items(spark, sf), "run"))


@query
def gallery_search(spark, sf):
    return _flat_items(gallery.gallery_search(_items(spark, sf), "  /INPUT/1 "))


@query
def gallery_search_indexed(spark, sf):
    """The same search out of a stored index of three-letter pieces."""
    folder, fields = scratch_path(spark, "search"), ("id", "source_video")
    trigram.write_search_index(_items(spark, sf), folder, fields, gallery.INDEX_ORDER)
    return _flat_items(trigram.search(spark, folder, "  /INPUT/1 ", fields))


@query
def gallery_page(spark, sf):
    """The second page of what a search finds, out of its stored index."""
    found, folder = gallery.gallery_search(_items(spark, sf), "/input/1"), scratch_path(spark, "gallery")
    ranked.write_ranked(found, folder, gallery.INDEX_ORDER)
    return _flat_items(ranked.ranked_page(spark, folder, 2, gallery.PAGE_SIZE))


@query
def video_limit(spark, sf):
    return inventory.video_limit(b.media(spark, sf), 100).select("media_path", "size_bytes")


@query
def largest_pending(spark, sf):
    return inventory.largest_pending(_flagged(spark, sf)).select("media_path", "size_bytes")


@query
def log_tail(spark, sf):
    lines = stages.clean_lines(b.stage_log_lines(spark, sf))
    return stages.log_tail(lines).select("file", "recency", "line")


@query
def stratified_review_sample(spark, sf):
    media = b.media(spark, sf).select("doc_id", (F.col("fps") >= 50).alias("high_fps"))
    flagged = captions.with_caption_flags(b.captions(spark, sf), cap=b.TOKEN_CAP)
    strata = flagged.select("doc_id", "subset", "at_cap").join(media, "doc_id")
    return captions.stratified_review_sample(strata, ["high_fps", "at_cap", "subset"], "doc_id", k=5)


# ---- set operations -------------------------------------------------------------------


@query
def phase_timeline(spark, sf):
    state = b.stage_state(spark, sf)
    timeline = stages.phase_timeline(
        state.where(F.col("phase") == "main").drop("phase"), state.where(F.col("phase") == "resume").drop("phase")
    )
    return timeline.select("phase", "stage_short", when_text("ts").alias("ts"), F.round("minute", 6).alias("minute"))


@query
def input_identity(spark, sf):
    return audit.input_identity(b.media(spark, sf), b.processed(spark, sf), "media_path")


@query
def source_coverage(spark, sf):
    inputs = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("source_id"))
    outputs = b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("source_id"))
    return audit.source_coverage(inputs, outputs, "source_id")


# ---- user functions -------------------------------------------------------------------


@query
def batched_map(spark, sf):
    texts = b.captions(spark, sf).select("doc_id", "caption")
    made = batched.batched_map(texts, fixtures.word_counter, 64, fixtures.WORD_COUNT, stage="words", keep=["doc_id"])
    return made.select("doc_id", "n_words", F.try_element_at("errors", F.lit("words")).alias("error"))


# ---- gates and audits -----------------------------------------------------------------


def _gated(spark, sf):
    return captions.caption_gate(b.captions(spark, sf), cap=b.TOKEN_CAP)


@query
def caption_gate(spark, sf):
    return _gated(spark, sf).select("doc_id", "accepted", F.array_join("reasons", ",").alias("reasons"))


@query
def gate_report(spark, sf):
    return captions.gate_report(_gated(spark, sf))


@query
def gate_precision(spark, sf):
    return captions.gate_precision(_gated(spark, sf), b.table(spark, sf, "labels"), "doc_id")


@query
def validity_rules(spark, sf):
    judged = audit.validity_rules(b.clip_docs(spark, sf))
    return judged.select("span_uuid", "n_windows", "accepted", "valid", "flag_agrees")


@query
def batch_sweep_select(spark, sf):
    daily = b.runs(spark, sf)
    measured = daily.select(
        "batch_size",
        (F.col("failures") > F.col("windows") * 2).alias("oom"),
        (F.col("failures") / (F.col("failures") + F.col("windows"))).alias("memory_share"),
        F.lit(0.0).alias("store_growth"),
        F.col("windows").alias("captions"),
        "seconds",
    )
    return runs.batch_sweep(measured).withColumn("peak_memory", F.round("peak_memory", 6))


@query
def resource_alerts(spark, sf):
    alerts = resources.resource_alerts(b.gpu_samples(spark, sf))
    return alerts.withColumns({"first_ts": when_text("first_ts", micros=True), "window_start": when_text("window_start")})


@query
def gpu_window_stats(spark, sf):
    return resources.gpu_window_stats(b.gpu_samples(spark, sf)).withColumn("window_start", when_text("window_start"))


@query
def hypothesis_verdict(spark, sf):
    measured = stages.actor_utilisation(b.stage_state(spark, sf)).select(
        F.col("stage_short").alias("hypothesis"),
        F.when(F.col("stage_short") != "error", F.col("utilisation")).alias("value"),
        F.lit(0.3).alias("threshold"),
        F.when(F.col("stage_short") == "view", "below").otherwise("above").alias("direction"),
    )
    return runs.hypothesis_verdict(measured)


@query
def preflight_gate(spark, sf):
    return runs.preflight_gate(b.media(spark, sf), gpus_needed=4, gpus=2)
