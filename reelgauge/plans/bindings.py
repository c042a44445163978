"""Domain tables derived from the driver's star-schema and text tables.

No media ships with this repository, so every domain table is a projection of a driver
table; the arithmetic is repeated in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.operators.ordered import running_sum, time_block

# Stage order of the event types.
STAGE_NUMBERS = {"signup": 0, "view": 1, "click": 2, "purchase": 3, "error": 4}
LINKS = (("signup", "view"), ("view", "click"), ("click", "purchase"))
TOKEN_CAP = 256
WINDOWS_PER_CLIP = 8


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _path(source: Column, doc_id: Column) -> Column:
    return F.concat(F.lit("/input/"), source, F.lit("/"), doc_id.cast("string"), F.lit(".mp4"))


def media_columns(docs: DataFrame) -> DataFrame:
    """The manifest of a documents table; works on streams too."""
    doc, kind = F.col("doc_id"), F.pmod(F.col("doc_id"), F.lit(4))
    pick = lambda *options: F.element_at(F.array(*[F.lit(o) for o in options]), (kind + 1).cast("int"))
    return docs.select(
        "doc_id",
        _path(F.col("source"), doc).alias("media_path"),
        F.col("source").alias("subset"),
        (F.col("n_chars") * 37).alias("size_bytes"),
        (F.col("n_chars") / F.lit(50.0)).alias("duration_s"),
        F.when(doc % 14 == 0, 60.0).when(doc % 3 == 0, 25.0).otherwise(30.0).alias("fps"),
        pick(256, 640, 1280, 1920).alias("width"),
        pick(144, 360, 720, 1080).alias("height"),
        (F.col("n_chars") * 8 + kind * 1000).alias("bitrate"),
    )


def media(spark: SparkSession, sf: str) -> DataFrame:
    return media_columns(table(spark, sf, "documents").select("doc_id", "source", "n_chars"))


def processed(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents count as processed; the manifest gives their path."""
    labels = table(spark, sf, "labels").select("doc_id")
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return docs.join(labels, "doc_id", "left_semi").select(_path(F.col("source"), F.col("doc_id")).alias("media_path"))


def captions(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.col("text").alias("caption"), F.col("lang").alias("subset"))


def clip_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Caption windows in long form: eight turns of a conversation make one clip."""
    turns = table(spark, sf, "conversations")
    number = F.floor(F.col("turn") / WINDOWS_PER_CLIP).cast("bigint")
    place = F.pmod(F.col("turn"), F.lit(WINDOWS_PER_CLIP)).cast("int")
    return turns.select(
        F.concat_ws("-", "conv_id", number).alias("clip_id"),
        F.col("conv_id").alias("clip_no"),
        place.alias("place"),
        "role",
        "text",
    )


def clip_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Nested metadata documents; a document holds at most eight windows."""
    no = F.col("clip_no")
    key = F.when(F.col("role") == "system", "system_note").otherwise(F.concat("role", F.lit("_caption")))
    entry = F.struct("place", key.alias("key"), "text")
    nested = clip_windows(spark, sf).groupBy("clip_id", "clip_no").agg(F.array_sort(F.collect_list(entry)).alias("_w"))

    def window(w: Column) -> Column:
        names = F.array(F.lit("start_frame"), F.lit("end_frame"), w["key"])
        values = F.array((w["place"] * 256).cast("string"), ((w["place"] + 1) * 256).cast("string"), w["text"])
        return F.map_from_arrays(names, values)

    message = F.concat(F.lit("code "), (no % 7).cast("string"))
    stage = F.element_at(F.array(F.lit("transcode"), F.lit("caption"), F.lit("write")), (no % 3 + 1).cast("int"))
    return nested.select(
        F.col("clip_id").alias("span_uuid"),
        "clip_no",
        F.concat(F.lit("/input/"), (no % 20).cast("string"), F.lit(".mp4")).alias("source_video"),
        F.array((no * 10).cast("double"), (no * 10 + 10).cast("double")).alias("duration_span"),
        F.lit(1280).alias("width"),
        F.lit(720).alias("height"),
        F.lit(30.0).alias("framerate"),
        F.concat(F.lit("/run/clips/"), "clip_id", F.lit(".mp4")).alias("clip_location"),
        F.concat(F.lit("/run/metas/v0/"), "clip_id", F.lit(".json")).alias("metadata_path"),
        F.transform("_w", window).alias("windows"),
        (no % 5 != 0).alias("valid"),
        F.when(no % 6 == 0, F.create_map(stage, message)).alias("errors"),
    )


def clip_files(spark: SparkSession, sf: str) -> DataFrame:
    """Existing clip files: every tenth conversation lost its clip."""
    clips = clip_windows(spark, sf).select("clip_id", "clip_no").distinct()
    return clips.where(F.col("clip_no") % 10 != 0).select(
        F.concat(F.lit("/run/clips/"), "clip_id", F.lit(".mp4")).alias("path"),
        (F.col("clip_no") * 100 + 7).alias("size_bytes"),
    )


def artifact_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a run folder: clips, their metadata, and video and chunk markers."""
    clips = clip_files(spark, sf).select(F.substring("path", F.lit(6), F.length("path")).alias("relative_path"), "size_bytes")
    metas = clip_windows(spark, sf).groupBy("clip_id").agg(F.sum(F.length("text")).alias("size_bytes"))
    metas = metas.select(F.concat(F.lit("metas/v0/"), "clip_id", F.lit(".json")).alias("relative_path"), "size_bytes")
    source = clip_windows(spark, sf).select((F.col("clip_no") % 20).alias("n")).distinct()
    marks = F.array(
        F.concat(F.lit("processed_videos/"), F.col("n").cast("string"), F.lit(".json")),
        F.concat(F.lit("processed_clip_chunks/"), F.col("n").cast("string"), F.lit("_0.json")),
        F.concat(F.lit("logs/run"), F.col("n").cast("string")),
    )
    marks = source.select(F.explode(marks).alias("relative_path"), F.lit(2).cast("bigint").alias("size_bytes"))
    return clips.unionByName(metas).unionByName(marks)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return event_columns(table(spark, sf, "events"))


def event_columns(raw: DataFrame) -> DataFrame:
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def stage_name(kind: Column) -> Column:
    number = F.create_map(*[F.lit(x) for pair in STAGE_NUMBERS.items() for x in pair])
    return F.format_string("Stage %02d - %s", number[kind], kind)


def stage_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Per hour and stage: finished tasks and what the hour looked like.

    Users are folded per hour first, so a hot event type never gathers in one task.
    """
    per_user = (
        events(spark, sf)
        .groupBy(F.date_trunc("hour", "ts").alias("ts"), F.col("event_type").alias("stage_short"), "user_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max((F.col("value") >= 50).cast("int")).alias("_busy"),
            F.count_if(F.col("value") < 20).alias("_queued"),
        )
    )
    return per_user.groupBy("ts", "stage_short").agg(
        F.sum("_n").alias("finished"),
        F.count(F.lit(1)).alias("actors_ready"),
        F.sum("_busy").alias("actors_running"),
        F.sum("_queued").alias("input_queue"),
    )


def stage_state(spark: SparkSession, sf: str) -> DataFrame:
    blocked = stage_increments(spark, sf).withColumn("_block", time_block(F.col("ts"), 86_400))
    total = running_sum(blocked, "finished", ["stage_short"], "_block", ["ts"], "tasks_completed").drop("_block")
    return total.select(
        "ts",
        stage_name(F.col("stage_short")).alias("stage"),
        "stage_short",
        F.when(F.col("ts") < F.lit("2024-01-21").cast("timestamp"), "main").otherwise("resume").alias("phase"),
        "finished",
        "actors_ready",
        "actors_running",
        (F.col("actors_ready") - F.col("actors_running")).alias("actors_idle"),
        "tasks_completed",
        "input_queue",
        (F.col("input_queue") * 2).alias("output_queue"),
        (F.col("finished") / F.lit(3600.0)).alias("tasks_per_actor_s"),
    )


def stage_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``stage_state`` as raw log lines with colour codes and noise: one log per day.

    ``line_no`` is the hour with a place inside the hour; ``block`` cuts a day in four.
    """
    state = stage_state(spark, sf)
    hour = F.col("ts")
    stamp = F.concat(F.date_format(hour, "yyyy-MM-dd HH:mm:ss"), F.lit(".000000"))
    column = lambda name: F.col(name).cast("string")
    cells = F.concat_ws(
        " │ ", F.lit("0"), F.lit("0"), column("actors_ready"), column("actors_running"), column("actors_idle"),
        column("tasks_completed"), F.lit("0"), column("input_queue"), column("output_queue"), F.lit("1"), F.lit(""),
        F.format_string("%.5f", "tasks_per_actor_s"),
    )
    number = F.substring("stage", 7, 2).cast("int")
    rows = state.select("ts", (F.lit(10) + number).alias("k"), F.concat(F.lit("│ "), "stage", F.lit("  │ "), cells, F.lit(" │")).alias("line"))
    at = lambda k, line: F.struct(F.lit(k).alias("k"), line.alias("line"))
    hour_no = F.hour(hour)
    frame = F.array(
        at(0, F.concat(stamp, F.lit(" | \x1b[32mINFO\x1b[0m | monitor"))),
        at(1, F.lit("Stage state:")),
        at(2, F.lit("╒═════════╤════════╕")),
        at(3, F.lit("│ Stage   │ Target │")),
        at(20, F.lit("╘═════════╧════════╛")),
        at(21, F.lit("│ Stage 99 - Noise │ 1 │ 2 │ 3 │ 4 │ 5 │ 6 │ 7 │ 8 │ 9 │ 10 │ 11 │ 12 │")),
        at(22, F.when(hour_no == 5, "\x1b[31mERROR\x1b[0m worker lost").when(hour_no == 6, "Caption for clip ready").otherwise("idle")),
        at(23, F.concat(F.lit("Generated "), hour_no.cast("string"), F.lit(" captions for video"))),
    )
    fixed = state.select("ts").distinct().select("ts", F.inline(frame))
    seconds = F.unix_seconds(hour)
    return rows.unionByName(fixed).select(
        F.concat(F.lit("log-"), F.date_format(hour, "yyyy-MM-dd")).alias("file"),
        F.floor(seconds / 21_600).cast("bigint").alias("block"),
        (seconds * 100 + F.col("k")).alias("line_no"),
        "line",
    )


def caption_columns(raw: DataFrame) -> DataFrame:
    """Clicks as caption events; works on streams too."""
    user = F.col("user_id")
    return raw.where(F.col("event_type") == "click").select(
        F.concat(F.lit("10.0.0."), (user % 4).cast("string")).alias("ip"),
        "ts",
        (user % 7 + 1).cast("int").alias("n_captions"),
        F.concat(F.lit("/input/"), user.cast("string"), F.lit(".mp4")).alias("media_path"),
    )


def caption_events(spark: SparkSession, sf: str) -> DataFrame:
    return caption_columns(events(spark, sf))


def caption_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a log line; clicks are caption-generation lines."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    head = F.concat(
        F.lit("\x1b[36m(CaptionGenerationStage pid="), F.col("user_id").cast("string"), F.lit(", ip=10.0.0."),
        (F.col("user_id") % 4).cast("string"), F.lit(")\x1b[0m "), stamp,
    )
    made = F.concat(
        F.lit(" | INFO | Generated "), (F.col("user_id") % 7 + 1).cast("string"), F.lit(" captions for \x1b[1mvideo\x1b[0m /input/"),
        F.col("user_id").cast("string"), F.lit(".mp4 chunk-0"),
    )
    other = F.concat(F.lit(" | INFO | "), "event_type")
    line = F.concat(head, F.when(F.col("event_type") == "click", made).otherwise(other))
    return events(spark, sf).select(
        F.lit("captions.log").alias("file"),
        time_block(F.col("ts")).alias("block"),
        F.col("event_id").alias("line_no"),
        line.alias("line"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """One run per event day."""
    day = F.date_trunc("day", "ts")
    count = lambda kind: F.count_if(F.col("event_type") == kind)
    daily = events(spark, sf).groupBy(day.alias("day")).agg(
        count("purchase").alias("videos"),
        count("view").alias("clips"),
        count("click").alias("windows"),
        count("error").alias("failures"),
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
    )
    number = F.dayofmonth("day")
    size = F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4)), (number % 3 + 1).cast("int"))
    return daily.select(
        F.date_format("day", "yyyy-MM-dd").alias("run_id"),
        F.concat(F.lit("input-"), (number % 2).cast("string")).alias("input_id"),
        F.when(number <= 20, "main").otherwise("resume").alias("phase"),
        size.alias("batch_size"),
        "videos", "clips", "windows", "failures", "start_ts", "end_ts",
        (F.unix_seconds("end_ts") - F.unix_seconds("start_ts")).alias("seconds"),
    )


def gpu_samples(spark: SparkSession, sf: str) -> DataFrame:
    user = F.col("user_id")
    scaled = F.round(F.col("value") * 100).cast("bigint")
    return events(spark, sf).select(
        "event_id",
        "ts",
        (user % 4).cast("int").alias("gpu"),
        F.concat(F.lit("host-"), (user % 3).cast("string")).alias("host"),
        (scaled % 100).alias("utilization"),
        (scaled % 4600).alias("memory_used"),
        F.lit(4600).cast("bigint").alias("memory_total"),
        (scaled % 350).alias("power"),
        (scaled % 1000).alias("disk_free"),
        F.lit(1000).cast("bigint").alias("disk_total"),
        (scaled % 300).alias("store_used"),
        F.lit(300).cast("bigint").alias("store_capacity"),
    )
