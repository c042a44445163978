"""Table schemas and the run configuration."""

from __future__ import annotations


from pyspark.sql import types as T

MEDIA_PROBE = T.StructType(
    [
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("fps", T.DoubleType()),
        T.StructField("bitrate", T.LongType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("size_bytes", T.LongType()),
    ]
)

# Caption keys differ from run to run, so windows are maps and never inferred.
CLIP_DOCUMENT = T.StructType(
    [
        T.StructField("span_uuid", T.StringType()),
        T.StructField("source_video", T.StringType()),
        T.StructField("duration_span", T.ArrayType(T.DoubleType())),
        T.StructField("width_source", T.IntegerType()),
        T.StructField("height_source", T.IntegerType()),
        T.StructField("framerate_source", T.DoubleType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("framerate", T.DoubleType()),
        T.StructField("clip_location", T.StringType()),
        T.StructField("windows", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("valid", T.BooleanType()),
        T.StructField("errors", T.VariantType()),
    ]
)

PROCESSED_MARKER = T.StructType([T.StructField("video", T.StringType())])

SHARD_MEMBER = T.StructType(
    [
        T.StructField("shard", T.StringType()),
        T.StructField("member_index", T.IntegerType()),
        T.StructField("member_path", T.StringType()),
        T.StructField("suffix", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("is_unsafe", T.BooleanType()),
        T.StructField("payload", T.BinaryType()),
    ]
)

# Fixed value: column order of the stage time series.
STAGE_COLUMNS = (
    "timestamp",
    "stage",
    "actors_target",
    "actors_pending",
    "actors_ready",
    "actors_running",
    "actors_idle",
    "tasks_completed",
    "tasks_returned_none",
    "input_queue",
    "output_queue",
    "slots_used",
    "slots_empty",
    "tasks_per_actor_s",
)

STAGE_TEXT = T.StructType([T.StructField(name, T.StringType()) for name in STAGE_COLUMNS])

GPU_TEXT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("timestamp", "index", "utilization", "memory_used", "memory_total", "power")
    ]
)

RUN_REPORT = T.StructType(
    [
        T.StructField("artifacts", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("config", T.MapType(T.StringType(), T.StringType())),
        T.StructField("environment", T.MapType(T.StringType(), T.StringType())),
        T.StructField("error", T.StringType()),
        T.StructField("execution_mode", T.StringType()),
        T.StructField("output_tasks", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("stage_metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("stages", T.ArrayType(T.StringType())),
        T.StructField("status", T.StringType()),
        T.StructField("throughput_clips_per_s", T.DoubleType()),
        T.StructField("throughput_videos_per_s", T.DoubleType()),
        T.StructField("wall_time_s", T.DoubleType()),
    ]
)
