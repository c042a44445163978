"""Registered streaming queries: each drains the driver's table to parquet and returns it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.plans import bindings as b
from reelgauge.plans import fixtures
from reelgauge.plans.batch import Query, parsed_stages, when_text
from reelgauge.session import scratch_path
from reelgauge.sources import growing
from reelgauge.streaming import logs
from reelgauge.streaming import monitors as m

STREAMS: dict[str, Query] = {}


def query(function: Query) -> Query:
    STREAMS[function.__name__] = function
    return function


def _source(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The table as a stream, be it one file or a folder of part files."""
    path, known = f"{sf}/{name}.parquet", b.table(spark, sf, name)
    if all(f.rstrip("/").endswith(f"/{name}.parquet") for f in known.inputFiles()):
        return m.file_stream(spark, sf, known.schema, glob=f"{name}.parquet")
    return m.file_stream(spark, path, known.schema)


def _captions(raw: DataFrame) -> DataFrame:
    return b.caption_columns(b.event_columns(raw))


def _fed(spark: SparkSession, rows: DataFrame, part: Column, drain: Callable[[DataFrame], object]) -> None:
    """Three parts of a table (numbered 0 to 2) come one after the other, and each is drained by a start of its own."""
    folder = scratch_path(spark, "stream-in")
    for number in range(3):
        rows.where(part == number).write.mode("append").parquet(folder)
        drain(m.file_stream(spark, folder, rows.schema))


#: Thirds of the month.
THIRD = "CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END"


def _updated(spark: SparkSession, sf: str, shape: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """Every window with its newest figures, the open ones included, over three batches."""
    target, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-cp")
    _fed(spark, b.table(spark, sf, "events"), F.expr(THIRD), lambda raw: m.drain_batches(shape(_captions(raw)), target, checkpoint, mode="update"))
    return m.newest(spark.read.parquet(target), keys)


def _windows_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({n: when_text(n, micros=True) for n in ("window_start", "window_end")})


@query
def stream_clip_plan(spark, sf):
    manifest = b.media_columns(_source(spark, sf, "documents"))
    plan = m.stream_clip_plan(manifest).select("media_path", "clip_index", "start_s", "end_s")
    target = scratch_path(spark, "stream-out")
    m.drain(plan, target, scratch_path(spark, "stream-cp"))
    return spark.read.schema(plan.schema).parquet(target)


@query
def stream_dedup_media(spark, sf):
    """Paths come again in later batches, which compare with what the earlier ones planned."""
    target, checkpoint = scratch_path(spark, "paths-out"), scratch_path(spark, "paths-cp")
    _fed(spark, b.table(spark, sf, "events"), F.expr(THIRD), lambda raw: m.drain_new_paths(_captions(raw), target, checkpoint))
    return spark.read.parquet(target).select("media_path")


@query
def stream_tumbling_rates(spark, sf):
    return _windows_as_text(_updated(spark, sf, m.stream_tumbling_rates, ["window_start", "ip"]))


@query
def stream_sliding_rates(spark, sf):
    return _windows_as_text(_updated(spark, sf, m.stream_sliding_rates, ["window_start"]))


@query
def stream_idle_sessions(spark, sf):
    """Sessions the stream gave out, and those it still holds; nothing is computed from the table itself."""
    target, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-cp")
    _fed(spark, b.table(spark, sf, "events"), F.expr(THIRD), lambda raw: m.drain(m.stream_idle_sessions(_captions(raw)), target, checkpoint))
    tail = m.open_sessions(spark, checkpoint)
    return _windows_as_text(spark.read.schema(tail.schema).parquet(target).unionByName(tail))


@query
def stream_stage_gap(spark, sf):
    target, checkpoint = scratch_path(spark, "gap-out"), scratch_path(spark, "gap-cp")
    events = b.event_columns(_source(spark, sf, "events"))
    steps = events.select(
        F.when(F.col("ts") < F.lit("2024-01-21").cast("timestamp"), "main").otherwise("resume").alias("run_id"),
        F.col("event_type").alias("stage_short"),
    )
    gaps = m.stream_stage_gap(steps, "signup", "view")
    m.drain_batches(gaps, target, checkpoint, mode="update")
    updates = spark.read.parquet(target)
    last = updates.groupBy("run_id").agg(F.max_by(F.struct(*gaps.columns), F.col("batch_id")).alias("_last"))
    return last.select("_last.*")


@query
def stream_transitions(spark, sf):
    folder = scratch_path(spark, "samples")
    state = b.stage_state(spark, sf).select("ts", "stage_short", "actors_ready")
    state.write.parquet(folder)
    target = scratch_path(spark, "transitions")
    m.stream_transitions(m.file_stream(spark, folder, state.schema), target, scratch_path(spark, "transitions-cp"))
    return m.read_transitions(spark, target).withColumn("ts", when_text("ts"))


@query
def stream_stage_log(spark, sf):
    """Logs grow between three starts and end in the middle of a line; the last batch is replayed by each start."""
    folder, target, checkpoint = scratch_path(spark, "growing"), scratch_path(spark, "log-out"), scratch_path(spark, "log-cp")
    bodies = fixtures.log_bodies(b.stage_log_lines(spark, sf))
    for share in (0.4, 0.75, 1.0):
        written = F.substring("body", F.lit(1), F.ceil(F.length("body") * share).cast("int"))
        fixtures.write_files(bodies.withColumn("body", written), folder)
        m.forget_last_commit(spark, checkpoint)
        logs.drain_stage_rows(growing.log_stream(spark, folder), target, checkpoint)
    return parsed_stages(logs.stage_rows(spark, target))


@query
def stream_idempotent_sink(spark, sf):
    """Three batches; before the second and the third start the last batch loses its commit, so it is replayed."""
    target, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "sink-cp")

    def start(raw):
        m.forget_last_commit(spark, checkpoint)
        m.drain_batches(_captions(raw), target, checkpoint)

    _fed(spark, b.table(spark, sf, "events"), F.expr(THIRD), start)
    written = spark.read.parquet(target).drop("batch_id")
    return written.withColumn("ts", when_text("ts", micros=True))


@query
def stream_late_drop(spark, sf):
    """Every fifth event comes one third later than it should; those whose window has ended by then are counted apart."""
    target, checkpoint = scratch_path(spark, "late-out"), scratch_path(spark, "late-cp")
    part = F.least(F.lit(2), F.expr(THIRD) + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0))
    _fed(spark, b.table(spark, sf, "events"), part, lambda raw: m.drain_counts(b.event_columns(raw).select("ts"), target, checkpoint))
    return m.window_counts(spark, target).select(when_text("window_start").alias("window_start"), "n", "n_late")
