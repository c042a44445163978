"""Live forms of the planning and monitoring operators.

Each function takes a streaming DataFrame and returns one, or wires a sink. Event time
needs TIMESTAMP columns; cast TIMESTAMP_NTZ before calling.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from reelgauge.operators.ordered import attach, previous_value, time_block
from reelgauge.operators.planning import fixed_stride_spans
from reelgauge.streaming import seen


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    file_format: str = "parquet",
    files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Files of a folder as a stream; ``files_per_trigger`` bounds the active window."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def drain(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write everything available to parquet and stop; a restart goes on where it ended."""
    writer = stream.writeStream.format("parquet").outputMode(mode).trigger(availableNow=True)
    query = writer.option("path", target).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query


def _last_batch(spark: SparkSession, folder: str) -> int:
    """The highest batch id of a log in a checkpoint, -1 if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(where)] if system.exists(where) else []
    return max([int(n) for n in names if n.isdigit()], default=-1)


def replay_due(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the last batch of a stream was planned and not committed, so that its next start does it again."""
    return _last_batch(spark, f"{checkpoint}/offsets") > _last_batch(spark, f"{checkpoint}/commits")


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Leave a checkpoint as a driver does that is lost after a batch has written and before it has committed; if there is none, do nothing."""
    last = _last_batch(spark, f"{checkpoint}/commits")
    if last >= 0:
        _remove(spark, f"{checkpoint}/commits/{last}")


def drain_batches(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    mode: str = "append",
    shape: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Write each micro-batch to its own ``batch_id`` folder, replacing an earlier attempt.

    A batch that is replayed after a crash overwrites itself, so restarts add no row twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        shaped = shape(batch, batch_id) if shape else batch
        shaped.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).foreachBatch(write)
    query = writer.option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query


def stream_clip_plan(manifest: DataFrame, **params) -> DataFrame:
    """Arriving manifest rows to clip spans; stateless, so nothing is held back."""
    return fixed_stride_spans(manifest, **params)


def drain_new_paths(arrivals: DataFrame, target: str, checkpoint: str, path: str = "media_path") -> StreamingQuery:
    """Plan every arriving path once, however late it comes again and however input is cut into batches.

    Each batch folds its repeats (map-side, so a path that keeps re-arriving is no hot spot), leaves out what earlier
    batches have planned, and replaces its own folder when it is replayed. Planned paths are known by ``seen``, whose index
    lies in ``_index`` of the target, which readers of the table pass over: a batch without repeats opens filters only.
    """
    index = f"{target}/_index"

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = batch.select(path).distinct().persist()
        folder = f"{target}/batch_id={batch_id}"
        seen.unseen(paths, path, index, batch_id).write.mode("overwrite").parquet(folder)
        seen.remember(batch.sparkSession.read.schema(paths.schema).parquet(folder), path, index, batch_id)
        paths.unpersist()

    query = arrivals.writeStream.trigger(availableNow=True).foreachBatch(write).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query


def newest(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last update of every key, from a table of update batches: windows still open are in it."""
    rows = F.struct(*[c for c in updates.columns if c != "batch_id"])
    return updates.groupBy(*keys).agg(F.max_by(rows, "batch_id").alias("_last")).select("_last.*")


def _rates(grouped, minutes: float) -> DataFrame:
    return grouped.agg(
        F.count(F.lit(1)).alias("n_videos"),
        F.sum("n_captions").alias("n_captions"),
    ).withColumns(
        {
            "videos_per_min": F.round(F.col("n_videos") / F.lit(minutes), 6),
            "captions_per_min": F.round(F.col("n_captions") / F.lit(minutes), 6),
        }
    )


def _flat_window(df: DataFrame) -> DataFrame:
    return df.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")


def stream_tumbling_rates(events: DataFrame, minutes: int = 10, delay: str = "10 minutes") -> DataFrame:
    """Videos and captions per host and fixed window."""
    windowed = events.withWatermark("ts", delay).groupBy(F.window("ts", f"{minutes} minutes"), "ip")
    return _flat_window(_rates(windowed, float(minutes)))


def stream_sliding_rates(
    events: DataFrame, minutes: int = 30, every: int = 5, delay: str = "10 minutes"
) -> DataFrame:
    """The trailing rate over all hosts, refreshed every few minutes."""
    windowed = events.withWatermark("ts", delay).groupBy(F.window("ts", f"{minutes} minutes", f"{every} minutes"))
    return _flat_window(_rates(windowed, float(minutes)))


def stream_idle_sessions(events: DataFrame, idle: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Bursts of activity per host, split where nothing happened for ``idle``.

    ``window_end`` is the last event plus the idle time. Events of a host merge into
    sessions inside each input task before they shuffle (``SESSION_CONF`` asks for it), so a
    busy host is no hot spot. A session is given out once the watermark has passed its end:
    the open tail of each host is in ``open_sessions``.
    """
    sessions = events.withWatermark("ts", delay).groupBy(F.session_window("ts", idle).alias("window"), "ip")
    return _flat_window(sessions.agg(F.count(F.lit(1)).alias("n_videos"), F.sum("n_captions").alias("n_captions")))


def open_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sessions a drained ``stream_idle_sessions`` query still holds: the open tail of each host, out of its state store."""
    held = spark.read.format("statestore").load(checkpoint).select("value.*")
    window = F.col("session_window")
    return held.select(
        "ip", F.col("count").alias("n_videos"), F.col("sum").alias("n_captions"), window["start"].alias("window_start"), window["end"].alias("window_end")
    )


def stream_stage_gap(events: DataFrame, upstream: str, downstream: str, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Completed upstream minus downstream per run so far; use update mode.

    Both counts live in one state row, so no stream-stream join is needed and map-side
    combine folds the events of a hot stage.
    """
    counted = events.where(F.col("stage_short").isin(upstream, downstream)).groupBy(*keys).agg(
        F.count_if(F.col("stage_short") == upstream).alias("up_completed"),
        F.count_if(F.col("stage_short") == downstream).alias("down_completed"),
    )
    gap = F.greatest(F.col("up_completed") - F.col("down_completed"), F.lit(0))
    return counted.withColumn("gap", gap)


def stream_counts(events: DataFrame, delay: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Events per window; rows older than the watermark are dropped. Use update mode."""
    return _flat_window(events.withWatermark("ts", delay).groupBy(F.window("ts", window)).agg(F.count(F.lit(1)).alias("n")))


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows the state operators reported; aggregations count them after map-side combine, so this is a lower bound.

    ``drain_counts`` counts them exactly.
    """
    return sum(
        operator.numRowsDroppedByWatermark for progress in query.recentProgress for operator in progress.stateOperators
    )


def drain_counts(events: DataFrame, target: str, checkpoint: str, delay: str = "10 minutes", window: str = "1 hour") -> StreamingQuery:
    """Events per window, with every late row counted and kept.

    The watermark is carried beside the counts: it is the newest time of all earlier batches less ``delay``, as Spark's own.
    A row is late if its window had ended by then. So all rows of a window in one batch are late or none is, and
    rows can fold map-side before they are told apart; a busy window is no hot spot. Each batch writes its counts, its late rows
    and the carried time to folders of its own, and replaces them if it is replayed. Read with ``window_counts``; ``late_rows``
    has the rows themselves, for a second pass.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = None
        if batch_id > 0:
            mark = spark.read.schema("ts timestamp").parquet(f"{target}/mark/batch_id={batch_id - 1}").first()["ts"]
        held = F.lit(mark).cast("timestamp")
        rows = batch.where(F.col("ts").isNotNull()).persist()
        late = F.coalesce(F.window("ts", window)["end"] <= held - F.expr(f"INTERVAL {delay}"), F.lit(False))
        rows.where(late).write.mode("overwrite").parquet(f"{target}/late/batch_id={batch_id}")
        counts = rows.groupBy(F.window("ts", window)).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"))
        is_late = F.coalesce(F.col("window_end") <= held - F.expr(f"INTERVAL {delay}"), F.lit(False))
        _flat_window(counts).withColumn("late", is_late).write.mode("overwrite").parquet(f"{target}/counts/batch_id={batch_id}")
        rows.unpersist()
        written = spark.read.schema("newest timestamp").parquet(f"{target}/counts/batch_id={batch_id}")
        written.agg(F.greatest(F.max("newest"), held).alias("ts")).coalesce(1).write.mode("overwrite").parquet(f"{target}/mark/batch_id={batch_id}")

    writer = events.writeStream.trigger(availableNow=True).foreachBatch(apply)
    query = writer.option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query


def window_counts(spark: SparkSession, target: str) -> DataFrame:
    """window_start, window_end, n (rows in time) and n_late of a drained ``drain_counts``."""
    counts = spark.read.schema("n long, window_start timestamp, window_end timestamp, late boolean, batch_id long").parquet(f"{target}/counts")
    return counts.groupBy("window_start", "window_end").agg(
        F.sum(F.when(~F.col("late"), F.col("n")).otherwise(0)).alias("n"), F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)).alias("n_late")
    )


def late_rows(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/late").drop("batch_id")


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stream_transitions(
    samples: DataFrame,
    target: str,
    checkpoint: str,
    keys: tuple[str, ...] = ("stage_short",),
    block_seconds: int = 3600,
) -> StreamingQuery:
    """Append a row whenever the ready-actor count of a stage changes, across batches.

    Inside a batch the series is compared block by block in event-time order, so a hot
    stage is spread over tasks instead of being fed to one keyed function. Only the latest
    value per stage is carried to the next batch, as a table versioned by batch id: a replay needs
    the version before its own, so the one before that is removed. Each batch is read once. Samples
    older than the carried time of their stage are late and dropped.
    """
    key_list = list(keys)
    state_dir = f"{target}/state"

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        slim = batch.select(*key_list, "ts", F.col("actors_ready").cast("bigint").alias("ready"))
        slim = slim.withColumn("_block", time_block(F.col("ts"), block_seconds)).persist()
        state_schema = slim.select(*key_list, "ts", "ready").schema
        if batch_id == 0:
            before = spark.createDataFrame([], state_schema)
        else:
            before = spark.read.schema(state_schema).parquet(f"{state_dir}/batch_id={batch_id - 1}")
        held = before.select(*key_list, F.col("ts").alias("_held_ts"), F.col("ready").alias("_held"))
        fresh = attach(slim, held, key_list).where(F.col("_held_ts").isNull() | (F.col("ts") > F.col("_held_ts")))
        paired = previous_value(fresh, "ready", key_list, "_block", ["ts"], "_prev")
        previous = F.when(F.col("_prev").isNotNull(), F.col("_prev.value")).otherwise(F.col("_held"))
        is_first = F.col("_prev").isNull() & F.col("_held_ts").isNull()
        changed = paired.where(is_first | ~previous.eqNullSafe(F.col("ready")))
        changed = changed.select(*key_list, "ts", "ready", previous.alias("ready_before"))
        changed.write.mode("overwrite").parquet(f"{target}/changes/batch_id={batch_id}")
        merged = before.unionByName(fresh.select(*key_list, "ts", "ready"))
        latest = merged.groupBy(*key_list).agg(F.max_by(F.struct("ts", "ready"), F.col("ts")).alias("_s"))
        latest.select(*key_list, "_s.*").write.mode("overwrite").parquet(f"{state_dir}/batch_id={batch_id}")
        slim.unpersist()
        _remove(spark, f"{state_dir}/batch_id={batch_id - 2}")

    writer = samples.writeStream.trigger(availableNow=True).foreachBatch(apply)
    query = writer.option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query


def read_transitions(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/changes").drop("batch_id")
