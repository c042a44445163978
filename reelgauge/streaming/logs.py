"""Parsers that follow growing logs: each new line is read once, and what lies before it is carried as state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelgauge.functions.text import leading_timestamp
from reelgauge.operators import stages
from reelgauge.streaming.monitors import replay_due

_STATE = "file string, timestamp string, in_table boolean"


def _carried_lines(state: DataFrame) -> DataFrame:
    """State as the lines that lead to it, in front of all others; they are no table rows, so they give none."""
    lines = F.array(
        F.struct(F.lit(0).cast("long").alias("line_no"), F.col("timestamp").alias("line")),
        F.struct(F.lit(1).cast("long").alias("line_no"), F.when(F.col("in_table"), F.lit(stages.STATE_HEADER)).alias("line")),
    )
    return state.select("file", F.lit(-1).cast("long").alias("block"), F.inline(lines)).where(F.col("line").isNotNull())


def _after(lines: DataFrame) -> DataFrame:
    """The last timestamp of each log and whether a table is open; folds map-side to one row per log and task."""
    at, line = F.struct("block", "line_no"), F.col("line")
    marked = lines.select("file", at.alias("at"), leading_timestamp(line).alias("timestamp"), stages.block_mark().alias("mark"))
    last = lambda name: F.max_by(name, F.when(F.col(name).isNotNull(), F.col("at")))
    return marked.groupBy("file").agg(last("timestamp").alias("timestamp"), F.coalesce(last("mark"), F.lit(False)).alias("in_table"))


def drain_stage_rows(lines: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Parse what logs have gained (``sources.growing.log_stream``) as ``stage_log_parse`` would parse the whole logs.

    A table that is open at the end of a batch, and the timestamp above it, go on in the next one: one row per log
    is carried, in a table versioned by batch id, of which two are kept. Each batch replaces its own folders when it is replayed.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = stages.table_lines(batch).persist()
        both = kept
        if batch_id > 0:
            both = _carried_lines(spark.read.schema(_STATE).parquet(f"{target}/state/batch_id={batch_id - 1}")).unionByName(kept)
        stages.stage_log_parse(both).write.mode("overwrite").parquet(f"{target}/rows/batch_id={batch_id}")
        _after(both).write.mode("overwrite").parquet(f"{target}/state/batch_id={batch_id}")
        kept.unpersist()
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/state/batch_id={batch_id - 2}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    # A start of a Python source that replays a batch ends after it, so what is new takes another start.
    for _ in range(2 if replay_due(lines.sparkSession, checkpoint) else 1):
        query = lines.writeStream.trigger(availableNow=True).foreachBatch(apply).option("checkpointLocation", checkpoint).start()
        query.awaitTermination()
    return query


def stage_rows(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all drained batches, as ``stage_log_parse`` gives them."""
    return spark.read.parquet(f"{target}/rows").drop("batch_id")
