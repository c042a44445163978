"""Products of one run folder: what a user asks about a run that is on disk.

The folder holds ``clips/``, ``metas/v0/``, ``processed_videos/`` and
``processed_clip_chunks/``. A folder that does not exist yet counts as empty.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelgauge.functions.paths import plain_path
from reelgauge.operators import audit, gallery, inventory, planning, stages
from reelgauge.schemas import CLIP_DOCUMENT, RUN_REPORT
from reelgauge.sources import files, sinks


def _or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: str | StructType) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_listing(spark: SparkSession, run_dir: str) -> DataFrame:
    """Every file of the run with its path relative to the run folder."""
    root = run_dir.rstrip("/")
    listed = _or_empty(spark, lambda: files.list_files(spark, root), "path string, size_bytes bigint, modified timestamp")
    prefix = F.length(plain_path(F.lit(root)))
    return listed.withColumn("relative_path", F.substring("path", prefix + 2, F.length("path")))


def run_documents(spark: SparkSession, run_dir: str, recursive: bool = True) -> DataFrame:
    folder = f"{run_dir.rstrip('/')}/metas/v0"
    empty = StructType([*CLIP_DOCUMENT.fields, StructField("metadata_path", StringType())])
    return _or_empty(spark, lambda: files.clip_meta_read(spark, folder, recursive), empty)


def artifact_report(spark: SparkSession, run_dir: str) -> DataFrame:
    """File, byte, suffix, clip, metadata, validity and caption figures as (metric, suffix, value) rows."""
    return audit.artifact_metrics(run_listing(spark, run_dir), run_documents(spark, run_dir))


def progress(spark: SparkSession, run_dir: str, log: str) -> DataFrame:
    """Artifact counts and log markers right now, as one row."""
    lines = stages.clean_lines(files.read_log_lines(spark, log))
    return stages.progress_snapshot(run_listing(spark, run_dir), lines)


def run_gallery(spark: SparkSession, run_dir: str, page_size: int = gallery.PAGE_SIZE) -> DataFrame:
    """The sorted index of a run's clips whose files exist."""
    root = run_dir.rstrip("/")
    items = gallery.gallery_items(run_documents(spark, root, recursive=False), run_listing(spark, root), root)
    return gallery.gallery_index(items, root.rsplit("/", 1)[-1], page_size)


def processed_media(spark: SparkSession, run_dir: str) -> DataFrame:
    folder = f"{run_dir.rstrip('/')}/processed_videos"
    return _or_empty(spark, lambda: files.processed_read(spark, folder), "media_path string")


def pending_media(spark: SparkSession, input_path: str, run_dir: str) -> DataFrame:
    """Inputs the run has not finished, in path order: the list for a recovery run."""
    return inventory.pending_inputs(files.media_inventory(spark, input_path), processed_media(spark, run_dir))


def processed_chunks(spark: SparkSession, run_dir: str) -> DataFrame:
    """One row per chunk marker file with the source it belongs to; markers have the shape of video markers."""
    folder = f"{run_dir.rstrip('/')}/processed_clip_chunks"
    return _or_empty(spark, lambda: files.marker_read(spark, folder), "media_path string, marker_path string")


def selected_inputs(spark: SparkSession, folder: str, listed: str | None = None, first: int | None = None) -> DataFrame:
    """The inputs a run will take: the explicit list in its order, else the inventory by path; of these the first."""
    if listed is None:
        return inventory.video_limit(files.media_inventory(spark, folder, required=False), first)
    sizes = files.list_files(spark, folder).withColumnRenamed("path", "media_path")
    chosen = inventory.video_limit(files.input_list(spark, listed), first, "list_position")
    return chosen.join(sizes, "media_path", "left")


def input_problems(spark: SparkSession, folder: str, listed: str | None = None) -> list[str]:
    """Names what is not there of the input folder and the input list."""
    problems = []
    for what, path, kind in (("input folder", folder, "binaryFile"), ("input list", listed, "text")):
        try:
            if path is not None:
                spark.read.format(kind).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            problems.append(f"{what} {path} does not exist")
    return problems


def run_report(
    spark: SparkSession, run_dir: str, run_id: str, wall_time_s: float, execution_mode: str, settings: Mapping[str, str] | None = None,
    error: str | None = None, stage_sums: Mapping[str, float] | None = None,
) -> DataFrame:
    """One report row computed from what the run left in its folder: artifacts and throughput; ``stage_sums`` come from the run itself."""
    listing, docs = run_listing(spark, run_dir), run_documents(spark, run_dir)
    figures = audit.artifact_metrics(listing, docs)
    named = figures.select(F.concat_ws("_", "metric", "suffix").alias("name"), F.col("value").cast("double").alias("value"))
    artifacts = named.agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("artifacts"))  # one entry per file suffix
    done = processed_media(spark, run_dir).agg(F.count(F.lit(1)).alias("videos"))
    clips = listing.agg(F.count_if(F.col("relative_path").startswith("clips/") & F.col("relative_path").endswith(".mp4")).alias("clips"))
    per_s = lambda n: F.try_divide(n.cast("double"), F.lit(float(wall_time_s)))
    both = artifacts.select("artifacts", done.select("videos").scalar().alias("videos"), clips.select("clips").scalar().alias("clips"))
    known = {
        "artifacts": F.col("artifacts"),
        "config": F.create_map(*[F.lit(x) for pair in sorted((settings or {}).items()) for x in pair]).cast("map<string,string>"),
        "error": F.lit(error).cast("string"),
        "execution_mode": F.lit(execution_mode),
        "output_tasks": F.col("videos"),
        "run_id": F.lit(run_id),
        "stage_metrics": F.create_map(
            F.lit("videos_done"), F.col("videos").cast("double"), F.lit("clips_written"), F.col("clips").cast("double"),
            *[F.lit(x) for name, value in sorted((stage_sums or {}).items()) for x in (name, float(value))],
        ),
        "status": F.lit("failed" if error else "succeeded"),
        "throughput_clips_per_s": per_s(F.col("clips")),
        "throughput_videos_per_s": per_s(F.col("videos")),
        "wall_time_s": F.lit(float(wall_time_s)),
    }
    return both.select(*[known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in RUN_REPORT.fields])


class StageSums:
    """Sums that the stages of a run report while they are written."""

    def __init__(self) -> None:
        self.sums: dict[str, float] = {}

    def run(self, stage: str, df: DataFrame, action: Callable[[DataFrame], object], **measures: Column) -> None:
        """Do ``action`` (which has to run the table, such as a write) and add the stage's rows, seconds and measures.

        Spark takes the sums while the action's tasks run; the table is not read again.
        """
        seen, begin = Observation(), time.monotonic()
        action(df.observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(name) for name, m in measures.items())))
        for name, value in {**seen.get, "seconds": time.monotonic() - begin}.items():
            self.sums[f"{stage}_{name}"] = self.sums.get(f"{stage}_{name}", 0.0) + float(value or 0)


@contextmanager
def recorded_run(
    spark: SparkSession, run_dir: str, reports: str, run_id: str, execution_mode: str, settings: Mapping[str, str] | None = None
) -> Iterator[StageSums]:
    """Append the run's report to ``reports`` when the block ends, however it ends.

    A block that raises leaves a ``failed`` report with its error, the artifacts written so far and the sums of the stages that were
    done, and the error goes on.
    """
    stages_, begin = StageSums(), time.monotonic()

    def write(error: str | None) -> None:
        row = run_report(spark, run_dir, run_id, time.monotonic() - begin, execution_mode, settings, error, stages_.sums)
        sinks.run_report_write(row, reports)

    try:
        yield stages_
    except BaseException as error:
        write(f"{type(error).__name__}: {error}")
        raise
    write(None)


def conservation(spark: SparkSession, run_dir: str, media: DataFrame, rule: planning.PlanRule = planning.PlanRule()) -> DataFrame:
    """Planned against written clips, metadata, chunk and video markers per source, with errors as the explanation.

    ``media`` has media_path, duration_s and fps.
    """
    plan = planning.plan_run(media.select("media_path", "duration_s", "fps"), replace(rule, windows=None))
    counted = plan.groupBy("media_path").agg(F.count(F.lit(1)).alias("clips"))
    n = F.coalesce("clips", F.lit(0).cast("bigint"))
    expected = media.select("media_path").distinct().join(counted, "media_path", "left").select(
        "media_path", n.alias("clips"), n.alias("metas"), F.ceil(n / rule.chunk).alias("chunks"), F.lit(1).cast("bigint").alias("videos")
    )
    docs = run_documents(spark, run_dir)
    present = run_listing(spark, run_dir).select(F.col("path").alias("clip_location"), F.lit(1).alias("_file"))
    written = (
        docs.select(F.col("source_video").alias("media_path"), "clip_location")
        .join(present, "clip_location", "left")
        .groupBy("media_path")
        .agg(F.count("_file").alias("clips"), F.count(F.lit(1)).alias("metas"))
    )
    marked = processed_media(spark, run_dir).select("media_path", F.lit("videos").alias("kind")).unionByName(
        processed_chunks(spark, run_dir).distinct().select("media_path", F.lit("chunks").alias("kind"))
    )
    marked = marked.groupBy("media_path").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("chunks", "videos")])
    written = written.join(marked, "media_path", "full").na.fill(0, ["clips", "metas", "chunks", "videos"])
    failures = audit.errors_explode(docs, keep=["source_video"]).withColumnRenamed("source_video", "media_path")
    return audit.conservation_audit(expected, written, failures, ["media_path"], ["clips", "metas", "chunks", "videos"])
