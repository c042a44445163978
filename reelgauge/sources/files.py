"""Readers for media folders, input lists, metadata documents, logs and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.functions.numeric import rate
from reelgauge.functions.paths import MEDIA_SUFFIXES, is_media, plain_path, plain_uri
from reelgauge.schemas import CLIP_DOCUMENT, GPU_TEXT, PROCESSED_MARKER, RUN_REPORT, STAGE_TEXT
from reelgauge.sources.listing import can_list, list_levels


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``: path, size_bytes, modified. File content is never read.

    Spark plans listing tasks by file length; on folders of very large files set
    ``spark.sql.files.maxPartitionNum`` to keep them few.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return listed.select(
        plain_path(F.col("path")).alias("path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified")
    )


def media_inventory(
    spark: SparkSession, root: str, suffixes: Sequence[str] = MEDIA_SUFFIXES, required: bool = True
) -> DataFrame:
    """Media files below ``root`` in path order; an empty result is an error when ``required``.

    Folders are listed by executors level by level. A root that workers can't open, or that has wildcards or doesn't exist, goes to Spark's
    own listing, which passes through the driver (and names a missing root).
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    spread = can_list(root) and where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    listed = list_levels(spark, root) if spread else list_files(spark, root)
    found = listed.withColumn("path", plain_path(F.col("path"))).where(is_media(F.col("path"), suffixes))
    if required and found.isEmpty():
        raise RuntimeError(f"No supported media found under {root}.")
    return found.withColumnRenamed("path", "media_path").orderBy("media_path")


def input_list(spark: SparkSession, path: str) -> DataFrame:
    """Exact inputs from a text file, one path per line, trimmed, blank lines dropped.

    ``list_position`` keeps the listed order; no suffix filter applies.
    """
    listed = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("list_position"),
        F.regexp_replace("value", r"^\s+|\s+$", "").alias("media_path"),
    )
    return listed.where(F.col("media_path") != "")


def clip_meta_read(spark: SparkSession, root: str, recursive: bool = True, lines: bool = False) -> DataFrame:
    """Clip metadata documents with the path of their file.

    One JSON file per document, or with ``lines`` compacted files of one document per
    line, which is the form to keep at scale. The schema is fixed: windows are maps, so
    any caption key is kept and nothing is inferred. The gallery reads only the top
    folder (``recursive=False``).
    """
    reader = spark.read.schema(CLIP_DOCUMENT).option("multiLine", not lines).option("pathGlobFilter", "*.json")
    docs = reader.option("recursiveFileLookup", recursive).json(root)
    return docs.select("*", plain_uri(F.col("_metadata.file_path")).alias("metadata_path"))


def marker_read(spark: SparkSession, root: str, lines: bool = False) -> DataFrame:
    """The path each marker document names, and the marker's file; unreadable documents and ones without a path are skipped."""
    reader = spark.read.schema(PROCESSED_MARKER).option("multiLine", not lines).option("mode", "DROPMALFORMED")
    glob = "*" if lines else "*.json"
    marks = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(root)
    named = marks.where(F.coalesce("video", F.lit("")) != "")
    return named.select(F.col("video").alias("media_path"), plain_uri(F.col("_metadata.file_path")).alias("marker_path"))


def processed_read(spark: SparkSession, root: str, lines: bool = False) -> DataFrame:
    """Paths marked as processed, each once, however many markers name it."""
    return marker_read(spark, root, lines).select("media_path").distinct()


def read_log_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Log lines as (file, block, line_no, line).

    ``block`` is the byte offset of the file split a line came from and ``line_no``
    rises inside it, so (file, block, line_no) is the line order of a log of any size.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )


def stage_metrics_read(spark: SparkSession, path: str) -> DataFrame:
    """The stage time series from CSV with a header, as text columns."""
    return spark.read.schema(STAGE_TEXT).option("header", True).csv(path)


def gpu_samples_csv(spark: SparkSession, path: str) -> DataFrame:
    """Accelerator samples from CSV without a header; unit suffixes are removed."""
    raw = spark.read.schema(GPU_TEXT).option("ignoreLeadingWhiteSpace", True).csv(path)
    number = lambda name: F.regexp_extract(name, r"^\s*([-+0-9.eE]+)", 1).try_cast("double")
    return raw.select(
        F.try_to_timestamp(F.translate("timestamp", "/", "-")).alias("ts"),
        F.trim("index").try_cast("int").alias("gpu"),
        number("utilization").alias("utilization"),
        number("memory_used").alias("memory_used"),
        number("memory_total").alias("memory_total"),
        number("power").alias("power"),
    )


def run_report_read(spark: SparkSession, root: str, lines: bool = False) -> DataFrame:
    """Run reports with a fixed schema: one report per file, or one per line with ``lines``."""
    reader = spark.read.schema(RUN_REPORT).option("multiLine", not lines).option("pathGlobFilter", "*.json")
    return reader.option("recursiveFileLookup", True).json(root)


def report_overview(reports: DataFrame) -> DataFrame:
    """The fields a monitor shows for each run."""
    return reports.select(
        "run_id", "status", "wall_time_s", "output_tasks", "throughput_videos_per_s", "throughput_clips_per_s",
        F.map_keys("artifacts").alias("artifact_names"), "error",
    )


def report_throughput(reports: DataFrame) -> DataFrame:
    """Throughput recomputed from what was selected and written; 0 when no time passed."""
    inputs = F.try_element_at("environment", F.lit("input_files")).try_cast("double")
    clips = F.try_element_at("artifacts", F.lit("clip_files"))
    return reports.select(
        "run_id",
        rate(F.coalesce(inputs, F.lit(0.0)), F.col("wall_time_s")).alias("videos_per_s"),
        rate(F.coalesce(clips, F.lit(0.0)), F.col("wall_time_s")).alias("clips_per_s"),
    )
