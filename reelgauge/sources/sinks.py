"""Writers: stage CSV, run reports, the results index, and writes that leave existing artifacts alone."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.operators.ordered import attach
from reelgauge.schemas import STAGE_COLUMNS


def stage_metrics_write(rows: DataFrame, path: str) -> None:
    """The stage time series as CSV with a header, in the fixed column order."""
    rows.select(*STAGE_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def run_report_write(reports: DataFrame, path: str) -> None:
    """Append run reports as JSON, one line each, keys sorted."""
    reports.select(*sorted(reports.columns)).write.mode("append").json(path)


def gallery_index_write(index: DataFrame, path: str) -> None:
    """The index as JSON lines in files whose names ascend in index order: ``gallery_index`` sorts by ranges."""
    index.write.mode("overwrite").json(path)


def _readable(spark: SparkSession, target: str, key: str) -> DataFrame | None:
    try:
        return spark.read.parquet(target).select(key)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def new_artifacts(df: DataFrame, existing: DataFrame | None, key: str, prefer: str | None = None) -> DataFrame:
    """Rows whose key is not there yet, one per key.

    Of several rows with the same new key the one with the smallest ``prefer`` stays;
    without it any one of them. The fold is a map-side aggregate, so a key repeated
    in a third of all rows is no hot spot.
    """
    if existing is not None:
        df = df.join(existing.distinct(), key, "left_anti")
    if prefer is None:
        return df.dropDuplicates([key])
    folded = df.groupBy(key).agg(F.min_by(F.struct(*df.columns), F.col(prefer)).alias("_row"))
    return folded.select("_row.*")


def idempotent_write(
    df: DataFrame,
    key: str,
    target: str,
    dry_run: bool = False,
    partition_by: str | None = None,
    prefer: str | None = None,
) -> DataFrame:
    """Append only artifacts that ``target`` does not hold; existing files stay untouched.

    Returns what is (or with ``dry_run`` would be) new. Spark's commit protocol keeps files
    of failed tasks out of sight, and a rerun adds what is still missing. This avoids
    rewriting, it is not a checkpoint: the work that made ``df`` runs again.
    """
    spark = df.sparkSession
    fresh = new_artifacts(df, _readable(spark, target, key), key, prefer)
    if dry_run:
        return fresh
    writer = fresh.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(target)
    return fresh


def replace_error_lists(docs: DataFrame, full_errors: DataFrame, key: str = "span_uuid") -> DataFrame:
    """Put the complete stage-to-message map in place of a lossy list of stages."""
    kept = full_errors.select(key, F.col("errors").alias("_full"))
    return attach(docs, kept, [key]).withColumn("errors", F.coalesce("_full", "errors")).drop("_full")
