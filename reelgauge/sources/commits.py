"""Documents by key that are replaced whole: a write becomes visible by one marker, and of several writes of a key one counts.

Rows of a write lie in a folder of its own. The write is committed by an empty file whose name has its number and its folder; a
file appears at once or not at all, so readers see a write whole or don't see it, and a failed one never. Two writers that take the
same number are ordered by folder name: both are committed, and every reader decides each key alike.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.sources.sinks import new_artifacts

_DIGITS = 12


def _commits(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """Number and folder of each committed write, in order: one per write."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/commits")
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(where)] if system.exists(where) else []
    return sorted((int(n[:_DIGITS]), n[_DIGITS + 1 :]) for n in names if n[:_DIGITS].isdigit())


def stage(df: DataFrame, key: str, target: str, prefer: str | None = None) -> str:
    """Write rows where no reader looks yet; returns the folder to commit.

    Of several rows with one key the one with the smallest ``prefer`` is written. Without ``prefer`` rows are written as they come,
    without a shuffle, and readers take the first of them by file and place in it, so that all see the same one.
    """
    folder = uuid.uuid4().hex
    rows = df if prefer is None else new_artifacts(df, None, key, prefer)
    rows.write.parquet(f"{target}/data/commit_folder={folder}")
    return folder


def commit(spark: SparkSession, target: str, folder: str) -> int:
    """Make a staged write visible as the newest one; returns its number."""
    number = max([n for n, _ in _commits(spark, target)], default=-1) + 1
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/commits/{number:0{_DIGITS}d}-{folder}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True).close()
    return number


def replace(df: DataFrame, key: str, target: str, prefer: str | None = None) -> int:
    """Write and commit."""
    return commit(df.sparkSession, target, stage(df, key, target, prefer))


def committed(spark: SparkSession, target: str, key: str, keep: str = "last") -> DataFrame:
    """Each key once, null among them: from the last write that has it, or with ``keep="first"`` from the first.

    The writes are fixed when this is called; later ones don't show in the result. Rows move once, in one aggregate that folds
    versions and repeated rows of a key map-side.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, not {keep}")
    known = _commits(spark, target)
    if not known:
        raise ValueError(f"nothing is committed in {target}")
    columns = spark.read.parquet(f"{target}/data/commit_folder={known[-1][1]}").columns
    ranks = spark.createDataFrame([(folder, i) for i, (_, folder) in enumerate(known)], "commit_folder string, commit_rank int")
    rows = spark.read.option("mergeSchema", True).parquet(*[f"{target}/data/commit_folder={folder}" for _, folder in known])
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"commit_folder=([0-9a-f]+)/", 1)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    # One row per write, and the driver has just listed all of them: without the hint rows would be dealt by folder.
    ranked = rows.select(*columns, folder.alias("commit_folder"), place.alias("commit_place")).join(F.broadcast(ranks), "commit_folder")
    order = F.struct(F.col("commit_rank") * F.lit(-1 if keep == "last" else 1), "commit_place")
    return ranked.groupBy(F.col(key).alias("commit_key")).agg(F.min_by(F.struct(*columns), order).alias("commit_row")).select("commit_row.*")
