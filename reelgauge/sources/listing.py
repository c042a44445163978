"""Folders listed level by level on the executors; the driver holds one count per level and no file."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.session import scratch_path, ship_package
from reelgauge.sources.tar import _filesystem

_ENTRY = "path string, is_folder boolean, size_bytes long, modified timestamp"
_ROWS = 10_000
_MOST_TASKS = 10_000


def _hidden(name: str) -> bool:
    """Spark's rule for names that its readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _list(batches: Iterator) -> Iterator:
    """The entries of each folder of the batches; a root that is a file is its own entry."""
    import pyarrow as pa
    from pyarrow import fs

    utc = pa.timestamp("us", tz="UTC")
    schema = pa.schema([("path", pa.string()), ("is_folder", pa.bool_()), ("size_bytes", pa.int64()), ("modified", utc)])
    for batch in batches:
        for path, is_root in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            system, inner = _filesystem(path)
            prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
            alone = system.get_file_info(inner) if is_root else None
            if alone is not None and alone.is_file:
                found = [alone]
            else:
                # A folder may go away between two levels; it has no files then.
                found = [i for i in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)) if not _hidden(i.base_name)]
            for at in range(0, len(found), _ROWS):
                part = found[at : at + _ROWS]
                columns = [
                    pa.array([prefix + i.path for i in part], pa.string()),
                    pa.array([i.type == fs.FileType.Directory for i in part], pa.bool_()),
                    pa.array([i.size for i in part], pa.int64()),
                    pa.array([i.mtime if isinstance(i.mtime, dt.datetime) else None for i in part], utc),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)


def list_levels(spark: SparkSession, root: str, folders_per_task: int = 64) -> DataFrame:
    """Every file below ``root`` as path, size_bytes, modified, like ``files.list_files``, and files without bytes too.

    A job per level of folders lists the folders that the level before has found, and writes what it finds to the shared folder, so a
    lost executor lists its folders again and no one else's. One folder is one task, whose memory grows with the folder's entries.
    Listing is done when this returns. Only names that pyarrow can open (local, hdfs, s3, gs) are listed so.
    """
    ship_package(spark)
    target = scratch_path(spark, "listing")
    level, depth, tasks = spark.createDataFrame([(root, True)], "path string, is_root boolean"), 0, 1
    while True:
        written = f"{target}/level={depth}"
        level.repartition(tasks, "path").mapInArrow(_list, _ENTRY).write.parquet(written)
        folders = spark.read.schema(_ENTRY).parquet(written).where("is_folder")
        n = folders.count()
        if not n:
            break
        level, depth = folders.select("path", F.lit(False).alias("is_root")), depth + 1
        tasks = min(-(-n // folders_per_task), _MOST_TASKS)
    return spark.read.schema(_ENTRY).parquet(target).where(~F.col("is_folder")).select("path", "size_bytes", "modified")


def can_list(root: str) -> bool:
    """Whether workers can open the root; others are left to Spark's own listing."""
    import pyarrow as pa

    try:
        _filesystem(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False
    return not any(c in root for c in "*?[{")
