"""A sorted table stored with the rank of each file's first row, so that a page by number opens only the files it lies in.

``write_ranked`` sorts once by ranges. Files hold at most ``per_file`` rows and their names ascend in order, so the
rank of a row is its file's first rank and its place in the file, which Parquet readers know. ``ranks`` is one row per file
and is written last: a folder without it isn't finished, and reading a page of it fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PER_FILE = 100_000
_RANKS = "file string, first long, n long"


def write_ranked(rows: DataFrame, path: str, order: Sequence[str], per_file: int = PER_FILE) -> None:
    """Store the table by rank in a new folder. Rows that are equal in all of ``order`` have no order among themselves."""
    spark = rows.sparkSession
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", per_file).parquet(f"{path}/items")
    # Counting rows by file reads the files' footers and no column.
    counts = spark.read.schema(rows.schema).parquet(f"{path}/items").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    ranks = counts.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("first"), "n")
    ranks.write.parquet(f"{path}/ranks")


def files_of(spark: SparkSession, path: str, low: int, high: int) -> list[tuple[str, int]]:
    """The files with ranks from ``low`` to below ``high``, and their first ranks; they are as many as the range needs."""
    ranks = spark.read.schema(_RANKS).parquet(f"{path}/ranks")
    return [(r.file, r.first) for r in ranks.where((F.col("first") < high) & (F.col("first") + F.col("n") > low)).orderBy("first").collect()]


def ranked_page(spark: SparkSession, path: str, page: int, size: int) -> DataFrame:
    """One page with ``position`` (from 0), ``page``, ``pages`` and ``filtered_count``; the number is clamped.

    There is no sort and no shuffle: a filter by place in the files that hold the page: two, or three where a sorted range ends in a small file.
    """
    if size <= 0:
        raise ValueError("size must be positive")
    total = spark.read.schema(_RANKS).parquet(f"{path}/ranks").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    pages = max(1, -(-total // size))
    current = min(max(page, 1), pages)
    low, high = (current - 1) * size, current * size
    whole = spark.read.parquet(f"{path}/items")
    found = None
    for file, first in files_of(spark, path, low, high):
        rows = spark.read.schema(whole.schema).parquet(f"{path}/items/{file}")
        rows = rows.select("*", (F.col("_metadata.row_index") + first).alias("position"))
        found = rows if found is None else found.unionAll(rows)
    if found is None:
        found = whole.limit(0).select("*", F.lit(0).cast("long").alias("position"))
    found = found.where((F.col("position") >= low) & (F.col("position") < high))
    return found.withColumns({"page": F.lit(current).cast("bigint"), "pages": F.lit(pages).cast("bigint"), "filtered_count": F.lit(total).cast("bigint")})
