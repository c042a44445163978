"""An inverted index of the three-letter pieces of some columns, for substring searches that don't scan the table.

Rows are stored by rank in folders of ``PER_PART`` ranks. A posting is a piece and the rank of a row that has it, in folders by the hash of the
piece; pieces are counted in a table of their own. A search reads the postings of the rarest pieces of its text, keeps the
ranks that have all of them, opens the folders of rows these lie in, and tests the rows for the text itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from reelgauge.operators.ordered import global_position

PER_PART = 100_000  # this and the next are part of the stored form
BUCKETS = 64
_PIECE = 3
RAREST = 4  # a full id has dozens of pieces; more lists than this hardly leave fewer rows


def _pieces(text: Column) -> Column:
    starts = F.when(F.length(text) >= _PIECE, F.sequence(F.lit(1), F.length(text) - (_PIECE - 1)))
    return F.coalesce(F.transform(starts, lambda i: F.substring(text, i, F.lit(_PIECE))), F.array().cast("array<string>"))


def _bucket(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int")


def _has(fields: Sequence[str], wanted: str) -> Column:
    found = F.lit(False)
    for name in fields:
        found = found | F.coalesce(F.contains(F.lower(F.col(name)), F.lit(wanted)), F.lit(False))
    return found


def _rows(spark: SparkSession, path: str) -> DataFrame:
    columns = spark.read.parquet(f"{path}/columns").schema
    return spark.read.schema(columns.add("search_rank", LongType()).add("search_part", IntegerType())).parquet(f"{path}/rows")


def write_search_index(rows: DataFrame, path: str, fields: Sequence[str], order: Sequence[str]) -> None:
    """Store rows and their index in a new folder. ``order`` numbers the rows; those equal in all of it have no order among themselves.

    A piece that most rows have is split by rank, so it is no single task. The table of counts is written last: a
    folder without it isn't finished, and searching it fails.
    """
    spark = rows.sparkSession
    placed = global_position(rows, order, out="search_rank")
    part = F.expr(f"search_rank div {PER_PART}").cast("int")
    placed.withColumn("search_part", part).write.partitionBy("search_part").parquet(f"{path}/rows")
    rows.limit(0).write.parquet(f"{path}/columns")  # a table without rows has no folders to read its columns from
    stored = _rows(spark, path)
    every = F.array_distinct(F.concat(*[_pieces(F.lower(F.col(name))) for name in fields]))
    postings = stored.select("search_rank", F.explode(every).alias("piece")).withColumn("bucket", _bucket(F.col("piece")))
    dealt = postings.repartitionByRange("bucket", "piece", "search_rank").sortWithinPartitions("bucket", "piece", "search_rank")
    dealt.write.partitionBy("bucket").parquet(f"{path}/postings")
    lists = spark.read.schema("search_rank long, piece string, bucket int").parquet(f"{path}/postings")
    counts = lists.groupBy("bucket", "piece").agg(F.count(F.lit(1)).alias("n"))
    counts.repartition("bucket").sortWithinPartitions("bucket", "piece").write.partitionBy("bucket").parquet(f"{path}/counts")


def rarest_pieces(spark: SparkSession, path: str, wanted: str) -> list[str] | None:
    """The pieces of the text with the shortest lists; None if the table lacks one of them."""
    pieces = sorted({wanted[i : i + _PIECE] for i in range(len(wanted) - _PIECE + 1)})
    known = spark.read.schema("piece string, n long, bucket int").parquet(f"{path}/counts").where(_opened(spark, pieces) & F.col("piece").isin(pieces))
    found = sorted((r.n, r.piece) for r in known.collect())  # one row per piece of the query
    return [piece for _, piece in found[:RAREST]] if len(found) == len(pieces) else None


def _opened(spark: SparkSession, pieces: Sequence[str]) -> Column:
    """The folders that the pieces lie in."""
    buckets = spark.createDataFrame([(p,) for p in pieces], "piece string").select(_bucket(F.col("piece")).alias("b")).distinct()
    return F.col("bucket").isin([r.b for r in buckets.collect()])


def candidate_ranks(spark: SparkSession, path: str, wanted: str) -> DataFrame | None:
    """Ranks of the rows that have the rarest pieces; all rows with the text are among them."""
    pieces = rarest_pieces(spark, path, wanted)
    if pieces is None:
        return None
    lists = spark.read.schema("search_rank long, piece string, bucket int").parquet(f"{path}/postings")
    lists = lists.where(_opened(spark, pieces) & F.col("piece").isin(pieces))
    return lists.groupBy("search_rank").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(pieces)).select("search_rank")


def search(spark: SparkSession, path: str, query: str, fields: Sequence[str]) -> DataFrame:
    """Rows with the query in one of the indexed ``fields``, ignoring case, as ``gallery_search`` gives them.

    A blank query keeps all rows; one of fewer than three letters scans them.
    """
    rows, wanted = _rows(spark, path), query.strip().lower()
    shown = [c for c in rows.columns if c not in ("search_rank", "search_part")]
    if not wanted:
        return rows.select(*shown)
    if len(wanted) < _PIECE:
        return rows.where(_has(fields, wanted)).select(*shown)
    ranks = candidate_ranks(spark, path, wanted)
    if ranks is None:
        return rows.limit(0).select(*shown)
    parts = ranks.select(F.expr(f"search_rank div {PER_PART}").cast("int").alias("p")).distinct()
    numbers = [r.p for r in parts.collect()]  # one for 100,000 rows of the table at most
    return rows.where(F.col("search_part").isin(numbers)).join(ranks, "search_rank", "left_semi").where(_has(fields, wanted)).select(*shown)
