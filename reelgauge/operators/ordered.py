"""Running values over long ordered series without one task per series.

A plain window partitioned by the series key sends a whole series to one task.
Here every series is cut into blocks by a ``block`` column that never decreases
along the order (a time bucket, a file split). Each block is folded to one summary row
with map-side combine, and a window over the few summaries carries values from block
to block. The carried value then enters its block as one extra row in front of the
others, so the rows need one shuffle by (series, block) and no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelgauge.session import ensure_checkpoint_dir

_TAG_BITS = 33  # monotonically_increasing_id: partition above, row position below


def time_block(ts: Column, seconds: int = 3600) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` so that null keys meet each other."""
    if not keys:
        raise ValueError("attach needs at least one key")
    renamed = small.select(
        *[F.col(key).alias(f"_k{i}") for i, key in enumerate(keys)],
        *[name for name in small.columns if name not in keys],
    )
    condition = F.col(keys[0]).eqNullSafe(F.col("_k0"))
    for i, key in enumerate(keys[1:], 1):
        condition = condition & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    return df.join(renamed, condition, how).drop(*[f"_k{i}" for i in range(len(keys))])


def _before(keys: Sequence[str], block: str):
    return W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, -1)


def _with_carried(df: DataFrame, carried: DataFrame) -> DataFrame:
    """Data rows and one carried row per block, which sorts first (``_seq`` 0)."""
    rows = df.withColumn("_seq", F.lit(1))
    return rows.unionByName(carried.withColumn("_seq", F.lit(0)), allowMissingColumns=True)


def _in_block(keys: Sequence[str], block: str, order: Sequence[str]):
    return W.partitionBy(*keys, block).orderBy("_seq", *order)


def _data_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("_seq") == 1).drop("_seq")


def running_sum(
    df: DataFrame, value: str, keys: Sequence[str], block: str, order: Sequence[str], out: str
) -> DataFrame:
    """Cumulative sum of ``value`` along each series, current row included."""
    sums = df.groupBy(*keys, block).agg(F.sum(value).alias("_block_sum"))
    carried = sums.select(*keys, block, F.sum("_block_sum").over(_before(keys, block)).alias("_carried"))
    both = _with_carried(df, carried)
    amount = F.coalesce(F.when(F.col("_seq") == 1, F.col(value)).otherwise(F.col("_carried")), F.lit(0))
    total = F.sum(amount).over(_in_block(keys, block, order).rowsBetween(W.unboundedPreceding, 0))
    return _data_rows(both.withColumn(out, total)).drop("_carried")


def row_index(
    df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], out: str = "row_index"
) -> DataFrame:
    """0-based position in each series."""
    numbered = running_sum(df.withColumn("_one", F.lit(1).cast("bigint")), "_one", keys, block, order, out)
    return numbered.withColumn(out, F.col(out) - 1).drop("_one")


def carry_forward(
    df: DataFrame, values: Sequence[str], keys: Sequence[str], block: str, order: Sequence[str]
) -> DataFrame:
    """Replace each null in ``values`` by the latest earlier non-null of its series."""
    at = F.struct(*order)
    lasts = df.groupBy(*keys, block).agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), at)).alias(v) for v in values])
    carried = lasts.select(
        *keys, block, *[F.last(v, ignorenulls=True).over(_before(keys, block)).alias(v) for v in values]
    )
    upto = _in_block(keys, block, order).rowsBetween(W.unboundedPreceding, 0)
    both = _with_carried(df, carried)
    return _data_rows(both.withColumns({v: F.last(v, ignorenulls=True).over(upto) for v in values}))


def previous_value(
    df: DataFrame, value: str, keys: Sequence[str], block: str, order: Sequence[str], out: str
) -> DataFrame:
    """``value`` of the row before, as struct(value); null on the first row of a series."""
    boxed = F.struct(F.col(value).alias("value"))
    lasts = df.groupBy(*keys, block).agg(F.max_by(boxed, F.struct(*order)).alias("_box"))
    carried = lasts.select(*keys, block, F.lag("_box").over(W.partitionBy(*keys).orderBy(block)).alias("_box"))
    both = _with_carried(df.withColumn("_box", boxed), carried)
    return _data_rows(both.withColumn(out, F.lag("_box").over(_in_block(keys, block, order)))).drop("_box")


def global_position(df: DataFrame, order: Sequence[Column | str], out: str = "position") -> DataFrame:
    """0-based position of every row in one total order of the whole table.

    Rows are range-partitioned and sorted, and the sorted table is checkpointed so
    that the partition bounds cannot move between counting and numbering. Only one
    count per partition is folded into offsets. ``order`` must end in a unique key.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_tag", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_tag", _TAG_BITS))
    )
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(_before([], "_part")), F.lit(0)).alias("_offset")
    )
    local = F.col("_tag").bitwiseAND((1 << _TAG_BITS) - 1)
    # One row per shuffle partition: the hint is safe whatever the table holds.
    placed = tagged.join(F.broadcast(offsets), "_part")
    return placed.withColumn(out, local + F.col("_offset")).drop("_part", "_tag", "_offset")


def key_position(df: DataFrame, key: str, out: str = "position") -> DataFrame:
    """Number of rows with a smaller ``key``: the 0-based place of every row in order of a unique key.

    Rows that share a key share the place of the first; null comes first. Only keys with their counts are
    range-partitioned and checkpointed; other columns move once, in the join that brings the places back.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    cut = keys.repartitionByRange("_key").withColumn("_part", F.spark_partition_id()).checkpoint()
    placed = running_sum(cut, "_rows", [], "_part", ["_key"], "_upto")
    return attach(df, placed.select(F.col("_key").alias(key), (F.col("_upto") - F.col("_rows")).alias(out)), [key])
