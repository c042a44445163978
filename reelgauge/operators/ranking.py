"""Exact order statistics that never sort one group in one task.

Values fall into logarithmic blocks, a coarse non-decreasing function of the value.
Block totals (map-side combine leaves a few rows per group) locate the block that holds
a wanted rank. That block is cut again, into ``_FINE`` equal ranges between its smallest and
largest value, and located the same way; only the distinct values of one such range
are ordered. So n distinct values in one narrow block still leave about n / 4096 to a task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelgauge.operators.ordered import attach
from reelgauge.session import ensure_checkpoint_dir

_BLOCKS_PER_OCTAVE = 256
_FINE = 4096


def _block(value: Column) -> Column:
    """A coarse, non-decreasing function of the value."""
    number = value.cast("double")
    octave = F.least(F.log2(F.abs(number)), F.lit(1100.0))
    level = F.greatest(F.floor(octave * _BLOCKS_PER_OCTAVE) + 1100 * _BLOCKS_PER_OCTAVE, F.lit(1))
    return (
        F.when(F.isnan(number), F.lit(1 << 30))
        .when(number == 0, F.lit(0))
        .when(number < 0, -level)
        .otherwise(level)
        .cast("bigint")
    )


def _totals(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and value range of each block."""
    number = F.col("_value").cast("double")
    return rows.groupBy(*keys).agg(F.sum("_n").alias("_block_n"), F.min(number).alias("_low"), F.max(number).alias("_high"))


def _upto(blocks: DataFrame, keys: Sequence[str], block: str) -> DataFrame:
    upto = W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, 0)
    return blocks.withColumn("_start", F.sum("_block_n").over(upto) - F.col("_block_n"))


def _located(blocks: DataFrame, keys: Sequence[str], block: str, counted: bool = False) -> DataFrame:
    """The block that holds each wanted rank, with the rank inside it (``_rest``)."""
    if not counted:
        upto = W.partitionBy(*keys, "_name").orderBy(block).rowsBetween(W.unboundedPreceding, 0)
        blocks = blocks.withColumn("_start", F.sum("_block_n").over(upto) - F.col("_block_n"))
    rest = F.col("_rank") - F.col("_start")
    return blocks.where((rest >= 0) & (rest < F.col("_block_n"))).withColumn("_rest", rest)


def _targets(whole: DataFrame, keys: Sequence[str], ranks: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """The block of each named rank, out of the totals of all blocks."""
    wanted = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(i).alias("place")) for i, n in enumerate(ranks)])
    total = F.sum("_block_n").over(W.partitionBy(*keys))
    rank_of = F.element_at(F.array(*[r(F.col("_total")) for r in ranks.values()]), F.col("_want.place") + 1)
    first = whole.withColumn("_total", total).withColumn("_want", F.explode(wanted))
    return _located(first.select("*", F.col("_want.name").alias("_name"), rank_of.alias("_rank")), keys, "_block")


def _asked_blocks(targets: DataFrame, block_keys: Sequence[str]) -> DataFrame:
    return targets.groupBy(*block_keys).agg(F.first("_low").alias("_low"), F.first("_high").alias("_high"))


def _picked(hit: DataFrame, targets: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The wanted values out of the rows of the wanted blocks (``hit``), one column per name."""
    block_keys = [*keys, "_block"]
    number, low, high = F.col("_value").cast("double"), F.col("_low"), F.col("_high")
    place = F.floor((number - low) / (high - low) * _FINE)
    fine = F.when((high > low) & (place < _FINE), place).when(high > low, F.lit(_FINE - 1)).otherwise(F.lit(0)).cast("int")
    rows = hit.withColumn("_fine", fine).groupBy(*block_keys, "_fine", "_value").agg(F.sum("_n").alias("_n"))
    parts = _totals(rows, [*block_keys, "_fine"]).drop("_low", "_high")
    asked = targets.select(*block_keys, "_name", F.col("_rest").alias("_rank"))
    placed = _located(attach(_upto(parts, block_keys, "_fine"), asked, block_keys, how="inner"), block_keys, "_fine", counted=True)
    block_keys = [*block_keys, "_fine"]
    wants = placed.groupBy(*block_keys).agg(F.collect_list(F.struct(F.col("_name").alias("name"), F.col("_rest").alias("rest"))).alias("_wants"))
    hit = attach(rows, wants, block_keys, how="inner")
    inside = W.partitionBy(*block_keys).orderBy("_value").rowsBetween(W.unboundedPreceding, 0)
    ended = hit.withColumn("_end", F.sum("_n").over(inside)).select(
        *keys, "_value", "_n", "_end", F.explode("_wants").alias("_want")
    )
    chosen = ended.where((F.col("_want.rest") < F.col("_end")) & (F.col("_want.rest") >= F.col("_end") - F.col("_n")))
    return chosen.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_want.name") == name, F.col("_value"))).alias(name) for name in names]
    )


def nearest_rank_index(total: Column, p: float) -> Column:
    """0-based index round((n - 1) * p), halves to even."""
    return F.bround((total - 1) * F.lit(float(p))).cast("bigint")


def values_at(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    ranks: Mapping[str, Callable[[Column], Column]],
    few_values: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """One row per group with the value at each named 0-based rank.

    Each rank is a function of the group's count of non-null values. Groups with
    no value at all do not appear.

    By default the input is read for block totals, and again keeping only the rows of the
    wanted blocks, so no pass shuffles all values; how the wanted blocks meet the rows is
    left to adaptive execution. With ``few_values`` (counters, small integers)
    rows are folded to one per distinct value first and the input is read once. A
    ``weight`` column says how many rows each row stands for.
    """
    keys = list(keys)
    count = F.col(weight) if weight else F.lit(1).cast("bigint")
    rows = df.select(*keys, F.col(value).alias("_value"), count.alias("_n"))
    if few_values:
        # Nulls weigh nothing. A filter would be pushed below shared aggregates and
        # keep Spark from reusing their shuffle.
        counted = F.when(F.col("_value").isNotNull(), F.col("_n")).otherwise(F.lit(0))
        rows = rows.groupBy(*keys, "_value").agg(F.sum(counted).alias("_n"))
    else:
        rows = rows.where(F.col("_value").isNotNull())
    rows = rows.withColumn("_block", _block(F.col("_value")))
    targets = _targets(_totals(rows, [*keys, "_block"]), keys, ranks)
    block_keys = [*keys, "_block"]
    hit = attach(rows, _asked_blocks(targets, block_keys), block_keys, how="inner")
    return _picked(hit, targets, keys, list(ranks))


def nearest_rank(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    percentiles: Mapping[str, float],
    empty_zero: bool = False,
    few_values: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Nearest-rank percentiles per group, e.g. ``{"p50": 0.5, "p90": 0.9}``.

    A group without values is absent, or 0 in every column with ``empty_zero``.
    """
    ranks = {name: (lambda total, p=p: nearest_rank_index(total, p)) for name, p in percentiles.items()}
    found = values_at(df, value, keys, ranks, few_values, weight)
    if not empty_zero:
        return found
    zero = F.lit(0).cast(df.schema[value].dataType)
    if not keys:
        return found.agg(*[F.coalesce(F.max(name), zero).alias(name) for name in percentiles])
    filled = attach(df.select(*keys).distinct(), found, keys)
    return filled.withColumns({name: F.coalesce(F.col(name), zero) for name in percentiles})


def ranks_by_sets(
    df: DataFrame, measures: Sequence[str], labels: Sequence[str], percentiles: Mapping[str, float]
) -> DataFrame:
    """Nearest-rank percentiles of several measures, by each label alone and over all rows.

    Gives ``set`` (place of the label, or -1 for all rows), ``label`` (as text), ``measure`` and one column per
    percentile. Measures share one type. A set without values of a measure has no row for it.

    Rows are folded to counts of (labels, measure, block) before they are shared out to the sets, so only folded rows
    are repeated. The blocks that hold the wanted ranks, a few rows per set, are checkpointed. Each combination of
    labels then gets the blocks its sets want, in one array of at most (sets x measures x percentiles) entries, and
    the rows meet them in one join by their own labels.
    """
    labels, keys = list(labels), ["_set", "_label", "_measure"]
    ranks = {name: (lambda total, p=p: nearest_rank_index(total, p)) for name, p in percentiles.items()}
    sets = F.explode(
        F.array(
            *[F.struct(F.lit(i).alias("_set"), F.col(name).cast("string").alias("_label")) for i, name in enumerate(labels)],
            F.struct(F.lit(-1).alias("_set"), F.lit("all").alias("_label")),
        )
    ).alias("_of")
    options = F.array(*[F.struct(F.lit(i).alias("_measure"), F.col(name).alias("_value")) for i, name in enumerate(measures)])
    values = df.select(*labels, F.inline(options)).where(F.col("_value").isNotNull())
    cells = _totals(values.withColumn("_block", _block(F.col("_value"))).withColumn("_n", F.lit(1).cast("bigint")), [*labels, "_measure", "_block"])
    shared = cells.select(sets, "_measure", "_block", "_block_n", "_low", "_high").select("_of.*", "_measure", "_block", "_block_n", "_low", "_high")
    whole = shared.groupBy(*keys, "_block").agg(
        F.sum("_block_n").alias("_block_n"), F.min("_low").alias("_low"), F.max("_high").alias("_high")
    )
    ensure_checkpoint_dir(df.sparkSession)
    targets = _targets(whole, keys, ranks).checkpoint()
    asked = _asked_blocks(targets, [*keys, "_block"])
    combinations = df.select(*labels).distinct()
    offers = attach(combinations.select(*labels, sets).select(*labels, "_of.*"), asked, ["_set", "_label"], how="inner")
    wants = offers.groupBy(*labels).agg(F.collect_list(F.struct(*keys, "_block", "_low", "_high")).alias("_wants"))
    numbers = F.array(*[F.col(name) for name in measures])
    blocks = F.array(*[_block(F.col(name)) for name in measures])
    rows = df.select(*labels, numbers.alias("_numbers"), blocks.alias("_blocks"))
    met = attach(rows, wants, labels, how="inner")
    found = met.select("_numbers", F.inline(F.filter("_wants", lambda w: F.get("_blocks", w["_measure"]) == w["_block"])))
    value = F.get("_numbers", F.col("_measure"))
    hit = found.select(*keys, "_block", "_low", "_high", value.alias("_value"), F.lit(1).cast("bigint").alias("_n"))
    name = F.element_at(F.array(*[F.lit(m) for m in measures]), F.col("_measure") + 1)
    picked = _picked(hit.where(F.col("_value").isNotNull()), targets, keys, list(ranks))
    return picked.select(F.col("_set").alias("set"), F.col("_label").alias("label"), name.alias("measure"), *percentiles)


def median(
    df: DataFrame, value: str, keys: Sequence[str], out: str = "median", few_values: bool = False
) -> DataFrame:
    """Exact median; the mean of the two middle values for an even count."""
    middle = {
        "_low": lambda total: F.floor((total - 1) / 2).cast("bigint"),
        "_high": lambda total: F.ceil((total - 1) / 2).cast("bigint"),
    }
    found = values_at(df, value, keys, middle, few_values)
    return found.select(*keys, ((F.col("_low") + F.col("_high")) / 2).cast("double").alias(out))
