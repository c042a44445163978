"""Manifests: what is there, what is done, what is left, how it is distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelgauge.functions.numeric import frame_rate, pixels, rate, ratio, resolution
from reelgauge.operators.ordered import attach, key_position
from reelgauge.operators.ranking import median, ranks_by_sets
from reelgauge.session import ensure_checkpoint_dir


def video_limit(media: DataFrame, n: int | None, order: str = "media_path") -> DataFrame:
    """First n inputs; None keeps all. Order by ``list_position`` to take an explicit list as it is listed."""
    return media if n is None else media.orderBy(order).limit(n)


def _number(text: Column, kind: str) -> Column:
    return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))


def probe_json(df: DataFrame, document: str, stat_size: str = "size_bytes") -> DataFrame:
    """Media-probe JSON to typed columns, first stream only.

    Size falls back to the listed file size, bit rate to the stream's and then to 0,
    dimensions to 0. A bare JSON zero counts as missing, a quoted "0" does not. An
    unreadable document gives the fallbacks.
    """
    doc = F.col("_doc")

    def text(path: str) -> Column:
        return F.try_variant_get(doc, path, "string")

    def given(path: str) -> Column:
        is_text = F.schema_of_variant(F.try_variant_get(doc, path, "variant")) == "STRING"
        bare_zero = ~is_text & F.coalesce(text(path).try_cast("double") == 0, F.lit(False))
        return F.when((text(path) != "") & ~bare_zero, text(path))

    zero = F.lit(0)
    bitrate = F.coalesce(given("$.format.bit_rate"), given("$.streams[0].bit_rate"))
    return (
        df.withColumn("_doc", F.try_parse_json(document))
        .withColumns(
            {
                "width": F.coalesce(_number(text("$.streams[0].width"), "int"), zero),
                "height": F.coalesce(_number(text("$.streams[0].height"), "int"), zero),
                "fps": frame_rate(text("$.streams[0].avg_frame_rate")),
                "bitrate": F.coalesce(_number(bitrate, "bigint"), zero.cast("bigint")),
                "duration_s": text("$.format.duration").try_cast("double"),
                "probed_bytes": F.coalesce(_number(given("$.format.size"), "bigint"), F.col(stat_size)),
            }
        )
        .drop("_doc")
    )


def _marked(markers: DataFrame, path: str) -> DataFrame:
    return markers.where(F.col(path).isNotNull()).select(path).distinct()


def pending_inputs(media: DataFrame, processed: DataFrame, path: str = "media_path") -> DataFrame:
    """Inputs without a processed marker, in path order."""
    return media.join(_marked(processed, path), path, "left_anti").orderBy(path)


def done_flag(media: DataFrame, processed: DataFrame, path: str = "media_path") -> DataFrame:
    marks = _marked(processed, path).withColumn("done", F.lit(True))
    return media.join(marks, path, "left").withColumn("done", F.coalesce("done", F.lit(False)))


def largest_pending(flagged: DataFrame, k: int = 8, size: str = "size_bytes", path: str = "media_path") -> DataFrame:
    """The k biggest unfinished inputs, ties in path order."""
    return flagged.where(~F.col("done")).orderBy(F.desc(size), F.asc(path)).limit(k)


def subset_completion(flagged: DataFrame, subset: str = "subset") -> DataFrame:
    done = F.count_if("done")
    return flagged.groupBy(subset).agg(
        done.alias("n_done"),
        F.count(F.lit(1)).alias("n_total"),
        ratio(done, F.count(F.lit(1))).alias("done_share"),
    )


def input_volume(media: DataFrame, wall_seconds: float | None = None) -> DataFrame:
    """Count, bytes and source time of an input set, with rates when it was timed."""
    total_bytes, total_ms = F.sum("size_bytes"), F.sum(F.round(F.col("duration_s") * 1000).cast("bigint"))
    columns = [
        F.count(F.lit(1)).alias("n_files"),
        total_bytes.alias("total_bytes"),
        total_ms.alias("total_ms"),
        F.round(F.try_divide(total_ms, F.count(F.lit(1))) / 1000, 6).alias("mean_s"),
    ]
    if wall_seconds is not None:
        wall = F.lit(float(wall_seconds))
        columns += [
            F.round(rate(total_ms / 1000, wall), 6).alias("source_s_per_s"),
            F.round(rate(total_bytes / (1024 * 1024), wall), 6).alias("mib_per_s"),
        ]
    return media.agg(*columns)


def size_stats(
    artifacts: DataFrame, kind: str = "kind", size: str = "size_bytes", full_count: int | None = None
) -> DataFrame:
    """Size spread per artifact kind, and the bytes ``full_count`` artifacts would take."""
    basic = artifacts.groupBy(kind).agg(
        F.count(size).alias("n"),
        F.sum(size).alias("total_bytes"),
        F.round(F.avg(size), 6).alias("mean_bytes"),
        F.min(size).alias("min_bytes"),
        F.max(size).alias("max_bytes"),
    )
    result = attach(basic, median(artifacts, size, [kind], "median_bytes"), [kind])
    if full_count is None:
        return result
    return result.withColumn(
        "full_bytes", F.round(F.try_divide(F.col("total_bytes") * full_count, F.col("n"))).cast("bigint")
    )


def position_groups(
    media: DataFrame, n: int = 58, path: str = "media_path", out: str = "position_group"
) -> DataFrame:
    """Consecutive groups of n files in path order, numbered from 1. Only paths are sorted and checkpointed."""
    placed = key_position(media, path)
    return placed.withColumn(out, (F.floor(F.col("position") / n) + 1).cast("bigint"))


def distribution_by_group(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Count, mean and nearest-rank median of size and bit rate, mean pixels per group.

    ``labels`` are grouping columns; each of them alone and the total give groups, as (kind, label). Rows are folded
    to sums per combination of labels first, and only these sums are shared out to the groups. Labels and measures are
    checkpointed, since they are read four times.
    """
    ensure_checkpoint_dir(df.sparkSession)
    measured = df.select(
        *labels,
        F.col("size_bytes").cast("bigint").alias("size"),
        F.col("bitrate").cast("bigint").alias("bitrate"),
        pixels(F.col("width"), F.col("height")).alias("pixels"),
    ).checkpoint()
    parts = ("size", "bitrate", "pixels")
    sums = [f(name).alias(f"_{how}_{name}") for name in parts for how, f in (("sum", F.sum), ("n", F.count))]
    folded = measured.groupBy(*labels).agg(F.count(F.lit(1)).alias("_n"), *sums)
    groups = F.array(
        *[F.struct(F.lit(name).alias("kind"), F.col(name).cast("string").alias("label")) for name in labels],
        F.struct(F.lit("all").alias("kind"), F.lit("all").alias("label")),
    )
    means = (
        folded.withColumn("_of", F.explode(groups))
        .groupBy("_of")
        .agg(
            F.sum("_n").alias("n"),
            *[F.round(F.try_divide(F.sum(f"_sum_{m}"), F.sum(f"_n_{m}")), 6).alias(f"{m}_mean") for m in parts],
        )
        .select("_of.*", "n", *[f"{m}_mean" for m in parts])
    )
    ranked = ranks_by_sets(measured, ["size", "bitrate"], labels, {"p50": 0.5})
    kind = F.coalesce(F.get(F.array(*[F.lit(name) for name in labels]), F.col("set")), F.lit("all")) if labels else F.lit("all")
    pick = lambda name: F.max(F.when(F.col("measure") == name, F.col("p50"))).alias(f"{name}_p50")
    wide = ranked.groupBy(kind.alias("kind"), "label").agg(pick("size"), pick("bitrate"))
    return attach(means, wide, ["kind", "label"])


def top_resolutions(
    df: DataFrame, group: str, k: int = 5, order: str = "media_path"
) -> DataFrame:
    """Most common resolutions per group; ties go to the one seen first in ``order``."""
    counted = (
        df.groupBy(group, resolution(F.col("width"), F.col("height")).alias("resolution"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_first"))
    )
    best = W.partitionBy(group).orderBy(F.desc("n"), F.asc("_first"))
    return (
        counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("_first")
    )
