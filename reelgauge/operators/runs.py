"""Run-level throughput, comparison, projection and verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelgauge.functions.numeric import minutes_between, rate
from reelgauge.operators.inventory import video_limit

UNITS = ("videos", "clips", "windows")


def _rates(seconds: Column, counts: Mapping[str, Column], digits: int = 6) -> dict[str, Column]:
    """Per-minute and per-second rates; 0 when no time elapsed."""
    made = {}
    for unit, count in counts.items():
        made[f"{unit}_per_min"] = F.round(rate(count * 60, seconds), digits)
        made[f"{unit}_per_s"] = F.round(rate(count, seconds), digits)
    return made


def run_throughput(runs: DataFrame, key: str = "run_id") -> DataFrame:
    """Videos, clips and windows per minute and second of each run."""
    summed = runs.groupBy(key).agg(F.sum("seconds").alias("seconds"), *[F.sum(u).alias(u) for u in UNITS])
    return summed.withColumns(_rates(F.col("seconds"), {u: F.col(u) for u in UNITS}))


def throughput_total(runs: DataFrame, phase: str = "phase") -> DataFrame:
    """Per-phase rates, the active total over all phases, and the wall-clock total.

    A rollup gives phases and active total together; the wall clock divides the same
    amounts by the span from first start to last end.
    """
    rolled = runs.rollup(phase).agg(
        F.grouping_id().alias("_whole"),
        F.sum("seconds").alias("seconds"),
        *[F.sum(u).alias(u) for u in UNITS],
        F.min("start_ts").alias("_from"),
        F.max("end_ts").alias("_to"),
    )
    wall = minutes_between(F.col("_to"), F.col("_from")) * 60
    active = F.struct(
        F.when(F.col("_whole") == 1, "active_total").otherwise(F.col(phase)).alias("scope"),
        F.col("seconds").cast("double").alias("seconds"),
    )
    rows = F.when(
        F.col("_whole") == 1,
        F.array(active, F.struct(F.lit("wall_clock").alias("scope"), wall.alias("seconds"))),
    ).otherwise(F.array(active))
    long = rolled.select(*UNITS, F.inline(rows))
    per_min = {f"{u}_per_min": F.round(rate(F.col(u) * 60, F.col("seconds")), 3) for u in UNITS}
    return long.withColumns(per_min).withColumn("minutes", F.round(F.col("seconds") / 60, 2)).drop("seconds")


def run_compare(runs: DataFrame, baseline: str, on: str = "input_id", key: str = "run_id") -> DataFrame:
    """Every run against the baseline run on the same input."""
    base = runs.where(F.col(key) == baseline).select(
        on, F.col("seconds").alias("_seconds"), *[F.col(u).alias(f"_{u}") for u in UNITS]
    )
    joined = runs.where(F.col(key) != baseline).join(base, on)
    deltas = {
        f"{u}_per_min_delta": F.round(
            rate(F.col(u) * 60, F.col("seconds")) - rate(F.col(f"_{u}") * 60, F.col("_seconds")), 6
        )
        for u in UNITS
    }
    wall = F.round(F.try_divide(F.col("seconds").cast("double"), F.col("_seconds").cast("double")), 6)
    return joined.select(key, on, wall.alias("wall_ratio"), *[c.alias(n) for n, c in deltas.items()])


def eta_projection(progress: DataFrame) -> DataFrame:
    """Minutes left and for the full set at the observed rate; null before any progress.

    ``progress`` has done, total and seconds.
    """
    per_item = F.try_divide(F.col("seconds").cast("double"), F.col("done").cast("double"))
    return progress.withColumns(
        {
            "remaining": F.col("total") - F.col("done"),
            "per_min": F.round(rate(F.col("done") * 60, F.col("seconds")), 6),
            "eta_min": F.round((F.col("total") - F.col("done")) * per_item / 60, 4),
            "full_min": F.round(F.col("total") * per_item / 60, 4),
        }
    )


def stage_perf(perf: DataFrame, keys: Sequence[str] = ("stage",)) -> DataFrame:
    """Sum, mean and population deviation of process and idle time, and items, per stage."""
    columns = []
    for name in ("process_s", "idle_s"):
        columns += [
            F.round(F.sum(name), 4).alias(f"{name}_sum"),
            F.round(F.avg(name), 4).alias(f"{name}_mean"),
            F.round(F.stddev_pop(name), 4).alias(f"{name}_std"),
        ]
    return perf.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_tasks"), F.sum("items").alias("items"), *columns)


def batch_sweep(
    runs: DataFrame, repeats: int = 2, memory_share: float = 0.9, growth: float = 0.0
) -> DataFrame:
    """Which caption batch sizes qualify, with one row marked ``selected``.

    A size qualifies when it ran at least ``repeats`` times, never ran out of memory, stayed
    below the memory share, did not slow down against the next smaller size and its
    object store did not grow by more than ``growth``. The largest that qualifies wins.
    """
    per_size = runs.groupBy("batch_size").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if("oom").alias("n_oom"),
        F.max("memory_share").alias("peak_memory"),
        F.max("store_growth").alias("peak_growth"),
        rate(F.sum("captions"), F.sum("seconds")).alias("_rate"),
    )
    before = F.lag("_rate").over(W.orderBy("batch_size"))
    judged = per_size.withColumn("not_slower", F.coalesce(F.col("_rate") >= before, F.lit(True)))
    judged = judged.withColumn(
        "qualifies",
        (F.col("n_runs") >= repeats)
        & (F.col("n_oom") == 0)
        & (F.col("peak_memory") < memory_share)
        & F.col("not_slower")
        & (F.col("peak_growth") <= growth),
    )
    best = F.max(F.when(F.col("qualifies"), F.col("batch_size"))).over(W.partitionBy())
    return judged.withColumns(
        {
            "selected": F.coalesce(F.col("batch_size") == best, F.lit(False)),
            "captions_per_s": F.round("_rate", 6),
        }
    ).drop("_rate")


def hypothesis_verdict(measured: DataFrame) -> DataFrame:
    """supported, rejected, or inconclusive without a measurement.

    ``measured`` has hypothesis, value, threshold and direction (``above``/``below``).
    """
    holds = F.when(F.col("direction") == "above", F.col("value") > F.col("threshold")).otherwise(
        F.col("value") < F.col("threshold")
    )
    verdict = F.when(holds.isNull(), "inconclusive").when(holds, "supported").otherwise("rejected")
    return measured.withColumn("verdict", verdict)


def preflight_gate(
    media: DataFrame,
    gpus_needed: int = 0,
    gpus: int = 0,
    first: int | None = None,
    order: str = "media_path",
    problems: Sequence[str] = (),
) -> DataFrame:
    """Conditions a run must meet as (check, ok, detail) rows.

    ``problems`` are faults found before, such as a missing input folder. Input figures are
    one aggregate over the selected inputs: the ``first`` ones in ``order``.
    """
    figures = video_limit(media, first, order).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("total")
    )
    found = figures.select(
        F.lit("inputs").alias("check"), (F.col("n") > 0).alias("ok"), F.concat_ws(" ", "n", F.lit("files,"), "total", F.lit("bytes")).alias("detail")
    )
    known = [
        ("parameters", not problems, "; ".join(problems)),
        ("gpu_capacity", gpus_needed <= gpus, f"needs {gpus_needed}, has {gpus}"),
    ]
    return media.sparkSession.createDataFrame(known, found.schema).unionByName(found)


def require_preflight(gate: DataFrame) -> None:
    """Raise when any check failed; the gate has a fixed handful of rows."""
    failed = gate.where(~F.col("ok")).collect()
    if failed:
        raise RuntimeError("; ".join(f"{r['check']}: {r['detail']}" for r in failed))
