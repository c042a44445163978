"""Host and accelerator samples: interval statistics and alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.numeric import ratio


def gpu_window_stats(samples: DataFrame, interval: str = "1 hour", keys: Sequence[str] = ("gpu",)) -> DataFrame:
    """Mean and peak utilisation, memory and power per accelerator and interval."""
    stats = []
    for name in ("utilization", "memory_used", "power"):
        stats += [F.round(F.avg(name), 4).alias(f"{name}_mean"), F.max(name).alias(f"{name}_max")]
    return (
        samples.groupBy(F.window("ts", interval).alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("n_samples"), *stats)
        .withColumn("window_start", F.col("_w.start"))
        .drop("_w")
    )


def default_rules() -> dict[str, Column]:
    """Alert name to condition; a rule over a column that is null never fires."""
    return {
        "disk_low": F.col("disk_free") < F.col("disk_total") * 0.05,
        "gpu_memory_high": F.col("memory_used") >= F.col("memory_total") * 0.9,
    }


def resource_alerts(
    samples: DataFrame,
    interval: str = "1 hour",
    keys: Sequence[str] = ("host",),
    rules: Mapping[str, Column] | None = None,
    store_used: str = "store_used",
    store_capacity: str = "store_capacity",
) -> DataFrame:
    """Alerts per host and interval: how many samples broke the rule, and the store's peak share."""
    rules = rules or default_rules()
    fired = F.filter(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]), lambda n: n.isNotNull())
    share = ratio(F.col(store_used), F.col(store_capacity))
    return (
        samples.withColumns({"_fired": fired, "_share": share})
        .where(F.size("_fired") > 0)
        .select(*keys, F.window("ts", interval).alias("_w"), F.explode("_fired").alias("alert"), "ts", "_share")
        .groupBy(*keys, "_w", "alert")
        .agg(F.count(F.lit(1)).alias("n_samples"), F.min("ts").alias("first_ts"), F.max("_share").alias("store_share_max"))
        .withColumn("window_start", F.col("_w.start"))
        .drop("_w")
    )
