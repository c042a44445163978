"""User code over batches of rows, with setup per worker and failures kept per row."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_READY: dict[str, Callable[[pd.DataFrame], pd.DataFrame]] = {}


def _batches(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Cut or join incoming frames to exactly ``size`` rows; the last may be shorter."""
    held: list[pd.DataFrame] = []
    rows = 0
    for frame in frames:
        while len(frame):
            part, frame = frame.iloc[: size - rows], frame.iloc[size - rows :]
            held.append(part)
            rows += len(part)
            if rows == size:
                yield pd.concat(held, ignore_index=True)
                held, rows = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def batched_map(
    df: DataFrame,
    factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    batch_size: int,
    out_schema: T.StructType,
    workers: int | None = None,
    profile: ResourceProfile | None = None,
    stage: str = "batched_map",
    inputs: Sequence[str] | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Apply ``factory()(batch)`` to batches of ``batch_size`` rows.

    The factory runs once per Python worker. The function returns one row per input row,
    in order, with the columns of ``out_schema``; they are appended to the kept columns. It sees the ``inputs``; of
    the table only ``inputs`` and ``keep`` are read and pass through Python (both are all columns unless given).
    When a batch fails its halves are tried, down to single rows, so the function must
    bear being called again on the same rows. A row that fails alone gets nulls and its
    message under ``stage`` in the ``errors`` map. ``workers`` sets the number of partitions; ``profile`` asks Spark for e.g. one accelerator per task.
    """
    if batch_size <= 0 or (workers is not None and workers <= 0):
        raise ValueError("batch_size and workers must be positive")
    token = uuid.uuid4().hex
    names = out_schema.fieldNames()
    inputs, keep = (list(df.columns if c is None else c) for c in (inputs, keep))
    slim = df.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*keep, *inputs])))
    source = slim.repartition(workers) if workers else slim
    error_type = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([*(source.schema[c] for c in keep), *out_schema.fields, T.StructField("errors", error_type)])

    def run(batch: pd.DataFrame, work) -> pd.DataFrame:
        made = work(batch[inputs])
        if len(made) != len(batch):
            raise ValueError(f"{len(batch)} rows in, {len(made)} rows out")
        made = made[names].reset_index(drop=True)
        made["errors"] = None
        return made

    def attempt(batch: pd.DataFrame, work) -> list[pd.DataFrame]:
        """Halve a failing batch until the failing rows stand alone."""
        try:
            return [run(batch, work)]
        except Exception as error:
            if len(batch) == 1:
                failure = {stage: f"{type(error).__name__}: {error}"}
                return [pd.DataFrame([{**dict.fromkeys(names), "errors": failure}], dtype=object)]
            middle = len(batch) // 2
            halves = (batch.iloc[:middle], batch.iloc[middle:])
            return [part for half in halves for part in attempt(half.reset_index(drop=True), work)]

    def over_partition(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Imported here so that every task of a worker process sees the same cache.
        from reelgauge.operators import batched

        if token not in batched._READY:
            batched._READY.clear()  # one user object at a time: the last call's is freed
            batched._READY[token] = factory()
        work = batched._READY[token]
        for batch in _batches(frames, batch_size):
            parts = [part.astype(object) for part in attempt(batch, work)]
            yield pd.concat([batch[keep], pd.concat(parts, ignore_index=True)], axis=1)

    return source.mapInPandas(over_partition, schema, profile=profile)
