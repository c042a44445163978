"""Row-to-many-rows planning: clip spans, caption windows, frame samples, chunks.

Every generator is narrow, so a plan runs straight off the manifest scan without a
shuffle and only small columns travel with the exploded rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.ids import span_id
from reelgauge.operators.inventory import video_limit


def _indexes(count: Column) -> Column:
    """[0 .. count-1]; ``sequence`` alone would count down from 0 for an empty range."""
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def span_count(
    duration: Column, clip_len: float = 10.0, stride: float = 10.0, min_len: float = 2.0, limit_clips: int = 0
) -> Column:
    """How many spans one file gives: starts at k*stride whose span lasts min_len or more."""
    if min(clip_len, stride, min_len) <= 0:
        raise ValueError("clip_len, stride and min_len must be positive")
    if min_len > clip_len:
        return F.lit(0).cast("bigint")
    whole = F.floor((duration - F.lit(float(min_len))) / F.lit(float(stride))) + 1
    count = F.when(duration >= min_len, whole).otherwise(F.lit(0)).cast("bigint")
    return F.least(count, F.lit(limit_clips).cast("bigint")) if limit_clips > 0 else count


def fixed_stride_spans(
    df: DataFrame,
    duration: str = "duration_s",
    clip_len: float = 10.0,
    stride: float = 10.0,
    min_len: float = 2.0,
    limit_clips: int = 0,
) -> DataFrame:
    """One row per clip span with ``clip_index``, ``start_s`` and ``end_s``.

    ``limit_clips`` caps spans per file when above 0.
    """
    count = span_count(F.col(duration), clip_len, stride, min_len, limit_clips)
    start = F.col("clip_index") * F.lit(float(stride))
    return df.withColumn("clip_index", F.explode(_indexes(count))).withColumns(
        {"start_s": start, "end_s": F.least(start + F.lit(float(clip_len)), F.col(duration))}
    )


def with_clip_id(df: DataFrame, media_path: str = "media_path") -> DataFrame:
    return df.withColumn("clip_id", span_id(F.col(media_path), F.col("start_s"), F.col("end_s")))


def clip_chunks(df: DataFrame, clips_per_chunk: int = 32) -> DataFrame:
    """Adds the chunk a clip travels in."""
    return df.withColumn("chunk_index", F.floor(F.col("clip_index") / clips_per_chunk).cast("int"))


def chunk_sizes(clips: DataFrame, clips_per_chunk: int = 32, media_path: str = "media_path") -> DataFrame:
    return (
        clip_chunks(clips, clips_per_chunk)
        .groupBy(media_path, "chunk_index")
        .agg(F.count(F.lit(1)).alias("n_clips"))
    )


def window_count(frames: Column, window: int = 256, remainder: int = 128) -> Column:
    """Full windows, plus one for a remainder of at least ``remainder`` frames; 0 without frames."""
    full = F.floor(frames / window)
    extra = (F.pmod(frames, F.lit(window)) >= remainder).cast("bigint")
    return F.when(frames > 0, F.greatest(full + extra, F.lit(1))).otherwise(F.lit(0)).cast("bigint")


def caption_windows(
    clips: DataFrame, fps: str = "fps", window: int = 256, remainder: int = 128
) -> DataFrame:
    """One row per caption window, [start_frame, end_frame) inside its clip.

    The last window runs to the end of the clip, so a remainder too short for its
    own window is absorbed.
    """
    frames = F.round((F.col("end_s") - F.col("start_s")) * F.col(fps)).cast("bigint")
    exploded = (
        clips.withColumn("_frames", frames)
        .withColumn("_windows", window_count(F.col("_frames"), window, remainder))
        .withColumn("window_index", F.explode(_indexes(F.col("_windows"))))
    )
    start = (F.col("window_index") * window).cast("int")
    is_last = F.col("window_index") == F.col("_windows") - 1
    end = F.when(is_last, F.col("_frames")).otherwise(start + window).cast("int")
    return exploded.withColumns({"start_frame": start, "end_frame": end}).drop("_frames", "_windows")


def frame_samples(windows: DataFrame, fps: str = "fps", sampling_fps: float = 2.0) -> DataFrame:
    """One row per sampled frame of a window, every fps/sampling_fps frames from its start."""
    step = F.col(fps) / F.lit(float(sampling_fps))
    length = F.col("end_frame") - F.col("start_frame")
    most = F.ceil(length / step).cast("int") + 1
    exploded = windows.withColumn("sample_index", F.explode(_indexes(most)))
    frame = F.col("start_frame") + F.round(F.col("sample_index") * step).cast("int")
    return exploded.withColumn("frame", frame).where(F.col("frame") < F.col("end_frame"))


def windows_explode(docs: DataFrame, windows: str = "windows", keep_empty: bool = False) -> DataFrame:
    """One row per window of a metadata document with its position."""
    explode = F.posexplode_outer if keep_empty else F.posexplode
    others = [name for name in docs.columns if name != windows]
    return docs.select(*others, explode(windows).alias("window_index", "window"))


def windows_per_clip(windows: DataFrame, keys=("media_path", "clip_index"), high_fps: float = 50.0) -> DataFrame:
    """How many clips have 1, 2, ... windows, and how many of those are high frame rate."""
    per_clip = windows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_windows"), F.max("fps").alias("_fps"))
    return per_clip.groupBy("n_windows").agg(
        F.count(F.lit(1)).alias("n_clips"), F.count_if(F.col("_fps") >= high_fps).alias("n_high_fps")
    )


@dataclass(frozen=True)
class PlanRule:
    """What is planned from a manifest: spans, chunks and, unless ``windows`` is None, caption windows."""

    length_s: float = 10.0
    stride_s: float = 10.0
    least_s: float = 2.0
    #: Spans kept per file; 0 keeps all.
    first_clips: int = 0
    chunk: int = 32
    #: Frames of a window, and of the shortest remainder that is a window of its own.
    windows: tuple[int, int] | None = None

    def spans(self, media: DataFrame) -> DataFrame:
        return fixed_stride_spans(
            media, clip_len=self.length_s, stride=self.stride_s, min_len=self.least_s, limit_clips=self.first_clips
        )


def plan_totals(media: DataFrame, group: str = "subset", rule: PlanRule = PlanRule()) -> DataFrame:
    """Files, clips and caption windows per group, counted without exploding anything."""
    length, stride = float(rule.length_s), float(rule.stride_s)
    frames, remainder = rule.windows or (256, 128)
    duration, fps, clips = F.col("duration_s"), F.col("fps"), F.col("_clips")
    # All spans that end inside the file are equally long; those cut by its end are counted one by one.
    whole = F.least(clips, F.greatest(F.floor((duration - length) / stride) + 1, F.lit(0)).cast("bigint"))
    of = lambda seconds: window_count(F.round(seconds * fps).cast("bigint"), frames, remainder)
    last = -(-length // stride)
    cut = F.transform(F.sequence(F.lit(0), F.lit(int(last))), lambda i: F.when(whole + i < clips, of(duration - (whole + i) * stride)).otherwise(F.lit(0)))
    tail = F.aggregate(cut, F.lit(0).cast("bigint"), lambda total, n: total + n)
    counted = media.select(
        group, "duration_s", "fps", span_count(duration, length, stride, float(rule.least_s), rule.first_clips).alias("_clips")
    )
    return counted.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_media"),
        F.sum("_clips").alias("n_clips"),
        F.sum((whole * of(F.lit(length)) + tail).cast("bigint")).alias("n_windows"),
    )


def plan_run(media: DataFrame, rule: PlanRule = PlanRule(), first: int | None = None, order: str = "media_path") -> DataFrame:
    """The whole plan of a run: clips with id and chunk, and with windows asked for their windows.

    Input selection (the ``first`` inputs in ``order``) comes before, so nothing is generated for unwanted files.
    """
    clips = clip_chunks(with_clip_id(rule.spans(video_limit(media, first, order))), rule.chunk)
    if rule.windows is None:
        return clips
    return caption_windows(clips, window=rule.windows[0], remainder=rule.windows[1])
