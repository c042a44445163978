"""Inputs in the external formats, written by Spark from the driver's tables."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgauge.plans import bindings as b
from reelgauge.schemas import STAGE_COLUMNS

WORD_COUNT = T.StructType([T.StructField("n_words", T.LongType())])


def _suffixed(doc_id):
    options = F.array(*[F.lit(x) for x in (".mp4", ".MOV", ".avi", ".txt", "", ".webm", ".tar.mkv")])
    return F.element_at(options, (doc_id % 7 + 1).cast("int"))


def write_input_list(spark: SparkSession, sf: str, folder: str) -> None:
    """Padded paths with a blank line after every entry."""
    lines = F.array(F.concat(F.lit("  "), "media_path", F.lit(" \t")), F.lit("   "))
    b.media(spark, sf).select(F.explode(lines).alias("value")).write.text(folder)


def _file_writer(folder: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        made: set[str] = set()
        for frame in frames:
            for name, body in zip(frame["name"], frame["body"], strict=True):
                parent, final = f"{inner}/{name}".rsplit("/", 1)[0], f"{inner}/{name}"
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(final) as sink:
                    sink.write(body.encode())
            yield pd.DataFrame({"n": [len(frame)]})

    return write


def write_files(rows: DataFrame, folder: str, deal: bool = True) -> None:
    """One file for each row of (name, body); a repeated task writes the same files again.

    Rows are dealt by name, so that a name is written by one task; with unique names ``deal=False`` saves that shuffle.
    """
    named = rows.select("name", "body")
    named = named.repartition("name") if deal else named
    named.mapInPandas(_file_writer(folder), "n bigint").write.format("noop").mode("overwrite").save()


def write_media(spark: SparkSession, sf: str, folder: str) -> None:
    """A file for each document, below a folder for each source, media and others in either case."""
    docs = b.table(spark, sf, "documents")
    name = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), _suffixed(F.col("doc_id")))
    write_files(docs.select(name.alias("name"), F.col("text").alias("body")), folder, deal=False)


def run_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The files of a run folder as (name, body) by stage: metadata documents, clips, markers of the sources."""
    docs = b.clip_docs(spark, sf).drop("metadata_path")
    clips = docs.where("clip_no % 10 <> 0")
    done = docs.where("clip_no % 4 <> 0").select("source_video").distinct()
    mark = F.concat(F.lit("processed_videos/"), F.regexp_extract("source_video", r"(\d+)", 1), F.lit(".json"))
    return {
        "metas": docs.select(F.concat(F.lit("metas/v0/"), "span_uuid", F.lit(".json")).alias("name"), F.to_json(F.struct(*[c for c in docs.columns if c != "clip_no"])).alias("body")),
        "clips": clips.select(F.concat(F.lit("clips/"), "span_uuid", F.when(F.col("clip_no") % 9 == 0, ".part").otherwise(".mp4")).alias("name"), F.col("span_uuid").alias("body")),
        "markers": done.select(mark.alias("name"), F.to_json(F.struct(F.col("source_video").alias("video"))).alias("body")),
    }


def _tar_writer(folder: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(inner, recursive=True)
        context = TaskContext.get()
        final = f"{inner}/shard-{context.partitionId():06d}.tar"
        draft = f"{inner}/.draft-{context.taskAttemptId()}"
        rows = 0
        with system.open_output_stream(draft) as sink, tarfile.open(fileobj=sink, mode="w|") as archive:
            for frame in frames:
                for name, text in zip(frame["name"], frame["text"], strict=True):
                    payload = text.encode()
                    member = tarfile.TarInfo(name)
                    member.size = len(payload)
                    archive.addfile(member, io.BytesIO(payload))
                    rows += 1
        system.move(draft, final)
        yield pd.DataFrame({"shard": [final], "n": [rows]})

    return write


def write_shards(spark: SparkSession, sf: str, folder: str) -> None:
    """One tar shard per partition; a finished shard appears under its name at once."""
    docs = b.table(spark, sf, "documents")
    name = F.concat(
        F.when(F.col("doc_id") % 10 == 9, "../").otherwise("60s/"), F.col("doc_id").cast("string"), _suffixed(F.col("doc_id"))
    )
    named = docs.select("doc_id", name.alias("name"), "text").repartition("doc_id").select("name", "text")
    named.mapInPandas(_tar_writer(folder), "shard string, n bigint").write.format("noop").mode("overwrite").save()


def write_clip_docs(spark: SparkSession, sf: str, folder: str) -> None:
    """Metadata documents as JSON lines; every other error field is a bare list of stages."""
    docs = b.clip_docs(spark, sf)
    stages = F.to_json(F.map_keys("errors"))
    errors = F.when(F.col("clip_no") % 12 == 0, stages).otherwise(F.to_json("errors"))
    shaped = docs.withColumn("errors", F.parse_json(errors)).drop("clip_no", "metadata_path")
    shaped.write.json(folder)


def write_markers(spark: SparkSession, sf: str, folder: str) -> None:
    """Processed markers with repeats, broken documents and documents without a path."""
    marker = F.to_json(F.struct(F.col("media_path").alias("video")))
    lines = F.array(marker, marker, F.lit('{"video": '), F.lit('{"other": 1}'), F.lit('{"video": ""}'))
    b.processed(spark, sf).select(F.explode(lines).alias("value")).write.text(folder)


def probe_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Probe output with one field missing, blank or zero by document."""
    kind = F.col("doc_id") % 7
    quoted = lambda name, value: F.concat(F.lit(f'"{name}": "'), value.cast("string"), F.lit('"'))
    bare = lambda name, value: F.concat(F.lit(f'"{name}": '), value.cast("string"))
    media = b.media(spark, sf)
    stream = F.concat_ws(
        ", ",
        bare("width", F.col("width")),
        bare("height", F.col("height")),
        quoted("avg_frame_rate", F.when(F.col("fps") == 30, "30000/1001").otherwise(F.col("fps").cast("int").cast("string"))),
        F.when(kind != 3, quoted("bit_rate", F.col("bitrate"))),
    )
    form = F.concat_ws(
        ", ",
        quoted("duration", F.col("duration_s")),
        F.when(kind == 5, F.lit('"bit_rate": 0')).when(~kind.isin(2, 3), quoted("bit_rate", F.col("bitrate") + 1)),
        F.when(kind == 5, F.lit('"size": ""')).when(kind == 6, F.lit('"size": "0"')).when(kind != 1, quoted("size", F.col("size_bytes") + 3)),
    )
    streams = F.when(kind == 4, F.lit("[]")).otherwise(F.concat(F.lit("[{"), stream, F.lit("}]")))
    document = F.concat(F.lit('{"streams": '), streams, F.lit(', "format": {'), form, F.lit("}}"))
    return media.select("doc_id", "size_bytes", document.alias("document"))


def write_log(lines: DataFrame, folder: str) -> None:
    """Log lines as text files in line order; a log is never cut between files."""
    ordered = lines.repartitionByRange("file").sortWithinPartitions("file", "line_no")
    ordered.select(F.col("line").alias("value")).write.text(folder)


def log_bodies(lines: DataFrame) -> DataFrame:
    """Each log as one text (name, body), for logs of bounded length such as those of a day."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))["line"]
    text = F.concat(F.array_join(ordered, "\n"), F.lit("\n"))
    return lines.groupBy(F.concat("file", F.lit(".log")).alias("name")).agg(text.alias("body"))


def stage_text(spark: SparkSession, sf: str) -> DataFrame:
    """``stage_state`` as text rows; a zero queue is left blank."""
    state = b.stage_state(spark, sf)
    zero = F.lit("0")
    values = {
        "timestamp": F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".000000")),
        "input_queue": F.when(F.col("input_queue") != 0, F.col("input_queue")),
        "actors_target": zero, "actors_pending": F.lit(""), "tasks_returned_none": zero,
        "slots_used": F.lit("1"), "slots_empty": F.lit(None),
    }
    return state.select(*[values.get(n, F.col(n) if n in state.columns else None).cast("string").alias(n) for n in STAGE_COLUMNS])


def write_gpu_csv(spark: SparkSession, sf: str, folder: str) -> None:
    samples = b.gpu_samples(spark, sf)
    unit = lambda name, suffix: F.concat(F.col(name).cast("string"), F.lit(f" {suffix}"))
    samples.select(
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss.SSSSSS").alias("ts"), "gpu",
        unit("utilization", "%").alias("u"), unit("memory_used", "MiB").alias("m"),
        unit("memory_total", "MiB").alias("t"), unit("power", "W").alias("p"),
    ).write.option("header", False).csv(folder)


def run_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of the daily runs; a day with many failures counts as failed."""
    daily = b.runs(spark, sf)
    failed = F.col("failures") > F.col("windows")
    double = lambda name: F.col(name).cast("double")
    return daily.select(
        "run_id",
        F.when(failed, "failed").otherwise("succeeded").alias("status"),
        double("seconds").alias("wall_time_s"),
        F.col("videos").alias("output_tasks"),
        F.create_map(F.lit("clip_files"), double("clips"), F.lit("windows"), double("windows")).alias("artifacts"),
        F.create_map(F.lit("batch_size"), F.col("batch_size").cast("string")).alias("config"),
        F.create_map(F.lit("input_files"), F.col("videos").cast("string")).alias("environment"),
        F.when(failed, F.concat(F.col("failures").cast("string"), F.lit(" failures"))).alias("error"),
    )


def rerun_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A folder before and after a rerun: some files dropped, some changed, some new."""
    docs = b.table(spark, sf, "documents")
    path = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"))
    before = docs.select(path.alias("path"), F.col("text").alias("content"))
    changed = F.when(F.col("doc_id") % 50 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    kept = docs.where(F.col("doc_id") % 50 != 1).select(path.alias("path"), changed.alias("content"))
    added = b.table(spark, sf, "benchmark").select(
        F.concat(F.lit("bench/"), F.col("item_id").cast("string")).alias("path"), F.col("text").alias("content")
    )
    return before, kept.unionByName(added)


def member_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Page addresses without scheme as member names, some of them unsafe."""
    below = F.regexp_replace("url", "^[a-z]+://", "")
    kind = F.col("page_id") % 5
    prefix = F.when(kind == 0, "../").when(kind == 1, "/").otherwise("")
    return b.table(spark, sf, "pages").select("page_id", F.concat(prefix, below).alias("member_path"))


def word_counter() -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Counts words; every 97th document is a planned failure."""

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["doc_id"] % 97 == 0).any():
            raise ValueError("planned failure")
        return pd.DataFrame({"n_words": batch["caption"].str.count(r"\S+").astype("int64")})

    return count
