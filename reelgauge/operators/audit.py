"""Conservation, coverage, identity and error accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.paths import suffix
from reelgauge.functions.text import has_caption_key, has_caption_text
from reelgauge.operators.ordered import attach


def missing_outputs(docs: DataFrame, listing: DataFrame, location: str = "clip_location") -> DataFrame:
    """Metadata whose artifact is not in the listing."""
    files = listing.select(F.col("path").alias(location)).distinct()
    return docs.join(files, location, "left_anti")


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    seen = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return seen.where(F.col("n") > 1)


def conservation_audit(
    expected: DataFrame,
    written: DataFrame,
    errors: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
) -> DataFrame:
    """Expected against written counts per source, and whether errors explain the gap.

    ``expected`` and ``written`` carry one count column per measure and are summed per
    key before they meet, so a hot source is folded map-side. ``errors`` has one row
    per recorded failure.
    """

    def summed(df: DataFrame, label: str) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(m).alias(f"{label}_{m}") for m in measures])

    left, right = summed(expected, "expected"), summed(written, "written")
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[f"written_{m}" for m in measures])
    match = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    condition = match[0]
    for extra in match[1:]:
        condition = condition & extra
    joined = left.join(right, condition, "full_outer")
    for k in keys:
        joined = joined.withColumn(k, F.coalesce(F.col(k), F.col(f"_r_{k}"))).drop(f"_r_{k}")
    counts = [f"{side}_{m}" for side in ("expected", "written") for m in measures]
    joined = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in counts})
    failed = errors.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_errors"))
    joined = attach(joined, failed, keys).withColumn("n_errors", F.coalesce("n_errors", F.lit(0)).cast("bigint"))
    gaps = {f"missing_{m}": F.col(f"expected_{m}") - F.col(f"written_{m}") for m in measures}
    joined = joined.withColumns(gaps)
    closed = F.lit(True)
    explained = F.lit(True)
    for name in gaps:
        closed = closed & (F.col(name) == 0)
        explained = explained & (F.col(name) >= 0) & (F.col(name) <= F.col("n_errors"))
    status = F.when(closed, "closed").when(explained, "explained").otherwise("unexplained")
    return joined.withColumn("status", status)


def manifest(df: DataFrame, path: str, content: str) -> DataFrame:
    """Path and SHA-256 of the content; only the digest travels further."""
    return df.select(F.col(path).alias("path"), F.sha2(F.col(content), 256).alias("checksum"))


def rerun_manifest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """added / removed / changed / same for every path of two manifests.

    One aggregate over both sides instead of a join; should a path repeat on a side, its
    largest checksum stands for it.
    """
    none = F.lit(None).cast("string")
    both = before.select("path", F.col("checksum").alias("_old"), none.alias("_new"), F.lit(1).alias("_side")).unionByName(
        after.select("path", none.alias("_old"), F.col("checksum").alias("_new"), F.lit(2).alias("_side"))
    )
    seen = both.groupBy("path").agg(
        F.max("_old").alias("old_checksum"), F.max("_new").alias("new_checksum"), F.bit_or("_side").alias("_side")
    )
    change = (
        F.when(F.col("_side") == 2, "added")
        .when(F.col("_side") == 1, "removed")
        .when(F.col("old_checksum").eqNullSafe(F.col("new_checksum")), "same")
        .otherwise("changed")
    )
    return seen.select("path", change.alias("change"), "old_checksum", "new_checksum")


def input_identity(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """How two input sets overlap, from one shuffle over both."""
    both = first.select(key, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        second.select(key, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    seen = both.groupBy(key).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    counted = seen.agg(
        F.count_if((F.col("_a") == 1) & (F.col("_b") == 0)).alias("only_first"),
        F.count_if((F.col("_a") == 0) & (F.col("_b") == 1)).alias("only_second"),
        F.count_if((F.col("_a") == 1) & (F.col("_b") == 1)).alias("in_both"),
    )
    return counted.withColumn("identical", (F.col("only_first") == 0) & (F.col("only_second") == 0))


def source_coverage(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Input sources that appear nowhere in the output."""
    return inputs.select(key).distinct().join(outputs.select(key).distinct(), key, "left_anti")


def errors_map(errors: Column) -> Column:
    """A VARIANT error field as stage -> message.

    A mapping keeps its messages; the older bare list of stages gets null messages.
    """
    as_map = F.try_variant_get(errors, "$", "map<string,string>")
    as_list = F.try_variant_get(errors, "$", "array<string>")
    from_list = F.map_from_arrays(as_list, F.transform(as_list, lambda _: F.lit(None).cast("string")))
    return F.coalesce(as_map, from_list)


def errors_explode(docs: DataFrame, errors: str = "errors", keep: Sequence[str] = ()) -> DataFrame:
    """One row per recorded failure: the kept columns, stage and message."""
    if docs.schema[errors].dataType.typeName() == "variant":
        docs = docs.withColumn(errors, errors_map(F.col(errors)))
    return docs.select(*keep, F.explode(errors).alias("stage", "message"))


def error_rollup(errors: DataFrame, stage: str = "stage", source: str = "source_video") -> DataFrame:
    """Failures by stage and source, by each alone, and in total."""
    return (
        errors.cube(stage, source)
        .agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n_errors"))
    )


def validity_rules(docs: DataFrame, captions: bool = True, windows: str = "windows") -> DataFrame:
    """Adds ``accepted``: what the validity flag of a finished clip should be.

    With captions a clip needs a window and text in every window. Without, an empty
    window list and a false flag are right.
    """
    filled = F.coalesce(F.col(windows), F.array().cast(docs.schema[windows].dataType))
    n_windows = F.size(filled)
    every_text = F.forall(filled, has_caption_text)
    accepted = (n_windows > 0) & every_text if captions else n_windows == 0
    flag = F.coalesce(F.col("valid"), F.lit(False))
    agrees = accepted == flag if captions else accepted & ~flag
    return docs.withColumns(
        {"n_windows": n_windows.cast("bigint"), "accepted": accepted, "flag_agrees": agrees}
    )


def _as_rows(one_row: DataFrame) -> DataFrame:
    """Columns of a one-row table as (metric, suffix, value) rows."""
    cells = [F.struct(F.lit(c).alias("metric"), F.lit(None).cast("string").alias("suffix"), F.col(c).alias("value")) for c in one_row.columns]
    return one_row.select(F.inline(F.array(*cells)))


def listing_metrics(listing: DataFrame) -> DataFrame:
    """Files, bytes, clip files and metadata files in all, and files per suffix.

    ``listing`` has ``relative_path`` below the output folder and ``size_bytes``. Suffixes
    come out as rows, however many there are.
    """
    path, ending = F.col("relative_path"), suffix(F.col("relative_path"))
    in_folder = lambda folder, kind: F.count_if(path.startswith(folder) & path.endswith(kind))
    totals = listing.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("total_bytes"),
        in_folder("clips/", ".mp4").alias("clip_files"),
        in_folder("metas/v0/", ".json").alias("metadata_files"),
    )
    by_suffix = listing.groupBy(F.when(ending == "", "<none>").otherwise(ending).alias("suffix")).agg(
        F.count(F.lit(1)).alias("value")
    )
    return _as_rows(totals).unionByName(by_suffix.withColumn("metric", F.lit("files_by_suffix")))


def metadata_metrics(docs: DataFrame, windows: str = "windows") -> DataFrame:
    """One row: valid clips and captioned windows, by key presence and by text."""
    per_doc = docs.select(
        F.coalesce(F.col("valid"), F.lit(False)).alias("_valid"),
        F.size(F.filter(windows, has_caption_key)).alias("_keyed"),
        F.size(F.filter(windows, has_caption_text)).alias("_texted"),
    )
    # A missing window list has size -1 or null and counts as none.
    at_least_zero = lambda name: F.coalesce(F.sum(F.greatest(F.col(name), F.lit(0))), F.lit(0)).cast("bigint")
    return per_doc.agg(
        F.count_if("_valid").alias("valid_clips"),
        at_least_zero("_keyed").alias("captioned_windows"),
        at_least_zero("_texted").alias("windows_with_text"),
    )


def artifact_metrics(listing: DataFrame, docs: DataFrame) -> DataFrame:
    """All figures of one output folder as (metric, suffix, value) rows."""
    return listing_metrics(listing).unionByName(_as_rows(metadata_metrics(docs)))
