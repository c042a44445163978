"""A sorted, searchable, paged index of finished clips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.paths import artifact_url
from reelgauge.operators.ordered import global_position

PAGE_SIZE = 10
INDEX_ORDER = ("source_video", "duration_span", "id")


def gallery_items(docs: DataFrame, listing: DataFrame, run_dir: str) -> DataFrame:
    """Metadata documents whose clip file exists, as index items.

    ``docs`` is ``clip_meta_read`` output with ``metadata_path``; ``listing`` has one
    ``path`` per existing file.
    """
    files = listing.select(F.col("path").alias("clip_location"))
    root = F.lit(run_dir)
    return docs.join(files, "clip_location", "left_semi").select(
        F.col("span_uuid").alias("id"),
        "source_video",
        "duration_span",
        "width",
        "height",
        "framerate",
        F.greatest(F.coalesce(F.size("windows"), F.lit(0)), F.lit(0)).cast("bigint").alias("window_count"),
        F.coalesce("valid", F.lit(False)).alias("valid"),
        artifact_url(F.col("clip_location"), root).alias("video_url"),
        artifact_url(F.col("metadata_path"), root).alias("metadata_url"),
    )


def gallery_index(items: DataFrame, run_id: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Items in index order with run id, item count and page size on every row."""
    total = items.select(F.count(F.lit(1))).scalar()
    return items.withColumns(
        {"run_id": F.lit(run_id), "item_count": total, "page_size": F.lit(page_size)}
    ).orderBy(*INDEX_ORDER)


def gallery_search(items: DataFrame, query: str) -> DataFrame:
    """Items whose id or source contains the query, ignoring case; a blank query keeps all."""
    wanted = query.strip().lower()
    if not wanted:
        return items
    hit = lambda name: F.contains(F.lower(F.col(name)), F.lit(wanted))
    return items.where(hit("id") | hit("source_video"))


def gallery_page(items: DataFrame, page: int, size: int = PAGE_SIZE) -> DataFrame:
    """One page with page number, page count and filtered count; the number is clamped.

    For a table that is not stored: rows get their place from one distributed sort, so a page deep inside a large index
    costs the same as the first and nothing passes through the driver. An index that is asked for more than one page is
    better stored by ``sources.ranked``, whose pages need no sort.
    """
    if size <= 0:
        raise ValueError("size must be positive")
    placed = global_position(items, list(INDEX_ORDER))
    filtered = placed.select(F.count(F.lit(1))).scalar()
    pages = F.greatest(F.ceil(filtered / F.lit(size)), F.lit(1))
    current = F.least(F.greatest(F.lit(page), F.lit(1)), pages)
    numbered = placed.withColumns(
        {"page": current.cast("bigint"), "pages": pages.cast("bigint"), "filtered_count": filtered}
    )
    first = (F.col("page") - 1) * size
    return numbered.where((F.col("position") >= first) & (F.col("position") < first + size))
