"""Exact duplicates: 128-bit content hash, smallest stable id, byte comparison inside groups.

Texts are equal when they are identical after white space is deleted. Rows are grouped by the
128-bit hash *and* the normalised text, so the aggregate itself compares bytes and a hash collision
makes two groups. The aggregate folds copies inside each input task before the shuffle: a group that
has a third of all rows sends one row per task. Its state is one count and one decimal that orders
rows by (code points, then smaller id), so it stays in hashed aggregation. Rows get their group's
result by a join of narrow rows on (hash, SHA-256); no text is in that join, and adaptive execution
splits its hot keys.

Cases: null text is empty; ids may be null (a null id loses every tie and keeps a group only if all
its ids are null); rows that repeat id and text are told apart only by ``deduplicated``, which
keeps one of them; an empty table gives an empty result; other columns, whatever their names, pass ``deduplicated``
untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.tables import numbered, place, row_tag, without, written
from reelgauge.llm.words import squeezed, whole

#: No 64-bit id is above this; it stands for a null id.
_TOP = (1 << 63) - 1
_SPAN = 1 << 64


def _normalised(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.length(whole(F.col(f"`{text}`"))).alias("chars"),
        squeezed(F.col(f"`{text}`")).alias("norm"),
    ).withColumn("hash", F.unhex(F.md5("norm")))


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per distinct normalised text: hash, text_sha256, keep_id, group_size."""
    # Larger for more code points, then for the smaller id.
    rank = F.expr(f"CAST(chars AS DECIMAL(38, 0)) * {_SPAN}BD + ({_TOP}BD - CAST(coalesce(doc_id, {_TOP}) AS DECIMAL(38, 0)))")
    best = F.expr(f"{_TOP}BD - pmod(best, {_SPAN}BD)")
    return (
        _normalised(docs, text, doc_id)
        .select("hash", "norm", rank.cast("decimal(38,0)").alias("rank"))
        .groupBy("hash", "norm")
        .agg(F.max("rank").alias("best"), F.count("*").alias("group_size"))
        .select(
            "hash",
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            F.when(best != _TOP, best.cast("long")).alias("keep_id"),
            "group_size",
        )
    )


def membership(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    rows = _normalised(docs, text, doc_id).select("doc_id", "hash", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
    return rows.join(groups(docs, text, doc_id), ["hash", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns: one for each distinct normalised text.

    Decisions are made on narrow rows, one for each id and text. Whole rows then meet the tags that go in one join.
    """
    base = numbered(docs)
    name, whole_text = place(docs, doc_id).cast("long"), place(docs, text)
    rows = base.select(
        name.alias("doc_id"),
        row_tag(name, whole_text).alias("tag"),
        F.length(whole(whole_text)).alias("chars"),
        F.unhex(F.sha2(squeezed(whole_text).cast("binary"), 256)).alias("sha"),
    )
    rows = written(rows.groupBy("tag", "doc_id", "chars", "sha").agg(F.count("*").alias("n")), "exact-rows")
    keep = groups(docs, text, doc_id).select(F.unhex("text_sha256").alias("sha"), "keep_id")
    rows = written(
        rows.join(keep, "sha").select("sha", "tag", "chars", "n", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("named")), "exact-named"
    )
    # Rows that repeat the id, too: the longest text stays, then the one with the larger tag.
    best = rows.where("named").groupBy("sha").agg(F.max(F.struct("chars", "tag")).alias("best"), F.count("*").alias("tags"))
    tied = written(rows.where("named").join(best.where("tags > 1"), "sha").where("tag <> best.tag").select("tag"), "exact-ties")
    gone = rows.where("NOT named").select("tag").unionByName(tied)
    return without(docs, row_tag(name, whole_text), gone, rows.where("named AND n > 1").select("tag"))
