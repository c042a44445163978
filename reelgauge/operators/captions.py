"""Caption quality: flags, statistics, the training-index gate and review samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelgauge.functions.numeric import ratio
from reelgauge.functions.text import caption_flags, token_count
from reelgauge.operators.ordered import attach
from reelgauge.operators.ranking import nearest_rank

# Reject reasons in the order they are reported.
GATE_REASONS = {
    "empty": "is_empty",
    "at_token_cap": "at_cap",
    "no_terminal": "no_terminal",
    "template": "has_template",
    "heading": "has_heading",
    "refusal": "has_refusal",
}


def with_caption_flags(
    captions: DataFrame, text: str = "caption", tokens: str | None = None, cap: int = 256
) -> DataFrame:
    """Adds token count and quality flags; counts whitespace tokens without a ``tokens`` column."""
    counted = captions.withColumn("n_tokens", F.col(tokens) if tokens else token_count(F.col(text)))
    return counted.withColumns(caption_flags(F.col(text), F.col("n_tokens"), cap))


def caption_stats(captions: DataFrame, keys: Sequence[str], text: str = "caption", cap: int = 256) -> DataFrame:
    """Counts, exact duplicates and token percentiles per group.

    Duplicates are found on SHA-256 digests, so whole texts are never shuffled. Every
    figure depends on the text alone, so one fold per distinct text serves them all and
    texts are read and tokenized once.
    """
    flagged = with_caption_flags(captions, text, cap=cap)
    per_text = flagged.groupBy(
        *keys,
        F.unhex(F.sha2(F.col(text), 256)).alias("_digest"),
        "n_tokens",
        "is_empty",
        "at_cap",
        (F.col("at_cap") & ~F.col("has_terminal")).alias("_cut"),
    ).agg(F.count(F.lit(1)).alias("_n"))
    rows_where = lambda flag: F.coalesce(F.sum(F.when(F.col(flag), F.col("_n"))), F.lit(0))
    total = F.sum("_n")
    summary = per_text.groupBy(*keys).agg(
        total.alias("n"),
        rows_where("is_empty").alias("n_empty"),
        F.coalesce(F.sum(F.when(F.col("_digest").isNotNull(), F.col("_n") - 1)), F.lit(0)).alias("n_duplicates"),
        ratio(F.sum(F.col("n_tokens") * F.col("_n")), total).alias("tokens_mean"),
        rows_where("at_cap").alias("n_at_cap"),
        ratio(rows_where("at_cap") * 100, total).alias("at_cap_pct"),
        rows_where("_cut").alias("n_cut_off"),
    )
    levels = {"tokens_p50": 0.5, "tokens_p75": 0.75, "tokens_p90": 0.9, "tokens_p95": 0.95}
    ranked = nearest_rank(per_text, "n_tokens", list(keys), levels, few_values=True, weight="_n")
    return attach(summary, ranked, list(keys))


def caption_gate(captions: DataFrame, text: str = "caption", tokens: str | None = None, cap: int = 256) -> DataFrame:
    """Adds ``reasons`` (every rule a caption breaks) and ``accepted``."""
    flagged = with_caption_flags(captions, text, tokens, cap)
    flagged = flagged.withColumn("no_terminal", ~F.col("has_terminal") & ~F.col("is_empty"))
    reasons = F.array_compact(F.array(*[F.when(F.col(flag), F.lit(name)) for name, flag in GATE_REASONS.items()]))
    return flagged.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)


def gate_report(gated: DataFrame, subset: str = "subset") -> DataFrame:
    """Rows and share per subset and reason, with subtotals; accepted rows get reason ``accepted``.

    A caption with two reasons counts under both, so shares refer to all captions of
    the subset and may add up to more than 1.
    """
    reasons = F.when(F.col("accepted"), F.array(F.lit("accepted"))).otherwise(F.col("reasons"))
    counted = gated.groupBy(subset, reasons.alias("_reasons")).agg(F.count(F.lit(1)).alias("_n"))
    by_reason = (
        # never empty; explode_outer keeps Spark from filtering this branch's scan on its own
        counted.select(subset, F.explode_outer("_reasons").alias("reason"), "_n")
        .rollup("reason", subset)
        .agg(F.grouping_id().cast("int").alias("level"), F.sum("_n").alias("n_rows"))
        .where(F.col("level") < 3)
    )
    totals = (
        counted.rollup(subset)
        .agg(F.grouping_id().cast("int").alias("_whole"), F.sum("_n").alias("n_captions"))
        .select(subset, F.col("_whole").alias("level"), "n_captions")
    )
    joined = attach(by_reason, totals, ["level", subset])
    return joined.withColumn("share", ratio(F.col("n_rows"), F.col("n_captions")))


def gate_precision(gated: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """How far the gate agrees with quality labels."""
    judged = gated.select(key, "accepted").join(labels.select(key, "quality"), key)
    return judged.groupBy("accepted").agg(
        F.count(F.lit(1)).alias("n_labelled"),
        F.count_if(F.col("quality") == 1).alias("n_good"),
        ratio(F.count_if(F.col("quality") == 1), F.count(F.lit(1))).alias("good_share"),
    )


def stratified_review_sample(df: DataFrame, strata: Sequence[str], key: str, k: int) -> DataFrame:
    """k rows of every stratum in an order fixed by a hash of the id.

    Spark keeps only k rows per stratum of each partition before the shuffle, so a
    stratum of any size is safe.
    """
    shuffled = W.partitionBy(*strata).orderBy(F.sha1(F.col(key).cast("string")), F.col(key))
    return df.withColumn("sample_rank", F.row_number().over(shuffled)).where(F.col("sample_rank") <= k)
