"""Quality rules: a table of thresholds compiled into one projection.

A rule names a measure and the closed range it must lie in. ``judge`` computes the measures of a
whole text with built-in functions only, applies every rule, and lists the names of the rules that
failed. There is no shuffle and no user function, so a text is judged in the task that reads it.

Cases: a null or blank text has no words and fails the base rule; ratios over nothing are 0; rows are
judged one by one, so repeated rows give repeated results and an empty table gives an empty one;
columns of the input that are not asked for never reach the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.words import whole, word_array

#: Frequent function words of the corpus languages.
STOP_WORDS = {
    "en": "the be to of and that have with in is for on by was are from this it as at",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un une du que est pour dans sur par au qui pas plus",
    "es": "de la que el en y los del se las por un para con no una su al lo como",
}

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in [low, high]; None leaves that side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Length, symbol, stop-word and line thresholds, as used for web text in published work.
RULES = (
    Rule("length", "n_words", 50, 1_000_000),
    Rule("mean_word_length", "mean_word_chars", 2, 16),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("duplicate_lines", "dup_line_share", None, 0.5),
)


def _ratio(part: Column, all_: Column) -> Column:
    return F.when(all_ == 0, F.lit(0.0)).otherwise(part / all_)


def _repeat_words(words: str, hashes: str) -> Column:
    """Words that lie in a 3-word window whose words occur in another window of the same text too.

    Hashes of the windows decide whether there is any repeat; only then the windows themselves are
    sorted, so equal hashes of different windows change nothing. Sorting keeps very long texts at
    n log n. Each repeated window at position p covers three words, or fewer when the next one is near.
    """
    return F.expr(f"""
        CASE WHEN size(array_distinct({hashes})) = size({hashes}) THEN 0L ELSE
          aggregate(
            transform(array(sort_array(transform(sequence(0, size({words}) - 3),
                i -> struct(concat_ws(' ', {words}[i], {words}[i + 1], {words}[i + 2]) AS w, i AS i)))),
              g -> sort_array(transform(filter(sequence(0, size(g) - 1),
                j -> (j > 0 AND g[j].w = get(g, j - 1).w) OR (j < size(g) - 1 AND g[j].w = get(g, j + 1).w)),
                j -> g[j].i))),
            0L,
            (none, p) -> CASE WHEN size(p) = 0 THEN 0L ELSE
              aggregate(sequence(0, size(p) - 1), 0L, (n, k) -> n + least(3L, coalesce(CAST(get(p, k + 1) - p[k] AS BIGINT), 3L)))
            END)
        END""")


def measured(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), stop_words: Sequence[str] | None = None) -> DataFrame:
    """The kept columns and the measures of each text."""
    stops = sorted(set(stop_words or " ".join(STOP_WORDS.values()).split()))
    t = F.col("_text")
    return (
        docs.select(*(F.col(f"`{k}`") for k in keep), whole(F.col(f"`{text}`")).alias("_text"))
        .withColumns({"_words": word_array(t), "_lines": F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")})
        .withColumn(
            "_hashes",
            F.expr("""CASE WHEN size(_words) < 3 THEN CAST(array() AS array<bigint>)
                ELSE transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])) END"""),
        )
        .select(
            *(F.col(f"`{k}`") for k in keep),
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, f"[{SYMBOLS}]+", ""))).cast("long").alias("n_symbols"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size(F.array_intersect("_words", F.array(*map(F.lit, stops)))).cast("int").alias("n_stop_words"),
            _repeat_words("_words", "_hashes").alias("n_repeat_words"),
        )
        .withColumns(
            {
                "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
                "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
                "dup_line_share": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
            }
        )
    )


def judge(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    rules: Sequence[Rule] = RULES,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """``measured`` plus ``base_failed``, ``failed`` (names of failed rules, in table order) and ``kept``."""
    broken = []
    for rule in rules:
        value = F.col(rule.measure)
        outside = F.lit(False)
        if rule.low is not None:
            outside = outside | (value < rule.low)
        if rule.high is not None:
            outside = outside | (value > rule.high)
        broken.append(F.when(outside, F.lit(rule.name)))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measured(docs, text, keep, stop_words)
        .withColumns({"base_failed": base, "failed": F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")})
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    )
