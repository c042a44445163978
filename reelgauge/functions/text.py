"""Expressions over log lines and caption text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the log and caption formats.
ANSI_PATTERN = "\x1b\\[[0-9;]*[A-Za-z]"
LINE_TIMESTAMP_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d+)"
FAILURE_PATTERN = "Pipeline execution failed|Traceback|ERROR"
CAPTION_LINE_TEXT = "Caption for clip"
GENERATED_PATTERN = "Generated .* captions for video"
TEMPLATE_TEXT = "The video appears"
HEADING_TEXT = "###"
BLANKS = " \t\n\r\f"
REFUSAL_TEXTS = ("i cannot", "i can't", "i am unable", "i'm sorry", "i apologise", "i apologize")


def strip_ansi(line: Column) -> Column:
    """Remove terminal colour codes and turn carriage returns into line ends.

    Most lines hold neither, and a substring test is far cheaper than a rewrite.
    """
    plain = F.when(F.contains(line, F.lit("\x1b")), F.regexp_replace(line, ANSI_PATTERN, "")).otherwise(line)
    return F.when(F.contains(line, F.lit("\r")), F.translate(plain, "\r", "\n")).otherwise(plain)


def leading_timestamp(line: Column) -> Column:
    """The timestamp a line starts with, null when there is none."""
    found = F.regexp_extract(line, LINE_TIMESTAMP_PATTERN, 1)
    return F.when((F.substring(line, 5, 1) == "-") & (found != ""), found)


def stage_short(stage: Column) -> Column:
    """Text after the first ' - ', or the whole name."""
    return F.element_at(F.split(stage, " - ", 2), -1)


def line_markers(line: Column) -> dict[str, Column]:
    return {
        "is_failure": line.rlike(FAILURE_PATTERN),
        "is_caption": F.contains(line, F.lit(CAPTION_LINE_TEXT)),
        "is_generated": line.rlike(GENERATED_PATTERN),
    }


def token_count(text: Column) -> Column:
    """Whitespace-separated tokens; 0 for blank text."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("bigint")


def has_refusal(text: Column) -> Column:
    """Contains a refusal or apology as whole words, in any case.

    Plain substring tests come first, so the slower word-boundary pattern only sees
    text that holds one of the phrases.
    """
    lowered = F.lower(text)
    held = F.lit(False)
    for phrase in REFUSAL_TEXTS:
        held = held | F.contains(lowered, F.lit(phrase))
    return held & lowered.rlike(r"\b(" + "|".join(REFUSAL_TEXTS) + r")\b")


def caption_flags(text: Column, tokens: Column, cap: int) -> dict[str, Column]:
    """Quality flags of one caption; ``tokens`` comes from the caller's tokenizer."""
    body = F.coalesce(text, F.lit(""))
    trimmed = F.rtrim(body, F.lit(BLANKS))
    return {
        "is_empty": trimmed == "",
        "at_cap": tokens >= cap,
        "has_terminal": F.substring(trimmed, -1, 1).isin(".", "?", "!"),
        "has_heading": F.contains(body, F.lit(HEADING_TEXT)),
        "has_template": F.contains(body, F.lit(TEMPLATE_TEXT)),
        "has_refusal": has_refusal(body),
    }


def has_caption_key(window: Column) -> Column:
    """A window counts as captioned when any key ends with the caption suffix."""
    return F.exists(F.map_keys(window), lambda key: F.endswith(key, F.lit("_caption")))


def has_caption_text(window: Column) -> Column:
    """Stricter form: some caption key holds non-blank text."""
    return F.exists(
        F.map_entries(window),
        lambda entry: F.endswith(entry["key"], F.lit("_caption"))
        & (F.trim(F.coalesce(entry["value"], F.lit(""))) != ""),
    )
