"""Expressions over paths and object names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Media suffixes accepted as inputs.
MEDIA_SUFFIXES = (".mp4", ".mov", ".avi", ".mkv", ".webm")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def plain_path(path: Column) -> Column:
    """Local file URIs as plain paths, the form that markers and documents use."""
    return F.regexp_replace(path, "^file:/+", "/")


def plain_uri(uri: Column) -> Column:
    """The same for percent-encoded URIs."""
    return plain_path(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))


def suffix(path: Column) -> Column:
    """Last dotted part of the file name with its dot, '' when there is none.

    A leading dot does not start a suffix and a trailing dot is not one.
    """
    return F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1)


def is_media(path: Column, suffixes=MEDIA_SUFFIXES) -> Column:
    return F.lower(suffix(path)).isin(*suffixes)


def unsafe_member(path: Column) -> Column:
    """True for an absolute path or one with a parent-directory part."""
    return path.startswith("/") | F.array_contains(F.split(path, "/"), "..")


def checked_member(path: Column) -> Column:
    """The path itself; the query fails when it is unsafe."""
    message = F.concat(F.lit("member "), path, F.lit(" would leave the target folder"))
    return F.when(unsafe_member(path), F.raise_error(message)).otherwise(path)


def artifact_url(path: Column, run_dir: Column) -> Column:
    """Path below the run folder under the served asset root."""
    prefix = F.concat(run_dir, F.lit("/"))
    below = F.substring(path, F.length(prefix) + 1, F.length(path))
    return F.when(F.startswith(path, prefix), F.concat(F.lit("/assets/"), below))
