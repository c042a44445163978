"""URL rules found by hashed host-suffix and path-prefix expressions.

Every distinct URL is expanded into the expressions (host suffix + path prefix) that some rule could
have: only the shapes (number of host labels, length of the path) that occur among the rules are
built, so a URL gives a few rows whatever its length. Expressions meet the rules on the first four
bytes of their SHA-256, the remaining bytes confirm a hit, and the longest confirmed rule decides.
The rule list can have any length: Spark broadcasts it only when its measured size is small, and
otherwise shuffles both sides by the hash prefix, where adaptive execution splits hot prefixes.

Cases: null URLs and URLs without ``://`` have an empty host and path and meet no rule; no rule gives
the default verdict; equal rules with different verdicts are settled as ``block``; rows with null
or repeated keys keep their own result, since the decision belongs to the URL; an empty rule list or
table works; other columns never reach the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.words import lower_ascii

#: Production rules: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
SCHEMA = "host string, path string, verdict string"


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), SCHEMA)


def parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """The distinct URLs with host (A-Z lowered) and path."""
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    return (
        pages.select(F.col(f"`{url}`").alias("url"))
        .distinct()
        .withColumn("_rest", rest)
        .withColumn("_host", F.regexp_extract("_rest", r"^([^/?#]*)", 1))
        .select(
            "url",
            lower_ascii(F.col("_host")).alias("host"),
            F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), r"^([^?#]*)", 1).alias("path"),
        )
    )


def _hashed(df: DataFrame, host: str, path: str) -> DataFrame:
    # A space cannot be in a rule's host, so the pair can be read back from the joined text.
    return df.withColumn("_digest", F.unhex(F.sha2(F.concat_ws(" ", host, path), 256))).withColumn(
        "_short", F.conv(F.hex(F.substring("_digest", 1, 4)), 16, 10).cast("long")
    )


def decide(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """url, host, path -> the same with ``rule`` (null if none) and ``verdict``."""
    clean = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .withColumn("host", lower_ascii(F.col("host")))
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # 'block' sorts after 'allow'
        .withColumn("_labels", F.size(F.split("host", r"\.")))
    )
    shapes = sorted((r[0], r[1]) for r in clean.select("_labels", F.length("path")).distinct().collect())
    if not shapes:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    table = F.array(*(F.struct(F.lit(a).alias("labels"), F.lit(b).alias("chars")) for a, b in shapes))
    fits = F.filter(table, lambda s: (s["labels"] <= F.size(F.split("host", r"\."))) & (s["chars"] <= F.length("path")))
    expressions = (
        urls.where(F.col("url").isNotNull() & (F.col("host") != ""))
        .select("url", "host", "path", F.explode(fits).alias("_s"))
        .select(
            "url",
            F.expr("substring_index(host, '.', -_s.labels)").alias("_suffix"),
            F.expr("substring(path, 1, _s.chars)").alias("_prefix"),
        )
    )
    hits = (
        _hashed(expressions, "_suffix", "_prefix")
        .join(
            _hashed(clean, "host", "path").select(
                "_short", F.col("_digest").alias("_full"), F.concat("host", "path").alias("rule"), "verdict"
            ),
            "_short",
        )
        .where(F.col("_digest") == F.col("_full"))
        .groupBy("url")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "verdict", "rule")).alias("_best"))
        .select("url", F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("verdict"))
    )
    return urls.join(hits, "url", "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",), default: str = "allow") -> DataFrame:
    """The kept columns with host, path, rule and verdict of every row's URL.

    The joins take nulls and repeated rows as they are. One URL may have a third of the rows:
    decisions are made per distinct URL (``distinct`` folds before its shuffle), and the join that
    brings them back is one that adaptive execution can split.
    """
    decided = decide(parts(pages, url), rules, default)
    rows = pages.select(*(F.col(f"`{k}`").alias(f"k{n}") for n, k in enumerate(keep)), F.col(f"`{url}`").alias("_url"))
    return rows.join(decided, F.col("_url").eqNullSafe(F.col("url")), "left").select(
        *(F.col(f"k{n}").alias(k) for n, k in enumerate(keep)), "host", "path", "rule", "verdict"
    )
