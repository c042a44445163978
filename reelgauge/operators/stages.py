"""Stage logs to stage time series, and the analytics on those series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelgauge.functions.numeric import minutes_between, ratio
from reelgauge.functions.text import leading_timestamp, line_markers, stage_short, strip_ansi
from reelgauge.operators.ordered import attach, carry_forward, previous_value, row_index, running_sum, time_block
from reelgauge.operators.ranking import nearest_rank
from reelgauge.schemas import STAGE_COLUMNS

# The framing of stage tables and of caption events in a log.
STATE_HEADER = "Stage state:"
STATE_CLOSER = "╘"
CELL_SEPARATOR = "│"
STAGE_ROW_START = "│ Stage "
STAGE_CELL_PATTERN = r"^ Stage \d+ - ."
STAGE_CELLS = 12
CAPTION_EVENT_PATTERN = (
    r"CaptionGenerationStage pid=\d+, ip=([0-9.]+).*?"
    r"(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d+).*?"
    r"Generated (\d+) captions for video (.+?) chunk-"
)

LINE_KEYS = ["file"]
LINE_ORDER = ["line_no"]
NUMBER_COLUMNS = STAGE_COLUMNS[2:]


def clean_lines(lines: DataFrame) -> DataFrame:
    """Log lines without terminal codes."""
    return lines.withColumn("line", strip_ansi(F.col("line")))


def log_line_order(lines: DataFrame) -> DataFrame:
    """0-based line position in each log, counted block by block."""
    return row_index(lines, LINE_KEYS, "block", LINE_ORDER, out="line_index")


def timestamp_carry(lines: DataFrame) -> DataFrame:
    """Adds the latest line-leading timestamp, '' before the first one."""
    marked = lines.withColumn("timestamp", leading_timestamp(F.col("line")))
    filled = carry_forward(marked, ["timestamp"], LINE_KEYS, "block", LINE_ORDER)
    return filled.withColumn("timestamp", F.coalesce("timestamp", F.lit("")))


def block_mark() -> Column:
    """True on a line that opens a table, false on one that closes it, else null."""
    return F.when(F.col("line") == STATE_HEADER, F.lit(True)).when(
        F.col("line").startswith(STATE_CLOSER), F.lit(False)
    )


def table_block_state(lines: DataFrame) -> DataFrame:
    """Adds ``in_table``: between a state header and the next closing border."""
    marked = lines.withColumn("in_table", block_mark())
    filled = carry_forward(marked, ["in_table"], LINE_KEYS, "block", LINE_ORDER)
    is_header = F.col("line") == STATE_HEADER
    return filled.withColumn("in_table", F.coalesce("in_table", F.lit(False)) & ~is_header)


def _is_table_row() -> Column:
    return F.col("line").startswith(STAGE_ROW_START)


def table_lines(lines: DataFrame) -> DataFrame:
    """The lines that ``stage_log_parse`` looks at, without terminal codes: rows, borders and possible timestamps."""
    line = F.col("line")
    is_mark = (line == STATE_HEADER) | line.startswith(STATE_CLOSER) | (F.substring(line, 5, 1) == "-")
    return clean_lines(lines).where(_is_table_row() | is_mark)


def stage_log_parse(lines: DataFrame) -> DataFrame:
    """Stage tables of raw logs as text rows, one column per table cell.

    ``lines`` has file, block, line_no and line; see ``read_log_lines``. Both carried
    values travel in one pass, and only lines that matter take part in it. Rows are told
    apart by prefixes and one split, so no pattern runs over the bulk of a log.
    """
    line = F.col("line")
    # Rows are cut up before the shuffle, where every file split has its own task.
    marked = table_lines(lines).select(
        *LINE_KEYS, "block", *LINE_ORDER,
        leading_timestamp(line).alias("timestamp"),
        block_mark().alias("_open"),
        F.when(_is_table_row(), F.split(line, CELL_SEPARATOR)).alias("_parts"),
    )
    filled = carry_forward(marked, ["timestamp", "_open"], LINE_KEYS, "block", LINE_ORDER)
    # A row is bordered on both sides: '', stage, twelve cells, ''.
    parts, last = F.col("_parts"), STAGE_CELLS + 2
    is_whole = (F.size(parts) == last + 1) & (F.get(parts, F.lit(last)) == "") & parts[1].rlike(STAGE_CELL_PATTERN)
    rows = filled.where(F.col("_open") & parts.isNotNull() & is_whole)
    return rows.select(
        *LINE_KEYS, "block", *LINE_ORDER,
        F.coalesce("timestamp", F.lit("")).alias("timestamp"),
        F.trim(parts[1]).alias("stage"),
        *[F.trim(parts[i + 2]).alias(name) for i, name in enumerate(NUMBER_COLUMNS)],
    )


def typed_stage_state(rows: DataFrame) -> DataFrame:
    """Text rows to numbers: blank or missing is 0; adds ``ts`` and ``stage_short``."""
    number = lambda name: F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))
    return rows.withColumns({name: number(name) for name in NUMBER_COLUMNS}).withColumns(
        {"ts": F.try_to_timestamp("timestamp"), "stage_short": stage_short(F.col("stage"))}
    )


def caption_event_parse(lines: DataFrame) -> DataFrame:
    """Caption-generation log lines as (ip, ts, n_captions, media_path).

    A literal pre-check, on lines without colour codes, keeps the pattern off other lines,
    and one replacement takes a hit apart instead of one match per column.
    """
    likely = clean_lines(lines).where(F.contains(F.col("line"), F.lit("Generated ")) & F.contains(F.col("line"), F.lit(" captions for video ")))
    # explode_outer: a plain explode would make Spark match every line twice.
    found = F.regexp_extract_all("line", F.lit(CAPTION_EVENT_PATTERN), F.lit(0))
    hits = likely.select(F.explode_outer(found).alias("hit")).where(F.col("hit").isNotNull())
    parts = F.split(F.regexp_replace("hit", CAPTION_EVENT_PATTERN, "$1\n$2\n$3\n$4"), "\n")
    return hits.select(parts.alias("part")).select(
        F.col("part")[0].alias("ip"),
        F.try_to_timestamp(F.col("part")[1]).alias("ts"),
        F.col("part")[2].cast("int").alias("n_captions"),
        F.col("part")[3].alias("media_path"),
    )


def marked_lines(lines: DataFrame, width: int = 260) -> DataFrame:
    """Adds the marker flags and cuts the line to ``width`` characters."""
    return lines.withColumns(line_markers(F.col("line"))).withColumn("line", F.substring("line", 1, width))


def latest_per_stage(lines: DataFrame, stages: Sequence[str], k: int = 2, width: int = 300) -> DataFrame:
    """The last k table lines naming each stage of each log."""
    named = F.filter(F.array(*[F.lit(s) for s in stages]), lambda s: F.contains(F.col("line"), s))
    hits = lines.where(F.contains(F.col("line"), F.lit(CELL_SEPARATOR))).withColumn("stage", F.explode(named))
    latest = W.partitionBy(*LINE_KEYS, "stage").orderBy(F.desc("block"), *[F.desc(c) for c in LINE_ORDER])
    ranked = hits.withColumn("recency", F.row_number().over(latest)).where(F.col("recency") <= k)
    return ranked.withColumn("line", F.substring("line", 1, width))


def log_tail(lines: DataFrame, k: int = 12, width: int = 260) -> DataFrame:
    """The last k lines of each log, cut to ``width`` characters."""
    latest = W.partitionBy(*LINE_KEYS).orderBy(F.desc("block"), *[F.desc(c) for c in LINE_ORDER])
    ranked = lines.withColumn("recency", F.row_number().over(latest)).where(F.col("recency") <= k)
    return ranked.withColumn("line", F.substring("line", 1, width))


def log_counts(lines: DataFrame) -> DataFrame:
    """One row: failure, caption and generated-batch line counts."""
    marks = line_markers(F.col("line"))
    return lines.agg(
        F.count_if(marks["is_failure"]).alias("n_failures"),
        F.count_if(marks["is_caption"]).alias("n_caption_lines"),
        F.count_if(marks["is_generated"]).alias("n_generated"),
    )


def progress_snapshot(listing: DataFrame, lines: DataFrame) -> DataFrame:
    """Artifacts and log markers of a run at one moment, as one row."""
    path = F.col("relative_path")
    found = listing.agg(
        F.count_if(path.startswith("clips/") & path.endswith(".mp4")).alias("n_clips"),
        F.count_if(path.startswith("metas/v0/") & path.endswith(".json")).alias("n_metas"),
        F.count_if(path.startswith("processed_videos/") & path.endswith(".json")).alias("n_videos"),
        F.count_if(path.startswith("processed_clip_chunks/") & path.endswith(".json")).alias("n_chunks"),
    )
    counts = log_counts(lines)
    return found.select("*", *[counts.select(name).scalar().alias(name) for name in counts.columns])


# ---- analytics over stage_state -------------------------------------------------


def elapsed_minutes(state: DataFrame, keys: Sequence[str] = (), out: str = "minute") -> DataFrame:
    """Minutes since the first sample of each run or phase."""
    if not keys:
        return state.withColumn(out, minutes_between(F.col("ts"), state.select(F.min("ts")).scalar()))
    starts = state.groupBy(*keys).agg(F.min("ts").alias("_start"))
    return attach(state, starts, keys).withColumn(out, minutes_between(F.col("ts"), F.col("_start"))).drop("_start")


def stage_summary(state: DataFrame, keys: Sequence[str] = ("stage_short",)) -> DataFrame:
    """Per stage: actor means, completed, queue peaks, speed percentiles, span, snapshots."""
    basic = state.groupBy(*keys).agg(
        F.round(F.avg("actors_ready"), 6).alias("ready_mean"),
        F.round(F.avg("actors_running"), 6).alias("running_mean"),
        F.max("tasks_completed").cast("bigint").alias("completed"),
        F.max("input_queue").cast("bigint").alias("max_input_queue"),
        F.max("output_queue").cast("bigint").alias("max_output_queue"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count_distinct("ts").alias("snapshots"),
    )
    basic = basic.withColumn("duration_min", F.round(minutes_between(F.col("last_ts"), F.col("first_ts")), 6))
    moving = state.where(F.col("tasks_per_actor_s") > 0)
    speeds = nearest_rank(moving, "tasks_per_actor_s", keys, {"speed_p50": 0.5, "speed_p90": 0.9})
    return attach(basic, speeds, keys).withColumns(
        {name: F.coalesce(F.round(name, 6), F.lit(0.0)) for name in ("speed_p50", "speed_p90")}
    )


def ready_histogram(state: DataFrame, keys: Sequence[str] = ("stage_short",)) -> DataFrame:
    """Snapshots per ready-actor count, with their share of the stage."""
    counted = state.groupBy(*keys, F.col("actors_ready").cast("bigint").alias("ready")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.withColumn("share", ratio(F.col("n"), F.sum("n").over(W.partitionBy(*keys))))


def actor_utilisation(state: DataFrame, keys: Sequence[str] = ("stage_short",)) -> DataFrame:
    return state.groupBy(*keys).agg(
        F.round(F.avg("actors_running"), 6).alias("running_mean"),
        F.round(F.avg("actors_ready"), 6).alias("ready_mean"),
        ratio(F.avg("actors_running"), F.avg("actors_ready")).alias("utilisation"),
    )


def ready_transitions(
    state: DataFrame,
    keys: Sequence[str] = ("stage_short",),
    block_seconds: int = 3600,
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Rows where the ready-actor count differs from the row before; the first row always counts.

    Give a tie-breaker in ``order`` when samples repeat a timestamp.
    """
    slim = state.select(*keys, *dict.fromkeys(["ts", *order]), F.col("actors_ready").cast("bigint").alias("ready"))
    slim = slim.withColumn("_block", time_block(F.col("ts"), block_seconds))
    paired = previous_value(slim, "ready", keys, "_block", list(order), "_prev")
    changed = F.col("_prev").isNull() | ~F.col("_prev.value").eqNullSafe(F.col("ready"))
    return paired.where(changed).select(*keys, "ts", "ready", F.col("_prev.value").alias("ready_before"))


def stage_gaps(
    state: DataFrame, links: Sequence[tuple[str, str]], keys: Sequence[str] = (), *, order: Sequence[str]
) -> DataFrame:
    """In-flight work per timestamp and link: completed upstream minus downstream, never below 0.

    One conditional aggregate serves every link, with no self-join. Timestamps with only
    one stage of a link are skipped. Of repeated samples the last in ``order`` wins, for a
    parsed log (block, line_no).
    """
    last = F.struct(*order)
    names = sorted({name for link in links for name in link})
    column = {name: f"_s{i}" for i, name in enumerate(names)}
    wide = state.where(F.col("stage_short").isin(*names)).groupBy(*keys, "ts").agg(
        *[F.max_by("tasks_completed", F.when(F.col("stage_short") == n, last)).alias(c) for n, c in column.items()]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(f"{up}>{down}").alias("link"), (F.col(column[up]) - F.col(column[down])).alias("gap"))
            for up, down in links
        ]
    )
    long = wide.select(*keys, "ts", F.inline(pairs)).where(F.col("gap").isNotNull())
    return long.withColumn("gap", F.greatest("gap", F.lit(0)).cast("bigint"))


def stage_gap(
    state: DataFrame, upstream: str, downstream: str, keys: Sequence[str] = (), *, order: Sequence[str]
) -> DataFrame:
    """``stage_gaps`` of one link."""
    return stage_gaps(state, [(upstream, downstream)], keys, order=order)


def gap_stats(gaps: DataFrame, keys: Sequence[str] = ("link",)) -> DataFrame:
    """Mean, nearest-rank p95 and maximum of each gap series."""
    basic = gaps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("gap"), 6).alias("gap_mean"), F.max("gap").alias("gap_max")
    )
    return attach(basic, nearest_rank(gaps, "gap", keys, {"gap_p95": 0.95}, few_values=True), keys)


def cumulative_completed(
    increments: DataFrame, value: str, keys: Sequence[str] = ("stage_short",), block_seconds: int = 3600
) -> DataFrame:
    """Running total of ``value`` per stage over time."""
    blocked = increments.withColumn("_block", time_block(F.col("ts"), block_seconds))
    return running_sum(blocked, value, keys, "_block", ["ts"], "cumulative").drop("_block")


def phase_timeline(main: DataFrame, resume: DataFrame, gap_minutes: float = 4.0) -> DataFrame:
    """Both phases on one axis; resume starts ``gap_minutes`` after the main phase ends."""
    first = elapsed_minutes(main.withColumn("phase", F.lit("main")))
    second = elapsed_minutes(resume.withColumn("phase", F.lit("resume")))
    shift = main.select(minutes_between(F.max("ts"), F.min("ts")) + gap_minutes).scalar()
    return first.unionByName(second.withColumn("minute", F.col("minute") + shift))


def tail_overshoot(
    state: DataFrame, keys: Sequence[str], minutes: float, idle_share: float = 0.5
) -> DataFrame:
    """Ready-actor peak in the last ``minutes`` against the median before them.

    ``overshoot`` is set when the tail peak tops the steady median while most ready
    actors sit idle.
    """
    phase = list(keys[:-1])
    ends = state.groupBy(*phase).agg(F.max("ts").alias("_end"))
    marked = attach(state, ends, phase).withColumn(
        "_tail", minutes_between(F.col("_end"), F.col("ts")) <= F.lit(float(minutes))
    )
    tail = marked.where("_tail").groupBy(*keys).agg(
        F.max("actors_ready").cast("bigint").alias("tail_peak"),
        ratio(F.sum(F.col("actors_ready") - F.col("actors_running")), F.sum("actors_ready")).alias("tail_idle_share"),
    )
    steady = nearest_rank(marked.where("not _tail"), "actors_ready", keys, {"steady_median": 0.5}, few_values=True)
    joined = attach(tail, steady, keys).withColumn("steady_median", F.col("steady_median").cast("bigint"))
    above = (F.col("tail_peak") > F.col("steady_median")) & (F.col("tail_idle_share") > idle_share)
    return joined.withColumn("overshoot", F.coalesce(above, F.lit(False)))


def queue_boundedness(
    gaps: DataFrame, keys: Sequence[str] = ("link",), growth: float = 2.0, block_seconds: int = 3600
) -> DataFrame:
    """Does in-flight work grow with time? Slope per hour and peak of each third of the samples.

    Thirds are equal counts in time order, the earlier ones one longer when uneven.
    """
    blocked = gaps.withColumn("_block", time_block(F.col("ts"), block_seconds))
    placed = row_index(blocked, keys, "_block", ["ts"], "_i")
    totals = gaps.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("ts").alias("_start"))
    placed = attach(placed, totals, keys)
    low, rest = F.floor(F.col("_n") / 3), F.pmod(F.col("_n"), F.lit(3))
    long_part = rest * (low + 1)
    third = F.when(F.col("_i") < long_part, F.floor(F.col("_i") / (low + 1))).otherwise(
        rest + F.floor((F.col("_i") - long_part) / F.greatest(low, F.lit(1)))
    )
    hours = minutes_between(F.col("ts"), F.col("_start")) / 60
    peak = lambda i: F.max(F.when(F.col("_third") == i, F.col("gap")))
    stats = placed.withColumns({"_third": third, "_hours": hours}).groupBy(*keys).agg(
        F.round(F.regr_slope(F.col("gap").cast("double"), F.col("_hours")), 4).alias("slope_per_hour"),
        peak(0).alias("peak_first"),
        peak(1).alias("peak_middle"),
        peak(2).alias("peak_last"),
    )
    grows = F.col("peak_last") > F.col("peak_first") * growth
    return stats.withColumn("bounded", ~F.coalesce(grows, F.lit(False)))


# ---- caption events ---------------------------------------------------------------


def events_by_host(events: DataFrame) -> DataFrame:
    return events.groupBy("ip").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum("n_captions").alias("n_captions"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def trailing_rates(events: DataFrame, minutes: Sequence[int] = (5, 10, 20, 30)) -> DataFrame:
    """Videos and captions per minute in the last m minutes, bounds included.

    The latest event is a scalar subquery, so the scan keeps only the longest window
    and one aggregation serves every m.
    """
    latest = events.select(F.max("ts")).scalar()
    longest = F.make_dt_interval(mins=F.lit(max(minutes)))
    recent = events.where(F.col("ts") >= latest - longest).withColumn("_age", minutes_between(latest, F.col("ts")))
    sums = recent.agg(
        *[F.count_if(F.col("_age") <= float(m)).alias(f"_v{m}") for m in minutes],
        *[F.sum(F.when(F.col("_age") <= float(m), F.col("n_captions"))).alias(f"_c{m}") for m in minutes],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("minutes"),
                F.round(F.col(f"_v{m}") / m, 6).alias("videos_per_min"),
                F.round(F.coalesce(F.col(f"_c{m}"), F.lit(0)) / m, 6).alias("captions_per_min"),
            )
            for m in minutes
        ]
    )
    return sums.select(F.inline(rows))
