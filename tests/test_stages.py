import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reelgauge.operators import stages
from reelgauge.sources.files import read_log_lines

CELLS = "0 │ 0 │ {r} │ {q} │ 1 │ {c} │ 0 │ 4 │ 5 │ 1 │ 0 │ 0.25"


def snapshot(ts, rows, colour=True):
    head = f"{ts} | \x1b[32mINFO\x1b[0m | monitor" if colour else f"{ts} | INFO"
    body = [f"│ Stage {i:02d} - {name}   │ {CELLS.format(r=r, q=r, c=c)} │" for i, (name, r, c) in enumerate(rows)]
    return [head, "Stage state:", "╒════╕", "│ Stage │ Target │", *body, "╘════╛"]


def write_log(tmp_path, lines, name="run.log"):
    (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(tmp_path / name)


def test_log_tables_become_rows(spark, tmp_path):
    lines = ["│ Stage 00 - Early │ " + CELLS.format(r=9, q=9, c=9) + " │"]
    lines += snapshot("2026-09-05 18:41:30.000001", [("A", 1, 5), ("B", 2, 3)])
    lines += ["│ Stage 07 - After │ " + CELLS.format(r=9, q=9, c=9) + " │", "noise"]
    lines += ["Stage state:", "│ Stage 01 - Short │ 1 │ 2 │", "│ Stage 02 - B │ " + CELLS.format(r=3, q=3, c=8) + " │", "╘"]
    got = stages.stage_log_parse(read_log_lines(spark, write_log(tmp_path, lines))).orderBy("line_no").collect()
    assert [(r.timestamp[:19], r.stage, r.actors_ready, r.tasks_completed) for r in got] == [
        ("2026-09-05 18:41:30", "Stage 00 - A", "1", "5"),
        ("2026-09-05 18:41:30", "Stage 01 - B", "2", "3"),
        ("2026-09-05 18:41:30", "Stage 02 - B", "3", "8"),
    ]
    assert got[0].tasks_per_actor_s == "0.25"


def test_rows_before_any_timestamp_have_an_empty_one(spark, tmp_path):
    lines = snapshot("not a time", [("A", 1, 1)], colour=False)
    assert stages.stage_log_parse(read_log_lines(spark, write_log(tmp_path, lines))).first().timestamp == ""


def test_carriage_returns_end_lines(spark, tmp_path):
    path = tmp_path / "cr.log"
    path.write_bytes("\r".join(snapshot("2026-09-05 18:41:30.5", [("A", 1, 1)])).encode())
    assert stages.stage_log_parse(read_log_lines(spark, str(path))).count() == 1


def test_log_cut_into_many_splits_parses_the_same(spark, tmp_path):
    rng = random.Random(11)
    lines, expected, inside = [], [], False
    for i in range(400):
        stamp = (dt.datetime(2026, 9, 5) + dt.timedelta(seconds=30 * i)).strftime("%Y-%m-%d %H:%M:%S.%f")
        samples = [(n, rng.randint(0, 9), i) for n in "ABC"]
        part = snapshot(stamp, samples)
        closed, opened = rng.random() >= 0.2, rng.random() >= 0.2
        if not closed:
            part.pop()
        if not opened:
            part.pop(1)
        # A table without header counts if the one before it was not closed.
        inside = inside or opened
        if inside:
            expected += [(stamp, f"Stage {k:02d} - {n}", str(ready), str(done)) for k, (n, ready, done) in enumerate(samples)]
        inside = inside and not closed
        lines += part + ["worker says hello"] * rng.randint(0, 5)
    path = write_log(tmp_path, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = read_log_lines(spark, path)
        assert read.select("block").distinct().count() > 20
        got = stages.stage_log_parse(read).orderBy("line_no").collect()
        numbered = stages.log_line_order(read).orderBy("line_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.timestamp, r.stage, r.actors_ready, r.tasks_completed) for r in got] == expected
    assert [r.line for r in numbered] == lines and [r.line_index for r in numbered] == list(range(len(lines)))


def test_caption_events(spark):
    lines = [
        "\x1b[36m(CaptionGenerationStage pid=1, ip=10.0.0.5)\x1b[0m 2026-09-05 19:00:01.5 | INFO | Generated 3 captions for video /in/a b.mp4 chunk-0",
        "x (CaptionGenerationStage pid=1, ip=10.0.0.6) 2025-01-01 00:00:00.25 | Generated 12 captions for video /b.mp4 chunk-1",
        "(OtherStage pid=1, ip=10.0.0.6) 2025-01-01 00:00:00.25 | Generated 12 captions for video /b.mp4 chunk-1",
        "Generated 2 captions for video /c.mp4 chunk-0",
        "(CaptionGenerationStage pid=1, ip=10.0.0.7) 2025-01-01 00:00:01.0 | Generated 1 captions for video\x1b[0m /d.mp4 chunk-0",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    got = sorted((r.ip, r.ts.isoformat(), r.n_captions, r.media_path) for r in stages.caption_event_parse(df).collect())
    assert got == [("10.0.0.5", "2026-09-05T19:00:01.500000", 3, "/in/a b.mp4"), ("10.0.0.6", "2025-01-01T00:00:00.250000", 12, "/b.mp4"), ("10.0.0.7", "2025-01-01T00:00:01", 1, "/d.mp4")]


def series(spark, rows):
    """(minute, stage, ready, running, completed) samples."""
    start = dt.datetime(2026, 9, 5, 18)
    full = [
        (start + dt.timedelta(minutes=m), s, float(r), float(q), float(c), float(i), 0.0, 0.5 if c else 0.0)
        for i, (m, s, r, q, c) in enumerate(rows)
    ]
    return spark.createDataFrame(
        full,
        "ts timestamp, stage_short string, actors_ready double, actors_running double, tasks_completed double, "
        "input_queue double, output_queue double, tasks_per_actor_s double",
    )


def test_gap_floors_at_zero_and_skips_lonely_samples(spark):
    state = series(spark, [(0, "up", 1, 1, 5), (0, "down", 1, 1, 9), (1, "up", 1, 1, 9), (2, "up", 1, 1, 9), (2, "down", 1, 1, 4)])
    assert [r.gap for r in stages.stage_gap(state, "up", "down", order=["ts"]).orderBy("ts").collect()] == [0, 5]
    links = stages.stage_gaps(state, [("up", "down")], order=["ts"])
    assert [r.gap for r in links.orderBy("ts").collect()] == [0, 5]


def test_gap_takes_the_last_of_repeated_samples(spark):
    state = series(spark, [(0, "up", 1, 1, 9), (0, "up", 1, 1, 7), (0, "down", 1, 1, 1)])
    assert stages.stage_gap(state, "up", "down", order=["input_queue"]).first().gap == 6


def test_gap_has_one_shuffle_and_no_join(spark, plan):
    text = plan(stages.stage_gap(series(spark, [(0, "up", 1, 1, 5)]), "up", "down", order=["ts"]))
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_transitions_and_histogram(spark):
    ready = [0, 4, 9, 9, 9, 10, 9]
    state = series(spark, [(i * 600, "t", r, 1, 1) for i, r in enumerate(ready)])
    got = stages.ready_transitions(state).orderBy("ts").collect()
    assert [(r.ready, r.ready_before) for r in got] == [(0, None), (4, 0), (9, 4), (10, 9), (9, 10)]
    shares = {r.ready: (r.n, r.share) for r in stages.ready_histogram(state).collect()}
    assert shares[9] == (4, round(4 / 7, 6))


def test_summary(spark):
    state = series(spark, [(0, "a", 1, 1, 0), (30, "a", 3, 2, 4), (60, "a", 4, 3, 6)])
    r = stages.stage_summary(state).first()
    assert (r.completed, r.snapshots, r.duration_min, r.speed_p50, r.max_input_queue) == (6, 3, 60.0, 0.5, 2)
    idle = stages.stage_summary(series(spark, [(0, "a", 1, 1, 0)])).first()
    assert (idle.speed_p50, idle.speed_p90) == (0.0, 0.0)


def test_phase_timeline_shifts_resume(spark):
    main, resume = series(spark, [(0, "a", 1, 1, 1), (70, "a", 1, 1, 1)]), series(spark, [(500, "a", 1, 1, 1), (510, "a", 1, 1, 1)])
    got = sorted((r.phase, r.minute) for r in stages.phase_timeline(main, resume).collect())
    assert got == [("main", 0.0), ("main", 70.0), ("resume", 74.0), ("resume", 84.0)]


def test_tail_overshoot(spark):
    rows = [(i, "w", 1, 1, i) for i in range(60)] + [(60 + i, "w", r, 1, 60) for i, r in enumerate((26, 104, 116))]
    rows += [(i, "calm", 2, 2, i) for i in range(63)]
    state = series(spark, rows).withColumn("phase", F.lit("resume"))
    got = {r.stage_short: (r.tail_peak, r.steady_median, r.overshoot) for r in stages.tail_overshoot(state, ["phase", "stage_short"], 3).collect()}
    assert got == {"w": (116, 1, True), "calm": (2, 2, False)}


@pytest.mark.parametrize(("gaps", "bounded"), [([3, 5, 4, 5, 3, 4, 5], True), ([1, 2, 3, 5, 8, 13, 21], False)])
def test_boundedness(spark, gaps, bounded):
    start = dt.datetime(2026, 9, 5)
    df = spark.createDataFrame([("l", start + dt.timedelta(hours=9 * i), g) for i, g in enumerate(gaps)], "link string, ts timestamp, gap bigint")
    r = stages.queue_boundedness(df).first()
    assert (r.bounded, r.peak_first, r.peak_middle, r.peak_last) == (bounded, max(gaps[:3]), max(gaps[3:5]), max(gaps[5:]))


def test_trailing_rates_divide_by_the_window(spark):
    start = dt.datetime(2026, 9, 5, 20)
    rows = [("a", start + dt.timedelta(minutes=m), 2) for m in (0, 6, 9, 10)]
    df = spark.createDataFrame(rows, "ip string, ts timestamp, n_captions int")
    got = {r.minutes: (r.videos_per_min, r.captions_per_min) for r in stages.trailing_rates(df).collect()}
    assert got == {5: (0.6, 1.2), 10: (0.4, 0.8), 20: (0.2, 0.4), 30: (round(4 / 30, 6), round(8 / 30, 6))}


def test_tails_keep_k_lines_per_log(spark, plan):
    rows = [(f, i // 10, i, f"│ {s} {i}") for f in ("x", "y") for i in range(40) for s in ("AStage", "BStage")]
    df = spark.createDataFrame(rows, "file string, block bigint, line_no bigint, line string")
    got = stages.latest_per_stage(df, ["AStage", "BStage"])
    assert plan(got).count("WindowGroupLimit") == 2  # k lines per task travel, never a whole log
    assert sorted((r.file, r.stage, r.line_no) for r in got.collect()) == [(f, s, n) for f in "xy" for s in ("AStage", "BStage") for n in (38, 39)]
    assert stages.log_tail(df, k=3).count() == 6
