import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from reelgauge.operators import planning, stages
from reelgauge.streaming import monitors

START = dt.datetime(2026, 9, 5, 18)
EVENTS = "ts timestamp, ip string, n_captions int, media_path string"


def events(spark, minutes, ip="a"):
    rows = [(START + dt.timedelta(minutes=m), ip, 2, f"/in/{int(m) % 3}.mp4") for m in minutes]
    return spark.createDataFrame(rows, EVENTS)


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def live(spark, folder, schema, **options):
    return monitors.file_stream(spark, folder, spark.createDataFrame([], schema).schema, **options)


def test_clip_plan_equals_batch(spark, place):
    media = spark.createDataFrame([(f"/{i}.mp4", float(i)) for i in range(50)], "media_path string, duration_s double")
    media.repartition(5).write.parquet(place("in"))
    plan = monitors.stream_clip_plan(live(spark, place("in"), media.schema.simpleString()[7:-1].replace(":", " "), files_per_trigger=2))
    monitors.drain(plan, place("out"), place("cp"))
    batch = planning.fixed_stride_spans(media)
    assert sorted(map(tuple, spark.read.parquet(place("out")).collect())) == sorted(map(tuple, batch.collect()))


def test_restart_adds_only_new_input(spark, place):
    for round_no in range(3):
        if round_no < 2:
            events(spark, range(round_no * 10, round_no * 10 + 10)).write.mode("append").parquet(place("in"))
        monitors.drain_batches(live(spark, place("in"), EVENTS), place("out"), place("cp"))
    assert spark.read.parquet(place("out")).count() == 20


def test_replayed_batch_replaces_itself(spark, place):
    events(spark, range(10)).write.parquet(place("in"))

    def broken(batch, batch_id):
        raise RuntimeError("executor lost after the write")

    calls = []

    def shape(batch, batch_id):
        calls.append(batch_id)
        return batch

    monitors.drain_batches(live(spark, place("in"), EVENTS), place("out"), place("cp"), shape=shape)
    # The same batch again under a fresh checkpoint stands for a crash before the commit.
    monitors.drain_batches(live(spark, place("in"), EVENTS), place("out"), place("cp2"), shape=shape)
    assert calls == [0, 0] and spark.read.parquet(place("out")).count() == 10
    with pytest.raises(Exception, match="executor lost"):
        monitors.drain_batches(live(spark, place("in"), EVENTS), place("out"), place("cp3"), shape=broken)


@pytest.mark.parametrize("batches", [1, 3])
def test_paths_are_planned_once_however_batches_are_cut(spark, place, batches):
    for part in range(3):  # every path comes again, hours later
        events(spark, [300 * part + m for m in range(30)]).coalesce(1).write.mode("append").parquet(place("in"))
    stream = monitors.file_stream(spark, place("in"), EVENTS, files_per_trigger=3 // batches)
    for _ in range(2):
        monitors.drain_new_paths(stream, place("out"), place("cp"))
    assert sorted(r.media_path for r in spark.read.parquet(place("out")).collect()) == ["/in/0.mp4", "/in/1.mp4", "/in/2.mp4"]
    assert len({r.batch_id for r in spark.read.parquet(place("out")).select("batch_id").distinct().collect()}) == 1


@pytest.mark.parametrize("batches", [1, 3])
def test_open_windows_are_in_the_newest_updates(spark, place, batches):
    for part in ([0, 1], [9.9, 10], [25, 41]):
        events(spark, part).coalesce(1).write.mode("append").parquet(place("in"))
    stream = monitors.stream_tumbling_rates(monitors.file_stream(spark, place("in"), EVENTS, files_per_trigger=3 // batches))
    monitors.drain_batches(stream, place("out"), place("cp"), mode="update")
    got = monitors.newest(spark.read.parquet(place("out")), ["window_start", "ip"]).collect()
    assert {(r.window_start - START).seconds // 60: r.n_videos for r in got} == {0: 3, 10: 1, 20: 1, 40: 1}


def test_streams_read_tables_that_are_folders(spark, place):
    """Each table as one file and as a folder of part files gives the same rows."""
    from reelgauge.plans import live as registered

    for name in ("documents", "events"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").repartition(3).write.parquet(f"{place('sf')}/{name}.parquet")
    for name in ("stream_clip_plan", "stream_dedup_media", "stream_tumbling_rates", "stream_sliding_rates", "stream_idle_sessions",
                 "stream_stage_gap", "stream_transitions", "stream_idempotent_sink", "stream_late_drop"):
        one, many = (sorted(map(repr, registered.STREAMS[name](spark, d).collect())) for d in ("/root/testdata/sf0.001", place("sf")))
        assert one and one == many, name


def test_tumbling_emits_closed_windows_only(spark, place):
    events(spark, [0, 1, 9.9, 10, 25, 41]).write.parquet(place("in"))
    monitors.drain(monitors.stream_tumbling_rates(live(spark, place("in"), EVENTS)), place("out"), place("cp"))
    got = {(r.window_start - START).seconds // 60: (r.n_videos, r.n_captions, r.videos_per_min) for r in spark.read.parquet(place("out")).collect()}
    assert got == {0: (3, 6, 0.3), 10: (1, 2, 0.1), 20: (1, 2, 0.1)}


def test_idle_sessions_split_on_silence(spark, place):
    events(spark, [0, 10, 20, 60, 61, 200]).write.parquet(place("in"))
    monitors.drain(monitors.stream_idle_sessions(live(spark, place("in"), EVENTS)), place("out"), place("cp"))
    got = sorted(((r.window_start - START).seconds // 60, (r.window_end - START).seconds // 60, r.n_videos) for r in spark.read.parquet(place("out")).collect())
    assert got == [(0, 50, 3), (60, 91, 2)]


def test_open_sessions_come_from_the_state(spark, place):
    """What the stream has given out and what it holds are all sessions; without the stream there is nothing to read."""
    for part in ([0, 10, 20], [25, 60, 61], [200, 205, 210]):
        events(spark, part).write.mode("append").parquet(place("in"))
        sessions = monitors.stream_idle_sessions(live(spark, place("in"), EVENTS))
        monitors.drain(sessions, place("out"), place("cp"))
    tail = monitors.open_sessions(spark, place("cp"))
    spans = lambda df: sorted(((r.window_start - START).seconds // 60, (r.window_end - START).seconds // 60, r.n_videos, r.n_captions) for r in df.collect())
    assert spans(tail) == [(200, 240, 3, 6)]
    assert spans(spark.read.schema(tail.schema).parquet(place("out"))) == [(0, 55, 4, 8), (60, 91, 2, 4)]
    with pytest.raises(Exception):
        monitors.open_sessions(spark, place("nowhere")).collect()


def test_late_rows_are_dropped_and_reported(spark, place):
    late = 0
    for minutes in (range(120, 180), range(0, 60)):
        events(spark, minutes).write.mode("append").parquet(place("in"))
        query = monitors.drain_batches(monitors.stream_counts(live(spark, place("in"), EVENTS)), place("out"), place("cp"), mode="update")
        late += monitors.dropped_by_watermark(query)
    newest = spark.read.parquet(place("out")).groupBy("window_start").agg(F.max_by("n", "batch_id").alias("n"))
    assert newest.agg(F.sum("n")).first()[0] == 60 and late > 0


LATE_PARTS = [[130, 125, 131, 5], [200, 59, 119, 121, 121, 60], [], [10, 11, 189, 190, 250, 239], [250, 251, 181]]


@pytest.mark.parametrize("replayed", [False, True])
def test_late_rows_are_counted_exactly(spark, place, replayed):
    """Equal to counting by hand, over batches with late rows, an empty one, and batches replayed after a crash."""
    want, newest, late_minutes = {}, None, []
    for part in LATE_PARTS:
        frame = events(spark, part)
        frame.unionByName(frame.limit(1).withColumn("ts", F.lit(None).cast("timestamp"))).write.mode("append").parquet(place("in"))
        if replayed:
            monitors.forget_last_commit(spark, place("cp"))
        monitors.drain_counts(live(spark, place("in"), EVENTS), place("out"), place("cp"))
        for m in part:
            is_late = newest is not None and 60 * (m // 60 + 1) <= newest - 10
            n, n_late = want.get(m // 60, (0, 0))
            want[m // 60] = (n + (not is_late), n_late + is_late)
            late_minutes += [m] * is_late
        newest = max([*part, *([] if newest is None else [newest])])
    got = {int((r.window_start - START).total_seconds()) // 3600: (r.n, r.n_late) for r in monitors.window_counts(spark, place("out")).collect()}
    assert got == want and sum(n for _, n in want.values()) == len(late_minutes) > 3
    kept = monitors.late_rows(spark, place("out"))
    assert sorted((r.ts - START).total_seconds() / 60 for r in kept.collect()) == sorted(late_minutes)


def test_a_lost_commit_replays_the_batch(spark, place):
    for part in (range(0, 5), range(5, 20), range(20, 30)):
        events(spark, part).write.mode("append").parquet(place("in"))
        monitors.forget_last_commit(spark, place("cp"))
        monitors.drain_batches(live(spark, place("in"), EVENTS), place("out"), place("cp"))
    assert spark.read.parquet(place("out")).groupBy("batch_id").count().count() == 3
    assert spark.read.parquet(place("out")).count() == 30


def test_stage_gap_updates_across_batches(spark, place):
    schema = "run_id string, stage_short string"
    for part in ([("r", "up")] * 5 + [("r", "down")], [("r", "down")] * 2, [("q", "down")]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(place("in"))
        gaps = monitors.stream_stage_gap(live(spark, place("in"), schema), "up", "down")
        monitors.drain_batches(gaps, place("out"), place("cp"), mode="update")
    got = sorted((r.batch_id, r.run_id, r.gap) for r in spark.read.parquet(place("out")).collect())
    assert got == [(0, "r", 4), (1, "r", 2), (2, "q", 0)]


def test_transitions_carry_over_batches_and_drop_late_samples(spark, place):
    schema = "ts timestamp, stage_short string, actors_ready double"

    def put(samples):
        rows = [(START + dt.timedelta(minutes=m), s, float(r)) for m, s, r in samples]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(place("in"))
        monitors.stream_transitions(live(spark, place("in"), schema), place("out"), place("cp"), block_seconds=120)

    first = [(2, "t", 4), (0, "t", 1), (1, "t", 1), (3, "t", 4), (0, "w", 1)]
    second = [(1, "t", 9), (4, "t", 4), (5, "t", 6), (0.5, "x", 2)]
    third = [(6, "w", 1), (7, "w", 3), (8, "t", 6)]
    for part in (first, second, third):
        put(part)
    got = sorted(((r.ts - START).total_seconds() / 60, r.stage_short, r.ready, r.ready_before) for r in monitors.read_transitions(spark, place("out")).collect())
    kept = [s for s in first + second + third if s != (1, "t", 9)]
    state = spark.createDataFrame([(START + dt.timedelta(minutes=m), s, float(r)) for m, s, r in kept], schema)
    batch = sorted(((r.ts - START).total_seconds() / 60, r.stage_short, r.ready, r.ready_before) for r in stages.ready_transitions(state).collect())
    key = lambda r: (r[0], r[1])
    assert sorted(got, key=key) == sorted(batch, key=key)
    versions = sorted(p.name for p in pathlib.Path(place("out"), "state").iterdir())
    assert versions == ["batch_id=1", "batch_id=2"]


def test_transition_state_stays_flat(spark, place):
    """Fifty batches leave two versions of one row per stage, and give what one batch gives."""
    schema = "ts timestamp, stage_short string, actors_ready double"
    rng = random.Random(4)
    rows = [(START + dt.timedelta(seconds=30 * i), "st"[i % 2], float(rng.randrange(3))) for i in range(200)]
    for k in range(50):
        spark.createDataFrame(rows[4 * k : 4 * k + 4], schema).coalesce(1).write.mode("append").parquet(place("in"))
    monitors.stream_transitions(live(spark, place("in"), schema, files_per_trigger=1), place("out"), place("cp"))
    folders = sorted(pathlib.Path(place("out"), "state").iterdir())
    assert len(folders) == 2 and [spark.read.parquet(str(f)).count() for f in folders] == [2, 2]
    got = sorted((r.ts, r.stage_short, r.ready, r.ready_before or 0) for r in monitors.read_transitions(spark, place("out")).collect())
    batch = stages.ready_transitions(spark.createDataFrame(rows, schema)).collect()
    assert got == sorted((r.ts, r.stage_short, r.ready, r.ready_before or 0) for r in batch)
