import json

import pytest
from pyspark.sql import functions as F

from reelgauge.operators import gallery, planning, runs
from reelgauge.plans import run_folder
from reelgauge.sources import files


def put(root, entries):
    for name, body in entries.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)


def document(root, clip, source, start, **extra):
    return json.dumps(
        {"span_uuid": clip, "source_video": source, "duration_span": [start, start + 10], "clip_location": f"{root}/clips/{clip}.mp4", **extra}, indent=2
    )


@pytest.fixture
def run(tmp_path):
    root = tmp_path / "run 1+a"
    captioned = {"valid": True, "windows": [{"start_frame": 0, "end_frame": 256, "m_caption": "A dog."}]}
    put(
        root,
        {
            "clips/c1.mp4": "clip",
            "clips/c2.mp4": "clip",
            "metas/v0/c1.json": document(root, "c1", "/in/b.mp4", 10, **captioned),
            "metas/v0/c2.json": document(root, "c2", "/in/a.mp4", 0, width=640),
            "metas/v0/c3.json": document(root, "c3", "/in/a.mp4", 10, errors={"transcode": "ffmpeg exited with code 1"}),
            "metas/v0/deep/c4.json": document(root, "c4", "/in/b.mp4", 0, **captioned),
            "processed_videos/a.json": json.dumps({"video": f"{tmp_path}/in/a.mp4"}),
            "processed_clip_chunks/a_0.json": "{}",
        },
    )
    put(tmp_path / "in", {"a.mp4": "12345", "b.mp4": "1", "c.MKV": "1", "skip.txt": "1"})
    return root


def figures(metrics):
    return {(r.metric, r.suffix) if r.suffix else r.metric: r.value for r in metrics.collect()}


def test_minimal_output_tree(spark, tmp_path):
    put(tmp_path / "out", {"clips/a.mp4": "clip", "metas/v0/a.json": "{}"})
    got = figures(run_folder.artifact_report(spark, str(tmp_path / "out")))
    expected = {"clip_files": 1, "metadata_files": 1, "file_count": 2, "total_bytes": 6, "valid_clips": 0, "captioned_windows": 0}
    assert {name: got[name] for name in expected} == expected


def test_missing_folder_is_empty(spark, tmp_path):
    assert set(figures(run_folder.artifact_report(spark, str(tmp_path / "nowhere"))).values()) == {0}
    assert run_folder.run_gallery(spark, str(tmp_path / "nowhere")).count() == 0


def test_report_of_a_run(spark, run):
    assert figures(run_folder.artifact_report(spark, str(run))) == {
        "file_count": 8, "total_bytes": sum(p.stat().st_size for p in run.rglob("*.*") if p.is_file()), "clip_files": 2, "metadata_files": 4,
        "valid_clips": 2, "captioned_windows": 2, "windows_with_text": 2, ("files_by_suffix", ".json"): 6, ("files_by_suffix", ".mp4"): 2,
    }


def test_gallery_of_a_run(spark, run):
    index = run_folder.run_gallery(spark, str(run) + "/")
    got = [(r.id, r.window_count, r.valid, r.width, r.video_url, r.metadata_url, r.run_id, r.item_count) for r in index.collect()]
    assert got == [
        ("c2", 0, False, 640, "/assets/clips/c2.mp4", "/assets/metas/v0/c2.json", "run 1+a", 2),
        ("c1", 1, True, None, "/assets/clips/c1.mp4", "/assets/metas/v0/c1.json", "run 1+a", 2),
    ]
    assert [r.id for r in gallery.gallery_page(gallery.gallery_search(index, "B.MP4"), 1).collect()] == ["c1"]


def test_pending_feeds_the_next_run(spark, run, tmp_path):
    pending = run_folder.pending_media(spark, str(tmp_path / "in"), str(run))
    names = [r.media_path for r in pending.collect()]
    assert names == [f"{tmp_path}/in/b.mp4", f"{tmp_path}/in/c.MKV"]
    (tmp_path / "pending.txt").write_text("\n".join(names))
    chosen = run_folder.selected_inputs(spark, str(tmp_path / "in"), str(tmp_path / "pending.txt"))
    assert sorted((r.media_path, r.size_bytes) for r in chosen.collect()) == [(n, 1) for n in names]
    gate = {r.check: (r.ok, r.detail) for r in runs.preflight_gate(chosen).collect()}
    assert gate["inputs"] == (True, "2 files, 2 bytes")


def test_preflight_counts_after_the_limit(spark, run, tmp_path):
    gate = {r.check: r.detail for r in runs.preflight_gate(run_folder.selected_inputs(spark, str(tmp_path / "in"), first=1)).collect()}
    assert gate["inputs"] == "1 files, 5 bytes"


def test_first_of_a_list_is_as_listed(spark, run, tmp_path):
    names = [f"{tmp_path}/in/{n}" for n in ("c.MKV", "b.mp4", "a.mp4")]
    (tmp_path / "list.txt").write_text("\n".join(names))
    chosen = run_folder.selected_inputs(spark, str(tmp_path / "in"), str(tmp_path / "list.txt"), first=2)
    assert sorted(r.media_path for r in chosen.collect()) == sorted(names[:2])
    assert run_folder.input_problems(spark, str(tmp_path / "in"), str(tmp_path / "list.txt")) == []
    found = run_folder.input_problems(spark, str(tmp_path / "nowhere"), str(tmp_path / "no.txt"))
    assert len(found) == 2 and "nowhere" in found[0]


def test_report_is_computed_from_the_folder(spark, run):
    row = run_folder.run_report(spark, str(run), "r1", 10.0, "streaming").first()
    assert (row.execution_mode, row.status, row.output_tasks) == ("streaming", "succeeded", run_folder.processed_media(spark, str(run)).count())
    clips = run_folder.run_listing(spark, str(run)).where("relative_path LIKE 'clips/%'").count()
    assert clips > 0 and row.throughput_clips_per_s == clips / 10.0 and row.artifacts


def test_only_clips_count_as_clips(spark, run):
    put(run, {"clips/c9.mp4.part": "half", "clips/deep/c8.mp4": "clip", "clips/notes.txt": "no"})
    row = run_folder.run_report(spark, str(run), "r1", 10.0, "batch").first()
    assert (row.artifacts["clip_files"], row.stage_metrics["clips_written"], row.throughput_clips_per_s) == (3, 3, 0.3)


def test_every_run_leaves_a_report(spark, run, tmp_path):
    """Sums of the stages that were done, whether the run ends well or not; the error goes on."""
    rows = spark.range(100).withColumn("s", F.col("id") * 0.5)

    def work(recorder, fail):
        for part in range(2):
            recorder.run("transcode", rows.where(F.col("id") % 2 == part), lambda df, at=part: df.write.mode("overwrite").parquet(f"{tmp_path}/t{at}"), busy=F.sum("s"))
        if fail:
            recorder.run("caption", rows, lambda df: df.select(F.raise_error(F.lit("no model"))).collect())
        recorder.run("write", rows.limit(0), lambda df: df.write.mode("overwrite").parquet(f"{tmp_path}/w"), busy=F.sum("s"))

    with run_folder.recorded_run(spark, str(run), f"{tmp_path}/reports", "good", "streaming", {"a": "b"}) as recorder:
        work(recorder, False)
    with pytest.raises(Exception, match="no model"), run_folder.recorded_run(spark, str(run), f"{tmp_path}/reports", "bad", "batch") as recorder:
        work(recorder, True)
    with pytest.raises(KeyboardInterrupt), run_folder.recorded_run(spark, f"{tmp_path}/nowhere", f"{tmp_path}/reports", "stopped", "batch"):
        raise KeyboardInterrupt
    got = {r.run_id: r for r in files.run_report_read(spark, f"{tmp_path}/reports", lines=True).collect()}
    assert {k: r.status for k, r in got.items()} == {"good": "succeeded", "bad": "failed", "stopped": "failed"}
    assert "no model" in got["bad"].error and got["good"].error is None and got["good"].config == {"a": "b"}
    sums = {k: v for k, v in got["good"].stage_metrics.items() if not k.endswith("seconds")}
    assert sums == {"transcode_rows": 100, "transcode_busy": 2475, "write_rows": 0, "write_busy": 0, "videos_done": 1, "clips_written": 2}
    assert got["good"].stage_metrics["transcode_seconds"] > 0
    assert "write_rows" not in got["bad"].stage_metrics and got["bad"].stage_metrics["transcode_rows"] == 100
    assert got["good"].artifacts["clip_files"] == 2 and got["stopped"].output_tasks == 0


def test_markers_of_a_long_source(spark, tmp_path):
    """Ninety clips in chunks of 32 have three markers, and all of them count."""
    root = tmp_path / "run"
    source = "/in/long.mp4"
    entries = {f"metas/v0/c{i}.json": document(root, f"c{i}", source, 10 * i) for i in range(90)} | {f"clips/c{i}.mp4": "x" for i in range(90)}
    entries |= {f"processed_clip_chunks/long_{k}.json": json.dumps({"video": source}) for k in range(3)} | {"processed_videos/long.json": json.dumps({"video": source})}
    put(root, entries)
    media = spark.createDataFrame([(source, 900.0, 30.0)], "media_path string, duration_s double, fps double")
    row = run_folder.conservation(spark, str(root), media).first()
    assert (row.expected_chunks, row.written_chunks, row.missing_clips, row.status) == (3, 3, 0, "closed")
    (root / "processed_clip_chunks/long_1.json").unlink()
    row = run_folder.conservation(spark, str(root), media).first()
    assert (row.written_chunks, row.missing_chunks, row.status) == (2, 1, "unexplained")


def test_progress(spark, run, tmp_path):
    (tmp_path / "run.log").write_text("Caption for clip x\n\x1b[31mERR\x1b[0mOR boom\nGenerated 4 captions for video /a chunk-0\nTraceback\n")
    r = run_folder.progress(spark, str(run), str(tmp_path / "run.log")).first()
    assert tuple(r) == (2, 4, 1, 1, 2, 1, 1)


@pytest.mark.parametrize("windows", [None, (256, 128)])
def test_conservation_of_a_run(spark, run, windows):
    media = spark.createDataFrame([("/in/a.mp4", 20.0, 60.0), ("/in/b.mp4", 20.0, 30.0), ("/in/z.mp4", 9.0, 30.0)], "media_path string, duration_s double, fps double")
    rule = planning.PlanRule(windows=windows)
    put(run, {"processed_videos/b.json": json.dumps({"video": "/in/b.mp4"}), "processed_clip_chunks/b_0.json": json.dumps({"video": "/in/b.mp4"})})
    rows = {r.media_path: r for r in run_folder.conservation(spark, str(run), media, rule).collect()}
    got = {k: (r.missing_clips, r.missing_metas, r.missing_chunks, r.missing_videos, r.n_errors, r.status) for k, r in rows.items() if k and k.startswith("/in/")}
    assert got == {
        "/in/a.mp4": (1, 0, 1, 1, 1, "explained"), "/in/b.mp4": (1, 0, 0, 0, 0, "unexplained"), "/in/z.mp4": (1, 1, 1, 1, 0, "unexplained"),
    }
    other = next(r for k, r in rows.items() if k and k.endswith("/in/a.mp4") and k != "/in/a.mp4")
    assert (other.expected_videos, other.written_videos, other.status) == (0, 1, "unexplained")


def test_plan_run_follows_the_configuration(spark):
    media = spark.createDataFrame([(f"/{i}.mp4", 60.0, 60.0) for i in range(4)], "media_path string, duration_s double, fps double")
    assert planning.plan_run(media, planning.PlanRule(first_clips=3), first=2).count() == 6
    assert planning.plan_run(media, planning.PlanRule(windows=(256, 128))).count() == 48
    with pytest.raises(ValueError, match="must be positive"):
        planning.plan_run(media, planning.PlanRule(stride_s=0))


@pytest.mark.parametrize("length,stride,least", [(10, 10, 2), (8, 3, 1), (4, 6, 4), (30, 7, 2)])
def test_totals_follow_the_rule(spark, length, stride, least):
    rows = [(f"/{i}.mp4", "s", i * 3.7, (25.0, 60.0)[i % 2]) for i in range(40)]
    media = spark.createDataFrame(rows, "media_path string, subset string, duration_s double, fps double")
    rule = planning.PlanRule(length_s=length, stride_s=stride, least_s=least, windows=(256, 128))
    total = planning.plan_totals(media, rule=rule).first()
    spans = rule.spans(media)
    assert total.n_clips == spans.count() and total.n_windows == planning.caption_windows(spans).count()
