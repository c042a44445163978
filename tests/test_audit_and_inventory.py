import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelgauge.operators import audit, inventory


def figures(metrics):
    return {(r.metric, r.suffix) if r.suffix else r.metric: r.value for r in metrics.collect()}


def test_artifact_metrics_of_a_small_tree(spark):
    listing = spark.createDataFrame([("clips/a.mp4", 4), ("metas/v0/a.json", 2)], "relative_path string, size_bytes bigint")
    docs = spark.createDataFrame([(None, None)], "valid boolean, windows array<map<string,string>>")
    assert figures(audit.artifact_metrics(listing, docs)) == {
        "clip_files": 1, "metadata_files": 1, "file_count": 2, "total_bytes": 6, "valid_clips": 0, "captioned_windows": 0,
        "windows_with_text": 0, ("files_by_suffix", ".json"): 1, ("files_by_suffix", ".mp4"): 1,
    }


def test_artifact_metrics_of_an_empty_folder(spark):
    listing = spark.createDataFrame([], "relative_path string, size_bytes bigint")
    docs = spark.createDataFrame([], "valid boolean, windows array<map<string,string>>")
    got = figures(audit.artifact_metrics(listing, docs))
    assert len(got) == 7 and set(got.values()) == {0}


def test_files_without_suffix(spark):
    listing = spark.createDataFrame([("logs/run", 1), ("clips/.mp4", 1), ("x/clips/a.mp4", 1)], "relative_path string, size_bytes bigint")
    got = figures(audit.listing_metrics(listing))
    assert (got["files_by_suffix", "<none>"], got["files_by_suffix", ".mp4"], got["clip_files"]) == (2, 1, 1)


def test_captioned_by_key_or_by_text(spark):
    docs = spark.createDataFrame(
        [(True, [{"m_caption": ""}, {"m_caption": "x"}, {"note": "y"}]), (False, [])], "valid boolean, windows array<map<string,string>>"
    )
    r = audit.metadata_metrics(docs).first()
    assert (r.valid_clips, r.captioned_windows, r.windows_with_text) == (1, 2, 1)
    got = [(x.accepted, x.flag_agrees) for x in audit.validity_rules(docs).collect()]
    assert got == [(False, False), (False, True)]
    plain = audit.validity_rules(docs, captions=False).collect()
    assert [(x.accepted, x.flag_agrees) for x in plain] == [(False, False), (True, True)]


def test_conservation(spark):
    expected = spark.createDataFrame([("a", 6), ("b", 5), ("c", 6), (None, 1)], "src string, clips int")
    written = spark.createDataFrame([("a", 4), ("a", 2), ("b", 4), ("d", 1), (None, 1)], "src string, clips int")
    failed = spark.createDataFrame([("b",)], "src string")
    got = {r.src: (r.missing_clips, r.status) for r in audit.conservation_audit(expected, written, failed, ["src"], ["clips"]).collect()}
    assert got == {"a": (0, "closed"), "b": (1, "explained"), "c": (6, "unexplained"), "d": (-1, "unexplained"), None: (0, "closed")}


def test_manifest_diff(spark):
    make = lambda rows: audit.manifest(spark.createDataFrame(rows, "path string, body string"), "path", "body")
    diff = audit.rerun_manifest_diff(make([("a", "1"), ("b", "1"), ("c", None)]), make([("a", "1"), ("b", "2"), ("c", None), ("d", "1")]))
    assert {r.path: r.change for r in diff.collect()} == {"a": "same", "b": "changed", "c": "same", "d": "added"}
    gone = audit.rerun_manifest_diff(make([("a", "1")] * 50 + [("z", None)]), make([("a", "1")] * 50))
    assert {r.path: r.change for r in gone.collect()} == {"a": "same", "z": "removed"} and gone.count() == 2


def test_identity_and_coverage(spark, plan):
    one = spark.createDataFrame([("a",), ("a",), ("b",)], "p string")
    two = spark.createDataFrame([("b",), ("c",)], "p string")
    joined = audit.input_identity(one, two, "p")
    assert "Join" not in plan(joined)
    assert tuple(joined.first()) == (1, 1, 1, False)
    assert audit.input_identity(one, one, "p").first().identical
    assert [r.p for r in audit.source_coverage(one, two, "p").collect()] == ["a"]


def test_error_rollup_totals(spark):
    errors = spark.createDataFrame([("t", "x"), ("t", "y"), ("w", "x")], "stage string, source_video string")
    got = {(r.stage, r.source_video, r.level): r.n_errors for r in audit.error_rollup(errors).collect()}
    assert got[None, None, 3] == 3 and got["t", None, 1] == 2 and got[None, "x", 2] == 2 and got["w", "x", 0] == 1


def test_missing_and_duplicates(spark):
    docs = spark.createDataFrame([("a", "/c/a"), ("b", "/c/b"), ("b", "/c/b")], "id string, clip_location string")
    listing = spark.createDataFrame([("/c/b",)], "path string")
    assert [r.id for r in audit.missing_outputs(docs, listing).collect()] == ["a"]
    assert audit.duplicate_ids(docs, "id").collect() == [("b", 2)]


def manifest_rows(n=233, seed=2):
    rng = random.Random(seed)
    return [
        (f"/in/{i:04d}.mp4", rng.choice("xy"), rng.randint(1, 10**9), rng.randint(0, 10**7), *rng.choice([(256, 144), (1920, 1080), (640, 360)]), rng.random() < 0.4)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def flagged(spark):
    schema = "media_path string, subset string, size_bytes bigint, bitrate bigint, width int, height int, done boolean"
    return spark.createDataFrame(manifest_rows(), schema).repartition(3)


def test_distribution_matches_brute_force(flagged):
    placed = inventory.position_groups(flagged, n=58)
    got = {(r.kind, r.label): r for r in inventory.distribution_by_group(placed, ["position_group", "done"]).collect()}
    rows = manifest_rows()
    groups = {("position_group", str(i // 58 + 1)): rows[i // 58 * 58 : i // 58 * 58 + 58] for i in range(len(rows))}
    groups |= {("done", str(flag).lower()): [r for r in rows if r[6] == flag] for flag in (True, False)}
    groups["all", "all"] = rows
    assert set(got) == set(groups)
    for key, part in groups.items():
        r = got[key]
        sizes, rates = sorted(p[2] for p in part), sorted(p[3] for p in part)
        middle = round((len(part) - 1) * 0.5)
        assert (r.n, r.size_p50, r.bitrate_p50) == (len(part), sizes[middle], rates[middle])
        assert r.pixels_mean == pytest.approx(sum(p[4] * p[5] for p in part) / len(part))


def test_last_position_group_is_short(flagged):
    sizes = {r.position_group: r["count"] for r in inventory.position_groups(flagged, n=58).groupBy("position_group").count().collect()}
    assert sizes == {1: 58, 2: 58, 3: 58, 4: 58, 5: 1}


def test_position_groups_keep_rows_of_one_path_together(spark):
    rows = [("b", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5), (None, 6)]
    placed = inventory.position_groups(spark.createDataFrame(rows, "media_path string, v int"), n=2)
    got = {r.v: (r.position, r.position_group) for r in placed.collect()}
    assert got == {4: (0, 1), 6: (0, 1), 2: (2, 2), 1: (3, 2), 3: (3, 2), 5: (5, 3)}


def test_position_groups_checkpoint_only_paths(flagged, plan):
    text = plan(inventory.position_groups(flagged))
    scans = [line for line in text.splitlines() if "Scan ExistingRDD" in line and "_part#" in line]
    assert scans and all("_key#" in line and "size_bytes" not in line for line in scans)


def test_distribution_with_nulls_and_without_rows(spark):
    schema = "g string, size_bytes bigint, bitrate bigint, width int, height int"
    rows = [(None, 5, None, 2, 2), (None, 7, 3, 2, 2), (None, 9, 4, None, 2), ("x", None, None, 4, 1)]
    got = {(r.kind, r.label): r for r in inventory.distribution_by_group(spark.createDataFrame(rows, schema), ["g"]).collect()}
    assert set(got) == {("g", None), ("g", "x"), ("all", "all")}
    none = got["g", None]
    assert (none.n, none.size_p50, none.bitrate_p50, none.size_mean) == (3, 7, 3, 7.0)
    assert (got["g", "x"].n, got["g", "x"].size_p50, got["g", "x"].bitrate_mean) == (1, None, None)
    assert (got["all", "all"].n, got["all", "all"].size_p50) == (4, 7)
    assert inventory.distribution_by_group(spark.createDataFrame([], schema), ["g"]).count() == 0


def test_pending_done_and_largest(spark, flagged):
    marks = flagged.where("done").select("media_path").unionAll(spark.createDataFrame([(None,), ("/gone",)], "media_path string"))
    plain = flagged.drop("done")
    assert inventory.pending_inputs(plain, marks).count() == flagged.where("not done").count()
    again = inventory.done_flag(plain, marks)
    assert again.count() == 233 and again.exceptAll(flagged.select(again.columns)).isEmpty()
    expected = sorted((r for r in manifest_rows() if not r[6]), key=lambda r: (-r[2], r[0]))[:8]
    assert [r.media_path for r in inventory.largest_pending(again).collect()] == [r[0] for r in expected]


def test_largest_pending_plans_as_top_k(flagged, plan):
    assert "TakeOrderedAndProject" in plan(inventory.largest_pending(flagged))


def test_top_resolutions_break_ties_by_first_path(flagged):
    got = [(r.resolution, r.n) for r in inventory.top_resolutions(flagged, "subset", k=2).where("subset = 'x'").orderBy("rank").collect()]
    part = [f"{r[4]}x{r[5]}" for r in manifest_rows() if r[1] == "x"]
    assert got == Counter(part).most_common(2)


def test_completion_volume_and_sizes(spark, flagged):
    shares = {r.subset: (r.n_done, r.n_total) for r in inventory.subset_completion(flagged).collect()}
    rows = manifest_rows()
    assert shares == {s: (sum(r[6] for r in rows if r[1] == s), sum(r[1] == s for r in rows)) for s in "xy"}
    volume = inventory.input_volume(flagged.withColumn("duration_s", F.lit(60.0)), wall_seconds=0).first()
    assert (volume.n_files, volume.total_bytes, volume.mean_s, volume.mib_per_s) == (233, sum(r[2] for r in rows), 60.0, 0.0)
    sizes = spark.createDataFrame([("clip", 1), ("clip", 2), ("clip", 9), ("clip", 4)], "kind string, size_bytes bigint")
    r = inventory.size_stats(sizes, full_count=8).first()
    assert (r.n, r.median_bytes, r.mean_bytes, r.full_bytes) == (4, 3.0, 4.0, 32)


def test_video_limit_is_in_path_order(flagged):
    assert [r.media_path for r in inventory.video_limit(flagged, 2).collect()] == ["/in/0000.mp4", "/in/0001.mp4"]
    assert inventory.video_limit(flagged, None).count() == 233


def test_limit_follows_the_given_order(flagged):
    listed = flagged.withColumn("list_position", -F.col("size_bytes"))
    assert inventory.video_limit(listed, 5, "list_position").agg(F.min("size_bytes")).first()[0] > listed.agg(F.min("size_bytes")).first()[0]
