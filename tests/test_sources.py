import gzip
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from reelgauge.functions import paths
from reelgauge.operators import audit, inventory
from reelgauge.plans import run_folder
from reelgauge.schemas import MEDIA_PROBE
from reelgauge.sources import files, sinks, tar


def tree(root, entries):
    for name, payload in entries.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(payload)
    return str(root)


def make_tar(path, entries, mode="w"):
    with tarfile.open(path, mode) as archive:
        for name, payload in entries:
            info = tarfile.TarInfo(name)
            if payload is None:
                info.type = tarfile.DIRTYPE
                archive.addfile(info)
            else:
                info.size = len(payload)
                archive.addfile(info, io.BytesIO(payload))
    return str(path)


def test_inventory_filters_suffixes_and_never_reads_content(spark, tmp_path, plan):
    root = tree(tmp_path / "in", {"b/x.MP4": b"12345", "a.webm": b"1", "notes.txt": b"n", "c/noext": b"", ".mp4": b"h"})
    found = files.media_inventory(spark, root)
    assert [r.media_path.rsplit("/in/")[1] for r in found.collect()] == ["a.webm", "b/x.MP4"]
    assert [r.size_bytes for r in found.collect()] == [1, 5]
    assert "content" not in plan(found)


def test_empty_inventory_is_an_error(spark, tmp_path):
    root = tree(tmp_path / "in", {"notes.txt": b"n"})
    with pytest.raises(RuntimeError, match="No supported media"):
        files.media_inventory(spark, root)
    assert files.media_inventory(spark, root, required=False).count() == 0


def test_input_list_trims_and_keeps_order(spark, tmp_path):
    listed = tmp_path / "pending.txt"
    listed.write_text(" /b.mp4 \n\n\t/a.txt\n   \n/c.mp4")
    got = files.input_list(spark, str(listed)).orderBy("list_position")
    assert [r.media_path for r in got.collect()] == ["/b.mp4", "/a.txt", "/c.mp4"]


@pytest.mark.parametrize(
    ("name", "ending"),
    [("/a/b.mp4", ".mp4"), ("b.tar.gz", ".gz"), (".hidden", ""), ("/a.d/none", ""), ("dot.", ""), ("x..y", ".y")],
)
def test_suffix(spark, name, ending):
    assert spark.createDataFrame([(name,)], "p string").select(paths.suffix(F.col("p"))).first()[0] == ending


def test_member_paths(spark):
    df = spark.createDataFrame([("a/b.mp4",), ("/a",), ("../x",), ("a/../b",), ("a..b/c",)], "p string")
    flagged = {r.p: r.u for r in df.select("p", paths.unsafe_member(F.col("p")).alias("u")).collect()}
    assert flagged == {"a/b.mp4": False, "/a": True, "../x": True, "a/../b": True, "a..b/c": False}
    assert df.where("p like 'a/b%'").select(paths.checked_member(F.col("p"))).first()[0] == "a/b.mp4"
    with pytest.raises(Exception, match="would leave the target folder"):
        df.select(paths.checked_member(F.col("p"))).collect()


def test_tar_cap_suffixes_and_payload(spark, tmp_path):
    entries = [("list.csv", b"n,1"), ("deep/er/One Two.MKV", b"12345"), ("deep/er/notes", b""), ("three.Avi", b""), ("four.mp4.part", b"x"), ("é.mov", b"\x00\xff")]
    shard = make_tar(tmp_path / "s.tar", entries)
    first = tar.tar_members(spark, shard, max_members=2).collect()
    assert [(r.member_path, r.payload, r.member_index) for r in first] == [("deep/er/One Two.MKV", b"12345", 1), ("three.Avi", b"", 3)]
    names = tar.tar_members(spark, shard, with_payload=False).orderBy("member_index").collect()
    assert [(r.member_path, r.size_bytes, r.payload) for r in names] == [("deep/er/One Two.MKV", 5, None), ("three.Avi", 0, None), ("é.mov", 2, None)]
    with pytest.raises(ValueError):
        tar.tar_members(spark, shard, max_members=0)


def test_tar_cap_counts_matches_per_shard_and_reads_folders(spark, tmp_path):
    folder = tmp_path / "shards"
    folder.mkdir()
    for n in range(3):
        make_tar(folder / f"s{n}.tar", [("d", None), ("x.txt", b"t"), ("A.MOV", b"m"), ("b.mp4", b"v"), ("c.mp4", b"w")])
    (folder / "z.tar.gz").write_bytes(gzip.compress((folder / "s0.tar").read_bytes()))
    members = tar.tar_members(spark, str(folder), max_members=2)
    assert members.rdd.getNumPartitions() == 4
    got = sorted((r.shard.rsplit("/")[-1], r.member_path) for r in members.collect())
    assert got == [(s, m) for s in ("s0.tar", "s1.tar", "s2.tar", "z.tar.gz") for m in ("A.MOV", "b.mp4")]


@pytest.mark.parametrize("split", [1, 700, 5000, 1 << 30])
def test_split_shards_equal_streams(spark, tmp_path, split):
    """Plain shards are shared by tasks, compressed ones are not; members of any size, long names, links and folders between."""
    folder = tmp_path / "shards"
    folder.mkdir()
    entries = [("d", None), ("x" * 150 + "/long.mp4", b"n" * 300), ("../up.mp4", b"u"), ("empty.mov", b""), ("a.txt", b"t" * 3000)]
    entries += [(f"{i}.mp4", bytes([i]) * (i * 53)) for i in range(40)]
    make_tar(folder / "one.tar", entries)
    make_tar(folder / "two.tar", [("b.mkv", b"m" * 9000)])
    make_tar(folder / "none.tar", [])
    make_tar(folder / "three.tar.gz", entries[:12], "w:gz")
    (folder / "named.tar").write_bytes(gzip.compress((folder / "two.tar").read_bytes()))  # compressed, whatever its name says
    index = tar.tar_index(spark, str(folder))
    assert {r.shard.rsplit("/")[-1] for r in index.where("offset IS NULL").collect()} == {"three.tar.gz", "named.tar"}
    parts = tar.split_members(index, split)
    assert parts.schema == tar.tar_members(spark, str(folder)).schema
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, tar.tar_members(spark, str(folder)).collect()))
    if split == 700:
        assert parts.where(F.col("shard").endswith("one.tar")).select(F.spark_partition_id()).distinct().count() > 10
    some = tar.split_members(tar.tar_index(spark, str(folder), max_members=2), split)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, tar.tar_members(spark, str(folder), max_members=2).collect()))
    with pytest.raises(Exception, match="would leave the target folder"):
        tar.tar_index(spark, str(folder), strict=True).collect()


def test_unsafe_members_are_marked_or_fail(spark, tmp_path):
    shard = make_tar(tmp_path / "s.tar", [("../notes.txt", b"skip"), ("../escape.mp4", b"x"), ("ok.mp4", b"y")])
    got = {r.member_path: (r.is_unsafe, r.payload) for r in tar.tar_members(spark, shard).collect()}
    assert got == {"../escape.mp4": (True, None), "ok.mp4": (False, b"y")}
    with pytest.raises(Exception, match="would leave the target folder"):
        tar.tar_members(spark, shard, strict=True).collect()


def test_many_members_cross_batches(spark, tmp_path, monkeypatch):
    shard = make_tar(tmp_path / "s.tar", [(f"{i}.mp4", str(i).encode()) for i in range(3000)])
    got = [r.payload.decode() for r in tar.tar_members(spark, shard).collect()]
    assert got == [str(i) for i in range(3000)]


def test_clip_documents_with_any_caption_key(spark, tmp_path):
    one = {"span_uuid": "u1", "source_video": "/v.mp4", "duration_span": [0, 10.0], "clip_location": "/c/u1.mp4", "valid": True,
           "windows": [{"start_frame": 0, "end_frame": 256, "m1_caption": "hi"}], "errors": {"transcode": "ffmpeg exited with code 1"}}
    two = {"span_uuid": "u2", "source_video": "/v.mp4", "duration_span": [10, 20], "errors": ["write", "caption"]}
    root = tree(tmp_path / "metas", {"u1.json": json.dumps(one, indent=2).encode(), "deep/u2.json": json.dumps(two, indent=2).encode()})
    docs = files.clip_meta_read(spark, root)
    by_id = {r.span_uuid: r for r in docs.withColumn("errors", audit.errors_map(F.col("errors"))).collect()}
    assert by_id["u1"].windows == [{"start_frame": "0", "end_frame": "256", "m1_caption": "hi"}]
    assert by_id["u1"].errors == {"transcode": "ffmpeg exited with code 1"}
    assert by_id["u2"].errors == {"write": None, "caption": None} and by_id["u2"].windows is None
    assert files.clip_meta_read(spark, root, recursive=False).count() == 1
    exploded = audit.errors_explode(docs, keep=["span_uuid"]).collect()
    assert sorted((r.span_uuid, r.stage) for r in exploded) == [("u1", "transcode"), ("u2", "caption"), ("u2", "write")]


def test_processed_markers_skip_broken_documents(spark, tmp_path):
    root = tree(tmp_path / "p", {"a.json": b'{"video": "/a.mp4"}', "b.json": b"{broken", "c.json": b'{"x": 1}', "d.json": b'{"video":\n "/a.mp4"}'})
    assert [r.media_path for r in files.processed_read(spark, root).collect()] == ["/a.mp4"]


@pytest.mark.parametrize(
    ("document", "expected"),
    [
        ({"streams": [{"width": 2, "height": 3, "avg_frame_rate": "30000/1001", "bit_rate": "7"}], "format": {"duration": "1.5", "size": "9"}}, (2, 3, 7, 9)),
        ({"streams": [{"width": 2, "height": 3}, {"width": 9, "height": 9}], "format": {"bit_rate": 5, "size": 0}}, (2, 3, 5, 100)),
        ({"streams": [{}], "format": {"bit_rate": "", "size": ""}}, (0, 0, 0, 100)),
        ({"streams": [], "format": {"bit_rate": "0", "size": "0"}}, (0, 0, 0, 0)),
        ({}, (0, 0, 0, 100)),
    ],
)
def test_probe_fallbacks(spark, document, expected):
    df = spark.createDataFrame([(json.dumps(document), 100)], "d string, size_bytes bigint")
    r = inventory.probe_json(df, "d").first()
    assert (r.width, r.height, r.bitrate, r.probed_bytes) == expected


def test_probe_types_and_unreadable_documents(spark):
    quoted_elsewhere = json.dumps({"streams": [{"bit_rate": "0", "width": "640"}], "format": {"bit_rate": 0, "size": 2**60}})
    df = spark.createDataFrame([(quoted_elsewhere, 100), ("{broken", 100), (None, 100)], "d string, size_bytes bigint")
    probed = inventory.probe_json(df, "d")
    types = dict(probed.drop("size_bytes").withColumnRenamed("probed_bytes", "size_bytes").dtypes)
    assert {f.name: f.dataType.simpleString() for f in MEDIA_PROBE} == {n: t for n, t in types.items() if n != "d"}
    got = [(r.width, r.bitrate, r.probed_bytes, r.fps) for r in probed.collect()]
    assert got == [(640, 0, 2**60, None), (0, 0, 100, None), (0, 0, 100, None)]


def test_stage_csv_reads_blanks(spark, tmp_path):
    from reelgauge.operators.stages import typed_stage_state
    from reelgauge.schemas import STAGE_COLUMNS

    row = dict.fromkeys(STAGE_COLUMNS, "") | {"timestamp": "2024-05-01 10:00:00.500000", "stage": "Stage 03 - A - B", "actors_ready": "2"}
    table = spark.createDataFrame([tuple(row[c] for c in STAGE_COLUMNS)], ", ".join(f"{c} string" for c in STAGE_COLUMNS))
    sinks.stage_metrics_write(table, str(tmp_path / "csv"))
    header = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()[0]
    assert header == ",".join(STAGE_COLUMNS)
    got = typed_stage_state(files.stage_metrics_read(spark, str(tmp_path / "csv"))).first()
    assert (got.actors_ready, got.input_queue, got.stage_short) == (2.0, 0.0, "A - B")
    assert got.ts.microsecond == 500000


def test_gpu_samples_lose_their_units(spark, tmp_path):
    (tmp_path / "g.csv").write_text("2026/09/05 18:41:30.123, 0, 97 %, 42300 MiB, 46068 MiB, 310.55 W\n2026/09/05 18:41:40.000, 1, [N/A], 1 MiB, 2 MiB, 3 W\n")
    got = files.gpu_samples_csv(spark, str(tmp_path / "g.csv")).orderBy("gpu").collect()
    assert (got[0].gpu, got[0].utilization, got[0].memory_used, got[0].power, got[0].ts.second) == (0, 97.0, 42300.0, 310.55, 30)
    assert got[1].utilization is None


def test_reports_keep_one_line_each_with_sorted_keys(spark, tmp_path):
    root = str(tmp_path / "reports")
    for name, error in (("good", None), ("bad", "no disk")):
        report = run_folder.run_report(spark, str(tmp_path / "none"), name, 12.5, "batch", {"chunk": "32"}, error)
        sinks.run_report_write(report, root)
    got = {r.run_id: r for r in files.run_report_read(spark, root, lines=True).collect()}
    assert (got["good"].status, got["good"].output_tasks, got["bad"].status, got["bad"].error) == ("succeeded", 0, "failed", "no disk")
    assert got["good"].execution_mode == "batch" and got["good"].config["chunk"] == "32" and got["good"].throughput_videos_per_s == 0
    for line in "".join(p.read_text() for p in (tmp_path / "reports").glob("*.json")).splitlines():
        assert list(json.loads(line)) == sorted(json.loads(line))


def test_idempotent_write_leaves_existing_rows(spark, tmp_path):
    target = str(tmp_path / "out")
    first = spark.createDataFrame([("a", "1", "clips"), ("b", "1", "metas")], "path string, body string, kind string")
    again = spark.createDataFrame([("a", "2", "clips"), ("c", "2", "clips"), ("c", "1", "clips")], "path string, body string, kind string")
    assert sinks.idempotent_write(first, "path", target, dry_run=True).count() == 2
    assert not (tmp_path / "out").exists()
    sinks.idempotent_write(first, "path", target, partition_by="kind")
    before = {p: p.read_bytes() for p in (tmp_path / "out").rglob("*.parquet")}
    sinks.idempotent_write(again, "path", target, partition_by="kind", prefer="body")
    assert {p: p.read_bytes() for p in before} == before
    got = {r.path: r.body for r in spark.read.parquet(target).collect()}
    assert got == {"a": "1", "b": "1", "c": "1"}


def test_full_error_map_replaces_the_list(spark):
    docs = spark.createDataFrame([("a", None), ("b", None)], "span_uuid string, errors map<string,string>")
    full = spark.createDataFrame([("a", {"transcode": "boom"})], "span_uuid string, errors map<string,string>")
    got = {r.span_uuid: r.errors for r in sinks.replace_error_lists(docs, full).collect()}
    assert got == {"a": {"transcode": "boom"}, "b": None}
