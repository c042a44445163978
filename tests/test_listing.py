import os

import pytest

from reelgauge.sources import files, listing


def tree(root):
    names = ["a.mp4", "b.txt", "x/c.MOV", "x/y/z/d d.mp4", "x/y/e%20f+g.mp4", "ü/日本.mkv", "_hidden/h.mp4", ".h.mp4", "x/_tmp", "k=_v/i.mp4", "_k=v/j.mp4"]
    for i, name in enumerate(names):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"0" * (i + 1))
    (root / "empty" / "deep").mkdir(parents=True)
    for i in range(150):
        (root / "many" / f"{i:03d}").mkdir(parents=True)
        (root / "many" / f"{i:03d}" / "clip.webm").write_bytes(b"1")


def shown(df):
    return sorted((r.path, r.size_bytes, r.modified) for r in df.collect())


def test_levels_equal_spark_listing(spark, tmp_path):
    """Names with blanks, signs and letters of any kind; hidden names and empty folders give nothing."""
    tree(tmp_path)
    want = shown(files.list_files(spark, str(tmp_path)))
    got = shown(listing.list_levels(spark, str(tmp_path), folders_per_task=7))
    assert [g[:2] for g in got] == [w[:2] for w in want] and len(got) == 150 + 8
    assert all(abs((g[2] - w[2]).total_seconds()) < 1 for g, w in zip(got, want, strict=True))
    assert shown(listing.list_levels(spark, f"file://{tmp_path}/x"))[0][0].endswith("/x/c.MOV")


def test_inventory_of_a_folder_a_file_and_nothing(spark, tmp_path):
    tree(tmp_path)
    found = [os.path.relpath(r.media_path, tmp_path) for r in files.media_inventory(spark, str(tmp_path)).collect()]
    assert found == sorted(found) and len(found) == 150 + 7 and "b.txt" not in found
    assert [r.media_path for r in files.media_inventory(spark, str(tmp_path / "x" / "c.MOV")).collect()] == [str(tmp_path / "x" / "c.MOV")]
    assert files.media_inventory(spark, str(tmp_path / "empty"), required=False).isEmpty()
    (tmp_path / "x" / "y" / "none.mp4").touch()  # a file without bytes is a file, which Spark's listing passes over
    assert [r.size_bytes for r in files.media_inventory(spark, str(tmp_path / "x" / "y")).collect()] == [5, 0, 4]
    with pytest.raises(RuntimeError, match="No supported media"):
        files.media_inventory(spark, str(tmp_path / "empty"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.media_inventory(spark, str(tmp_path / "none"))
