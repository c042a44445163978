import threading

import pytest

from reelgauge.sources import commits

ROW = "id string, text string"


def shown(spark, target, keep="last"):
    return {r.id: r.text for r in commits.committed(spark, target, "id", keep).collect()}


def test_a_document_is_swapped_whole(spark, tmp_path):
    """Staged rows are not seen; a commit shows all of them; null is a key; repeated rows of a write count once."""
    target = str(tmp_path / "docs")
    with pytest.raises(ValueError, match="nothing is committed"):
        commits.committed(spark, target, "id")
    commits.replace(spark.createDataFrame([("a", "1"), ("b", "1"), (None, "1"), ("a", "1")], ROW), "id", target)
    folder = commits.stage(spark.createDataFrame([("a", "2"), (None, None), ("c", "2")], ROW), "id", target)
    before = commits.committed(spark, target, "id")
    assert shown(spark, target) == {"a": "1", "b": "1", None: "1"}
    commits.commit(spark, target, folder)
    assert shown(spark, target) == {"a": "2", "b": "1", None: None, "c": "2"}
    assert shown(spark, target, "first") == {"a": "1", "b": "1", None: "1", "c": "2"}
    assert {r.id: r.text for r in before.collect()} == {"a": "1", "b": "1", None: "1"}
    assert commits.committed(spark, target, "id").count() == 4
    commits.replace(spark.createDataFrame([], ROW), "id", target)
    assert commits.committed(spark, target, "id").count() == 4


def test_repeated_rows_of_a_write_show_as_one_and_the_same(spark, tmp_path, plan):
    """A third of the rows share a key; every read gives the same row; ``prefer`` decides at the write; a write doesn't shuffle."""
    target = str(tmp_path / "docs")
    rows = [("hot" if i % 3 == 0 else f"k{i}", f"t{i:03d}") for i in range(300)]
    commits.replace(spark.createDataFrame(rows, ROW).repartition(7), "id", target)
    first = shown(spark, target)
    assert set(first) == {i for i, _ in rows} and all((i, t) in rows for i, t in first.items())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert shown(spark, target) == first
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plan(commits.committed(spark, target, "id")).count("Exchange hashpartitioning") == 1
    commits.replace(spark.createDataFrame(rows, ROW), "id", target, prefer="text")
    assert shown(spark, target)["hot"] == "t000"
    assert commits.committed(spark, target, "id").count() == len(set(first))


def test_concurrent_writers_leave_each_key_once(spark, tmp_path):
    target, writers = str(tmp_path / "docs"), 4
    frames = [spark.createDataFrame([(f"k{i}", f"w{w}") for i in range(20)], ROW) for w in range(writers)]
    threads = [threading.Thread(target=commits.replace, args=(f, "id", target)) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for keep in ("first", "last"):
        got = shown(spark, target, keep)
        assert len(got) == 20 and len(set(got.values())) == 1  # one writer won all of them
        assert commits.committed(spark, target, "id", keep).count() == 20


def test_writers_with_one_number_have_one_order(spark, tmp_path):
    """Both took the same number: every reader decides by the folder's name."""
    target = str(tmp_path / "docs")
    folders = [commits.stage(spark.createDataFrame([("k", name)], ROW), "id", target) for name in ("x", "y")]
    for f in folders:
        (tmp_path / "docs" / "commits").mkdir(exist_ok=True)
        (tmp_path / "docs" / "commits" / f"{0:012d}-{f}").touch()
    want = "xy"[folders.index(max(folders))]
    assert shown(spark, target) == {"k": want} and shown(spark, target, "first") == {"k": "xy".replace(want, "")}
