import random

import pytest
from pyspark.sql import functions as F

from reelgauge.streaming import monitors, seen


def read_bytes(spark):
    """Bytes that finished stages have read from files so far."""
    store = spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).inputBytes() for i in range(stages.size()))


def paths(spark, names):
    return spark.createDataFrame([(n,) for n in names], "media_path string")


def add(spark, index, folder, batch, names):
    """What of the names is new, as a drained stream would store it."""
    given = paths(spark, names).distinct()
    seen.unseen(given, "media_path", index, batch).write.mode("overwrite").parquet(f"{folder}/{batch}")
    new = spark.read.schema("media_path string").parquet(f"{folder}/{batch}")
    seen.remember(new, "media_path", index, batch)
    return {r.media_path for r in new.collect()}


def test_generations_are_the_digits_of_a_counter():
    for n in range(700):
        spans = seen.generations(n)
        assert [b for s in spans for b in range(s[0], s[1] + 1)] == list(range(n))
        assert len(spans) <= 7 * 4
        # One generation is new after a batch, and it holds all that is gone.
        after = seen.generations(n + 1)
        assert [s for s in after if s not in spans] == [after[-1]]
    assert seen.generations(0) == [] and seen.generations(10) == [(0, 7), (8, 8), (9, 9)]


def test_random_batches_give_each_key_once(spark, tmp_path, monkeypatch):
    """Tiny slots force many buckets; batches repeat old keys, nulls, empty texts, and are replayed."""
    monkeypatch.setattr(seen, "FAN", 2)
    monkeypatch.setattr(seen, "SLOT_ROWS", 4)
    monkeypatch.setattr(seen, "SLOT_BITS", 1)
    rng, known = random.Random(3), set()
    for batch in range(6):
        names = [rng.choice([None, "", f"/in/{rng.randrange(120)}.mp4", f"/ä/{rng.randrange(9)}"]) for _ in range(rng.choice([0, 5, 60]))]
        want = set(names) - known
        for _ in range(rng.choice([1, 2])):
            assert add(spark, str(tmp_path / "index"), str(tmp_path / "out"), batch, names) == want
        known |= want
    # Only what a replay of the last batch needs is left.
    needed = {seen._name(s) for n in (5, 6) for s in seen.generations(n)}
    assert {p.name.removeprefix("gen=") for p in (tmp_path / "index" / "keys").iterdir() if p.name.startswith("gen=")} <= needed


def test_a_batch_opens_only_buckets_it_may_hit(spark, tmp_path):
    """Bytes read for the same batch don't grow with the history, once that has many buckets."""
    index, taken = str(tmp_path / "index"), {}
    batch = [f"/new/{i}.mp4" for i in range(3)] + ["/old/7.mp4"]
    for n, size in ((1, 200_000), (2, 1_600_000)):
        at = f"{index}-{n}"
        history = spark.range(size).select(F.format_string("/old/%d.mp4", "id").alias("k"))
        seen._write(history, size, at, (0, 0))
        given = paths(spark, batch).persist()
        found = seen.candidates(given, "media_path", at, 1)[0].collect()
        assert "/old/7.mp4" in {r.k for r in found}
        before = read_bytes(spark)
        assert {r.media_path for r in seen.unseen(given, "media_path", at, 1).collect()} == set(batch[:3])
        taken[size] = read_bytes(spark) - before
        stored = sum(p.stat().st_size for p in (tmp_path / f"index-{n}").rglob("*.parquet"))
        print("history", size, "stored", stored, "read", taken[size])
        given.unpersist()
    assert 0 < taken[1_600_000] < 1.5 * taken[200_000] + 200_000 and taken[1_600_000] < stored / 5


def test_filters_know_their_keys_and_few_others(spark, tmp_path):
    index = str(tmp_path / "index")
    seen._write(spark.range(20_000).select(F.col("id").cast("string").alias("k")), 20_000, index, (0, 0))
    asked = spark.range(40_000).select(F.col("id").cast("string").alias("k"))
    passed = {int(r.k) for r in seen.candidates(asked, "k", index, 1)[0].collect()}
    assert set(range(20_000)) <= passed and len(passed) < 20_000 + 200


def test_a_lost_index_is_an_error(spark, tmp_path):
    add(spark, str(tmp_path / "index"), str(tmp_path / "out"), 0, ["a"])
    with pytest.raises(RuntimeError, match="lacks generations"):
        seen.unseen(paths(spark, ["b"]), "media_path", str(tmp_path / "index"), 3)


def test_replayed_stream_plans_each_path_once(spark, tmp_path):
    place = lambda name: str(tmp_path / name)
    for part in range(4):
        paths(spark, [f"/in/{i}.mp4" for i in range(part * 3, part * 3 + 6)]).coalesce(1).write.mode("append").parquet(place("in"))
        monitors.forget_last_commit(spark, place("cp"))
        monitors.drain_new_paths(monitors.file_stream(spark, place("in"), "media_path string"), place("out"), place("cp"))
    got = sorted(r.media_path for r in spark.read.parquet(place("out")).collect())
    assert got == sorted(f"/in/{i}.mp4" for i in range(15))
