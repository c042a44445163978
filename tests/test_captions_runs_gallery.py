import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgauge.operators import captions, gallery, resources, runs
from reelgauge.operators.batched import _batches, batched_map
from reelgauge.sources import ranked, sinks

TEXTS = {
    "good": "A man walks.  \n",
    "blank": " \n ",
    "cut": "word " * 256,
    "long_but_whole": "word " * 256 + "end.",
    "template": "The video appears to show a dog.",
    "heading": "### Scene\nA dog.",
    "refusal": "I CANNOT describe this.",
    "not_refusal": "Hawaii cannot wait.",
    "sorry": "Well, I'm sorry!",
}


def table(spark):
    return spark.createDataFrame([(k, v, "en") for k, v in TEXTS.items()], "id string, caption string, subset string")


def test_gate_reasons(spark):
    got = {r.id: r.reasons for r in captions.caption_gate(table(spark)).collect()}
    assert got == {
        "good": [], "blank": ["empty"], "cut": ["at_token_cap", "no_terminal"], "long_but_whole": ["at_token_cap"],
        "template": ["template"], "heading": ["heading"], "refusal": ["refusal"], "not_refusal": [], "sorry": ["refusal"],
    }


def test_null_caption_is_empty(spark):
    df = spark.createDataFrame([(None,)], "caption string")
    assert captions.caption_gate(df, tokens=None).first().reasons == ["empty"]


def test_gate_uses_a_given_token_column(spark):
    df = spark.createDataFrame([("A dog.", 256), ("A dog.", 255)], "caption string, n int")
    assert [r.accepted for r in captions.caption_gate(df, tokens="n").orderBy("n").collect()] == [True, False]


def test_gate_report_counts_each_reason(spark):
    got = {(r.reason, r.subset): (r.n_rows, r.n_captions) for r in captions.gate_report(captions.caption_gate(table(spark))).collect()}
    assert got["accepted", "en"] == (2, 9) and got["at_token_cap", None] == (2, 9) and got["refusal", "en"] == (2, 9)


def test_caption_stats(spark):
    df = table(spark).unionAll(table(spark).where("id in ('good', 'cut')"))
    r = captions.caption_stats(df, ["subset"]).first()
    tokens = sorted(len(v.split()) for v in [*TEXTS.values(), TEXTS["good"], TEXTS["cut"]])
    assert (r.n, r.n_empty, r.n_duplicates, r.n_at_cap, r.n_cut_off) == (11, 1, 2, 3, 2)
    assert r.tokens_mean == pytest.approx(sum(tokens) / 11, abs=1e-6)
    assert [r.tokens_p50, r.tokens_p90] == [tokens[5], tokens[9]]


def test_caption_stats_reads_texts_once(spark, plan, tmp_path):
    table(spark).write.parquet(str(tmp_path / "c"))
    stats = captions.caption_stats(spark.read.parquet(str(tmp_path / "c")), ["subset"])
    stats.collect()
    final = plan(stats).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_review_sample_is_deterministic(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("s"))
    first = captions.stratified_review_sample(df, ["s"], "id", 4)
    second = captions.stratified_review_sample(df.repartition(7), ["s"], "id", 4)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect())) and first.count() == 12


def test_published_throughput(spark):
    start = dt.datetime(2026, 9, 5, 18, 41, 28)
    rows = [
        ("main", 194, 1163, 1241, 4465.4376764297485, start, start + dt.timedelta(seconds=4465)),
        ("resume", 38, 228, 252, 1837.217269897461, start, dt.datetime(2026, 9, 5, 20, 56, 11)),
    ]
    df = spark.createDataFrame(rows, "phase string, videos int, clips int, windows int, seconds double, start_ts timestamp, end_ts timestamp")
    got = {r.scope: (r.videos_per_min, r.windows_per_min) for r in runs.throughput_total(df).collect()}
    assert got == {"main": (2.607, 16.675), "resume": (1.241, 8.230), "active_total": (2.209, 14.213), "wall_clock": (1.722, 11.083)}
    assert {r.scope: r.minutes for r in runs.throughput_total(df).collect()}["wall_clock"] == 134.72


def test_zero_elapsed_gives_zero(spark):
    df = spark.createDataFrame([("r", 3, 4, 5, 0)], "run_id string, videos int, clips int, windows int, seconds int")
    r = runs.run_throughput(df).first()
    assert (r.videos_per_min, r.clips_per_s) == (0.0, 0.0)


def test_run_compare(spark):
    df = spark.createDataFrame(
        [("batch", "i", 8, 48, 48, 200), ("stream", "i", 8, 48, 48, 100), ("other", "j", 1, 1, 1, 1)],
        "run_id string, input_id string, videos int, clips int, windows int, seconds int",
    )
    r = runs.run_compare(df, "batch").collect()
    assert [(x.run_id, x.wall_ratio, x.videos_per_min_delta) for x in r] == [("stream", 0.5, 2.4)]


def test_eta(spark):
    r = runs.eta_projection(spark.createDataFrame([(91, 232, 4077.0), (0, 5, 10.0)], "done int, total int, seconds double").orderBy("done")).collect()
    assert r[0].eta_min is None and r[1].remaining == 141 and round(r[1].eta_min) == 105 and round(r[1].full_min) == 173


def test_batch_sweep(spark):
    rows = [(1, False, 0.5, 0.0, 10, 10), (1, False, 0.5, 0.0, 10, 10), (2, False, 0.8, 0.0, 14, 10), (2, False, 0.85, 0.0, 14, 10), (4, False, 0.8, 0.0, 20, 10), (4, True, 0.8, 0.0, 20, 10), (8, False, 0.1, 0.0, 99, 1)]
    df = spark.createDataFrame(rows, "batch_size int, oom boolean, memory_share double, store_growth double, captions int, seconds int")
    assert [r.batch_size for r in runs.batch_sweep(df).where("selected").collect()] == [2]


def test_verdicts(spark):
    df = spark.createDataFrame([("a", 0.7, 0.5, "above"), ("b", 0.7, 0.5, "below"), ("c", None, 0.5, "above")], "hypothesis string, value double, threshold double, direction string")
    assert {r.hypothesis: r.verdict for r in runs.hypothesis_verdict(df).collect()} == {"a": "supported", "b": "rejected", "c": "inconclusive"}


def test_preflight(spark):
    media = spark.createDataFrame([("/a.mp4", 5), ("/b.mp4", 7)], "media_path string, size_bytes bigint")
    with pytest.raises(RuntimeError, match="needs 1, has 0"):
        runs.require_preflight(runs.preflight_gate(media, gpus_needed=1))
    runs.require_preflight(runs.preflight_gate(media, gpus_needed=1, gpus=1))
    with pytest.raises(RuntimeError, match="0 files"):
        runs.require_preflight(runs.preflight_gate(media.limit(0)))
    with pytest.raises(RuntimeError, match="no such folder"):
        runs.require_preflight(runs.preflight_gate(media, problems=["no such folder"]))
    assert runs.preflight_gate(media, first=1).where("check = 'inputs'").first().detail == "1 files, 5 bytes"


def items(spark, n=23):
    rows = [(f"id{i:02d}", f"/in/{'A' if i % 2 else 'b'}.mp4", [float(i // 5), 9.0]) for i in range(n)]
    return spark.createDataFrame(rows, "id string, source_video string, duration_span array<double>")


def test_index_files_hold_the_index_order(spark, tmp_path):
    index = gallery.gallery_index(items(spark, 200), "run")
    sinks.gallery_index_write(index, str(tmp_path / "index"))
    lines = [json.loads(x) for f in sorted((tmp_path / "index").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x["id"] for x in lines] == [r.id for r in index.collect()]
    assert {(x["run_id"], x["item_count"], x["page_size"]) for x in lines} == {("run", 200, 10)}


def test_pages_are_clamped_slices_of_the_index(spark):
    table = items(spark)
    ordered = [r.id for r in gallery.gallery_index(table, "run").collect()]
    read = lambda page: gallery.gallery_page(table, page).orderBy("position").collect()
    assert [r.id for p in (1, 2, 3) for r in read(p)] == ordered
    assert [r.id for r in read(99)] == ordered[20:] and [r.id for r in read(-4)] == ordered[:10]
    assert (read(99)[0].page, read(99)[0].pages, read(99)[0].filtered_count) == (3, 3, 23)
    assert gallery.gallery_page(table.limit(0), 1).count() == 0
    with pytest.raises(ValueError):
        gallery.gallery_page(table, 1, size=0)


@pytest.mark.parametrize("n,size,per_file", [(0, 10, 5), (1, 10, 100), (203, 10, 25), (203, 7, 1000), (203, 50, 9), (400, 1, 20)])
def test_stored_pages_equal_sorted_ones(spark, tmp_path, plan, n, size, per_file):
    """Every page, without a sort, from a few files where files are not smaller than a page."""
    table = items(spark, n) if n else items(spark, 1).limit(0)
    ordered = [r.id for r in gallery.gallery_index(table, "run").collect()]
    ranked.write_ranked(table.repartition(3), str(tmp_path / "index"), gallery.INDEX_ORDER, per_file)
    pages = max(1, -(-n // size))
    for asked in (-1, 1, 2, pages // 2, pages, pages + 5):
        got = ranked.ranked_page(spark, str(tmp_path / "index"), asked, size)
        page = min(max(asked, 1), pages)
        rows = sorted(got.collect(), key=lambda r: r.position)
        assert [r.id for r in rows] == ordered[(page - 1) * size : page * size]
        assert [r.position for r in rows] == list(range((page - 1) * size, min(n, page * size)))
        assert {(r.page, r.pages, r.filtered_count) for r in rows} <= {(page, pages, n)}
        assert n == 0 or ("Exchange" not in plan(got) and "Sort" not in plan(got))
        low = (page - 1) * size
        if size <= per_file and n > 4 * per_file:
            # The last file of each range may be small, so a page can meet three.
            assert len(ranked.files_of(spark, str(tmp_path / "index"), low, low + size)) <= 3
    with pytest.raises(ValueError):
        ranked.ranked_page(spark, str(tmp_path / "index"), 1, 0)


def test_search(spark):
    table = items(spark)
    assert gallery.gallery_search(table, "  ").count() == 23
    assert gallery.gallery_search(table, " a.MP4 ").count() == 11
    assert gallery.gallery_search(table, "ID07").count() == 1
    assert gallery.gallery_search(table, "50%_").count() == 0


def test_gallery_items_defaults(spark):
    docs = spark.createDataFrame(
        [("u1", "/v", [0.0, 1.0], None, None, None, None, None, "/run/clips/u1.mp4", "/run/metas/v0/u1.json"), ("u2", "/v", [0.0, 1.0], 1, 1, 1.0, [{}], True, "/run/clips/u2.mp4", "/x")],
        "span_uuid string, source_video string, duration_span array<double>, width int, height int, framerate double, "
        "windows array<map<string,string>>, valid boolean, clip_location string, metadata_path string",
    )
    files = spark.createDataFrame([("/run/clips/u1.mp4",), ("/run/clips/u1.mp4",)], "path string")
    r = gallery.gallery_items(docs, files, "/run").collect()
    assert len(r) == 1
    assert (r[0].window_count, r[0].valid, r[0].video_url, r[0].metadata_url) == (0, False, "/assets/clips/u1.mp4", "/assets/metas/v0/u1.json")


def test_alerts(spark):
    ts = dt.datetime(2026, 9, 5, 18, 10)
    rows = [("h", ts, 4, 100, 10, 100, 1, 2), ("h", ts, 50, 100, 90, 100, 2, 2), ("g", ts, 5, 100, 89, 100, 0, 2)]
    df = spark.createDataFrame(rows, "host string, ts timestamp, disk_free int, disk_total int, memory_used int, memory_total int, store_used int, store_capacity int")
    got = {(r.host, r.alert): (r.n_samples, r.store_share_max) for r in resources.resource_alerts(df).collect()}
    assert got == {("h", "disk_low"): (1, 0.5), ("h", "gpu_memory_high"): (1, 1.0)}


LENGTHS = T.StructType([T.StructField("n", T.LongType())])


@pytest.fixture
def lengths():
    """A factory made here travels to the workers by value."""

    def factory():
        def work(batch):
            if batch["text"].str.contains("boom").any():
                raise ValueError("boom")
            return pd.DataFrame({"n": batch["text"].str.len().astype("int64")})

        return work

    return factory


@pytest.mark.parametrize("size", [1, 3, 64])
def test_batched_map_keeps_every_row(spark, lengths, size):
    df = spark.createDataFrame([(i, "boom" if i % 7 == 0 else "x" * i) for i in range(50)], "id int, text string").repartition(3)
    got = {r.id: (r.n, r.errors) for r in batched_map(df, lengths, size, LENGTHS, stage="caption").collect()}
    assert got == {i: (None, {"caption": "ValueError: boom"}) if i % 7 == 0 else (i, None) for i in range(50)}


def test_batched_map_sends_only_inputs_and_kept_columns(spark, lengths):
    df = spark.createDataFrame([(i, "boom" if i == 3 else "x" * i, "wide") for i in range(9)], "id int, text string, extra string")
    made = batched_map(df, lengths, 4, LENGTHS, inputs=["text"], keep=["id"])
    assert made.columns == ["id", "n", "errors"]
    assert {r.id: r.n for r in made.collect()} == {i: None if i == 3 else i for i in range(9)}
    assert [r.n for r in batched_map(df.where("id <> 3"), lengths, 4, LENGTHS, keep=[], inputs=["text"]).orderBy("n").collect()] == [0, 1, 2, 4, 5, 6, 7, 8]


def test_batches_are_exact():
    frames = [pd.DataFrame({"a": range(n)}) for n in (5, 0, 1, 9)]
    assert [len(b) for b in _batches(iter(frames), 4)] == [4, 4, 4, 3]


def test_batched_map_checks_parameters(spark, lengths):
    with pytest.raises(ValueError):
        batched_map(spark.range(1), lengths, 0, LENGTHS)
