import random

import pytest
from pyspark.sql import functions as F

from reelgauge.operators import stages
from reelgauge.sources import files, growing
from reelgauge.streaming import logs, monitors

CELLS = " │ ".join(str(i) for i in range(1, 13))


def log(rng, tables, noise):
    """A log with stage tables, rows outside of tables, line ends of all kinds, letters of several bytes and blank lines."""
    out = []
    for t in range(tables):
        out.append(f"2026-09-05 18:{t // 60:02d}:{t % 60:02d}.000000 | \x1b[32mINFO\x1b[0m | monitor")
        out.append("Stage state:")
        out += [f"│ Stage {i:02d} - Ünder{i} │ {CELLS} │" for i in range(rng.randrange(4))]
        out += [rng.choice(["", "idle", "日本語 " * 5, "│ Stage 7 │ broken │"]) for _ in range(rng.randrange(noise))]
        if rng.random() < 0.8:  # some tables stay open
            out.append("╘═══╛")
        out.append(f"│ Stage 99 - Noise │ {CELLS} │")
    return "".join(line + rng.choice(["\n", "\r\n"]) for line in out).encode()


def stream_rows(df):
    return sorted((r.file.rsplit("/", 1)[-1], r.line_no, r.line) for r in df.collect())


@pytest.mark.parametrize("split_bytes", [1 << 20, 61])
def test_growing_by_parts_equals_the_batch_parser(spark, tmp_path, split_bytes):
    """Any byte may be the last one that is there; every start but the first replays a batch too."""
    rng, folder = random.Random(split_bytes), tmp_path / "logs"
    folder.mkdir()
    whole = {"a.log": log(rng, 25, 5), "b.log": log(rng, 3, 3), "empty.log": b""}
    cuts = {name: sorted(rng.randrange(len(body) + 1) for _ in range(2)) + [len(body)] for name, body in whole.items()}
    for step in range(3):
        for name, body in whole.items():
            (folder / name).write_bytes(body[: cuts[name][step]])
        monitors.forget_last_commit(spark, str(tmp_path / "cp"))
        stream = growing.log_stream(spark, str(folder), r".*\.log", split_bytes)
        logs.drain_stage_rows(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    pick = lambda df: sorted(map(tuple, df.select(F.element_at(F.split("file", "/"), -1), *df.columns[3:]).collect()))
    batch = stages.stage_log_parse(files.read_log_lines(spark, str(folder)))
    got = logs.stage_rows(spark, str(tmp_path / "out")).select(*batch.columns)
    assert pick(got) == pick(batch) and got.count() > 20
    assert len([p for p in (tmp_path / "out" / "state").iterdir() if p.name.startswith("batch_id=")]) <= 2


def test_lines_come_once_and_whole(spark, tmp_path):
    folder, lines = tmp_path / "logs", []
    folder.mkdir()

    def drain(finished=False):
        stream = growing.log_stream(spark, str(folder), finished=finished)
        monitors.drain_batches(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
        return [line for _, _, line in stream_rows(spark.read.parquet(str(tmp_path / "out")))]

    def add(data):
        with (folder / "a").open("ab") as file:
            file.write(data)

    add(b"one\ntw")
    assert drain() == ["one"]
    add(b"o\r\n\n\xff\rx\n" + b"y" * 300_000)
    assert drain() == ["one", "two", "", "�", "x"]
    add(b"\nend")
    assert drain() == ["one", "two", "", "�", "x", "y" * 300_000]
    assert drain() == drain() and drain()[-1] != "end"
    assert drain(finished=True)[-1] == "end"
    (folder / "a").write_bytes(b"anew\n")
    with pytest.raises(Exception, match="is shorter than what was read"):
        drain()


def test_a_folder_that_is_not_there_yet(spark, tmp_path):
    logs.drain_stage_rows(growing.log_stream(spark, str(tmp_path / "none")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert logs.stage_rows(spark, str(tmp_path / "out")).count() == 0


def test_caption_events_of_a_stream(spark, tmp_path):
    event = "(CaptionGenerationStage pid=7, ip=10.0.0.1) 2026-09-05 18:00:0{}.000000 | Generated {} captions for video /in/{}.mp4 chunk-0\n"
    (tmp_path / "logs").mkdir()
    text = ""
    for part in range(2):
        text += event.format(part, part + 1, part) + "other\n"
        (tmp_path / "logs" / "a.log").write_text(text)
        events = stages.caption_event_parse(growing.log_stream(spark, str(tmp_path / "logs")))
        monitors.drain(events, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted((r.n_captions, r.media_path) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "/in/0.mp4"), (2, "/in/1.mp4")]


@pytest.mark.parametrize("split_bytes", [1, 2, 3, 7, 1000])
def test_splits_share_lines_without_loss(split_bytes, tmp_path):
    """Every cut of every small text, without Spark."""
    import pyarrow.fs as fs

    rng = random.Random(split_bytes)
    for case in range(60):
        body = b"".join(rng.choice([b"", b"a", b"bcd", b"\r", b"\xc3\xa4"]) + rng.choice([b"\n", b"\r\n"]) for _ in range(rng.randrange(8))) + rng.choice([b"", b"half"])
        path = tmp_path / f"{case}"
        path.write_bytes(body)
        with fs.LocalFileSystem().open_input_file(str(path)) as file:
            end = growing.complete_bytes(file, len(body))
            assert end == body.rfind(b"\n") + 1
            splits = growing.LogReader({"path": str(tmp_path), "split_bytes": str(split_bytes)}).partitions({}, {str(path): end})
            got = [row for s in splits for rows in growing.split_lines(file, s) for row in rows]
        want, at = [], 0
        for line in body[:end].splitlines(keepends=True):
            want.append((at, line.rstrip(b"\r\n")))
            at += len(line)
        assert got == want, (body, split_bytes)
