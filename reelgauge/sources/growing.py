"""Logs that are being written, as a stream of whole lines: a Python data source whose offset is a byte of each file.

An offset lies behind a line end, so half a line is left to the batch that sees its end. New bytes are cut into splits that many
tasks read; a line belongs to the split it begins in. Which bytes a batch has follows from its offsets alone: a replayed
batch reads the same lines again, however the log has grown since.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reelgauge.session import ship_package
from reelgauge.sources.tar import _filesystem

LINE_ROW = StructType(
    [StructField("file", StringType()), StructField("block", LongType()), StructField("line_no", LongType()), StructField("line", StringType())]
)
_CHUNK = 4 << 20


class LineSplit(InputPartition):
    """The lines of a file that begin at ``low`` or later and before ``high``; new bytes go from ``start`` to ``end``."""

    def __init__(self, file: str, start: int, end: int, low: int, high: int):
        super().__init__((file, low))
        self.file, self.start, self.end, self.low, self.high = file, start, end, low, high


def complete_bytes(file, size: int) -> int:
    """Where the last line end before ``size`` lies, read from the back; 0 if there is none."""
    high = size
    while high > 0:
        low = max(0, high - _CHUNK // 64)
        at = file.read_at(high - low, low).rfind(b"\n")
        if at >= 0:
            return low + at + 1
        high = low
    return 0


def split_lines(file, split: LineSplit) -> Iterator[list[tuple[int, bytes]]]:
    """Portions of (offset, line) without line ends. Lines end as in Spark's text files: by \\n, \\r or both."""
    at, held = split.low, b""
    skip = split.low > split.start  # the line that runs into the split belongs to the one before
    if skip:
        at -= 1
    while at + len(held) < split.end:
        data = held + file.read_at(min(_CHUNK, split.end - at - len(held)), at + len(held))
        last = at + len(data) >= split.end
        cut = len(data) if last else data.rfind(b"\n") + 1
        rows, place = [], at
        for line in data[:cut].splitlines(keepends=True):
            if skip:
                skip = False
            elif place >= split.high:
                break
            else:
                rows.append((place, line.rstrip(b"\r\n")))
            place += len(line)
        if rows:
            yield rows
        at, held = at + cut, data[cut:]
        if at >= split.high:
            return


class LogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.pattern = re.compile(options.get("pattern", ".*"))
        self.split_bytes = int(options.get("split_bytes", str(64 << 20)))
        self.finished = options.get("finished", "false").lower() == "true"

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Reads the names and sizes of the logs, and of each one its end back to the last line end."""
        from pyarrow import fs

        system, inner = _filesystem(self.path)
        prefix = self.path[: len(self.path) - len(inner)] if self.path.endswith(inner) else ""
        found = system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
        offsets = {}
        for info in sorted((f for f in found if f.is_file and self.pattern.fullmatch(f.base_name)), key=lambda f: f.path):
            if self.finished:
                offsets[prefix + info.path] = info.size
            elif info.size:
                with system.open_input_file(info.path) as file:
                    offsets[prefix + info.path] = complete_bytes(file, info.size)
        return offsets

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        splits = []
        for file, high in end.items():
            low = start.get(file, 0)
            if high < low:
                raise ValueError(f"{file} is shorter than what was read of it: {high} < {low} bytes")
            splits += [LineSplit(file, low, high, at, min(at + self.split_bytes, high)) for at in range(low, high, self.split_bytes)]
        return splits

    def read(self, partition: LineSplit) -> Iterator:
        import pyarrow as pa

        system, inner = _filesystem(partition.file)
        schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("line_no", pa.int64()), ("line", pa.string())])
        with system.open_input_file(inner) as file:
            for rows in split_lines(file, partition):
                lines = pa.array([line.decode("utf-8", "replace") for _, line in rows], pa.string())
                names, blocks = pa.array([partition.file] * len(rows), pa.string()), pa.array([partition.low] * len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([names, blocks, pa.array([at for at, _ in rows], pa.int64()), lines], schema=schema)

    def commit(self, end: dict) -> None:
        """Nothing is kept beside the offsets."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_logs"

    def schema(self) -> StructType:
        return LINE_ROW

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LogReader(self.options)


def log_stream(spark: SparkSession, folder: str, pattern: str = ".*", split_bytes: int = 64 << 20, finished: bool = False) -> DataFrame:
    """Lines appended to the logs below ``folder`` as (file, block, line_no, line), as ``read_log_lines`` gives them.

    ``pattern`` must match a whole file name. ``line_no`` is the byte a line begins at. Bytes that are no UTF-8 are replaced. An empty folder
    or one that isn't there yet gives no rows. With ``finished`` a last line without an end counts as a line: ask for it once,
    when nothing is written any more. A log that gets shorter is an error: start anew under another checkpoint.
    """
    if split_bytes <= 0:
        raise ValueError("split_bytes must be positive")
    ship_package(spark)
    spark.dataSource.register(LogSource)
    options = {"path": folder.rstrip("/"), "pattern": pattern, "split_bytes": str(split_bytes), "finished": str(finished)}
    return spark.readStream.format("growing_logs").options(**options).load()
