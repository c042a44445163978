"""Tar shards as a table: a Python data source with one partition per shard.

``tar_members`` reads shards front to back in stream mode on the executors. Sizes beyond 2 GB are
fine because a shard is never one row; the ``binaryFile`` source could not hold it.

``tar_index`` and ``split_members`` read one plain shard by many tasks: the index hops from header to header without
reading payloads, and members are then read by byte ranges. A compressed shard has no offsets and stays one task.
"""

from __future__ import annotations

import tarfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from reelgauge.functions.paths import MEDIA_SUFFIXES
from reelgauge.schemas import SHARD_MEMBER
from reelgauge.session import ensure_checkpoint_dir

#: A member without its payload; ``offset`` is where its bytes begin, null if they can only be read as a stream.
INDEX_ROW = StructType([*SHARD_MEMBER.fields[:-1], StructField("offset", LongType())])

_BATCH_ROWS = 1024
_BATCH_BYTES = 32 * 1024 * 1024


#: Names that a shard may end with.
SHARD_ENDINGS = (".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")


class ShardPartition(InputPartition):
    def __init__(self, shard: str):
        super().__init__(shard)
        self.shard = shard


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@contextmanager
def _opened(shard: str, seek: bool) -> Iterator[tuple[tarfile.TarFile, bool]]:
    """The archive, and whether it can seek: a plain one that is asked to, or else a stream."""
    system, inner = _filesystem(shard)
    if seek:
        with system.open_input_file(inner) as file:
            try:
                archive = tarfile.open(fileobj=file, mode="r:")
            except tarfile.ReadError:
                archive = None
            if archive is not None:
                with archive:
                    yield archive, True
                return
    with system.open_input_stream(inner, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|*") as archive:
        yield archive, False


class ShardReader(DataSourceReader):
    def __init__(self, options):
        self.paths = options["paths"].split("\n")
        self.suffixes = tuple(options["suffixes"].split("\n"))
        self.max_members = int(options.get("max_members", "-1"))
        self.with_payload = options.get("with_payload", "true").lower() == "true"
        self.strict = options.get("strict", "false").lower() == "true"
        self.index = options.get("index", "false").lower() == "true"

    def partitions(self) -> Sequence[InputPartition]:
        """A folder stands for the tar files below it."""
        from pyarrow import fs

        shards = []
        for path in self.paths:
            system, inner = _filesystem(path)
            info = system.get_file_info(inner)
            if info.type == fs.FileType.Directory:
                prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
                below = system.get_file_info(fs.FileSelector(inner, recursive=True))
                shards += [prefix + f.path for f in below if f.is_file and f.base_name.lower().endswith(SHARD_ENDINGS)]
            else:
                shards.append(path)
        return [ShardPartition(shard) for shard in sorted(shards)]

    def _members(self, shard: str) -> Iterator[tuple]:
        kept = 0
        with _opened(shard, self.index) as (archive, seeks):
            for index, member in enumerate(archive):
                if 0 <= self.max_members <= kept:
                    break
                ending = PurePosixPath(member.name).suffix.lower()
                if not member.isfile() or ending not in self.suffixes:
                    continue
                kept += 1
                unsafe = member.name.startswith("/") or ".." in member.name.split("/")
                if unsafe and self.strict:
                    raise ValueError(f"member {member.name} would leave the target folder")
                if self.index:
                    # A sparse member is stored in pieces, so it is read as a stream too.
                    yield (shard, index, member.name, ending, member.size, unsafe, member.offset_data if seeks and not member.issparse() else None)
                    continue
                payload = archive.extractfile(member).read() if self.with_payload and not unsafe else None
                yield (shard, index, member.name, ending, member.size, unsafe, payload)

    def read(self, partition: ShardPartition) -> Iterator:
        """Arrow batches, cut by rows and by payload bytes so memory stays flat."""
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(INDEX_ROW if self.index else SHARD_MEMBER)
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)],
                schema=schema,
            )

        for row in self._members(partition.shard):
            rows.append(row)
            held += 0 if self.index else len(row[-1] or b"")
            if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "media_shards"

    def schema(self) -> StructType:
        return INDEX_ROW if self.options.get("index", "false").lower() == "true" else SHARD_MEMBER

    def reader(self, schema: StructType) -> DataSourceReader:
        return ShardReader(self.options)


def tar_members(
    spark: SparkSession,
    paths: str | Sequence[str],
    suffixes: Sequence[str] = MEDIA_SUFFIXES,
    max_members: int | None = None,
    with_payload: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Regular media members of each shard in archive order.

    ``max_members`` counts matching members per shard. Members with an unsafe path are
    marked and come without payload, or fail the read when ``strict``.
    """
    return _load(spark, paths, suffixes, max_members, with_payload=str(with_payload), strict=str(strict))


def _load(spark: SparkSession, paths: str | Sequence[str], suffixes: Sequence[str], max_members: int | None, **options: str) -> DataFrame:
    if max_members is not None and max_members <= 0:
        raise ValueError("max_members must be positive")
    spark.dataSource.register(ShardSource)
    listed = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("media_shards").option("paths", "\n".join(listed))
    reader = reader.option("suffixes", "\n".join(s.lower() for s in suffixes)).options(**options)
    if max_members is not None:
        reader = reader.option("max_members", str(max_members))
    return reader.load()


def tar_index(
    spark: SparkSession, paths: str | Sequence[str], suffixes: Sequence[str] = MEDIA_SUFFIXES, max_members: int | None = None, strict: bool = False
) -> DataFrame:
    """What ``tar_members`` gives without payloads, and the offset of each member's bytes. Of a plain shard only headers are read."""
    return _load(spark, paths, suffixes, max_members, index="true", strict=str(strict))


def split_members(index: DataFrame, split_bytes: int = 128 << 20) -> DataFrame:
    """The members of an index with their payloads, as ``tar_members`` gives them, read by tasks of about ``split_bytes``.

    A split has the members that begin in one range of a shard's bytes, so a task reads at most one member more than that. The
    index is checkpointed: it is counted for the number of tasks, and a lost executor needn't read headers again.
    """
    ensure_checkpoint_dir(index.sparkSession)
    split = F.coalesce(F.expr(f"offset div {split_bytes}"), F.lit(-1))
    placed = index.withColumn("split", split).checkpoint()
    tasks = max(1, placed.select("shard", "split").distinct().count())
    dealt = placed.repartition(tasks, "shard", "split").sortWithinPartitions("shard", "split", "member_index")
    names = SHARD_MEMBER.fieldNames()

    def payloads(rows: list[dict]) -> Iterator[bytes | None]:
        """Of members of one shard, in the order of the archive."""
        shard = rows[0]["shard"]
        if rows[0]["offset"] is not None:
            system, inner = _filesystem(shard)
            with system.open_input_file(inner) as file:
                for r in rows:
                    yield None if r["is_unsafe"] else file.read_at(r["size_bytes"], r["offset"])
            return
        with _opened(shard, False) as (archive, _):
            wanted = iter(rows)
            row = next(wanted)
            for at, member in enumerate(archive):
                if at == row["member_index"]:
                    yield None if row["is_unsafe"] else archive.extractfile(member).read()
                    row = next(wanted, None)
                    if row is None:
                        return

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(SHARD_MEMBER)
        # The rows of a task are narrow; a stream is opened once for all its members.
        runs: dict[tuple, list[dict]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                runs.setdefault((r["shard"], r["split"]), []).append(r)
        for rows in runs.values():
            out, held = [], 0
            for r, payload in zip(rows, payloads(rows), strict=True):
                out.append({**{n: r[n] for n in names[:-1]}, names[-1]: payload})
                held += len(payload or b"")
                if len(out) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return dealt.mapInArrow(run, SHARD_MEMBER)
