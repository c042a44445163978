"""Which keys earlier batches of a stream have had, so that a new batch opens only what may hold one of its own.

The keys of a batch are a generation; every ``FAN`` generations of one size are merged into one (as the digits of a
counter), so there are few of them and a key is rewritten once per level. A generation has 2^bits slots by the key's hash, and
one Bloom filter of 4 KB per slot; ``SLOTS`` slots share a bucket, which is a folder of its own, for keys as for filters. A
batch reads the filters of the buckets its keys fall into, and opens the key buckets of those keys that pass.
Which generations exist after n batches follows from n alone, so a replayed batch finds what its first attempt found and
writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 8  # generations of one size that are merged
SLOT_ROWS = 2048  # a slot holds 1024 to 2048 keys; 4 places of 32,768 bits each let 1 of 400 strange keys pass
SLOT_BITS = 5  # slots of a bucket, as a power of 2
_FILTER_BITS = 15

Span = tuple[int, int]


def generations(n: int) -> list[Span]:
    """First and last batch of each generation after ``n`` batches, oldest first."""
    spans, start, size = [], 0, 1
    while size * FAN <= n:
        size *= FAN
    while start < n:
        while start + size > n:
            size //= FAN
        spans.append((start, start + size - 1))
        start += size
    return spans


def _name(span: Span) -> str:
    return f"g{span[0]}_{span[1]}"


def _slot(key: Column, bits: Column) -> Column:
    """The leading bits of the hash; none of them is slot 0."""
    return F.when(bits == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", F.xxhash64(key), (64 - bits).cast("int")))


def _bucket(slot: Column) -> Column:
    return F.shiftright(slot, SLOT_BITS).cast("int")


def _places(key: Column) -> Column:
    second = F.xxhash64(F.lit(1), key)
    return F.array(*[F.shiftrightunsigned(second, _FILTER_BITS * i).bitwiseAND((1 << _FILTER_BITS) - 1) for i in range(4)])


def _has(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, place.bitwiseAND(7).cast("int")) == 1


def _within(opened: Iterable[tuple[str, int]]) -> Column:
    """Folders to open, as a condition on the partition columns."""
    by_name: dict[str, list[int]] = {}
    for name, bucket in opened:
        by_name.setdefault(name, []).append(bucket)
    found = F.lit(False)
    for name, buckets in by_name.items():
        found = found | ((F.col("gen") == name) & F.col("bucket").isin(buckets))
    return found


def _folders(df: DataFrame) -> list[tuple[str, int]]:
    """Distinct buckets: at most one for 32 to 64 thousand keys of the index."""
    return [(r.gen, r.bucket) for r in df.select("gen", "bucket").distinct().collect()]


def candidates(keys: DataFrame, key: str, index: str, n: int) -> tuple[DataFrame, DataFrame] | None:
    """Keys that pass the filter of a generation, with its folder, and the sizes of the generations; None before the first batch."""
    if n == 0:
        return None
    spark = keys.sparkSession
    names = [_name(s) for s in generations(n)]
    sizes = spark.read.schema("n long, bits int, gen string").parquet(f"{index}/size").where(F.col("gen").isin(names))
    known = sizes.collect()  # one row per generation: 7 for each power of 8 at most
    if len(known) != len(names):
        raise RuntimeError(f"{index} lacks generations of {n} batches: {sorted(set(names) - {r.gen for r in known})}")
    options = F.array(*[F.struct(F.lit(r.gen).alias("gen"), F.lit(r.bits).alias("bits")) for r in known])
    asked = keys.select(F.col(key).alias("k"), F.explode(options).alias("g")).select("k", "g.gen", _slot(F.col("k"), F.col("g.bits")).alias("slot"))
    asked = asked.withColumn("bucket", _bucket(F.col("slot")))
    filters = spark.read.schema("slot long, bitmap binary, gen string, bucket int").parquet(f"{index}/filters").where(_within(_folders(asked)))
    hit = asked.join(filters, ["gen", "bucket", "slot"])
    passes = F.forall(_places(F.col("k")), lambda place: _has(F.col("bitmap"), place))
    return hit.where(passes).select("k", "gen", "bucket"), sizes


def unseen(keys: DataFrame, key: str, index: str, n: int) -> DataFrame:
    """Of distinct ``keys`` those that none of the first ``n`` batches had; null is a key like others."""
    found = candidates(keys, key, index, n)
    if found is None:
        return keys
    opened = _folders(found[0])
    if not opened:
        return keys
    kind = keys.schema[key].dataType.simpleString()
    held = keys.sparkSession.read.schema(f"k {kind}, gen string, bucket int").parquet(f"{index}/keys").where(_within(opened)).select("k")
    return keys.join(held, F.col(key).eqNullSafe(held["k"]), "left_anti")


def _write(keys: DataFrame, n: int, index: str, span: Span) -> None:
    """Store a generation of ``n`` keys (column k); its size comes last."""
    bits = max(0, (max(n, 1) - 1) // SLOT_ROWS).bit_length()
    slot = _slot(F.col("k"), F.lit(bits))
    placed = keys.select("k", slot.alias("slot")).withColumn("bucket", _bucket(F.col("slot")))
    name = _name(span)
    placed.drop("slot").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{index}/keys/gen={name}")
    marked = placed.select("bucket", "slot", F.explode(_places(F.col("k"))).alias("place"))
    filters = marked.groupBy("bucket", "slot").agg(F.bitmap_construct_agg("place").alias("bitmap"))
    filters.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{index}/filters/gen={name}")
    size = keys.sparkSession.range(1).select(F.lit(n).cast("long").alias("n"), F.lit(bits).alias("bits"))
    size.coalesce(1).write.mode("overwrite").parquet(f"{index}/size/gen={name}")


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def remember(fresh: DataFrame, key: str, index: str, batch_id: int) -> None:
    """Add the stored, distinct, unseen keys of batch ``batch_id`` and merge what is due.

    What the batch before made superfluous goes now, because that batch can't be replayed any more.
    """
    spark = fresh.sparkSession
    before, after = generations(batch_id), generations(batch_id + 1)
    merged = [s for s in before if s not in after]
    rows, n = fresh.select(F.col(key).alias("k")), fresh.count()
    if merged:
        names = [_name(s) for s in merged]
        kind = fresh.schema[key].dataType.simpleString()
        old = spark.read.schema(f"k {kind}, gen string, bucket int").parquet(f"{index}/keys").where(F.col("gen").isin(names)).select("k")
        n += spark.read.schema("n long, gen string").parquet(f"{index}/size").where(F.col("gen").isin(names)).agg(F.sum("n")).first()[0]
        rows = rows.unionAll(old)
    _write(rows, n, index, after[-1])
    for span in generations(batch_id - 1) if batch_id > 0 else []:
        if span not in before:
            for part in ("size", "filters", "keys"):
                _remove(spark, f"{index}/{part}/gen={_name(span)}")
