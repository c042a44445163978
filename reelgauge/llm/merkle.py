"""Merkle manifest of a table: a tree of digests for each group, a tree over the groups, and a proof for every row.

Rows are leaves. In each group they ascend by the order column; while more than one node is left, every ARITY
consecutive ones become their digest (the last run may be shorter). What is left is the group's subroot, and the subroots,
ordered by group (null first, then bytewise), give the root by the same rule.

Places. Rows are sorted by (group, order) with range partitions; each one's place in its group is its place in its
partition and an offset of one row per (partition, group). So a group that holds a third of all rows is in as many
tasks as it has partitions. Runs of ARITY rows are the only groups that are ever gathered.

Proofs by pointer jumping. A node holds a pointer to an ancestor and the sibling segments on the way there, at first those
of one step. Each round joins the nodes with themselves, pointer to node, and puts the two ways together, so the distance
doubles until every pointer stands at the root. Only nodes above the distance can be pointed at, so that side of the
join shrinks by ARITY ** distance: where few keys are left the table is small and Spark broadcasts it by its size, and
no key is hot where it is large. Leaves of one run share their parent's way, and take it in the last jump as one row.

Cases: null fields have their own mark and differ from empty ones; a null group is a group of its own, the first; null orders come
first, and rows of equal order stand by their leaf; equal rows are leaves of their own with the same digest; a table of one
row has its leaf as root and an empty proof; an empty table gives an empty result; other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelgauge.llm.tables import written

ARITY = 8
#: The number of the tree over the groups; groups are numbered from 0.
TOP = -1


def leaf_of(docs: DataFrame, fields: Sequence[str], **changed: Column) -> Column:
    """Lowercase hex SHA-256 of the fields, each as its number of UTF-8 bytes, a colon and its value, or ``-`` if null."""
    parts = []
    for f in fields:
        value = changed.get(f, F.col(f"`{f}`")).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _digest(hashes: Column) -> Column:
    """Of an array of digests in hex: the digest of these texts, one after the other."""
    return F.sha2(F.array_join(hashes, "").cast("binary"), 256)


def _raw(hashes: Column) -> Column:
    return F.unhex(F.array_join(hashes, ""))


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def _numbered(rows: DataFrame, keys: Sequence[Column], label: str) -> DataFrame:
    """Adds ``pos``, the place by the keys (from 0). Rows with equal keys are spread over partitions as well."""
    order = [*keys, F.col("salt")]
    spread = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    # Written before anything is derived from the places, so that a lost executor can't deal them anew.
    placed = written(spread.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), label)
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    # ``at`` holds the partition above 33 bits for the row.
    base = F.coalesce(F.sum("size").over(before), F.lit(0)) - F.shiftleft(F.col("part").cast("long"), 33)
    offsets = sizes.select("part", base.alias("base"))
    # One row for each partition of the sort.
    return placed.join(F.broadcast(offsets), "part").withColumn("pos", F.col("at") + F.col("base")).drop("part", "at", "base")


def _height(n: int) -> int:
    """Levels above n nodes until one is left."""
    level = 0
    while n > 1:
        n, level = -(-n // ARITY), level + 1
    return level


def _grown(nodes: DataFrame, level: int, height: int) -> tuple[list[DataFrame], DataFrame]:
    """t, pos, hash, n (nodes of the tree at this level) -> the ways of all nodes below a top, and the tops (t, level, hash)."""
    ways, tops = [], []
    for at in range(level, height):
        tops.append(nodes.where("n = 1").select("t", F.lit(at).alias("level"), "hash"))
        runs = (
            nodes.where("n > 1")
            .groupBy("t", F.expr(f"pos div {ARITY}").alias("pos"), F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("pos").alias("child"), "hash"))).alias("members"))
        )
        runs = written(runs.withColumn("hash", _digest(F.col("members.hash"))), "merkle-level")
        one = runs.select("t", F.col("pos").alias("ppos"), F.col("members.hash").alias("hashes"), F.posexplode("members"))
        ways.append(
            one.select(
                "t", F.lit(at).alias("level"), F.col("col.child").alias("pos"),
                F.col("t").alias("pt"), F.lit(at + 1).alias("plevel"), "ppos", F.array(_step("hashes", F.col("pos"))).alias("way"),
            )
        )
        nodes = runs.select("t", "pos", "n", "hash")
    tops.append(nodes.where("n = 1").select("t", F.lit(height).alias("level"), "hash"))
    found = tops[0]
    for more in tops[1:]:
        found = found.unionByName(more)
    return ways, written(found, "merkle-tops")


def _step(hashes: str, at: Column) -> Column:
    """The siblings before and after a node of a run."""
    all_ = F.col(hashes)
    return F.struct(
        _raw(F.slice(all_, F.lit(1), at)).alias("left"), _raw(F.slice(all_, at + 2, F.greatest(F.size(all_) - at - 1, F.lit(0)))).alias("right")
    )


@dataclass(frozen=True)
class Manifest:
    """``runs``: t, pos, n, members (order, leaf, claimed). ``ways``: t, pos, way from a run's digest to the root. ``trees``: t, group, subroot."""

    runs: DataFrame
    ways: DataFrame
    trees: DataFrame
    root: str | None


def _jumped(nodes: DataFrame, height: int, depth: int) -> DataFrame:
    """t, level, pos, (pt, plevel, ppos), way -> the same with all pointers at the root (null) and whole ways."""
    distance = 1
    while distance < depth:
        # Only these can be that far above a node of level 1; the highest subroot stands under the tree over the groups.
        above = nodes.where(f"level + CASE WHEN t = {TOP} THEN {height} ELSE 0 END > {distance}").select(
            F.col("t").alias("pt"), F.col("level").alias("plevel"), F.col("pos").alias("ppos"),
            F.struct("pt", "plevel", "ppos").alias("next"), F.col("way").alias("rest"),
        )
        above = written(above, "merkle-above")
        moved = nodes.where("pt IS NOT NULL").join(above, ["pt", "plevel", "ppos"]).select(
            "t", "level", "pos", "next.pt", "next.plevel", "next.ppos", F.concat("way", "rest").alias("way")
        )
        nodes = written(nodes.where("pt IS NULL").unionByName(moved), "merkle-jump")
        distance *= 2
    return nodes


def manifest(docs: DataFrame, fields: Sequence[str], group: str, order: str, claimed: Column | None = None) -> Manifest:
    """The tree of the table. ``claimed`` is the leaf a row shows to the verifier, if not its own."""
    leaves = docs.select(
        F.col(f"`{group}`").alias("group"), F.col(f"`{order}`").alias("order"), leaf_of(docs, fields).alias("leaf"),
        (claimed if claimed is not None else F.lit(None)).cast("string").alias("claimed"),
    )
    leaves = written(leaves, "merkle-leaves")
    by_group = F.col("group").asc_nulls_first()
    leaves = _numbered(leaves, [by_group, F.col("order").asc_nulls_first(), F.col("leaf")], "merkle-sorted")
    trees = leaves.groupBy("group").agg(F.min("pos").alias("start"), F.count("*").alias("n"))
    trees = written(_numbered(written(trees, "merkle-groups"), [by_group], "merkle-trees").withColumnRenamed("pos", "t"), "merkle-trees")
    groups, most = trees.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    leaves = leaves.join(trees.withColumnRenamed("group", "g"), F.col("group").eqNullSafe(F.col("g")))
    place = F.col("pos") - F.col("start")
    runs = (
        leaves.select("t", "n", place.alias("place"), "order", "leaf", "claimed")
        .groupBy("t", "n", F.expr(f"place div {ARITY}").alias("pos"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "order", "leaf", "claimed"))).alias("members"))
    )
    lone = F.when(F.col("n") == 1, F.col("members.leaf")[0])
    runs = written(runs.withColumn("hash", F.coalesce(lone, _digest(F.col("members.leaf")))), "merkle-runs")
    height = max(1, _height(most))
    level1 = runs.select("t", "pos", "hash", F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"))
    ways, tops = _grown(level1, 1, height)
    over = _height(groups)
    top_ways, root = _grown(tops.select(F.lit(TOP).cast("long").alias("t"), F.col("t").alias("pos"), "hash", F.lit(groups).cast("long").alias("n")), 0, over)
    first = root.first()
    if groups > 1:
        # A subroot goes on as a leaf of the tree over the groups.
        entry = top_ways[0].select(F.col("pos").alias("t"), "pt", "plevel", "ppos", "way")
        ways.append(tops.join(entry, "t").select("t", "level", F.lit(0).cast("long").alias("pos"), "pt", "plevel", "ppos", "way"))
        ways += top_ways[1:]
        end = f"pt = {TOP} AND plevel = {over}"
    else:
        end = f"plevel = {height}"
        ways.append(tops.select("t", "level", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("long").alias("pt"), F.lit(None).cast("int").alias("plevel"), F.lit(None).cast("long").alias("ppos"), F.expr("CAST(array() AS array<struct<left: binary, right: binary>>)").alias("way")))
    nodes = ways[0]
    for more in ways[1:]:
        nodes = nodes.unionByName(more)
    # Nobody has to jump over the root: who points at it has arrived.
    arrived = F.coalesce(F.expr(end), F.lit(True))
    nodes = nodes.withColumns({c: F.when(~arrived, F.col(c)) for c in ("pt", "plevel", "ppos")})
    nodes = _jumped(written(nodes, "merkle-nodes"), height, height - 1 + over)
    subroots = tops.withColumnRenamed("hash", "subroot").select("t", "subroot")
    # One row per group, of a size that Spark knows: runs need not be shuffled by group to meet it.
    trees = written(trees.select("t", "group").join(subroots, "t"), "merkle-groups")
    return Manifest(runs, nodes.where(f"t <> {TOP} AND level = 1").select("t", "pos", "way"), trees, None if first is None else first["hash"])


def proofs(found: Manifest) -> DataFrame:
    """One row per leaf: order, group, leaf, way (siblings left and right, level by level), subroot, root, and what a verifier computes.

    ``folded_root`` is the root that follows from the claimed leaf (or the leaf itself) and the way.
    """
    rows = found.runs.join(found.ways.withColumnRenamed("way", "above"), ["t", "pos"]).join(found.trees, "t")
    rows = rows.select("n", "above", "group", "subroot", F.col("members.leaf").alias("leaves"), F.posexplode("members").alias("at", "m"))
    way = F.when(F.col("n") == 1, F.col("above")).otherwise(F.concat(F.array(_step("leaves", F.col("at"))), F.col("above")))
    rows = rows.select("group", "subroot", "m.order", "m.leaf", F.coalesce("m.claimed", "m.leaf").alias("shown"), way.alias("way"))
    fold = F.aggregate("way", F.col("shown"), lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])).cast("binary"), 256))
    proof = F.array_join(F.transform("way", lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")
    return rows.select(
        "order", "group", "leaf", "way", "subroot", F.lit(found.root).cast("string").alias("root"),
        F.sha2(proof.cast("binary"), 256).alias("proof_sha256"), fold.alias("folded_root"),
    )
