"""Hard-negative mining: exact top lists by inner product, through candidate lists that clusters of anchors share.

For each anchor, its positives are the rows of its own label with the highest scores. For each positive, its negatives are
the rows of other labels with the highest scores within [low_percent, 100] hundredths of the positive's score. Scores are
inner products of components floor(scale * x), whole numbers.

Anchors are clustered by direction. For a cluster with centroid c, whose members are at most theta from c, no member u has a
score above |u| * |v| * cos(max(0, angle(v, c) - theta)) with a candidate v. Candidates are sorted by this bound once for the
cluster, and every member walks down that one list, a stride at a time, until it is certain that nothing below can enter:
the bound is under the lowest score that could still count, of each list the member keeps.

At scale. Candidates are assigned to the nearest centroid and packed into blocks of about BLOCK rows; a centroid that
attracts a third of all rows has many blocks. A cluster of more than GROUP anchors is split into groups. First every group walks
the blocks of its own centroid. That gives each member a score that its last entry reaches at least, and the rest is
only visited where a centroid's bound does not rule it out. Walks meet their blocks in slices of SLICE blocks, so a task
holds one group and one slice; the slices' short lists are merged by a window of a few rows per anchor. Centroids (at most
CLUSTERS) are fitted on at most FIT_ROWS anchors, the first by a hash of the row; results don't depend on them, since walks
end only when certain.

Cases: rows with a null label, null vector, null id, or a null or non-finite component take no part; vectors of unequal length
are compared as if the shorter ended in zeros; rows count as often as they occur, and an anchor's other rows are all but itself,
so repeated rows give repeated results; ties go to the smaller id; fewer than asked are returned if there are no more, none
if no negative lies in the range (a positive score below 0 has no range); scores are exact, also where they do
not fit 53 bits, and limited to 64 bits; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelgauge.llm.tables import written

CLUSTERS = 256
#: Anchors per cluster that are aimed at.
PER_CLUSTER = 64
FIT_ROWS = 16_384
GROUP = 1024
BLOCK = 4096
SLICE = 16
STRIDE = 64
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
#: Room for rounding in angles and products.
_SLACK = 1e-6


@dataclass(frozen=True)
class Shape:
    """What is known of all vectors: their length, and how components are packed."""

    width: int
    kind: str
    #: Whether inner products are exact in doubles.
    plain: bool


@dataclass(frozen=True)
class Centroids:
    """Directions, and of the candidates nearest to each: the widest angle and the largest norm."""

    rows: np.ndarray
    angle: np.ndarray
    norm: np.ndarray


def clean(vectors: DataFrame, vec_id: str, vector: str, label: str, anchor: Column, scale: int) -> DataFrame:
    """id, label, q (whole numbers as doubles), anchor of the rows that take part."""
    x = F.col(f"`{vector}`").cast("array<double>")
    return vectors.where(
        F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & x.isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    ).select(
        F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
        F.transform(x, lambda v: _floor(v * scale)).alias("q"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )


def _floor(x: Column) -> Column:
    """The whole number below, as a double; above 53 bits every double is whole, and some don't fit a long."""
    return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)


def shape_of(rows: DataFrame) -> tuple[Shape, int]:
    """And the number of anchors."""
    top = F.array_max(F.transform("q", lambda v: F.abs(v)))
    width, most, anchors = rows.agg(F.max(F.size("q")), F.max(top), F.count_if("anchor")).first()
    width, most = width or 0, most or 0.0
    kind = next((k for k in ("i2", "i4") if most < 2 ** (8 * int(k[1]) - 1)), "f8")
    return Shape(width, f"<{kind}", most * most * max(width, 1) < 2**53), anchors


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of doubles as rows, zeros behind the shorter ones."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions (zero for the zero vector) and norms."""
    most = np.abs(x).max(axis=1, initial=0.0)[:, None]
    small = np.divide(x, most, out=np.zeros_like(x), where=most > 0)  # squares of large components overflow
    norm = np.sqrt((small * small).sum(axis=1))[:, None]
    return np.divide(small, norm, out=np.zeros_like(x), where=norm > 0), (norm * most)[:, 0]


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; the start is every so-manieth row."""
    unit = _unit(x)[0]
    unit = unit[np.linalg.norm(unit, axis=1) > 0]
    if not len(unit):
        return np.eye(1, x.shape[1])
    centre = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
    for _ in range(rounds):
        near = (unit @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, unit)
        moved, norm = _unit(total)
        centre = np.where(norm[:, None] > 1e-9, moved, centre)
    return centre


def _assigned(rows: DataFrame, centre: np.ndarray, shape: Shape) -> DataFrame:
    """id, label, anchor, packed components, nearest centroid, angle to it and norm."""
    shared = rows.sparkSession.sparkContext.broadcast(centre)  # CLUSTERS rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            x = _matrix(batch.column("q"), shape.width)
            unit, norm = _unit(x)
            cosine = unit @ c.T
            cell = cosine.argmax(axis=1) if len(x) else np.zeros(0, int)
            angle = _angle(cosine[np.arange(len(x)), cell])
            packed = [r.tobytes() for r in x.astype(shape.kind)]
            columns = [pa.array(packed, pa.binary()), pa.array(cell.astype(np.int32)), pa.array(angle), pa.array(norm)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("id", "label", "anchor")), *columns], ["id", "label", "anchor", "v", "cell", "angle", "norm"])

    return rows.select("id", "label", "anchor", "q").mapInArrow(run, "id long, label long, anchor boolean, v binary, cell int, angle double, norm double")


def _lowest(lists: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What a new entry of each list must reach."""
    return np.maximum(lists[..., -1], low)


class Walk:
    """The lists of one group of anchors, and their walk down lists of candidates.

    Each member has the same number of lists. A list takes rows of the member's label or of other labels with scores in
    [low, high]; it starts with ``floor``, a score that its last entry is known to reach.
    """

    def __init__(self, own: np.ndarray, label: np.ndarray, key: np.ndarray, same: bool, low: np.ndarray, high: np.ndarray, floor: np.ndarray, shape: Shape):
        self.own, self.label, self.key, self.same, self.shape = own, label, key, same, shape
        self.low, self.high = np.maximum(low, floor), high
        self.unit, self.norm = _unit(own.astype(float))

    def scores(self, members: np.ndarray, v: np.ndarray) -> np.ndarray:
        if self.shape.plain:
            return (self.own[members].astype(float) @ v.T.astype(float)).astype(np.int64)
        whole = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in v] for x in self.own[members]]
        return np.array([[max(_LEAST, min(_MOST, s)) for s in r] for r in whole], np.int64).reshape(len(members), len(v))

    def down(self, centre: np.ndarray, v: np.ndarray, label: np.ndarray, ids: np.ndarray, keys: np.ndarray, take: int) -> tuple[np.ndarray, ...]:
        """(member, list, score, id) of the entries; ``centre`` is the cluster's direction."""
        theta = _angle(self.unit @ centre).max(initial=0.0)
        unit, norm = _unit(v.astype(float))
        bound = norm * np.cos(np.clip(_angle(unit @ centre) - theta - _SLACK, 0.0, np.pi))
        bound = np.maximum(bound, 0.0) * (1 + _SLACK)
        order = np.argsort(-bound, kind="stable")
        m, t = self.low.shape
        top = np.full((m, t, take), _LEAST)
        rows: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 4]
        active, at, stride = np.arange(m), 0, STRIDE
        while at < len(order) and len(active):
            # Certain for a member: nothing below the bound reaches any of its lists.
            reach = bound[order[at]] * self.norm[active] + 1
            active = active[(reach[:, None] >= _lowest(top[active], self.low[active])).any(axis=1)]
            if not len(active):
                break
            # In the order of ids, so that of equal scores the first are kept.
            some = order[at : at + stride]
            some = some[np.argsort(ids[some], kind="stable")]
            at, stride = at + stride, min(2 * stride, 1024)
            score = self.scores(active, v[some])
            fits = (label[some][None, :] == self.label[active][:, None]) == self.same
            fits &= keys[some][None, :] != self.key[active][:, None]
            for k in range(t):
                ok = fits & (score <= self.high[active, k][:, None]) & (score >= _lowest(top[active, k], self.low[active, k])[:, None])
                seen = np.where(ok, score, _LEAST)
                if seen.shape[1] > take:
                    seen = np.partition(seen, seen.shape[1] - take, axis=1)[:, -take:]
                best = np.sort(np.concatenate([top[active, k], seen], axis=1), axis=1)[:, : -take - 1 : -1]
                top[active, k] = best
                tie = ok & (score == best[:, -1][:, None])
                row, col = np.nonzero((ok & (score > best[:, -1][:, None])) | (tie & (tie.cumsum(axis=1) <= take)))
                rows.append([active[row], np.full(len(row), k), score[row, col], ids[some][col]])
        member, list_, score, found = (np.concatenate(c) for c in zip(*rows, strict=True))
        order = np.lexsort((found, -score, list_, member))
        member, list_, score, found = member[order], list_[order], score[order], found[order]
        start = np.flatnonzero(np.concatenate([[True], (np.diff(member) != 0) | (np.diff(list_) != 0)])) if len(member) else np.zeros(0, int)
        place = np.arange(len(member)) - np.repeat(start, np.diff(np.append(start, len(member))))
        keep = place < take
        return member[keep], list_[keep], score[keep], found[keep]


def _unpacked(data: list[bytes], shape: Shape, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(data), shape.kind).reshape(rows, shape.width)


_ENTRY = "anchor long, list int, score long, id long"


def _cells(groups: DataFrame, centroids: Centroids, shape: Shape, home: bool) -> DataFrame:
    """g, cell: the centroids whose candidates a group must see; its own one, or all others that are not ruled out."""
    shared = groups.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            gs, cells = [], []
            for g, cell, members in zip(*(batch.column(n).to_pylist() for n in ("g", "cell", "members")), strict=True):
                if home:
                    want = [cell]
                else:
                    own = _unpacked([m["v"] for m in members], shape, len(members)).astype(float)
                    unit, norm = _unit(own)
                    need = np.array([min(max(x) for x in zip(m["low"], m["floor"], strict=True)) for m in members], float)
                    gap = _angle(unit @ c.rows.T) - c.angle[None, :] - _SLACK
                    bound = np.maximum(np.cos(np.clip(gap, 0.0, np.pi)), 0.0) * (1 + _SLACK) * c.norm[None, :] * norm[:, None] + 1
                    want = [x for x in np.flatnonzero((bound >= need[:, None]).any(axis=0)).tolist() if x != cell]
                gs += [g] * len(want)
                cells += want
            yield pa.RecordBatch.from_arrays([pa.array(gs, pa.int64()), pa.array(cells, pa.int32())], ["g", "cell"])

    return groups.select("g", "cell", "members").mapInArrow(run, "g long, cell int")


def _walked(groups: DataFrame, cells: DataFrame, blocks: DataFrame, centre: np.ndarray, shape: Shape, same: bool, take: int, slices: int) -> DataFrame:
    """anchor, list, score, id: the best of every slice for each list."""
    shared = groups.sparkSession.sparkContext.broadcast(centre)
    seen = cells.join(blocks, "cell").select("g", "slice", "ids", "keys", "labels", "data")
    asking = groups.select("g", "cell", "members", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))

    def run(group: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        columns = ["anchor", "list", "score", "id"]
        if not len(group) or not len(found):
            return pd.DataFrame({c: np.zeros(0, np.int32 if c == "list" else np.int64) for c in columns})
        members = list(group["members"].iloc[0])
        own = _unpacked([m["v"] for m in members], shape, len(members))
        low, high, floor = (np.array([list(m[c]) for m in members], np.int64) for c in ("low", "high", "floor"))
        key = np.array([m["anchor"] for m in members], np.int64)
        walk = Walk(own, np.array([m["label"] for m in members], np.int64), key, same, low, high, floor, shape)
        ids, keys, labels = (np.concatenate([np.frombuffer(x, "<i8") for x in found[c]]) for c in ("ids", "keys", "labels"))
        v = _unpacked(list(found["data"]), shape, len(ids))
        member, list_, score, hit = walk.down(shared.value[int(group["cell"].iloc[0])], v, labels, ids, keys, take)
        return pd.DataFrame({"anchor": key[member], "list": list_.astype(np.int32), "score": score, "id": hit})

    return asking.groupBy("g", "slice").cogroup(seen.groupBy("g", "slice")).applyInPandas(run, _ENTRY)


def _best(entries: DataFrame, take: int) -> DataFrame:
    """anchor, list, rank, score, id."""
    order = Window.partitionBy("anchor", "list").orderBy(F.col("score").desc(), "id")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= take)


def _lists(anchors: DataFrame, blocks: DataFrame, centroids: Centroids, shape: Shape, same: bool, take: int, slices: int) -> DataFrame:
    """anchor, list, rank, score, id: the best of every list of the anchors (g, cell, anchor, label, v, and by list: low, high)."""

    def grouped(members: DataFrame) -> DataFrame:
        return members.groupBy("g", "cell").agg(F.collect_list(F.struct("anchor", "label", "v", "low", "high", "floor")).alias("members"))

    def walked(groups: DataFrame, home: bool) -> DataFrame:
        return _walked(groups, _cells(groups, centroids, shape, home), blocks, centroids.rows, shape, same, take, slices)

    groups = written(grouped(anchors.withColumn("floor", F.transform("low", lambda _: F.lit(_LEAST)))), "mining-groups")
    first = written(_best(walked(groups, True), take), "mining-home")
    reached = first.groupBy("anchor", "list").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= take)
    reached = reached.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("list", "least"))).alias("reached"))
    floor = F.transform("low", lambda _, k: F.coalesce(F.element_at("reached", k), F.lit(_LEAST)))
    groups = written(grouped(anchors.join(reached, "anchor", "left").withColumn("floor", floor)), "mining-groups")
    return written(_best(first.drop("rank").unionByName(walked(groups, False)), take), "mining-lists")


def mine(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, scale: int = 256,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", fit_rows: int = FIT_ROWS, group: int = GROUP, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchor`` says which rows are anchors."""
    rows = clean(vectors, vec_id, vector, label, anchor, scale)
    shape, n_anchors = shape_of(rows)
    sample = rows.where("anchor").orderBy(F.xxhash64("id", "q")).limit(fit_rows).select("q").toArrow().column("q").combine_chunks()
    centre = fit_centroids(_matrix(sample, shape.width), min(CLUSTERS, 1 + n_anchors // PER_CLUSTER))
    # Rows have numbers, since ids may repeat; written, so that a lost executor can't number them anew.
    rows = written(_assigned(rows, centre, shape).withColumn("key", F.monotonically_increasing_id()), "mining-rows")
    sizes = rows.groupBy("cell").agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max("angle").alias("angle"), F.max("norm").alias("norm"))
    sizes = written(sizes, "mining-cells")
    found = sizes.collect()  # one row per centroid
    centroids = Centroids(centre, np.full(len(centre), -np.inf), np.zeros(len(centre)))
    for r in found:
        centroids.angle[r.cell], centroids.norm[r.cell] = r.angle, r.norm
    block = max(64, min(block, (1 << 20) // max(1, shape.width * int(shape.kind[2]))))
    slices = max(1, -(-sum(-(-r.n // block) for r in found) // SLICE))
    placed = rows.join(sizes.select("cell", "n", "anchors"), "cell")
    dealt = F.struct("id", "key", "label", "v")
    blocks = placed.groupBy("cell", F.expr(f"pmod(xxhash64(key), 1 + (n - 1) div {block})").alias("block")).agg(F.collect_list(dealt).alias("rows"))
    blocks = written(_packed_blocks(blocks, slices), "mining-blocks")
    anchors = placed.where("anchor").select(
        F.expr(f"cell * {1 << 32} + pmod(xxhash64(key, 1), 1 + (anchors - 1) div {group})").alias("g"), "cell", F.col("key").alias("anchor"), "id", "label", "v"
    )
    anchors = written(anchors, "mining-anchors")
    first = anchors.drop("id").withColumns({"low": F.array(F.lit(_LEAST)), "high": F.array(F.lit(_MOST))})
    near = _lists(first, blocks, centroids, shape, True, positives, slices).select("anchor", F.col("rank").alias("place"), F.col("score").alias("top"), F.col("id").alias("positive_id"))
    # A list for each positive: scores from low_percent hundredths of the positive's up to the positive's.
    least = F.expr(f"CAST(ceil(CAST(top AS DECIMAL(20,0)) * {low_percent}BD / 100BD) AS BIGINT)")
    ranges = near.select("anchor", "place", "top", least.alias("least")).where("least <= top")
    ranges = ranges.groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("lows"), F.map_from_entries(F.collect_list(F.struct("place", "top"))).alias("highs")
    )
    each = F.sequence(F.lit(1), F.lit(positives))
    low = F.transform(each, lambda k: F.coalesce(F.element_at("lows", k), F.lit(_MOST)))
    high = F.transform(each, lambda k: F.coalesce(F.element_at("highs", k), F.lit(_LEAST)))
    second = anchors.drop("id").join(ranges, "anchor").select("g", "cell", "anchor", "label", "v", low.alias("low"), high.alias("high"))
    far = _lists(second, blocks, centroids, shape, False, negatives, slices)
    return (
        far.withColumn("place", F.col("list") + 1).join(near, ["anchor", "place"])
        .join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("top").alias("positive_score"), F.col("score").alias("negative_score"))
    )


def _packed_blocks(blocks: DataFrame, slices: int) -> DataFrame:
    """cell, slice, ids, keys, labels, data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[bytes]] = [[], [], [], []]
            for rows in batch.column("rows"):
                fields = rows.values
                for store, name in zip(out, ("id", "key", "label"), strict=False):
                    store.append(fields.field(name).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                out[3].append(b"".join(fields.field("v").to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(o, pa.binary()) for o in out)], ["cell", "slice", "ids", "keys", "labels", "data"])

    named = blocks.select("cell", F.expr(f"CAST(pmod(xxhash64(cell, block), {slices}) AS INT)").alias("slice"), "rows")
    return named.mapInArrow(run, "cell int, slice int, ids binary, keys binary, labels binary, data binary")
