"""Near duplicates: SimHash fingerprints linked by a generalised pigeonhole search.

Fingerprints. A text is lower-cased (A-Z), cut into words and shingles, and each bit says whether more than half of
the shingles' hashes have it. 64-bit fingerprints use XXH64 (seed 42). Wide ones have 128 bits (XXH3), of
which the first half finds candidates and both are compared.

Search. ``bits`` are grouped so that correlated bits share a group (correlations are counted over all distinct
fingerprints). If two fingerprints differ in at most r bits and the groups have thresholds t_1..t_m with
sum(t) = r - m + 1, then in some group they differ in at most t_i bits; t_i = -1 leaves a group out. For every m the
best thresholds are found by dynamic programming over estimated costs: rows to shuffle for probing, and candidates to
compare. Candidates are estimated from sketches of every group's values over all distinct fingerprints, carried to
higher thresholds by the bits' odds of agreeing. The cheapest m wins.

Probe and verify. Fingerprints are gathered by (group, value). Within a bucket all are compared in arrays, and only
the spanning links leave it, so a dense bucket sends one row per member. Groups with t >= 1 probe the values nearby: a
probing fingerprint is compared with the whole bucket, and sends one link for each part of it that it touches.

Hot buckets (more than BUCKET members) would be one task. They have leaders instead, about LEADERS members chosen by hash:
members linked to the leaders' main part are connected already and need only be compared with members that are not,
while these are compared with all, in blocks. So a cluster of near copies costs what its size is, and no link is lost.

Copies with one fingerprint are one node from the start, so groups of exact copies never meet pairwise. Nodes are
fingerprints and never ids, so repeated and null ids join nothing that the texts do not join.

Cases: null texts are empty, and texts without words have fingerprint 0 and link like any other; ids may be null or repeat
(each row gets the result of its fingerprint); a component's id is the smallest of its rows', null if none has one; an
empty table gives an empty result; other columns, whatever their names, pass ``deduplicated`` untouched. It keeps one row of
each component: one with the component's id; of several such rows the one whose digest of id and text is smallest, and
of rows equal in both any one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.components import components
from reelgauge.llm.pieces import portions
from reelgauge.llm.tables import numbered, place, row_tag, without, written

BITS = 64
BUCKET = 4096
LEADERS = 64
#: Microseconds to shuffle one probing row, and to compare one candidate.
ROW_COST, PAIR_COST = 1.0, 0.006
_SKETCH = 256


@dataclass(frozen=True)
class Rule:
    """``words`` per shingle; links at ``radius`` bits of 64; if ``wide``, at ``total`` of 128 bits as well."""

    words: int = 3
    radius: int = 2
    wide: bool = False
    total: int = 128


#: The contract's rule.
EXACT = Rule()


def _shingled(text: str | None, rule: Rule) -> Iterator[np.ndarray]:
    """Hashes of the text's shingles, one row of 8 or 16 bytes each; long texts piece by piece."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    k = min(rule.words, len(words))
    n = len(words) - k + 1 if words else 0
    for i in range(0, n, 1 << 15):
        part = words[i : min(n, i + (1 << 15)) + k - 1]
        shingles = [b" ".join(s) for s in zip(*(part[j:] for j in range(k)), strict=False)]
        if rule.wide:
            data = np.frombuffer(b"".join([xxhash.xxh3_128_digest(s) for s in shingles]), np.uint8)
        else:
            data = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], "<u8").view(np.uint8)
        yield data.reshape(len(shingles), -1)


def _majority(pieces: list[np.ndarray] | Iterator[np.ndarray], rule: Rule) -> tuple[int, int]:
    ones, n = np.zeros(128 if rule.wide else BITS, np.int64), 0
    for data in pieces:
        ones += np.unpackbits(data, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(data)
    if not n:
        return 0, 0
    halves = np.packbits(2 * ones > n, bitorder="little").view("<i8").tolist()
    return halves[0], halves[1] if rule.wide else 0


def fingerprint(text: str | None, rule: Rule = EXACT) -> tuple[int, int]:
    """Two signed 64-bit halves; the second is 0 unless the rule is wide."""
    return _majority(_shingled(text, rule), rule)


def fingerprints(docs: DataFrame, rule: Rule = EXACT, text: str = "text", doc_id: str = "doc_id", tagged: bool = False) -> DataFrame:
    """doc_id, a, b of every row; if ``tagged``, the row's tag as well."""
    rows = numbered(docs)
    name, whole_text = place(docs, doc_id).cast("long"), place(docs, text)
    tag = row_tag(name, whole_text) if tagged else F.lit(None).cast("binary")
    rows = rows.select(name.alias("doc_id"), tag.alias("tag"), whole_text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in portions(whole, 2)):
            pairs = [fingerprint(t, rule) for t in batch.column(2).to_pylist()]
            halves = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *halves], ["doc_id", "tag", "a", "b"])

    found = rows.mapInArrow(run, "doc_id long, tag binary, a long, b long")
    return found if tagged else found.drop("tag")


def _bits(values: np.ndarray) -> np.ndarray:
    """One row of 64 bits per value, bit 0 first."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_groups(ones: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m groups of bits: each begins with the most correlated bit left and takes those most correlated with it.

    ``ones[i, j]`` counts fingerprints with both bits, of n.
    """
    p = np.diag(ones) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    r = np.abs(ones / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(r, 0)
    left, groups = list(range(BITS)), []
    for k in range(m):
        size = -(-len(left) // (m - k))
        group = [max(left, key=lambda b: (r[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (r[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def values_of(fingerprint_: np.ndarray, group: list[int]) -> np.ndarray:
    """The group's bits of each fingerprint, as a number."""
    bits, out = fingerprint_.astype(np.int64).view(np.uint64), np.zeros(len(fingerprint_), np.int64)
    for place, bit in enumerate(group):
        out |= ((bits >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return out


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with the given sum and the least cost; costs[i][t + 1] is group i's cost at t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t in range(-1, len(row) - 1):
                offer = (cost + row[t + 1], [*chosen, t])
                if done + t not in step or offer < step[done + t]:
                    step[done + t] = offer
        best = step
    return best[total]


@dataclass(frozen=True)
class Plan:
    groups: list[list[int]]
    thresholds: list[int]


def make_plan(nodes: DataFrame, radius: int, most: int = 8) -> Plan:
    """Groups and thresholds for all distinct fingerprints. What comes to the driver has a fixed size."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = _bits(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            for i in range(0, len(x), 1 << 16):
                total += (x[i : i + (1 << 16)].T @ x[i : i + (1 << 16)]).astype(np.float64)
            n += len(x)
        cells = np.append(total.reshape(-1), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    cells = {r[0]: r[1] for r in nodes.select("a").mapInArrow(pairs, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()}
    n = cells.get(BITS * BITS, 0)
    ones = np.array([cells.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)
    options = {m: correlated_groups(ones, n, m) for m in range(2, min(most, radius + 1) + 1)} | {radius + 1: correlated_groups(ones, n, radius + 1)}
    flat = [g for m in sorted(options) for g in options[m]]

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(flat), _SKETCH))
        for batch in batches:
            a = batch.column(0).to_numpy(zero_copy_only=False)
            for k, group in enumerate(flat):
                h = values_of(a, group).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                sign = 1.0 - 2.0 * ((h >> np.uint64(20)) & np.uint64(1)).astype(float)
                total[k] += np.bincount((h >> np.uint64(56)).astype(np.int64), weights=sign, minlength=_SKETCH)
        out = total.reshape(-1).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(out)], ["cell", "n"])

    sums = {r[0]: r[1] for r in nodes.select("a").mapInArrow(sketches, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()}
    same = [max(float(n), sum(float(sums.get(k * _SKETCH + j, 0)) ** 2 for j in range(_SKETCH))) for k in range(len(flat))]
    p = np.diag(ones) / max(n, 1)
    agree = np.clip(p * p + (1 - p) * (1 - p), 1e-9, 1 - 1e-9)
    plans, at = [], 0
    for m in sorted(options):
        costs = []
        for group in options[m]:
            # Pairs that agree but for k bits: those that agree on all, times the odds of k disagreements.
            odds = np.zeros(radius + 2)
            odds[0] = 1.0
            for bit in group:
                odds[1:] = odds[1:] + odds[:-1] * (1 - agree[bit]) / agree[bit]
            row, probes, ways = [0.0], 0.0, 1.0
            for t in range(radius + 1):
                probes += ways
                ways = ways * (len(group) - t) / (t + 1)
                row.append(n * (1 + (probes - 1) / 2) * ROW_COST + same[at] * float(odds[: t + 1].sum()) * PAIR_COST)
            costs.append(row)
            at += 1
        cost, thresholds = allocate(costs, radius - m + 1)
        plans.append((cost, m, Plan(options[m], thresholds)))
    return min(plans, key=lambda x: x[:2])[2]


def _near(a: np.ndarray, b: np.ndarray, a2: np.ndarray, b2: np.ndarray, rule: Rule) -> np.ndarray:
    """Matrix of links between two lists of fingerprints."""
    first = np.bitwise_count(a[:, None] ^ a2[None, :])
    if not rule.wide:
        return first <= rule.radius
    return (first <= rule.radius) & (first + np.bitwise_count(b[:, None] ^ b2[None, :]) <= rule.total)


def parts_of(a: np.ndarray, b: np.ndarray, rule: Rule) -> np.ndarray:
    """The connected part of each member of a bucket, as the place of its first member."""
    n = len(a)
    label = np.arange(n)
    # Rows of the matrix, some at a time; labels shrink by union with the smallest label that a row touches.
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    step = max(1, (1 << 20) // max(n, 1))
    for i in range(0, n, step):
        link = _near(a[i : i + step], b[i : i + step], a, b, rule)
        for r in range(len(link)):
            if link[r].sum() > 1:
                mine = i + r
                touched = np.flatnonzero(link[r])
                low = min({root(mine), *map(root, np.unique(label[touched]).tolist())})
                for x in {root(mine), *map(root, np.unique(label[touched]).tolist())}:
                    parent[x] = low
                label[touched] = low
                label[mine] = low
    return np.array([root(x) for x in label.tolist()], np.int64) if n else label


def _lists(batch: pa.RecordBatch, name: str, at: int, kind=np.uint64) -> np.ndarray:
    return np.array(batch.column(name)[at].as_py(), np.int64).view(kind)


_BUCKET = "part int, value long, block int, size int, bucket binary"
_LINK = "u long, v long"
_PACK = "part int, value long, block int, id array<long>, a array<long>, b array<long>"


def _opened(bucket: bytes) -> np.ndarray:
    """Rows of a packed bucket: ids, first halves, second halves, and the first member of each one's part."""
    return np.frombuffer(bucket, "<i8").reshape(4, -1)


def _members(rows: DataFrame) -> DataFrame:
    """Buckets as arrays of their members. Groups are bounded: hot values come in blocks."""
    grouped = rows.groupBy("part", "value", "block").agg(F.collect_list(F.struct("id", "a", "b")).alias("members"))
    return grouped.select("part", "value", "block", *(F.col(f"members.{c}").alias(c) for c in ("id", "a", "b")))


def _spanning(rows: DataFrame, rule: Rule) -> DataFrame:
    """A link from every member of a bucket to the first of its part, in one pass over buckets that nobody else asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for at in range(batch.num_rows):
                ids, a, b = (_lists(batch, c, at) for c in ("id", "a", "b"))
                us.append(ids.view(np.int64))
                vs.append(ids.view(np.int64)[parts_of(a, b, rule)])
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], ["u", "v"])

    return _members(rows).where(F.size("id") > 1).select("id", "a", "b").mapInArrow(run, _LINK)


def _gathered(rows: DataFrame, rule: Rule) -> DataFrame:
    """Buckets with the part of each member, packed."""
    arrays = _members(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, sizes = [], []
            for at in range(batch.num_rows):
                ids, a, b = (_lists(batch, c, at) for c in ("id", "a", "b"))
                label = parts_of(a, b, rule) if len(a) > 1 else np.zeros(len(a), np.int64)
                packed.append(np.stack([ids.view(np.int64), a.view(np.int64), b.view(np.int64), label]).astype("<i8").tobytes())
                sizes.append(len(ids))
            out = [*batch.columns[:3], pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["part", "value", "block", "size", "bucket"])

    return arrays.mapInArrow(run, _BUCKET)


def _inner_links(buckets: DataFrame) -> DataFrame:
    """A link from every member to the first of its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for data in batch.column(0).to_pylist():
                ids, _, _, label = _opened(data)
                us.append(ids)
                vs.append(ids[label])
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], ["u", "v"])

    return buckets.where("size > 1").select("bucket").mapInArrow(run, _LINK)


def _packs(part: np.ndarray, value: np.ndarray, block: np.ndarray, ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Rows that ask the same bucket as one row with lists."""
    order = np.lexsort((block, value, part))
    keys = [k[order] for k in (part, value, block)]
    first = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([np.diff(k) != 0 for k in keys])]))
    ends = pa.array(np.append(first, len(order)), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(c[order])) for c in (ids, a, b)]
    return pa.RecordBatch.from_arrays([*(pa.array(k[first]) for k in keys), *lists], ["part", "value", "block", "id", "a", "b"])


def _packed(rows: DataFrame) -> DataFrame:
    """Rows (part, value, block, id, a, b) packed within each Arrow batch, so that a bucket meets lists and not single rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _packs(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))

    return rows.select("part", "value", "block", "id", "a", "b").mapInArrow(run, _PACK)


def _probe(asks: DataFrame, buckets: DataFrame, rule: Rule) -> DataFrame:
    """Links of packed rows with the buckets of the same value: one for each row and part it touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "value", "block")]
            q = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("id", "a", "b")}
            ends = np.append(0, np.cumsum(batch.column("id").value_lengths().to_numpy(zero_copy_only=False)))
            change = np.logical_or.reduce([np.diff(k) != 0 for k in keys])
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for at, to in zip(edges[:-1], edges[1:], strict=True):
                ids, a2, b2, label = _opened(batch.column("bucket")[at].as_py())
                order = np.argsort(label, kind="stable")
                first = ids[label[order]]
                starts = np.flatnonzero(np.concatenate([[True], np.diff(label[order]) != 0]))
                a2, b2 = a2[order].view(np.uint64), b2[order].view(np.uint64)
                lo, hi, step = int(ends[at]), int(ends[to]), max(1, (1 << 20) // len(ids))
                for i in range(lo, hi, step):
                    j = min(hi, i + step)
                    link = _near(q["a"][i:j].view(np.uint64), q["b"][i:j].view(np.uint64), a2, b2, rule)
                    hit = np.flatnonzero(link.any(axis=1))
                    if len(hit):
                        row, part = np.nonzero(np.logical_or.reduceat(link[hit], starts, axis=1))
                        us.append(q["id"][i:j][hit][row])
                        vs.append(first[starts][part])
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], ["u", "v"])

    return asks.join(buckets, ["part", "value", "block"]).select("part", "value", "block", "id", "a", "b", "bucket").mapInArrow(run, _LINK)


def _placed(nodes: DataFrame, plan: Plan) -> DataFrame:
    """part, value, id, a, b: every group's own value."""
    used = [(k, g) for k, (g, t) in enumerate(zip(plan.groups, plan.thresholds, strict=True)) if t >= 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for k, group in used:
                columns = [np.full(len(ids), k, np.int32), values_of(a, group), ids, a, b]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "value", "id", "a", "b"])

    return nodes.select("id", "a", "b").mapInArrow(run, "part int, value long, id long, a long, b long")


def _asking(nodes: DataFrame, plan: Plan) -> DataFrame:
    """Packed rows (block 0) that ask for the larger values within each group's threshold.

    Of two values that differ, the smaller one probes the larger one, so each pair of buckets meets once.
    """
    used = [(k, g, t) for k, (g, t) in enumerate(zip(plan.groups, plan.thresholds, strict=True)) if t >= 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for k, group, t in used:
                value = values_of(a, group)
                flips = [sum(1 << p for p in c) for size in range(1, t + 1) for c in combinations(range(len(group)), size)]
                for i in range(0, len(flips), 16):
                    near = value[:, None] ^ np.array(flips[i : i + 16], np.int64)[None, :]
                    row, col = np.nonzero(near > value[:, None])
                    if len(row):
                        yield _packs(np.full(len(row), k, np.int32), near[row, col], np.zeros(len(row), np.int32), ids[row], a[row], b[row])

    return nodes.select("id", "a", "b").mapInArrow(run, _PACK)


def _hot_links(members: DataFrame, queries: DataFrame, hot: DataFrame, rule: Rule, bucket: int) -> DataFrame:
    """All links of hot buckets' members and of those who probe them (packed), through leaders and blocks."""
    keys = ["part", "value"]
    members = members.join(hot, keys)
    chosen = members.where(F.pmod(F.xxhash64("id", F.lit(1)), F.expr(f"greatest(1L, n div {LEADERS})")) == 0)

    def main_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for at in range(batch.num_rows):
                rows = batch.column("members")[at].as_py()
                ids, a, b = (np.array([r[c] for r in rows], np.int64) for c in ("id", "a", "b"))
                label = parts_of(a.view(np.uint64), b.view(np.uint64), rule)
                mine = label == np.bincount(label).argmax()
                for store, column in zip(out, (ids, a, b), strict=True):
                    store.append(column[mine].tolist())
            kinds = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("value"), *(pa.array(o, kinds) for o in out)], ["part", "value", "lid", "la", "lb"]
            )

    leaders = (
        chosen.groupBy(*keys).agg(F.collect_list(F.struct("id", "a", "b")).alias("members"))
        .mapInArrow(main_part, "part int, value long, lid array<long>, la array<long>, lb array<long>")
    )

    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the leader that a row links to, or null."""
        for batch in batches:
            found = []
            for at in range(batch.num_rows):
                a, b = (np.array([batch.column(c)[at].as_py()], np.int64).view(np.uint64) for c in ("a", "b"))
                link = np.flatnonzero(_near(a, b, _lists(batch, "la", at), _lists(batch, "lb", at), rule)[0])
                found.append(batch.column("lid")[at][int(link[0])].as_py() if len(link) else None)
            names = ["part", "value", "id", "a", "b", "n"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.int64())], [*names, "leader"])

    def tagged(rows: DataFrame) -> DataFrame:
        # A hot value's rows are split by adaptive execution; the leaders are one row per value.
        return rows.join(leaders, keys, "left").mapInArrow(covered, "part int, value long, id long, a long, b long, n long, leader long")

    own = written(tagged(members), "simhash-hot")
    asks = tagged(queries.join(hot, keys).select(*keys, "n", F.inline(F.arrays_zip("id", "a", "b"))))
    loose = own.where("leader IS NULL").groupBy(*keys).agg(F.count("*").alias("n_loose"))
    all_ = own.withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.expr(f"1 + n div {bucket}")).cast("int"))
    rest = own.where("leader IS NULL").join(loose, keys)
    rest = rest.withColumn("block", (-1 - F.pmod(F.xxhash64("id", F.lit(2)), F.expr(f"1 + n_loose div {bucket}"))).cast("int"))
    blocks = _gathered(all_.select(*keys, "block", "id", "a", "b").unionByName(rest.select(*keys, "block", "id", "a", "b")), rule)
    both = own.unionByName(asks).join(loose, keys, "left")
    # Connected rows ask the blocks of loose members (numbered below 0), loose rows all blocks.
    span = F.expr(
        f"CASE WHEN leader IS NOT NULL THEN CASE WHEN n_loose IS NULL THEN array() ELSE sequence(-1 - int(n_loose div {bucket}), -1) END"
        f" ELSE sequence(0, int(n div {bucket})) END"
    )
    asked = both.withColumn("block", F.explode(span.cast("array<int>"))).select(*keys, "block", "id", "a", "b")
    to_leader = own.unionByName(asks).where("leader IS NOT NULL AND leader <> id").select(F.col("id").alias("u"), F.col("leader").alias("v"))
    return to_leader.unionByName(_probe(_packed(asked), blocks, rule)).unionByName(_leader_links(leaders))


def _leader_links(leaders: DataFrame) -> DataFrame:
    """The leaders' main part is connected."""
    return leaders.select(F.explode("lid").alias("u"), F.expr("lid[0]").alias("v")).where("u <> v")


def links(nodes: DataFrame, rule: Rule, bucket: int = BUCKET) -> DataFrame:
    """id, a, b (distinct fingerprints) -> u, v: links whose components are those of all pairs within the rule."""
    plan = make_plan(nodes, rule.radius)
    own = _placed(nodes, plan)
    sizes = own.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > bucket)
    hot = written(sizes, "simhash-sizes")
    reach = any(t > 0 for t in plan.thresholds)
    asks = _asking(nodes, plan)
    found = None
    cold, cold_asks = own, asks
    if not hot.isEmpty():
        found = _hot_links(own, asks, hot, rule, bucket)
        cold, cold_asks = (rows.join(hot, ["part", "value"], "left_anti") for rows in (own, asks))
    cold = cold.withColumn("block", F.lit(0))
    if not reach:
        inner = _spanning(cold, rule)
        return inner if found is None else found.unionByName(inner)
    buckets = written(_gathered(cold, rule), "simhash-buckets")
    inner = _inner_links(buckets)
    found = inner if found is None else found.unionByName(inner)
    return found.unionByName(_probe(cold_asks, buckets, rule))


def _grouped(rows: DataFrame, rule: Rule, bucket: int) -> DataFrame:
    """doc_id, a, b, ... -> the same with ``group`` (a number of the component) and ``component_id``."""
    nodes = rows.groupBy("a", "b").agg(F.min("doc_id").alias("least"))
    # Written, so that a lost executor can't number the nodes anew.
    nodes = written(nodes.withColumn("id", F.monotonically_increasing_id()), "simhash-nodes")
    found = components(links(nodes.select("id", "a", "b"), rule, bucket))
    named = nodes.join(found, nodes["id"] == found["node"], "left").withColumn("group", F.coalesce("component", "id"))
    names = named.groupBy("group").agg(F.min("least").alias("component_id"))
    return rows.join(named.select("a", "b", "group").join(names, "group"), ["a", "b"], "left")


def classes(docs: DataFrame, rule: Rule = EXACT, text: str = "text", doc_id: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """doc_id, a, b, component_id of every row."""
    rows = written(fingerprints(docs, rule, text, doc_id), "simhash-rows")
    return _grouped(rows, rule, bucket).select("doc_id", "a", "b", "component_id")


def deduplicated(docs: DataFrame, rule: Rule = EXACT, text: str = "text", doc_id: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """One row of every component, with all its columns."""
    rows = written(fingerprints(docs, rule, text, doc_id, tagged=True), "simhash-rows")
    rows = written(_grouped(rows, rule, bucket).select("doc_id", "tag", "group", "component_id"), "simhash-groups")
    named = F.col("doc_id").eqNullSafe(F.col("component_id"))
    several = rows.where(named).groupBy("group").agg(F.count("*").alias("n"), F.min("tag").alias("keep")).where("n > 1")
    tied = written(rows.where(named).join(several, "group").groupBy("tag", "keep").agg(F.count("*").alias("n")), "simhash-ties")
    gone = rows.where(~named).select("tag").unionByName(tied.where("tag <> keep").select("tag")).distinct()
    return without(docs, row_tag(place(docs, doc_id).cast("long"), place(docs, text)), gone, tied.where("tag = keep AND n > 1").select("tag"))
