import math
import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from reelgauge.operators import ordered, ranking


def nearest(values, p):
    values = sorted(values)
    return values[round((len(values) - 1) * p)]


def skewed(spark, n=4000, seed=3):
    """A third and more of the rows in one group, a null group, repeated values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
        value = rng.choice([float(rng.randint(-5, 5)), rng.lognormvariate(3, 4), -rng.lognormvariate(1, 2), 0.0])
        rows.append((key, i, value))
    return rows, spark.createDataFrame(rows, "k string, t bigint, v double")


@pytest.mark.parametrize("few", [False, True])
def test_nearest_rank_equals_sorting(spark, few):
    rows, df = skewed(spark)
    got = {r.k: r for r in ranking.nearest_rank(df, "v", ["k"], {"p0": 0, "p50": 0.5, "p95": 0.95, "p100": 1}, few_values=few).collect()}
    groups = {k: [v for g, _, v in rows if g == k] for k in ("hot", "a", "b", None)}
    assert set(got) == set(groups)
    for k, values in groups.items():
        assert [got[k].p0, got[k].p50, got[k].p95, got[k].p100] == [nearest(values, p) for p in (0, 0.5, 0.95, 1)]


def test_values_in_a_narrow_range_are_cut_again(spark, plan):
    """Seconds of one day lie in one logarithmic block; the ranges inside it share the ordering."""
    df = spark.range(1_700_000_000, 1_700_086_400).select(F.lit("day").alias("k"), F.col("id").alias("v"))
    got = ranking.nearest_rank(df, "v", ["k"], {"p50": 0.5, "p99": 0.99})
    assert tuple(got.first()) == ("day", 1_700_000_000 + nearest_place(86_400, 0.5), 1_700_000_000 + nearest_place(86_400, 0.99))
    ordered_by = [line for line in plan(got).splitlines() if "Window [" in line and "_value" in line]
    assert ordered_by and all("_fine" in line for line in ordered_by)


def nearest_place(n, p):
    return nearest(range(n), p)


def test_hot_group_is_never_ordered_in_one_task(spark, plan):
    _, df = skewed(spark, 100)
    for few in (False, True):
        text = plan(ranking.nearest_rank(df, "v", ["k"], {"p90": 0.9}, few_values=few))
        windows = [line for line in text.splitlines() if "Window [" in line]
        assert windows and all("_block" in line for line in windows)
        assert "Generate explode" in text


def test_half_to_even_and_empty_groups(spark):
    df = spark.createDataFrame([("a", i) for i in range(4)] + [("n", None)], "k string, v int")
    assert ranking.nearest_rank(df, "v", ["k"], {"p": 0.5}).collect() == [("a", 2)]  # 1.5 -> 2
    six = spark.createDataFrame([("a", i) for i in range(6)], "k string, v int")
    assert ranking.nearest_rank(six, "v", ["k"], {"p": 0.5}).first().p == 2  # 2.5 -> 2
    filled = ranking.nearest_rank(df, "v", ["k"], {"p": 0.5}, empty_zero=True)
    assert sorted(map(tuple, filled.collect())) == [("a", 2), ("n", 0)]
    assert ranking.nearest_rank(df.where("v > 99"), "v", [], {"p": 0.5}, empty_zero=True).first().p == 0


@pytest.mark.parametrize("few", [False, True])
def test_extreme_values_keep_their_order(spark, few):
    values = [float("inf"), -float("inf"), 5e-324, -5e-324, 1.7e308, 0.0, -1.0, 1.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranks = {f"r{i}": (lambda n, i=i: F.lit(i).cast("bigint")) for i in range(len(values))}
    got = list(ranking.values_at(df, "v", [], ranks, few).first())
    assert got[:-1] == sorted(v for v in values if not math.isnan(v)) and math.isnan(got[-1])


def test_median_and_weights(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 10), ("b", 4), ("b", 7)], "k string, v int")
    assert dict(map(tuple, ranking.median(df, "v", ["k"]).collect())) == {"a": 2.0, "b": 5.5}
    heavy = spark.createDataFrame([(1, 1), (9, 5)], "v int, w bigint")
    assert ranking.nearest_rank(heavy, "v", [], {"p": 0.5}, few_values=True, weight="w").first().p == 9


def with_block(df, width):
    return df.withColumn("b", F.floor(F.col("t") / width).cast("bigint"))


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_running_sum_and_index_equal_one_scan(spark, width):
    rows, df = skewed(spark, 600)
    counted = with_block(df.withColumn("n", F.pmod("t", F.lit(5))), width)
    got = ordered.running_sum(counted, "n", ["k"], "b", ["t"], "total")
    got = ordered.row_index(got, ["k"], "b", ["t"])
    result = {(r.k, r.t): (r.total, r.row_index) for r in got.collect()}
    for k in ("hot", "a", "b", None):
        times = sorted(t for g, t, _ in rows if g == k)
        totals = list(accumulate(t % 5 for t in times))
        assert [result[k, t] for t in times] == list(zip(totals, range(len(times))))
    assert len(result) == len(rows)


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_carry_forward_and_previous_value(spark, width):
    rows, df = skewed(spark, 600)
    marked = df.withColumn("mark", F.when(F.col("t") % 11 == 0, F.col("t")))
    filled = {(r.k, r.t): r.mark for r in ordered.carry_forward(with_block(marked, width), ["mark"], ["k"], "b", ["t"]).collect()}
    before = {(r.k, r.t): r.p for r in ordered.previous_value(with_block(df, width), "v", ["k"], "b", ["t"], "p").collect()}
    for k in ("hot", "a", "b", None):
        series = sorted((t, v) for g, t, v in rows if g == k)
        last = None
        for i, (t, _) in enumerate(series):
            last = t if t % 11 == 0 else last
            assert filled[k, t] == last
            assert (before[k, t].value if before[k, t] else None) == (series[i - 1][1] if i else None)


def test_hot_series_is_spread_over_blocks(spark, plan):
    _, df = skewed(spark, 100)
    text = plan(ordered.running_sum(with_block(df, 7), "t", ["k"], "b", ["t"], "total"))
    assert "Join" not in text
    main = text.split("Union")[0]
    assert main.count("Exchange") == 1 and ", b#" in main[main.index("Exchange"):]


def test_percentiles_of_sets_match_brute_force(spark):
    rng = random.Random(8)
    rows = [(rng.choice("aaab"), rng.randrange(40), rng.choice([None, rng.randrange(-50, 10**6)]), 10**9 + rng.randrange(3000)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "hot string, cold int, x bigint, y bigint").repartition(5)
    got = ranking.ranks_by_sets(df, ["x", "y"], ["hot", "cold"], {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    want = {}
    for place, label in ((0, lambda r: r[0]), (1, lambda r: str(r[1])), (-1, lambda r: "all")):
        for name, i in (("x", 2), ("y", 3)):
            groups = {}
            for r in rows:
                if r[i] is not None:
                    groups.setdefault(label(r), []).append(r[i])
            for key, values in groups.items():
                values.sort()
                want[place, key, name] = tuple(values[round((len(values) - 1) * p)] for p in (0.25, 0.5, 0.75))
    assert {(r.set, r.label, r.measure): (r.p25, r.p50, r.p75) for r in got.collect()} == want


def test_global_position_is_a_total_order(spark):
    ids = list(range(500))
    random.Random(5).shuffle(ids)
    df = spark.createDataFrame([(f"p{i:04d}",) for i in ids], "path string").repartition(7)
    placed = ordered.global_position(df, ["path"])
    assert sorted(map(tuple, placed.collect())) == [(f"p{i:04d}", i) for i in range(500)]


def test_checkpoints_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    ordered.global_position(spark.range(10), ["id"]).count()
    assert spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(named)


def test_attach_needs_a_key(spark):
    with pytest.raises(ValueError):
        ordered.attach(spark.range(1), spark.range(1), [])
