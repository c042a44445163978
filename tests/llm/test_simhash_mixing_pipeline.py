import random
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from reelgauge.llm import components, exact_dedup, mixing, simhash
from reelgauge.llm.simhash import Rule

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, near):
    """Smallest id reachable for each id; near(a, b) says whether two fingerprints link."""
    parent = {i: i for i, _ in nodes}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, x) in enumerate(nodes):
        for j, y in nodes[:n]:
            if near(x, y):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in parent}


def test_fingerprints(words, odd_texts):
    for text in [*odd_texts, "One TWO three", "Ä b Ö", " ".join(words(300, "f"))]:
        assert simhash.fingerprint(text)[0] % (1 << 64) == brute_fingerprint(text)
    long = " ".join(words(40_000, "many"))
    assert simhash.fingerprint(long)[0] % (1 << 64) == brute_fingerprint(long)
    assert simhash.fingerprint("A b C d") == simhash.fingerprint("a  B\nc D")


def cluster(rng, size, flips, bits=64):
    centre = rng.getrandbits(bits)
    out = []
    for _ in range(size):
        x = centre
        for b in rng.sample(range(12), rng.randrange(flips + 1)):
            x ^= 1 << (5 * b)
        out.append(x)
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("radius,bucket", [(1, 4096), (2, 4096), (2, 6), (3, 4096), (3, 6), (5, 4096), (5, 9), (12, 4096), (12, 40)])
def test_links_lose_nothing(spark, radius, bucket):
    """Chains, dense clusters and loose points; small buckets make every path that serves hot buckets run."""
    rng = random.Random(radius * 100 + bucket)
    values = {rng.getrandbits(64) for _ in range(120)} | {0, (1 << 64) - 1, 3}
    for flips in (2, 4, 6):
        values |= set(cluster(rng, 60, flips))
    x = rng.getrandbits(64)
    for b in range(0, 40, radius):  # a chain whose ends are far apart
        for c in range(radius):
            x ^= 1 << ((b + c) % 64)
        values.add(x)
    nodes = list(enumerate(sorted(values), 10))
    rng.shuffle(nodes)
    frame = spark.createDataFrame([(i, signed(v), 0) for i, v in nodes], "id long, a long, b long")
    found = {r.node: r.component for r in components.components(simhash.links(frame, Rule(radius=radius), bucket)).collect()}
    want = brute_components(nodes, lambda a, b: (a ^ b).bit_count() <= radius)
    assert {i: found.get(i, i) for i, _ in nodes} == want
    assert len(set(want.values())) < len(nodes)


@pytest.mark.parametrize("bucket", [4096, 12])
def test_wide_links(spark, bucket):
    rng = random.Random(bucket)
    pairs = [(a, b) for k in range(6) for a, b in zip(cluster(rng, 40, 9), cluster(rng, 40, 11), strict=True)]
    nodes = list(enumerate(sorted(set(pairs))))
    rule = Rule(radius=4, wide=True, total=9)
    frame = spark.createDataFrame([(i, signed(a), signed(b)) for i, (a, b) in nodes], "id long, a long, b long")
    found = {r.node: r.component for r in components.components(simhash.links(frame, rule, bucket)).collect()}
    want = brute_components(nodes, lambda x, y: (d := (x[0] ^ y[0]).bit_count()) <= 4 and d + (x[1] ^ y[1]).bit_count() <= 9)
    assert {i: found.get(i, i) for i, _ in nodes} == want


def test_allocation_is_the_best():
    costs = [[0, 4, 9, 30], [0, 1, 50, 90], [0, 7, 8, 9]]
    every = [(costs[0][a + 1] + costs[1][b + 1] + costs[2][c + 1], a + b + c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3)]
    for total in range(-3, 7):
        cost, chosen = simhash.allocate(costs, total)
        assert cost == min(c for c, t in every if t == total) and sum(chosen) == total


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64))
    for a, b in ((0, 40), (5, 63), (10, 33)):
        bits[:, b] = bits[:, a]
    groups = simhash.correlated_groups((bits.T @ bits).astype(float), 4000, 4)
    assert sorted(x for g in groups for x in g) == list(range(64)) and {len(g) for g in groups} == {16}
    for a, b in ((0, 40), (5, 63), (10, 33)):
        assert any(a in g and b in g for g in groups)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 260)]
    odd = [(1, 1), (None, 2), (3, None), (300, 260), (260, 300)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(chain + star + odd, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(200, 260)]} | {300: 260, 260: 260}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_classes_of_odd_documents(spark, plain_docs, odd_texts, words):
    base = words(400, "base")
    near = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (3, 200)]
    rows = [*enumerate(odd_texts, 50), (7, " ".join(base)), *enumerate(near, 8), (7, " ".join(base)), (None, " ".join(base)), (None, "alone")]
    got = simhash.classes(plain_docs(rows).withColumn("a", F.lit(1)))
    have = [(r.doc_id, r.component_id) for r in got.collect()]
    want = {i: brute_fingerprint(t) for i, t in rows if i is not None}
    linked = brute_components(sorted(want.items()), lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(x for x in have if x[0] is not None) == sorted((i, linked[i]) for i, _ in rows if i is not None)
    assert sorted((x[1] for x in have if x[0] is None), key=str) == [7, None]
    assert simhash.classes(plain_docs([])).count() == 0


HELPERS = ["a", "b", "c0", "c1", "tag", "row", "n", "sha", "best", "keep", "group", "named", "name", "leaf0", "epochs", "cut", "copies", "copy", "_row", "_keep", "_sha", "_gone", "_copies", "_cut", "domain", "key"]


@pytest.fixture(scope="module")
def crowded(plain_docs):
    """A documents table with an extra column for every helper name, each with a value of its own."""

    def make(rows):
        docs = plain_docs(rows)
        return docs.select(*(F.lit(f"mine {h}").alias(h) for h in HELPERS[:9]), *docs.columns, *(F.lit(f"mine {h}").alias(h) for h in HELPERS[9:]))

    return make


def untouched(frame):
    return all(r[h] == f"mine {h}" for r in frame.collect() for h in HELPERS)


@pytest.mark.parametrize("bucket", [4096, 4])
def test_one_document_of_each_group_stays(crowded, words, bucket):
    """Repeated ids, null ids and repeated rows; the same id may be in two groups."""
    one, other, third = (" ".join(words(300, x)) for x in "abc")
    rows = [(5, one), (9, one.upper()), (2, other), (5, other + " "), (None, one), (None, third), (None, third), (None, third.upper()), (7, ""), (7, None), (8, " ")]
    rows += [(100 + i, other.replace(" ", "  ", i)) for i in range(12)]
    docs = crowded(rows)
    got = simhash.deduplicated(docs, bucket=bucket)
    assert got.columns == docs.columns and untouched(got)
    kept = [(r.doc_id, (r.text or "").lower().strip()) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(5, one), (2, other), (None, third), (7, "")], key=str)
    assert simhash.deduplicated(docs.limit(0)).count() == 0


def test_exact_copies_keep_ids_and_names(crowded):
    rows = [(5, "one text"), (5, "two text"), (3, "two  text"), (3, "two  text"), (5, "onetext"), (None, "x y"), (None, "x y"), (None, "xy"), (1, None), (2, "")]
    docs = crowded(rows)
    got = exact_dedup.deduplicated(docs)
    assert got.columns == docs.columns and untouched(got)
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(5, "one text"), (3, "two  text"), (None, "x y"), (1, None)], key=str)


def test_mixing_without_ids(crowded):
    """A third of a leaf has no ids; budgets are met to one document, whatever the columns are called."""
    rows = [(i if i % 3 else None, " ".join([f"w{i}"] * 10)) for i in range(2100)]
    docs = crowded(rows)
    for percent in (43, 71):
        mix = mixing.Mix(percent=percent, max_epochs=1)
        got = mixing.mixed(docs, {"part": F.lit("p")}, mix)
        assert got.columns == docs.columns and untouched(got)
        assert got.count() == 21 * percent
        assert sum(r.copies for r in mixing.copies(docs, {"part": F.lit("p")}, mix).collect()) == 21 * percent


def waterfill(budget, children):
    """children: name -> (capacity, weight); shares by repeated rounds of proportional dealing."""
    given = dict.fromkeys(children, 0)
    open_ = {n for n, (c, w) in children.items() if w > 0 and c > 0}
    left = budget
    while open_:
        total = sum(children[n][1] for n in open_)
        full = {n for n in open_ if children[n][0] * total <= left * children[n][1]}
        if not full:
            for n in open_:
                given[n] = left * children[n][1] // total
            break
        for n in full:
            given[n] = children[n][0]
            left -= children[n][0]
        open_ -= full
    return given


def brute_budgets(leaves, mix, depth=3):
    weight = lambda level, name: (mix.weights[level] if level < len(mix.weights) else {}).get(name, mix.default)

    def cap(prefix):
        level = len(prefix)
        if level == depth:
            return leaves[prefix] * mix.max_epochs if weight(level - 1, prefix[-1]) > 0 else 0
        if prefix and weight(level - 1, prefix[-1]) <= 0:
            return 0
        return sum(cap(p) for p in sorted({x[: level + 1] for x in leaves if x[:level] == prefix}))

    out = {}

    def deal(prefix, budget):
        if len(prefix) == depth:
            out[prefix] = budget
            return
        below = sorted({x[: len(prefix) + 1] for x in leaves if x[: len(prefix)] == prefix})
        for p, b in waterfill(budget, {p: (cap(p), weight(len(prefix), p[-1])) for p in below}).items():
            deal(p, b)

    deal((), min(sum(leaves.values()) * mix.percent // 100, cap(())))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_budgets(spark, seed):
    rng = random.Random(seed)
    leaves = {(rng.choice("ab"), rng.choice("xyz"), rng.choice("pqrst")): rng.choice([0, 1, 10, 1000, 7777]) for _ in range(20)}
    mix = mixing.Mix(weights=({"a": 3}, {"x": 0, "y": 5}, {"p": 9}), percent=[30, 80, 150, 400][seed], max_epochs=1 + seed % 3)
    rows = [(*k, v) for k, v in leaves.items()]
    frame = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    budgets = mixing.leaf_budgets(frame, ["domain", "lang", "source"], mix)
    got = {(r.domain, r.lang, r.source): r.budget for r in budgets.collect()}
    assert got == brute_budgets(leaves, mix)
    plan = budgets._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_prefixes_fill_the_budgets(spark, documents, words):
    rng = random.Random(2)
    rows = [(i, " ".join(words(rng.randrange(40), f"m{i}")), rng.choice(["en", "de", None]), rng.choice(["src0", "src9", "src14", "odd"]), 0) for i in range(600)]
    docs = documents(rows).withColumn("domain", F.lit("mine"))
    got = mixing.copies(docs).collect()
    assert len(got) == 600
    by = defaultdict(list)
    for r in got:
        by[r.domain, r.lang, r.source].append(r)
    biggest = max(r.n_tokens for r in got)
    for members in by.values():
        taken, budget, tokens = sum(r.n_tokens * r.copies for r in members), members[0].leaf_budget, members[0].leaf_tokens
        assert tokens == sum(r.n_tokens for r in members)
        assert budget - biggest <= taken <= budget
        assert len({r.copies for r in members}) <= 2
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in got)
    again = {r.doc_id: r.copies for r in mixing.copies(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in got}
    other = {r.doc_id: r.copies for r in mixing.copies(docs, mix=mixing.Mix(weights=mixing.MIX.weights, seed=8)).collect()}
    assert other != again
    assert mixing.copies(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_stages_keep_to_the_contract(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_duplicates", "near_duplicates", "mix", "tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        have = [r.doc_id for r in out.collect()]
        assert len(have) == len(set(have)) and set(have) < ids, name
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_against_brute_force(spark):
    """The whole run against single-machine versions of the stages that have one."""
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in corpus_pipeline.quality(spark, docs, SF).collect()}
    groups = defaultdict(list)
    for i, t in rows.items():
        groups["".join(c for c in t if c not in " \t\n\x0b\x0c\r")].append((-len(t), i))
    rows = {min(g)[1]: rows[min(g)[1]] for g in groups.values()}
    prints = [(i, brute_fingerprint(t)) for i, t in sorted(rows.items())]
    near = brute_components(prints, lambda x, y: (x ^ y).bit_count() <= 2)
    left = {i for i, c in near.items() if i == c}
    kept = docs.where(F.col("doc_id").isin(list(left)))
    want = {r.doc_id for r in mixing.copies(kept, mix=corpus_pipeline.MIX).collect() if r.copies}
    assert set(got) == want
    from tokenizers import Tokenizer
    import public_tokenizers

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in got.items():
        assert bytes(r.ids) == np.array(reference.encode(rows[i], add_special_tokens=False).ids, "<u4").tobytes()


def test_oracle_of_every_text_query(spark):
    from reelgauge.llm.oracle import ORACLE
    from reelgauge.llm.queries import QUERIES

    base = duckdb.connect()
    for table in ("documents", "pages", "labels", "conversations", "embeddings"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, SF)
        theirs = base.execute(sql)
        columns = [c[0] for c in theirs.description]
        assert sorted(columns) == sorted(df.columns), name
        mine = sorted(map(repr, (tuple(r[c] for c in sorted(columns)) for r in df.collect())))
        order = sorted(range(len(columns)), key=columns.__getitem__)
        assert mine == sorted(repr(tuple(r[i] for i in order)) for r in theirs.fetchall()), name


def test_the_rest_stands_without_this_folder():
    root = Path(corpus_pipeline.__file__).parent
    for source in [*(root / "reelgauge").glob("*.py"), *(p for d in ("functions", "operators", "plans", "sources", "streaming") for p in (root / "reelgauge" / d).glob("*.py"))]:
        assert "llm" not in source.read_text(), source
