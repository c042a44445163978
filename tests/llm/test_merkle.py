"""The manifest against a recursive version."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reelgauge.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, **changed):
    r = {**row, **changed}
    return h("".join("-" if r[f] is None else f"{len(str(r[f]).encode())}:{r[f]}" for f in FIELDS))


def tree(nodes):
    """(top, siblings before and after by level) of a list of digests."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k - k % 8 : k - k % 8 + 8]
            ways[i].append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
        at = [k // 8 for k in at]
        nodes = [h("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)]
    return nodes[0], ways


def brute(rows, shown):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, over = tree([trees[g][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for way, (*_, own, r) in zip(trees[g][1], sorted(groups[g], key=lambda x: x[:3]), strict=True):
            folded = shown(r) or own
            for left, right in way + over[k]:
                folded = h(left + folded + right)
            out.append((r["doc_id"], g, own, trees[g][0], root, h("".join(a + b for a, b in way + over[k])), folded))
    return sorted(out, key=str)


def check(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], schema)
    for extra in ("leaf", "order", "group", "t", "pos", "part", "at", "hash"):
        docs = docs.withColumn(extra, F.lit("mine"))
    claimed = F.when(F.col("doc_id") % 3 == 0, merkle.leaf_of(docs, FIELDS, text=F.lower("text")))
    got = merkle.proofs(merkle.manifest(docs, FIELDS, "lang", "doc_id", claimed))
    have = [(r.order, r.group, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got.collect()]
    want = brute(rows, lambda r: leaf(r, text=None if r["text"] is None else r["text"].lower()) if r["doc_id"] is not None and r["doc_id"] % 3 == 0 else None)
    assert sorted(have, key=str) == want
    return have


def row(i, lang="en", text="Some Text", source="s"):
    return {"doc_id": i, "source": source, "lang": lang, "n_chars": None if text is None else len(text), "text": text}


@pytest.mark.parametrize("sizes", [[1], [2], [8], [9], [64, 1, 7], [65, 513], [3] * 9, [1] * 70 + [200]])
def test_trees_of_many_shapes(spark, sizes):
    """Lone leaves, runs of one, trees of unequal height, more groups than one run holds."""
    ids = list(range(sum(sizes)))
    random.Random(1).shuffle(ids)
    rows = [row(ids.pop(), f"g{k}", f"Text {k}") for k, n in enumerate(sizes) for _ in range(n)]
    have = check(spark, rows)
    assert any(r[6] == r[4] for r in have) or len(rows) < 3


def test_odd_rows(spark):
    rows = [row(None), row(None, None), row(1, ""), row(1, ""), row(2, "ä"), row(3, "z", None), row(3, "z", ""), row(4, "Z", "é 𝔸", None)]
    rows += [row(7, "en")] * 40 + [row(7, "en", "other")] * 3 + [row(9, "en", "Long " * 50_000)]
    check(spark, rows)
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.proofs(merkle.manifest(docs, FIELDS, "lang", "doc_id")).count() == 0


def test_untampered_rows_verify(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in merkle.proofs(merkle.manifest(docs, FIELDS, "lang", "doc_id")).collect():
        assert r.folded_root == r.root and len(r.way) >= 2
