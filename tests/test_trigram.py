import random

import pytest
from pyspark.sql import functions as F

from reelgauge.operators import gallery
from reelgauge.sources import trigram

FIELDS = ("id", "source_video")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(5)
    letters = "aAbB1ßÄ日"
    rows = [
        (i, "".join(rng.choice(letters) for _ in range(rng.randrange(12))) if i % 11 else None, rng.choice(["/in/a.mp4", "/IN/ab.mp4", "", None, "/x/Ää"]))
        for i in range(400)
    ]
    rows += rows[:3]  # repeated rows stay repeated
    items = spark.createDataFrame(rows, "n int, id string, source_video string").withColumn("duration_span", F.array("n"))
    path = str(tmp_path_factory.mktemp("trigram") / "index")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(trigram, "PER_PART", 37)
        trigram.write_search_index(items, path, FIELDS, ["source_video", "n", "id"])
    return items, path


@pytest.mark.parametrize("query", ["", "  ", "a", "ab", "aab", "ABb", ".mp4", " /in/AB ", "ßä日", "zzz", "abzz", "/x/ää", "b1b"])
def test_searches_equal_the_scan(spark, stored, query, monkeypatch):
    monkeypatch.setattr(trigram, "PER_PART", 37)
    items, path = stored
    got, want = trigram.search(spark, path, query, FIELDS), gallery.gallery_search(items, query)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_search_opens_few_postings(spark, stored):
    """Every posting read belongs to one of the rarest pieces, and candidates are few."""
    items, path = stored
    query = next(r.id for r in items.collect() if r.id and len(r.id) > 8).lower()
    pieces = trigram.rarest_pieces(spark, path, query)
    assert len(pieces) == trigram.RAREST and all(p in query for p in pieces)
    ranks = trigram.candidate_ranks(spark, path, query)
    assert ranks.count() <= 3
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "PushedFilters: [In(piece" in plan
    assert trigram.rarest_pieces(spark, path, "qqq") is None


def test_an_empty_table_has_no_hits(spark, tmp_path):
    items = spark.createDataFrame([], "id string, source_video string")
    trigram.write_search_index(items, str(tmp_path / "i"), FIELDS, ["id"])
    assert trigram.search(spark, str(tmp_path / "i"), "abc", FIELDS).isEmpty()
