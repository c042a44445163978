"""The classifier's scores computed anew from its dictionaries and weights, and its accuracy on held-out documents."""

import math
import zlib

import pytest
import zstandard

from reelgauge.llm import quality_classifier, queries

SF = "/root/testdata/sf0.01"


def slow_score(text, model):
    """Bytes saved by the good dictionary over the bad one, piece by piece, through the logistic curve."""
    data = (text or "").encode()
    sizes = []
    for dictionary in (model.good, model.bad):
        compressor = zstandard.ZstdCompressor(
            level=quality_classifier.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_dict_id=False
        )
        pieces = [data[i : i + quality_classifier.PIECE] for i in range(0, len(data), quality_classifier.PIECE)]
        sizes.append(sum(len(compressor.compress(p)) for p in pieces))
    gain = (sizes[1] - sizes[0]) / (len(data) + quality_classifier.SMOOTH)
    short = quality_classifier.SMOOTH / (len(data) + quality_classifier.SMOOTH)
    a, b, c = model.weights
    return 1 / (1 + math.exp(-(a * gain + b * short + c)))


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in queries.op1_quality_classifier(spark, SF).collect()}


def test_scores_computed_anew(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_classifier.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = docs.select("doc_id", "text").collect()
    assert len(rows) == len(scored)
    for r in rows[::3]:
        assert scored[r.doc_id].score == pytest.approx(slow_score(r.text, model), abs=1e-9)
        assert scored[r.doc_id].predicted == (scored[r.doc_id].score >= 0.3)
        assert scored[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_documents(spark, scored):
    """Good documents are kept, bad ones mostly not; the rank of scores separates them."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality is not None}
    held = [(scored[i].score, y) for i, y in labels.items() if i in scored and scored[i].held_out]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert len(good) > 20 and len(bad) > 10
    area = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    kept, caught = sum(s >= 0.3 for s in good) / len(good), sum(s < 0.3 for s in bad) / len(bad)
    print(f"{len(held)} held-out labels: area {area:.3f}, good kept {kept:.3f}, bad rejected {caught:.3f}")
    assert area > 0.9 and kept > 0.9
