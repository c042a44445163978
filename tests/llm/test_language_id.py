"""Language identification: features and scores against a slow version, and held-out accuracy."""

import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgauge.llm import language_id, queries


def slow_features(text):
    """Letters, pairs and triples of lower-case letters and marks, as text."""
    out, run = Counter(), "\0"
    for c in (text or "").lower().replace("ς", "σ"):
        run += c if unicodedata.category(c)[0] == "L" else "" if run[-1] == "\0" else "\0"
    run += "" if run[-1] == "\0" else "\0"
    for n in (1, 2, 3):
        for i in range(len(run) - n + 1):
            g = run[i : i + n]
            if g != "\0" and not (n == 3 and g[1] == "\0"):
                out[g] += 1
    return out


def bucket_of(gram, buckets):
    return next(b for _, bs in language_id.features([gram.replace("\0", " ")], buckets) for b in bs)


@pytest.mark.parametrize("piece", [1 << 17, 1, 2, 3, 7, 50])
def test_features_of_every_cut(odd_texts, monkeypatch, piece):
    """However texts are cut or put together, they have the features of the whole."""
    texts = [*(t[:300] if t else t for t in odd_texts), "Grün ist, wo  ΣΑΣ wächst!", "ab", " a", "b ", "İi ß", "x1y2", "--", "日本 語"]
    whole = Counter()
    for n, t in enumerate(texts):
        for rows, bs in language_id.features([t], 1 << 20):
            whole.update(zip([n] * len(rows), bs.tolist(), strict=True))
    monkeypatch.setattr(language_id, "PIECE", piece)
    together = Counter()
    for rows, bs in language_id.features(texts, 1 << 20):
        together.update(zip(rows.tolist(), bs.tolist(), strict=True))
    assert together == whole
    for n, t in enumerate(texts):
        mine = sorted(c for (k, _), c in together.items() if k == n)
        assert sum(mine) == sum(slow_features(t).values())
        assert len(mine) == len(slow_features(t))  # no two features share one of 2 ** 20 buckets here


def slow_scores(rows, buckets, learn):
    """Counts, smoothing and Bayes' rule over buckets, by dictionaries."""
    counts, n = defaultdict(Counter), Counter()

    def cells(text):
        return Counter(b for _, bs in language_id.features([text], buckets) for b in bs.tolist())

    for i, text, lang in rows:
        if learn(i) and text is not None and lang is not None:
            counts[lang].update(cells(text))
            n[lang] += 1
    out = {}
    for i, text, _ in rows:
        found = cells(text)
        log = {
            lang: math.log(n[lang] / sum(n.values()))
            + sum(c * math.log((counts[lang][b] + language_id.SMOOTH) / (sum(counts[lang].values()) + language_id.SMOOTH * buckets)) for b, c in found.items())
            for lang in sorted(n)
        }
        best = max(log, key=log.get) if log and found else "und"
        out[i] = (best, 1 / sum(math.exp(x - log[best]) for x in log.values()) if best != "und" else 0.0)
    return out


def test_scores_against_slow_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(90)
    rows = [(r.doc_id, r.text[:400], r.lang) for r in docs.collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("c0", F.lit(1)).withColumn("score", F.lit("mine"))
    model = language_id.fit(frame, cells=1 << 14)
    assert model.table.shape == (4, 4096)
    got = {r.doc_id: r for r in language_id.predict(frame, model, ("doc_id", "c0")).collect()}
    for i, (lang, score) in slow_scores(rows, 4096, lambda i: zlib.crc32(str(i).encode()) % 3 != 1).items():
        assert (got[i].lang_pred, got[i].c0) == (lang, 1) and got[i].score == pytest.approx(score, abs=1e-9)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op13_language_id(spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    right = [truth[r.doc_id] == r.lang_pred for r in held if r.lang_pred != "und"]
    assert len(right) > 250 and np.mean(right) > 0.99
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark, odd_texts):
    schema = "doc_id long, text string, lang string"
    rows = [(i, t, "aa") for i, t in enumerate(odd_texts)] + [(100 + i, "der die das", "de") for i in range(6)] + [(200 + i, "the and of", "en") for i in range(6)]
    rows += [(None, "the and of", "zz"), (300, "the of", None), (301, "12 34", "de"), (302, None, None), (303, "the of", "en"), (303, "der das", "de")]
    frame = spark.createDataFrame(rows, schema)
    model = language_id.fit(frame)
    assert model.languages == ("aa", "de", "en")
    got = language_id.predict(frame, model, ("doc_id", "text")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.lang_pred == "und") == (not any(unicodedata.category(c)[0] == "L" for c in r.text or ""))
        assert r.score == 0 if r.lang_pred == "und" else 0 < r.score <= 1
    assert {r.lang_pred for r in got if r.doc_id in (300, None)} == {"en"}
    empty = frame.limit(0)
    assert language_id.predict(empty, model).count() == 0
    nothing = language_id.fit(empty)
    assert {(r.lang_pred, r.score) for r in language_id.predict(frame, nothing).collect()} == {("und", 0.0)}
    with pytest.raises(ValueError, match="more than"):
        language_id.fit(frame.withColumn("lang", F.col("doc_id").cast("string")), cells=4096)
