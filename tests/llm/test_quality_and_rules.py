import zlib

import pytest
from pyspark.sql import functions as F

from reelgauge.llm import exact_dedup, license_scan, quality_classifier, quality_rules, url_filter


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labelled(spark, plain_docs, words):
    rows, labels = [], []
    for i in range(400):
        w = words(60, f"q{i}")
        good = i % 3 > 0
        rows.append((i, " ".join(w) if good else " ".join(x.upper() + "###" for x in w)))
        labels.append((i, int(good), 0))
    return plain_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_holds_on_unseen_rows(labelled):
    docs, labels = labelled
    model = quality_classifier.fit(docs, labels, size=8192)
    scores = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    unseen = [i for i in scores if held_out(i)]
    assert len(unseen) > 50
    assert all((scores[i] >= quality_classifier.THRESHOLD) == (i % 3 > 0) for i in unseen)
    kept = {r.doc_id for r in quality_classifier.filtered(docs, model).collect()}
    assert kept == {i for i in scores if scores[i] >= quality_classifier.THRESHOLD}
    assert quality_classifier.filtered(docs, model).columns == docs.columns


def test_classifier_never_fits_on_held_out_labels(labelled, spark):
    docs, labels = labelled
    flipped = labels.withColumn("quality", F.when(quality_classifier.in_fold(F.col("doc_id"), 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_classifier.fit(docs, labels, size=8192) == quality_classifier.fit(docs, flipped, size=8192)


def test_classifier_odd_input(labelled, spark, plain_docs, odd_texts):
    docs, labels = labelled
    model = quality_classifier.fit(docs, labels, size=8192)
    odd = plain_docs([(i // 2, t) for i, t in enumerate(odd_texts)]).withColumn("score", F.lit("mine"))
    got = quality_classifier.score(odd, model, keep=("doc_id", "score")).collect()
    assert len(got) == len(odd_texts) and all(0 <= r[2] <= 1 for r in got)
    assert quality_classifier.score(docs.limit(0), model).count() == 0
    none = quality_classifier.fit(docs, labels.limit(0))
    assert {r.score for r in quality_classifier.score(odd, none).collect()} == {0.5}
    one_sided = quality_classifier.fit(docs, labels.withColumn("quality", F.lit(1)))
    assert quality_classifier.score(docs, one_sided).agg(F.min("score")).first()[0] > 0.9
    clash = labels.unionAll(labels.withColumn("quality", 1 - F.col("quality")))
    assert quality_classifier.fit(docs, clash).good == b""


def brute_repeats(text):
    w = text.split()
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    return len({p for i, g in enumerate(wins) if wins.count(g) > 1 for p in (i, i + 1, i + 2)})


@pytest.mark.parametrize("text", ["a b c", "a b c a b c", "a a a a", "a b c d a b c e b c d", "x y", "", "q w e r t q w e r t z q w e"])
def test_repeat_words(plain_docs, text):
    row = quality_rules.judge(plain_docs([(1, text)])).first()
    assert row.n_repeat_words == brute_repeats(text)
    assert row.n_words == len(text.split())


def test_quality_rules_verdicts(plain_docs, words, odd_texts):
    good = "the " + " of ".join(words(80, "good"))
    cases = [(1, good), (2, " ".join(x + "***" for x in good.split())), (3, " ".join(words(80, "no stops"))), (4, "of the\n" * 60), *enumerate(odd_texts, 10)]
    got = {r.doc_id: r for r in quality_rules.judge(plain_docs(cases).withColumn("n_words", F.lit("mine"))).collect()}
    assert got[1].kept and got[1].failed == []
    assert got[2].failed == ["symbols", "stop_words"] and not got[2].kept
    assert got[3].failed == ["stop_words"] and not got[3].base_failed
    assert got[4].base_failed and "duplicate_lines" in got[4].failed and got[4].n_dup_lines == 59
    assert len(got) == len(cases) and got[10].n_words == 0 and got[10].base_failed
    assert got[16].n_words == 10_000 and got[16].n_repeat_words == 10_000
    none = quality_rules.judge(plain_docs([]), rules=())
    assert none.count() == 0


def test_quality_rules_stay_native(plain_docs, plan):
    text = plan(quality_rules.judge(plain_docs([(1, "a")])))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


URLS = [
    ("https://A.Example.org/es/1?x=1", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    ("http://x.com/de", "x.com", "/de", None, "allow"),
    ("http://org", "org", "", None, "allow"),
    ("http://a.net/de/?q=http://x.com/de/", "a.net", "/de/", None, "allow"),
    ("x.com/de/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://h?/de/", "h", "", None, "allow"),
]


def test_url_rules(spark):
    rows = [(i, u, "<p>") for i, (u, *_) in enumerate(URLS)]
    pages = spark.createDataFrame(rows + rows[:3] + [(None, URLS[0][0], None)], "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = url_filter.filter_urls(pages, url_filter.rule_table(spark)).collect()
    assert len(got) == len(rows) + 4
    for r in got:
        assert tuple(r)[1:] == URLS[r.page_id or 0][1:]
    assert url_filter.filter_urls(pages.limit(0), url_filter.rule_table(spark)).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, url_filter.rule_table(spark, []), default="block").collect()} == {"block"}


def test_url_rules_equal_but_contradicting(spark):
    rules = url_filter.rule_table(spark, [("org", "/", "allow"), ("ORG", "/", "block"), (None, "/", "allow")])
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert url_filter.filter_urls(pages, rules).first().verdict == "block"


def test_exact_groups(plain_docs, spark):
    docs = plain_docs([(5, "a b"), (3, "ab"), (9, "a  b"), (7, "a\n\tb"), (1, None), (2, ""), (4, " \r"), (8, "other"), (8, "other")])
    got = {r.doc_id: r for r in exact_dedup.membership(docs).collect() if r.doc_id != 8}
    assert {i: (r.keep_id, r.group_size, r.kept) for i, r in got.items()} == {
        3: (7, 4, False), 5: (7, 4, False), 7: (7, 4, True), 9: (7, 4, False), 1: (4, 3, False), 2: (4, 3, False), 4: (4, 3, True),
    }
    kept = exact_dedup.deduplicated(docs.withColumn("hash", F.lit(1)))
    assert sorted(r.doc_id for r in kept.collect()) == [4, 7, 8] and "hash" in kept.columns
    assert exact_dedup.membership(docs.limit(0)).count() == 0 == exact_dedup.deduplicated(docs.limit(0)).count()
    nulls = plain_docs([(None, "q"), (None, "q "), (6, "q")])
    assert [tuple(r)[1:3] for r in exact_dedup.membership(nulls).collect()] == [(None, 3)] * 3 or exact_dedup.membership(nulls).first().group_size == 3


def test_exact_groups_compare_bytes(plain_docs, monkeypatch):
    """With a hash that always collides, different texts stay apart."""
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("00" * 16))
    got = exact_dedup.membership(plain_docs([(1, "a"), (2, "b"), (3, "b")])).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got) == [(1, 1), (2, 2), (3, 2)]


def test_licences(plain_docs, odd_texts):
    cases = [
        (1, "Licensed under the Apache License, Version 2.0.\nfoo bar"),
        (2, "RELEASED  under the MIT license!\nAll rights reserved."),
        (3, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
            " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
        (4, "You may obtain a copy of the License at."),
        (5, "nothing here"),
        (6, "Licensed under CC BY-NC 4.0.\nx\nLicensed under CC BY-NC 4.0."),
    ]
    docs = plain_docs([*cases, *enumerate(odd_texts, 10)]).withColumn("licenses", F.lit("mine"))
    got = {r.doc_id: (r.licenses, r.n_unmatched) for r in license_scan.scan(docs).collect()}
    assert got[1] == ("Apache-2.0", 0) and got[2] == ("MIT", 0) and got[3] == ("GPL-3.0-or-later", 0)
    assert got[4] == ("UNKNOWN", 1) and got[5] == ("", 0) and got[6] == ("CC-BY-NC-4.0", 0)
    assert all(got[i] == ("", 0) for i in range(10, 10 + len(odd_texts)))
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_licence_rules_are_ordered(plain_docs):
    docs = plain_docs([(1, "one\ntwo\none")])
    sentences = {"one": "A", "two": "B"}
    assert license_scan.scan(docs, sentences=sentences, rules=[("AB", ("A", "B")), ("A", ("A",))]).first().licenses == "AB A"
    assert license_scan.scan(docs, sentences=sentences, rules=[("A", ("A",)), ("AB", ("A", "B"))]).first().licenses == "A UNKNOWN"
