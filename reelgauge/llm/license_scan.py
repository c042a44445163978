"""Licence recognition from sentences.

A text is normalised and cut into sentences, and every sentence is looked up in a map from known licence sentences to their
identifiers. A sentence that is not known is cut into its lines: from every line on, the first three words look up the
known sentences that begin with them, and one is found if it ends where a line ends. So notices are found that are wrapped
over lines, in comments or not, and so are notices of one line without a full stop. The identifiers that are found, in order of
appearance, are matched against an ordered table of rules, each of them a sequence of identifiers. A rule takes the
identifiers it matched out of the sequence, so a later, more general rule does not see them. Rules without a name take what
says nothing alone; identifiers that no rule took make the text ``UNKNOWN``.

Maps are dealt into buckets by hash, since a look-up walks through its map: its cost doesn't grow with the table of sentences,
nor does the cost of a line. Everything is built-in functions in one projection: no shuffle, and the text is read once by
the task that has it.

Cases: null and blank texts have no licence; a text may have several licences, repeats of one count once, in order of
appearance; of known sentences that begin at the same line the longest is found, and no line counts for two; very long texts
are cut into sentences and lines of any number; an empty table gives an empty result; other columns, whatever their names,
are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.tables import numbered, place
from reelgauge.llm.words import whole

#: The names of the SPDX list that a mark may give, after normalisation -> licence.
SPDX = {
    "mit": "MIT",
    "isc": "ISC",
    "apache 2 0": "Apache-2.0",
    "bsd 2 clause": "BSD-2-Clause",
    "bsd 3 clause": "BSD-3-Clause",
    "gpl 2 0 only": "GPL-2.0-only",
    "gpl 2 0 or later": "GPL-2.0-or-later",
    "gpl 3 0 only": "GPL-3.0-only",
    "gpl 3 0 or later": "GPL-3.0-or-later",
    "lgpl 2 1 only": "LGPL-2.1-only",
    "lgpl 2 1 or later": "LGPL-2.1-or-later",
    "lgpl 3 0 only": "LGPL-3.0-only",
    "lgpl 3 0 or later": "LGPL-3.0-or-later",
    "agpl 3 0 only": "AGPL-3.0-only",
    "agpl 3 0 or later": "AGPL-3.0-or-later",
    "mpl 2 0": "MPL-2.0",
    "cc0 1 0": "CC0-1.0",
    "cc by 4 0": "CC-BY-4.0",
    "cc by sa 4 0": "CC-BY-SA-4.0",
    "unlicense": "Unlicense",
}

#: Licence sentences after normalisation -> identifier.
SENTENCES = {
    "licensed under the apache license version 2 0": "ApacheV2",
    "licensed under the apache license version 2 0 the license": "ApacheV2",
    "this project is licensed under the apache license version 2 0": "ApacheV2",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at": "ApacheCopy",
    "released under the mit license": "MITRef",
    "licensed under the mit license": "MITRef",
    "this project is licensed under the mit license": "MITRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "MITGrant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "this work is licensed under the gnu general public license version 3": "GPLv3",
    "licensed under the gnu general public license version 3": "GPLv3",
    "licensed under the gnu general public license version 2": "GPLv2",
    "this program is free software": "FreeSoftware",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPLv3Terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPLv2Terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "GPLTerms",
    "either version 3 of the license or at your option any later version": "GPLv3Later",
    "either version 2 of the license or at your option any later version": "GPLv2Later",
    "licensed under cc by nc 4 0": "CCBYNC4",
    "licensed under cc by 4 0": "CCBY4",
    "licensed under cc by sa 4 0": "CCBYSA4",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGrant",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPLv3Terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LGPLv21Terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "LGPLTerms",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPLv3Terms",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation": "AGPLTerms",
    "either version 2 1 of the license or at your option any later version": "LGPLv21Later",
    "this library is free software": "FreeSoftware",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL2",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "all rights reserved": "AllRights",
} | {"spdx license identifier " + name: "Spdx:" + licence for name, licence in SPDX.items()}

#: Ordered rules: the longer sequences stand before those they contain; what rules without a name take says nothing alone.
RULES: tuple[tuple[str | None, tuple[str, ...]], ...] = (
    *((licence, ("Spdx:" + licence,)) for licence in SPDX.values()),
    ("Apache-2.0", ("ApacheV2", "ApacheUse", "ApacheCopy")),
    ("MIT", ("MITGrant", "MITNotice")),
    ("GPL-3.0-or-later", ("FreeSoftware", "GPLv3Terms")),
    ("GPL-2.0-or-later", ("FreeSoftware", "GPLv2Terms")),
    ("GPL-3.0-or-later", ("FreeSoftware", "GPLTerms", "GPLv3Later")),
    ("GPL-2.0-or-later", ("FreeSoftware", "GPLTerms", "GPLv2Later")),
    ("LGPL-3.0-or-later", ("FreeSoftware", "LGPLv3Terms")),
    ("LGPL-2.1-or-later", ("FreeSoftware", "LGPLv21Terms")),
    ("LGPL-3.0-or-later", ("FreeSoftware", "LGPLTerms", "GPLv3Later")),
    ("LGPL-2.1-or-later", ("FreeSoftware", "LGPLTerms", "LGPLv21Later")),
    ("AGPL-3.0-or-later", ("FreeSoftware", "AGPLv3Terms")),
    ("AGPL-3.0-or-later", ("FreeSoftware", "AGPLTerms", "GPLv3Later")),
    ("ISC", ("ISCGrant",)),
    ("MPL-2.0", ("MPL2",)),
    ("Unlicense", ("Unlicense",)),
    ("BSD-3-Clause", ("AllRights", "BSDGrant", "BSDEndorse")),
    ("BSD-2-Clause", ("AllRights", "BSDGrant")),
    ("BSD-3-Clause", ("BSDGrant", "BSDEndorse")),
    ("BSD-2-Clause", ("BSDGrant",)),
    ("Apache-2.0", ("ApacheV2",)),
    ("MIT", ("MITRef",)),
    ("GPL-3.0-only", ("GPLv3",)),
    ("GPL-2.0-only", ("GPLv2",)),
    ("CC-BY-NC-4.0", ("CCBYNC4",)),
    ("CC-BY-SA-4.0", ("CCBYSA4",)),
    ("CC-BY-4.0", ("CCBY4",)),
    (None, ("AllRights",)),
)

#: Comment marks that begin a line; they end no sentence.
_MARKS = r"(?m)^[ \t]*(?:[#*/;!%'|>-]+|(?:dnl|rem)(?=[ \t]))"
#: A mark of the SPDX list goes on behind its colon.
_MARKED = "spdx-license-identifier *:"
#: A sentence ends at . ; : ! ? before white space or the end, or at a blank line.
_ENDS = r"[.;:!?]+(?=[\x20\x09-\x0D]|\z)"
#: Words by which a known sentence is looked up from the line where it begins.
LEAD = 3


def normalised(text: Column) -> Column:
    """Lower case, every run of other characters than letters and digits as one space, line breaks as one line feed, and
    the ends of sentences as two or more."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(whole(text)), _MARKS, ""), _MARKED, "spdx license identifier ")
    flat = F.regexp_replace(F.regexp_replace(flat, _ENDS, "\n\n"), r"[^\n\p{L}\p{N}]+", " ")
    return F.regexp_replace(F.regexp_replace(flat, " ?\n ?", "\n"), "^ +| +$", "")


def _lookup(table: Mapping[str, Column], absent: Column) -> Callable[[Column], Column]:
    """The value of a text. Each bucket of the hash is a small map; a hash is only a place, the texts themselves are compared."""
    n = max(1, len(table) // 4)
    buckets: dict[int, list[Column]] = defaultdict(list)
    for key, value in table.items():
        signed = (xxhash.xxh64_intdigest(key.encode(), 42) + (1 << 63)) % (1 << 64) - (1 << 63)
        buckets[signed % n] += [F.lit(key), value]
    dealt = F.array(*(F.create_map(*(buckets[i] or [F.lit("\n"), absent])) for i in range(n)))
    return lambda text: F.element_at(dealt, (F.pmod(F.xxhash64(text), F.lit(n)) + 1).cast("int"))[text]


_CANDIDATES = "array<struct<text:string,words:int,id:string>>"


def _leading(sentences: Mapping[str, str]) -> Callable[[Column], Column]:
    """The known sentences (text, words, id) that may begin with the given LEAD words, longer ones first."""
    by_lead: dict[str, list[str]] = defaultdict(list)
    for text in sorted(sentences, key=lambda x: (-len(x), x)):
        by_lead[" ".join(text.split(" ")[:LEAD])].append(text)
    entry = lambda x: F.struct(F.lit(x).alias("text"), F.lit(len(x.split(" "))).alias("words"), F.lit(sentences[x]).alias("id"))
    table = {lead: F.array(*map(entry, texts)) for lead, texts in by_lead.items()}
    found = _lookup(table, F.array().cast(_CANDIDATES))
    # Sentences of fewer words than LEAD are looked up by all they have.
    sizes = sorted({len(lead.split(" ")) for lead in table}, reverse=True)
    none = F.array().cast(_CANDIDATES)
    return lambda words: F.concat(*(F.coalesce(found(words if n == LEAD else F.substring_index(words, " ", n)), none) for n in sizes))


def _within(lines: Column, leading: Callable[[Column], Column]) -> Column:
    """Identifiers of the known sentences that are whole lines of a sentence, from its first line on."""

    def first_words(at: Column) -> Column:
        # Every line has a word, so LEAD lines have LEAD words.
        return F.substring_index(F.array_join(F.slice(lines, at + 1, LEAD), " "), " ", LEAD)

    def ends(found: Column, at: Column) -> Column:
        """The candidate with the number of its lines, 0 if it does not stand here."""
        text = F.array_join(F.slice(lines, at + 1, found["words"]), "\n")
        n = F.length(found["text"])
        stands = F.translate(text, "\n", " ").startswith(found["text"]) & F.substring(text, n + 1, F.lit(1)).isin("", "\n")
        used = F.length(F.substring(text, F.lit(1), n)) - F.length(F.translate(F.substring(text, F.lit(1), n), "\n", "")) + 1
        return F.struct(F.when(stands, used).otherwise(0).alias("lines"), found["id"].alias("id"))

    def step(seen: Column, at: Column) -> Column:
        hit = F.get(F.filter(F.transform(leading(first_words(at)), lambda c: ends(c, at)), lambda c: c["lines"] > 0), F.lit(0))
        after = F.struct((at + hit["lines"]).alias("next"), F.concat(seen["ids"], F.array(hit["id"])).alias("ids"))
        return F.when((at < seen["next"]) | hit.isNull(), seen).otherwise(after)

    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("ids"))
    return F.aggregate(F.sequence(F.lit(0), F.size(lines) - 1), start, step)["ids"]


def sentence_ids(text: Column, sentences: Mapping[str, str]) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known, leading = _lookup({s: F.lit(i) for s, i in sentences.items()}, F.lit("")), _leading(sentences)

    def of(sentence: Column) -> Column:
        found = known(F.translate(sentence, "\n", " "))
        return F.when(found.isNotNull(), F.array(found)).otherwise(_within(F.split(sentence, "\n"), leading))

    return F.flatten(F.transform(F.split(normalised(text), "\n\n+"), of))


def scan(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str | None, Sequence[str]]] = RULES,
) -> DataFrame:
    """The kept columns, ``sentence_ids`` and ``licenses`` (both joined by spaces), ``n_unmatched``."""
    content = place(docs, text)
    ids = sentence_ids(content, sentences)
    # A text without the longest word of any sentence has none of them; most texts end at this test.
    hint = content.rlike(r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(sorted({max(s.split(), key=len) for s in sentences})) + r")(?![\p{L}\p{N}])")
    kept = [place(docs, k).alias(f"k{n}") for n, k in enumerate(keep)]
    out = numbered(docs).select(
        *kept, F.when(hint, F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" "))).otherwise(F.lit("  ")).alias("ids")
    )
    names: dict[str, str] = {}
    matched = F.col("ids")
    for name, sequence in rules:
        mark = "" if name is None else " " + names.setdefault(name, f"@{len(names)}@") + " "
        matched = F.replace(matched, F.lit(f" {'  '.join(sequence)} "), F.lit(mark))
    tokens = F.filter(F.split(F.col("matched"), " +"), lambda x: x != "")
    marks = F.create_map(*(F.lit(x) for name, mark in names.items() for x in (mark, name)), F.lit("UNKNOWN"), F.lit("UNKNOWN"))
    return (
        out.withColumn("matched", matched)
        .withColumn("tokens", F.transform(tokens, lambda x: F.when(x.startswith("@"), x).otherwise(F.lit("UNKNOWN"))))
        .select(
            *(f"k{n}" for n in range(len(keep))),
            F.trim(F.regexp_replace("ids", " +", " ")),
            F.array_join(F.array_distinct(F.transform("tokens", lambda x: marks[x])), " "),
            F.size(F.filter("tokens", lambda x: x == "UNKNOWN")).cast("long"),
        )
        .toDF(*keep, "sentence_ids", "licenses", "n_unmatched")
    )
