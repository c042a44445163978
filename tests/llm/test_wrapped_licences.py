"""Whole published notices, wrapped and in comments, inside documents."""

import random
import re
import textwrap

import pytest
import regex

from reelgauge.llm import license_scan

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
BSD3 = BSD2 + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
GPL = """This program is free software{mark} you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation{stop} either version {n} of the License, or (at your option) any later
version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
NOTICES = {
    "ISC": [ISC, "Copyright (c) 2020, Someone\n" + ISC],
    "AGPL-3.0-or-later": [GPL.replace("GNU", "GNU Affero").format(mark=":", stop=", ", n=3), GPL.replace("GNU", "GNU Affero").format(mark=":", stop="; ", n=3)],
    "LGPL-2.1-or-later": [GPL.replace("GNU", "GNU Lesser").replace("program is free", "library is free").format(mark=";", stop=";", n=2.1)],
    "MIT": [MIT],
    "BSD-2-Clause": [BSD2, "Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + BSD2],
    "BSD-3-Clause": [BSD3, "Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + BSD3],
    "GPL-2.0-or-later": [GPL.format(mark=";", stop=";", n=2)],
    "GPL-3.0-or-later": [GPL.format(mark=":", stop=", ", n=3)],
    "Apache-2.0": [APACHE],
}


def wrapped(text, width):
    parts = [p if p.startswith("Copyright") else " ".join(p.split()) for p in text.split("\n\n")]
    return "\n\n".join(p if p.startswith("Copyright") else textwrap.fill(p, width) for p in parts)


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", ";; ", "! ", "-- ", "dnl "])
def test_whole_notices(plain_docs, mark):
    rows, want = [], {}
    for name, texts in NOTICES.items():
        for text in texts:
            for width, end in ((72, "\n"), (50, "\r\n"), (10_000, "\n")):
                lines = [f"{mark}{line}".rstrip() for line in wrapped(text, width).split("\n")]
                want[len(rows)] = name
                rows.append((len(rows), end.join(["some words", "", *lines, "", "more words"])))
    got = {r.doc_id: (r.licenses, r.n_unmatched) for r in license_scan.scan(plain_docs(rows)).collect()}
    assert got == {i: (name, 0) for i, name in want.items()}


def test_lines_and_other_sentences(plain_docs):
    cases = {
        "Copyright 2020 X\nLicensed under the MIT License\nsomething else": "MIT",
        "Copyright 2020 X\nReleased under\nthe MIT License.": "MIT",
        "It is not licensed under the MIT License\nhere": "",
        "Released under\n\nthe MIT License": "",
        "Released under; the MIT License": "",
        "// SPDX-License-Identifier: MIT\ncode": "MIT",
        "# spdx-license-identifier:GPL-3.0-or-later": "GPL-3.0-or-later",
        "/* SPDX-License-Identifier: Unheard-1.0 */": "",
        "Copyright 2020 Y. All rights reserved.": "",
        "Licensed under\nthe MIT License\nreleased under\nthe MIT License": "MIT",
    }
    got = {r.doc_id: r.licenses for r in license_scan.scan(plain_docs(list(enumerate(cases)))).collect()}
    assert got == dict(enumerate(cases.values()))


def brute(text, sentences):
    """Identifiers of whole lines within sentences, by comparing every run of lines with every known sentence."""
    flat = re.sub(r"(?m)^[ \t]*(?:[#*/;!%'|>-]+|(?:dnl|rem)(?=[ \t]))", "", text.lower())
    flat = re.sub(r"[.;:!?]+(?=[\x20\x09-\x0D]|\Z)", "\n\n", flat)
    flat = re.sub(r" ?\n ?", "\n", regex.sub(r"[^\n\p{L}\p{N}]+", " ", flat)).strip(" ")
    out = []
    for sentence in re.split("\n\n+", flat):
        lines, at = sentence.split("\n"), 0
        while at < len(lines):
            runs = [(" ".join(lines[at:to]), to) for to in range(len(lines), at, -1)]
            hit = next((r for r in runs if r[0] in sentences), None)
            out += [sentences[hit[0]]] if hit else []
            at = hit[1] if hit else at + 1
    return out


def test_random_lines_against_brute_force(plain_docs):
    """Known sentences that begin with each other, broken over lines and sentences at random."""
    sentences = {"a b c": "A", "a b c d": "B", "a b": "C", "c d": "D", "d": "E", "a b c d a b": "F", "longest": "G"}
    rng = random.Random(11)
    rows = [(i, "longest " + "".join(rng.choice(["a", "b", "c", "d", "x", "a b", "a\nb c", "a b c\nd", "a b\nc d a b"]) + rng.choice([" ", " ", "\n", "\n# ", ". ", "\n\n", ", "]) for _ in range(rng.randrange(60)))) for i in range(400)]
    got = {r.doc_id: r.sentence_ids.split() for r in license_scan.scan(plain_docs(rows), sentences=sentences).collect()}
    assert got == {i: brute(t, sentences) for i, t in rows}
    assert len({x for ids in got.values() for x in ids}) >= 6


def test_a_long_table(plain_docs):
    """Two thousand more sentences change no result."""
    many = license_scan.SENTENCES | {f"clause {i} of the agreement number {i % 7} holds": f"X{i}" for i in range(2000)}
    text = "Clause 1234 of the\nagreement number 2 holds.\n" + MIT
    got = license_scan.scan(plain_docs([(1, text)]), sentences=many).first()
    assert got.sentence_ids == "X1234 MITGrant MITNotice" and got.licenses == "UNKNOWN MIT"
