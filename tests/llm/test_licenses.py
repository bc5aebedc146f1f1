import random
import re

from quirework.llm.licenses import BASE, BODIES, FAMILIES, GATES, _kept, license_scan, rules

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_base(text):
    w = words(text)
    places = [(i, label) for phrase, label in BASE.items() for p in [phrase.split()] for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = sorted(i for i, _ in places)
    return len(w), starts, sorted({x for _, x in places})


def brute_rules(text):
    """All rules on the words, then pairwise containment."""
    joined = f" {' '.join(words(text))} "
    found = []
    for keyword, label, pattern, priority, sure in rules():
        for m in re.finditer(pattern, joined):
            start = joined[: m.start()].count(" ") - 1
            found.append((start, start + m[0].count(" ") + 1, label, priority, sure))
    found.sort(key=lambda d: (d[0], -d[1], -d[3], d[2]))
    kept = [d for i, d in enumerate(found) if not any(e[1] >= d[1] and e[3] >= d[3] for e in found[:i])]
    return {d[2] for d in kept}, max((d[4] for d in kept), default=0.0)


LINES = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: MIT", "(c) 2020, all rights reserved", "Creative Commons Attribution-ShareAlike 3.0 Unported", "BSD 3-Clause License", "Mozilla Public License 2.0", "public domain", "license", "mit", "cc by", "by cc", "gnu general", "the open font license"]


def test_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(x for _ in range(rng.randrange(6)) for x in (rng.choice(LINES), " ".join(rng.choices(["foo", "bar", "ÄB", "--", "\n"], k=rng.randrange(4)))))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "..."), (203, "MIT LICENSE"), (204, "mit license mit license"), (205, " ".join(["apache license"] * 500)), (None, "cc-by"), (204, "mit license mit license")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as words", "2 as found")
    got = license_scan(frame).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        n, starts, labels = brute_base(text[r.doc_id])
        assert (r.n_words, r.base_starts, r.base_labels) == (n, starts, labels)
        more, sure = brute_rules(text[r.doc_id])
        assert set(r.labels) == set(labels) | more, text[r.doc_id]
        assert r.score == max(sure, 0.5 if labels else 0.0)
    assert license_scan(frame.limit(0)).count() == 0


def test_rules_are_many_and_start_with_their_gate():
    assert len(rules()) > 250
    assert _kept is not None


SPDX = {"gpl-2.0": "GPL-2.0-only", "gpl-3.0": "GPL-3.0-or-later", "gpl": "GPL-1.0-only", "lgpl-2.1": "LGPL-2.1", "lgpl-3.0": "LGPL-3.0", "lgpl": "LGPL-2.0", "agpl-3.0": "AGPL-3.0-only", "gfdl-1.3": "GFDL-1.3", "apache-2.0": "Apache-2.0", "apache-1.1": "Apache-1.1", "mit": "MIT", "x11": "X11", "isc": "ISC", "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause", "bsd-4-clause": "BSD-4-Clause", "0bsd": "0BSD", "mpl-1.1": "MPL-1.1", "mpl-2.0": "MPL-2.0", "epl-1.0": "EPL-1.0", "epl-2.0": "EPL-2.0", "cddl-1.0": "CDDL-1.0", "eupl-1.2": "EUPL-1.2", "cc0-1.0": "CC0-1.0", "cc-by-2.0": "CC-BY-2.5", "cc-by-3.0": "CC-BY-3.0", "cc-by-4.0": "CC-BY-4.0", "cc-by-sa-3.0": "CC-BY-SA-3.0", "cc-by-sa-4.0": "CC-BY-SA-4.0", "cc-by-nd-4.0": "CC-BY-ND-4.0", "cc-by-nc-4.0": "CC-BY-NC-4.0", "cc-by-nc-sa-4.0": "CC-BY-NC-SA-4.0", "cc-by-nc-nd-4.0": "CC-BY-NC-ND-4.0", "cc-by": "CC-BY-1.0", "cc-by-sa": "CC-BY-SA-2.5", "cc-by-nc": "CC-BY-NC-2.0", "public-domain": "Public-Domain", "unlicense": "Unlicense", "wtfpl": "WTFPL", "zlib": "Zlib", "boost-1.0": "BSL-1.0", "artistic-2.0": "Artistic-2.0", "ofl-1.1": "OFL-1.1", "odbl-1.0": "ODbL-1.0", "python-2.0": "PSF-2.0", "postgresql": "PostgreSQL", "openrail": "OpenRAIL", "proprietary": "proprietary"}
SHORT = {"licensed under GPL v2": "gpl-2.0", "GPL-2.0-only": "gpl-2.0", "GPLv3": "gpl-3.0", "LGPL-2.1": "lgpl-2.1", "AGPL-3.0": "agpl-3.0", "MPL 2.0": "mpl-2.0", "under EPL-1.0": "epl-1.0", "CDDL 1.1": "cddl-1.0", "EUPL v1.2": "eupl-1.2", "GFDL": "gfdl-1.3"}


def test_identifiers_and_short_names_need_no_long_name(spark):
    assert set(SPDX) == {f[0] for f in FAMILIES}
    said = [(label, text) for label, name in SPDX.items() for text in (f"x SPDX-License-Identifier: {name}", f"see https://opensource.org/licenses/{name} y")] + [(label, text) for text, label in SHORT.items()]
    got = {r.doc_id: r for r in license_scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(said)], "doc_id long, text string")).collect()}
    for i, (label, text) in enumerate(said):
        assert label in got[i].labels, text
        base, (more, sure) = brute_base(text)[2], brute_rules(text)
        assert set(got[i].labels) == set(base) | more and got[i].score == max(sure, 0.5 if base else 0.0), text
    assert "gpl" not in {x for i, (_, t) in enumerate(said) if t in SHORT for x in got[i].labels}


#: Sentences as they stand in license files: none of them names its license.
BODY = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy\n of this software and associated documentation files (the \"Software\")": "mit",
    "The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.": "mit",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation": "boost-1.0",
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:": "bsd",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "bsd-3-clause",
    "All advertising materials mentioning features or use of this software must display the following acknowledgement:": "bsd-4-clause",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable": "zlib",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,": "apache-2.0",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License": "gpl",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2.0",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND": "no-warranty",
}


def test_bodies_are_found_without_a_name(spark):
    said = list(BODY)
    frame = spark.createDataFrame([(i, f"x {t} y") for i, t in enumerate(said)] + [(99, "word " * 200_000 + said[0])], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan(frame).collect()}
    for i, text in enumerate(said):
        assert BODY[text] in got[i].labels, (text, got[i].labels)
        more, sure = brute_rules(f"x {text} y")
        assert set(got[i].labels) == more | set(brute_base(text)[2]) and got[i].score == max(sure, 0.5 if brute_base(text)[2] else 0.0)
    assert got[99].labels == ["mit"] and got[99].n_words == 200_000 + len(words(said[0]))


def test_only_ascii_letters_are_lowered(spark):
    """A Kelvin sign is no k: contract words lower-case A-Z alone."""
    (r,) = license_scan(spark.createDataFrame([(1, "mit licen\u017fe, \u212a MIT LICENSE")], "doc_id long, text string")).collect()
    assert r.base_starts == [3] and r.n_words == 5


def test_every_match_holds_a_gate_and_its_keyword():
    texts = [f" {' '.join(words(t))} " for t in [*LINES, *SHORT, *BODY, *(f"{front} {x}" for x in SPDX.values() for front in ("SPDX-License-Identifier:", "spdx.org/licenses/"))]]
    for keyword, _, pattern, _, _ in rules():
        for text in texts:
            if re.search(pattern, text):
                assert keyword in text and any(g in text for g in GATES), (pattern, text)


def test_every_sentence_passes_its_gate_and_holds_its_keyword():
    for label, keyword, pattern, _ in BODIES:
        said = f" {re.sub(r'[(][?]:([^()|]*)(?:[|][^()]*)?[)][?]?', r'\1', pattern)} "
        assert keyword in said and any(g in said for g in GATES), (label, said)
