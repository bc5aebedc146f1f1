"""License detection with ordered signature rules, in DataFrame functions alone.

Texts become words (A-Z lower-cased, anything between words one blank). A document that holds one of a few gate
words is tested against the keyword of each rule, which every text that the rule can match holds: the keyword of the
name, or for rules of identifiers the words in front of them. Only rules whose keyword is there run. A rule
is a regular expression over the words, with a label, a priority and a confidence; licenses whose own text stands in a
document without their name are found by sentences of it (``BODIES``). Detections are word intervals;
in the order of their start, one that lies inside an earlier or longer one of at least its priority is suppressed.
Base phrases are always reported as such, suppression or not.

Everything happens inside the row: nothing is shuffled, and the rule table is a constant of the plan.

Defined cases: null and empty texts have no words, no labels and score 0. Very long texts are scanned whole. Detections
of equal place and priority stand in the order of their labels. Every row gives one row, repeated rows and null ids
included. Extra columns are ignored. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Every text that a rule or base phrase can match holds one of these.
GATES = ("licen", "gpl", " mpl ", " epl ", " cddl ", " eupl ", " gfdl ", "bsd", " cc ", "cc0", "creative commons", "public domain", "wtfpl", "openrail", "rights reserved", "released under", "distributed under", "provided under", "published under", "available under", "hereby granted", "redistribution and use", "without warranty", "without any express or implied", "free software", "unencumbered", "permission notice", "used to endorse", "advertising materials", "may not be called", "x consortium", "disclaims all warranties", "redistributions of source code", "origin of this software", "altered source versions", "standard version of this package", "neighboring rights", "compiled binary", "use based restrictions", "unauthorized copying")

#: Family: (label, keyword that every text with its name holds, regular expression of its name, SPDX identifier as words).
#: A family without a version leaves the versions of its namesakes to them: of equal detections only one stands.
FAMILIES = (
    ("gpl-2.0", "general public", "(?:gnu )?general public licen[sc]e(?: gpl)? (?:version |v ?)?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "general public", "(?:gnu )?general public licen[sc]e(?: gpl)? (?:version |v ?)?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl", "gpl", "(?:gnu )?gpl(?: ?v ?1)?", "gpl 1 0(?: only| or later)?"),
    ("lgpl-2.1", "lesser general public", "(?:gnu )?lesser general public licen[sc]e (?:version |v ?)?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "lesser general public", "(?:gnu )?lesser general public licen[sc]e (?:version |v ?)?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl(?: ?v ?2(?: 0)?)?", "lgpl 2 0(?: only| or later)?"),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public licen[sc]e(?: (?:version |v ?)?3(?: 0)?)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl-1.3", "free documentation", "(?:gnu )?free documentation licen[sc]e(?: (?:version |v ?)?1(?: [123])?)?", "gfdl 1 [123](?: only| or later)?"),
    ("apache-2.0", "apache", "apache(?: software)? licen[sc]e (?:version |v ?)?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "apache(?: software)? licen[sc]e (?:version |v ?)?1 [01]", "apache 1 [01]"),
    ("mit", "mit", "mit(?: x11)?", "mit"),
    ("x11", "x11", "x11", "x11"),
    ("isc", "isc", "isc", "isc"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd 4 clause"),
    ("0bsd", "bsd", "(?:zero clause bsd|0bsd|bsd zero clause)", "0bsd"),
    ("mpl-1.1", "mozilla", "mozilla public licen[sc]e (?:version |v ?)?1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", "mozilla public licen[sc]e(?: (?:version |v ?)?2 0)?", "mpl 2 0"),
    ("epl-1.0", "eclipse", "eclipse public licen[sc]e (?:version |v ?)?1 0", "epl 1 0"),
    ("epl-2.0", "eclipse", "eclipse public licen[sc]e(?: (?:version |v ?)?2 0)?", "epl 2 0"),
    ("cddl-1.0", "common development", "common development and distribution licen[sc]e(?: (?:version |v ?)?1 [01])?", "cddl 1 [01]"),
    ("eupl-1.2", "european union", "european union public licen[sc]e(?: (?:version |v ?)?1 [012])?", "eupl 1 [012]"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by-2.0", "cc by", "cc by 2 [05]", "cc by 2 [05]"),
    ("cc-by-3.0", "cc by", "cc by 3 0", "cc by 3 0"),
    ("cc-by-4.0", "cc by", "cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-3.0", "cc by sa", "cc by sa 3 0", "cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa", "cc by sa(?: 4 0)?", "cc by sa 4 0"),
    ("cc-by-nd-4.0", "cc by nd", "cc by nd(?: [34] 0)?", "cc by nd [34] 0"),
    ("cc-by-nc-4.0", "cc by nc", "cc by nc(?: [34] 0)?", "cc by nc [34] 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa", "cc by nc sa(?: [34] 0)?", "cc by nc sa [34] 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd", "cc by nc nd(?: [34] 0)?", "cc by nc nd [34] 0"),
    ("cc-by", "creative commons", "creative commons attribution(?: [234] [05])?(?: international| unported| generic)?", "cc by 1 0"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [234] [05])?(?: international| unported| generic)?", "cc by sa (?:1 0|2 [05])"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [234] [05])?(?: international| unported| generic)?", "cc by nc (?:1 0|2 [05])"),
    ("public-domain", "public domain", "(?:dedicated to |released (?:in)?to |in )?(?:the )?public domain", "public domain"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("zlib", "zlib", "(?:zlib|zlib libpng)", "zlib"),
    ("boost-1.0", "boost", "boost(?: software)?(?: 1 0)?", "bsl 1 0"),
    ("artistic-2.0", "artistic", "(?:perl )?artistic(?: 2 0)?", "artistic 2 0"),
    ("ofl-1.1", "open font", "(?:sil )?open font(?: 1 1)?", "ofl 1 1"),
    ("odbl-1.0", "open database", "open database(?: 1 0)?", "odbl 1 0"),
    ("python-2.0", "python", "python(?: software foundation)?", "(?:python|psf) 2 0"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("openrail", "openrail", "(?:creativeml |bigscience )?openrail(?: m)?", "openrail"),
    ("proprietary", "all rights reserved", "all rights reserved", "proprietary"),
)

#: Short names: (label, keyword that every text with the short name holds, its regular expression).
SHORT = (
    ("gpl-2.0", "gpl", "(?:gnu )?gpl ?(?:version |v ?)?2(?: 0)?"),
    ("gpl-3.0", "gpl", "(?:gnu )?gpl ?(?:version |v ?)?3(?: 0)?"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl ?(?:version |v ?)?2 1"),
    ("lgpl-3.0", "lgpl", "(?:gnu )?lgpl ?(?:version |v ?)?3(?: 0)?"),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl(?: ?(?:version |v ?)?3(?: 0)?)?"),
    ("gfdl-1.3", " gfdl ", "(?:gnu )?gfdl(?: (?:version |v ?)?1 [123])?"),
    ("mpl-1.1", " mpl ", "mpl (?:version |v ?)?1 1"),
    ("mpl-2.0", " mpl ", "mpl (?:version |v ?)?2 0"),
    ("epl-1.0", " epl ", "epl (?:version |v ?)?1 0"),
    ("epl-2.0", " epl ", "epl (?:version |v ?)?2 0"),
    ("cddl-1.0", " cddl ", "cddl(?: (?:version |v ?)?1 [01])?"),
    ("eupl-1.2", " eupl ", "eupl(?: (?:version |v ?)?1 [012])?"),
)

#: Sentences of the licenses themselves: (label, keyword, regular expression over the words, confidence).
BODIES = (
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 1.0),
    ("mit", "the above copyright notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 1.0),
    ("isc", "permission to use", "permission to use copy modify (?:and or|and) distribute this software for any purpose with or without fee is hereby granted", 0.95),
    ("boost-1.0", "hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", 1.0),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?", 0.95),
    ("bsd-3-clause", "neither the name of", "neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived from this software without specific prior written permission", 0.95),
    ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment", 0.95),
    ("zlib", "express or implied", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", 0.95),
    ("apache-2.0", "unless required by applicable law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 0.9),
    ("gpl", "free software", "this (?:program|library|file|package) is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser |affero )?general public license", 0.95),
    ("lgpl", "lesser general public", "you should have received a copy of the gnu lesser general public license along with", 0.95),
    ("agpl-3.0", "affero general public", "you should have received a copy of the gnu affero general public license along with", 0.95),
    ("mpl-2.0", "this source code form", "this source code form is subject to the terms of the mozilla public license v 2 0", 1.0),
    ("epl-2.0", "eclipse public", "made available under the terms of the eclipse public license(?: v)? 2 0", 1.0),
    ("epl-1.0", "eclipse public", "made available under the terms of the eclipse public license(?: v)? 1 0", 1.0),
    ("cddl-1.0", "common development", "the contents of this file are subject to the terms of the common development and distribution license", 1.0),
    ("ofl-1.1", "sil open font", "this font software is licensed under the sil open font license", 1.0),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 1.0),
    ("cc0-1.0", "this deed has dedicated", "the person who associated a work with this deed has dedicated the work to the public domain", 1.0),
    ("wtfpl", "this license document", "everyone is permitted to copy and distribute verbatim or modified copies of this license document", 0.6),
    ("gpl-2.0", "either version 2 of the license", "either version 2 of the license or at your option any later version", 0.8),
    ("gpl-3.0", "either version 3 of the license", "either version 3 of the license or at your option any later version", 0.8),
    ("gpl-3.0", "free copyleft license", "the gnu general public license is a free copyleft license for software and other kinds of works", 1.0),
    ("lgpl-2.1", "either version 2 1 of the license", "either version 2 1 of the license or at your option any later version", 0.95),
    ("lgpl-3.0", "incorporates the terms and conditions", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license", 1.0),
    ("agpl-3.0", "remote network interaction", "remote network interaction use with the gnu general public license", 0.95),
    ("gfdl-1.3", "free documentation license", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 1.0),
    ("apache-2.0", "in compliance with the license", "you may not use this file except in compliance with the license", 0.9),
    ("apache-1.1", "may not be called apache", "products derived from this software may not be called apache nor may apache appear in their name", 0.95),
    ("x11", "x consortium", "the name of the x consortium shall not be used in advertising or otherwise to promote the sale use or other dealings in this software", 1.0),
    ("isc", "disclaims all warranties", "the software is provided as is and the author disclaims all warranties with regard to this software", 0.8),
    ("bsd-2-clause", "redistributions of source code", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 0.8),
    ("zlib", "origin of this software", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", 1.0),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", 1.0),
    ("boost-1.0", "this entire statement", "the copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies", 1.0),
    ("artistic-2.0", "standard version of this package", "you may distribute verbatim copies of the source form of the standard version of this package in any medium without restriction", 1.0),
    ("python-2.0", "psf hereby grants", "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly", 1.0),
    ("postgresql", "without a written agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", 1.0),
    ("mpl-1.1", "mozilla public license", "the contents of this file are subject to the mozilla public license version 1 1", 1.0),
    ("mpl-2.0", " mpl ", "if a copy of the mpl was not distributed with this file you can obtain one at", 1.0),
    ("eupl-1.2", " eupl ", "licensed under the eupl version 1 [12] (?:only )?or as soon (?:as )?they will be approved by the european commission", 1.0),
    ("odbl-1.0", "open database license", "made available under the open database license", 1.0),
    ("cc-by-4.0", "creative commons", "licensed under (?:a |the )?creative commons attribution 4 0 international licen[sc]e", 1.0),
    ("cc-by-sa-4.0", "creative commons", "licensed under (?:a |the )?creative commons attribution share ?alike 4 0 international licen[sc]e", 1.0),
    ("cc-by-nc-4.0", "creative commons", "licensed under (?:a |the )?creative commons attribution non ?commercial 4 0 international licen[sc]e", 1.0),
    ("cc0-1.0", "neighboring rights", "has waived all copyright and related or neighboring rights to", 0.95),
    ("unlicense", "compiled binary", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary", 1.0),
    ("openrail", "use based restrictions", "the use based restrictions set forth in (?:attachment|paragraph) [^ ]+ (?:must be included|apply)", 0.6),
    ("proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited", 0.9),
    ("no-warranty", "without warranty of any kind", "(?:the software is )?provided as is without warranty of any kind", 0.5),
)
#: Priority of a body sentence: above all names that stand inside it.
BODY_PRIORITY = 6

#: Forms of a rule: (regular expression around a name or identifier, words in front of an identifier or none for a name, priority, confidence).
FORMS = (
    ("spdx license identifier {}", "spdx license identifier", 5, 1.0),
    ("licen[sc]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{}(?: licen[sc]e)?", None, 4, 0.95),
    ("(?:released|distributed|provided|published|available) under (?:the )?(?:terms of (?:the )?)?{}(?: licen[sc]e)?", None, 4, 0.95),
    ("licen[sc]e (?:is )?(?:the )?{}", None, 3, 0.8),
    ("{} licen[sc]e(?: (?:version |v ?)?[0-9](?: [0-9])?)?", None, 3, 0.9),
    ("(?:opensource|creativecommons|spdx) org licenses {}", "org licenses", 3, 0.9),
    ("{}", None, 2, 0.6),
)
#: Names that mean a license only next to the word itself.
_ONLY_WITH_WORD = {"mit", "x11", "isc", "zlib", "boost-1.0", "artistic-2.0", "ofl-1.1", "odbl-1.0", "python-2.0", "postgresql"}

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_MARK = "\u0001"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def rules() -> list[tuple[str, str, str, int, float]]:
    """(keyword, label, regular expression, priority, confidence), families by forms, most telling forms first.

    Every text that the expression can match holds the keyword.
    """
    out = [(keyword, label, f"(?<= )(?:{said})(?= )", BODY_PRIORITY, sure) for label, keyword, said, sure in BODIES]
    names = [(label, f" {k} " if k in ("mit", "isc", "x11") else k, name) for label, k, name, _ in FAMILIES] + list(SHORT)
    for form, front, priority, sure in FORMS:
        for label, keyword, said in [(label, front, spdx) for label, _, _, spdx in FAMILIES] if front else names:
            if form == "{}" and label in _ONLY_WITH_WORD:
                continue
            out.append((keyword, label, f"(?<= )(?:{form.format(said)})(?= )", priority, sure))
    return out


def _count(text: Column) -> Column:
    """Words of a blank-separated text without outer blanks."""
    return F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)


def _starts(words: Column, pattern: Column | str) -> Column:
    """Word positions at which ``pattern`` matches: each match gets a mark in front, which its first word then carries."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    marked = F.regexp_replace(words, pattern, F.lit(_MARK + "$0"))
    at = F.transform(F.split(F.btrim(marked), " ", -1), lambda w, i: F.when(F.startswith(w, F.lit(_MARK)), i))
    return F.filter(at, lambda i: i.isNotNull())


def _detections(words: Column) -> Column:
    """Sorted by start; of equal starts the longest first, then the highest priority."""
    by_key: dict[str, list] = {}
    for keyword, label, pattern, priority, sure in rules():
        by_key.setdefault(keyword, []).append((label, pattern, priority, sure))
    table = F.array(*[
        F.struct(F.lit(k).alias("keyword"), F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("pattern"), F.lit(c).alias("priority"), F.lit(d).alias("sure")) for a, b, c, d in of]).alias("rules"))
        for k, of in by_key.items()
    ])
    run = F.flatten(F.transform(F.filter(table, lambda f: F.contains(words, f["keyword"])), lambda f: f["rules"]))

    def found(rule: Column) -> Column:
        said = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
        return F.when(
            F.size(said) > 0,
            F.transform(
                F.arrays_zip(_starts(words, rule["pattern"]).alias("start"), said.alias("said")),
                lambda x: F.struct(
                    x["start"].alias("start"),
                    (-(x["start"] + _count(x["said"]))).alias("minus_end"),
                    (-rule["priority"]).alias("minus_priority"),
                    rule["label"].alias("label"),
                    rule["sure"].alias("sure"),
                ),
            ),
        )

    return F.array_sort(F.flatten(F.filter(F.transform(run, found), lambda x: x.isNotNull())))


def _kept(found: Column) -> Column:
    """Labels and best confidence of the detections that are not suppressed: one pass with the furthest end by priority."""
    levels = sorted({p for _, _, _, p, _ in rules()})
    start = F.struct(*[F.lit(0).alias(f"e{p}") for p in levels], F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"), F.lit(0).alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        end, priority = -d["minus_end"], -d["minus_priority"]
        covered = F.lit(False)
        for p in levels:
            covered = covered | ((priority <= p) & (acc[f"e{p}"] >= end))
        return F.struct(
            *[F.when(priority == p, F.greatest(acc[f"e{p}"], end)).otherwise(acc[f"e{p}"]).alias(f"e{p}") for p in levels],
            F.when(covered, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(d["label"]))).alias("labels"),
            F.when(covered, acc["score"]).otherwise(F.greatest(acc["score"], d["sure"])).alias("score"),
            F.when(covered, acc["kept"]).otherwise(acc["kept"] + 1).alias("kept"),
        )

    return F.aggregate(found, start, step)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``doc_id, n_words, base_starts, base_labels, detections, labels, n_kept, score`` for each row of ``docs``.

    ``detections`` holds start and end word, label, priority and confidence of every rule's matches, suppressed
    ones included; ``labels`` joins the base labels with those of the detections that stand.
    """
    words = F.regexp_replace(F.concat(F.lit(" "), F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _UPPER.lower()), F.lit(" ")), _BETWEEN, " ")
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), words.alias("words"))
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains("words", F.lit(word))
    blanks = F.length("words") - F.length(F.replace(F.col("words"), F.lit(" "), F.lit("")))
    out = out.select("doc_id", (F.when(F.length("words") > 1, blanks - 1).otherwise(0)).cast("long").alias("n_words"), F.when(gate, F.col("words")).alias("words"))
    base = "(?<= )(?:" + "|".join(BASE) + ")(?= )"
    said = F.array_distinct(F.regexp_extract_all("words", F.lit(base), F.lit(0)))
    name = F.create_map(*[F.lit(x) for pair in BASE.items() for x in pair])
    held = F.col("words").isNotNull()
    out = out.select(
        "doc_id",
        "n_words",
        F.when(held, _starts(F.col("words"), base)).otherwise(F.array().cast("array<int>")).alias("base_starts"),
        F.when(held, F.transform(said, lambda s: F.element_at(name, s))).otherwise(F.array().cast("array<string>")).alias("base_labels"),
        F.when(held, _detections(F.col("words"))).alias("found"),
    )
    out = out.withColumn("end", F.when(F.col("found").isNotNull(), _kept(F.col("found"))))
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id",
        "n_words",
        "base_starts",
        F.array_sort("base_labels").alias("base_labels"),
        F.transform("found", lambda d: F.struct(d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["label"].alias("label"), (-d["minus_priority"]).alias("priority"), d["sure"].alias("sure"))).alias("detections"),
        F.array_sort(F.array_union("base_labels", F.coalesce("end.labels", none))).alias("labels"),
        F.coalesce("end.kept", F.lit(0)).alias("n_kept"),
        F.greatest(F.coalesce("end.score", F.lit(0.0)), F.when(F.size("base_labels") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
