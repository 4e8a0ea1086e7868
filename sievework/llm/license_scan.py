"""Licence scans with a positional rare-token index, in DataFrame operations.

The index holds, for each word of the licence templates, where it stands in which template. A
file looks up all its licence words (weighted by inverse document frequency, counted over the whole
corpus; words that stand in too many documents aren't indexed), subtracts template places from file places, and sums the frequencies' weight of words
that agree on one relative position. Where enough of a template's weight agrees, the template's
mandatory key phrase is checked word by word at the place found, and its label is given.

Defined results: a null or empty text has no words, places or labels and score 0; ``first_word``
and ``last_word`` are null without a base phrase. Repeated rows are scanned each for itself. Very
long texts are scanned whole, in time about proportional to their words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and labels of the base scan (fixed values).
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Label: template words, mandatory key phrase within them.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0", "apache license version 2 0"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "source and binary forms"),
    "cc-by-4.0": ("licensed under cc by 4 0", "cc by 4 0"),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", "cc by nc 4 0"),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", "cc by sa 4 0"),
    "gpl-2.0": ("this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    "lgpl": ("under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    "mit-release": ("released under the mit license", "mit license"),
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    # parts of whole licence texts and notices
    "apache-2.0-notice": (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        "except in compliance with the license",
    ),
    "bsd-3-clause": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "endorse or promote products derived from this software",
    ),
    "bsd-disclaimer": (
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
        "and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages "
        "including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability "
        "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
        "procurement of substitute goods or services",
    ),
    "bsl-1.0": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software "
        "to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software",
        "any person or organization obtaining a copy",
    ),
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "under the terms of the gnu general public license",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice "
        "and this permission notice appear in all copies",
        "with or without fee is hereby granted",
    ),
    "mit-conditions": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
        "arising from out of or in connection with the software or the use or other dealings in the software",
        "all copies or substantial portions of the software",
    ),
    # how the licence texts themselves begin
    "agpl": ("under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    "agpl-3.0-text": ("gnu affero general public license version 3 19 november 2007 copyright c 2007 free software foundation inc", "gnu affero general public license version 3"),
    "apache-2.0-text": (
        "apache license version 2 0 january 2004 http www apache org licenses terms and conditions for use reproduction and distribution 1 definitions "
        "license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document",
        "terms and conditions for use reproduction and distribution",
    ),
    "cc-by-4.0-text": ("creative commons attribution 4 0 international public license by exercising the licensed rights defined below", "attribution 4 0 international public license"),
    "cc-by-nc-4.0-text": ("creative commons attribution noncommercial 4 0 international public license by exercising the licensed rights defined below", "attribution noncommercial 4 0 international public license"),
    "cc-by-sa-4.0-text": ("creative commons attribution sharealike 4 0 international public license by exercising the licensed rights defined below", "attribution sharealike 4 0 international public license"),
    "gpl-2.0-text": ("gnu general public license version 2 june 1991 copyright c 1989 1991 free software foundation inc", "gnu general public license version 2 june 1991"),
    "gpl-3.0-text": ("gnu general public license version 3 29 june 2007 copyright c 2007 free software foundation inc", "gnu general public license version 3 29 june 2007"),
    "lgpl-2.1-text": ("gnu lesser general public license version 2 1 february 1999 copyright c 1991 1999 free software foundation inc", "gnu lesser general public license version 2 1"),
    "lgpl-3.0-text": ("gnu lesser general public license version 3 29 june 2007 copyright c 2007 free software foundation inc", "gnu lesser general public license version 3"),
    "mpl-2.0-text": (
        "mozilla public license version 2 0 1 definitions 1 1 contributor means each individual or legal entity that creates contributes to the creation of or owns covered software",
        "contributes to the creation of or owns covered software",
    ),
    "wtfpl": ("everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", "changing it is allowed as long as the name is changed"),
    "zlib": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
        "alter it and redistribute it freely",
    ),
    "unlicense": ("this is free and unencumbered software released into the public domain", "free and unencumbered software"),
}
#: Share of a template's weight that must agree on one relative position.
LEAST_SHARE = 0.6
#: Words more frequent than this share of documents aren't in the index.
COMMON = 0.05


def licence_words() -> list[str]:
    return sorted({w for t, _ in TEMPLATES.values() for w in t.split()} | {p.split()[0] for p in BASE_PHRASES})


def file_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), "")


def inverse_frequencies(docs: DataFrame) -> dict[str, float]:
    """IDF of each licence word over all documents; the result has one number a licence word."""
    known = licence_words()
    rows = docs.select(F.explode(F.array_distinct(F.filter(file_words(F.col("text")), lambda w: w.isin(known)))).alias("word"))
    found = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = docs.count()
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) for w in known}


def _is(words: str, at: Column, phrase: str) -> Column:
    """Whether the phrase's words stand at ``at`` (from 0)."""
    parts = phrase.split()
    same = F.slice(words, F.greatest(at, F.lit(0)).cast("int") + 1, len(parts)) == F.array(*[F.lit(p) for p in parts])
    return (at >= 0) & same


def _base_places(phrase: str, label: str) -> Column:
    here = F.filter("_at", lambda x: (x["w"] == phrase.split()[0]) & _is("_words", x["i"], phrase))
    return F.transform(here, lambda x: F.struct(x["i"].cast("long").alias("i"), F.lit(label).alias("label")))


def scan(docs: DataFrame, keep: list[str], idf: dict[str, float] | None = None) -> DataFrame:
    """``keep``, ``n_words, n_base, first_word, last_word, base_labels, labels, score`` and ``found``:
    an array of (label, place, share) for the templates that were verified.

    ``score`` is the largest verified share; 0.5 where only a base phrase was found; else 0.
    Input columns of these names give way.
    """
    idf = inverse_frequencies(docs) if idf is None else idf
    rarest = -math.log(COMMON)
    index = {w: v for w, v in idf.items() if v >= rarest}
    for label, (template, _) in TEMPLATES.items():
        # a template whose words are all common is looked up by its three rarest
        if not any(w in index for w in template.split()):
            for w in sorted(set(template.split()), key=lambda w: -idf[w])[:3]:
                index[w] = idf[w]
    names = sorted(TEMPLATES)
    weight = {k: sum(max(index[w], 1e-6) for w in TEMPLATES[k][0].split() if w in index) for k in names}
    postings = {w: [(names.index(k), i) for k in names for i, x in enumerate(TEMPLATES[k][0].split()) if x == w] for w in index}
    postings = {w: p for w, p in postings.items() if p}
    order = sorted(postings, key=lambda w: (-index[w], w))
    starts = [p.split()[0] for p in BASE_PHRASES]
    wanted = sorted({*postings, *starts})

    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found"]
    rows = docs.select(F.struct(*[c for c in keep if c not in added]).alias("_row"), file_words(F.col("text")).alias("_words"))
    keep = ["_row"]
    at = F.filter(F.transform("_words", lambda w, i: F.when(w.isin(wanted), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())
    rows = rows.select(*keep, "_words", F.size("_words").cast("long").alias("n_words"), at.alias("_at"))

    base = [_base_places(p, k) for p, k in BASE_PHRASES.items()]
    rows = rows.select(*keep, "_words", "n_words", "_at", F.concat(*base).alias("_base"))
    entry = lambda k, i, w: f"named_struct('k', {k}, 'i', {i}, 'v', {max(index[w], 1e-6)!r}D)"
    # as SQL text: the words are letters and digits, and a call for each of the postings would take the driver seconds
    lookup = F.expr("map(" + ", ".join(f"'{w}', array({', '.join(entry(k, i, w) for k, i in postings[w])})" for w in order) + ")")
    placed = lambda x: F.transform(lookup[x["w"]], lambda e: F.struct(e["k"].alias("k"), (x["i"] - e["i"]).alias("rel"), e["v"].alias("v")))
    agree = F.sort_array(F.flatten(F.transform(F.filter("_at", lambda x: x["w"].isin(order)), placed)))
    rows = rows.select(*keep, "_words", "n_words", "_base", agree.alias("_agree"))
    differs = lambda x, i: F.coalesce((F.get("_agree", i - 1)["k"] != x["k"]) | (F.get("_agree", i - 1)["rel"] != x["rel"]), F.lit(True))
    firsts = F.filter(F.transform("_agree", lambda x, i: F.when(differs(x, i), i)), lambda i: i.isNotNull())
    rows = rows.select(*keep, "_words", "n_words", "_base", "_agree", firsts.alias("_firsts"))
    run = lambda i, j: F.slice("_agree", i + 1, F.coalesce(F.get("_firsts", j + 1), F.size("_agree")) - i)
    total = lambda i, j: F.aggregate(run(i, j), F.lit(0.0), lambda a, x: a + x["v"])
    weights = F.array(*[F.lit(float(weight[k]) or 1.0) for k in names])
    runs = F.transform("_firsts", lambda i, j: F.struct(F.get("_agree", i)["k"].alias("k"), F.get("_agree", i)["rel"].alias("rel"), F.least(F.lit(1.0), total(i, j) / F.element_at(weights, F.get("_agree", i)["k"] + 1)).alias("share")))
    rows = rows.select(*keep, "_words", "n_words", "_base", F.filter(runs, lambda x: x["share"] >= LEAST_SHARE).alias("_runs"))

    def verified(x: Column) -> Column:
        out = F.lit(False)
        for k, name in enumerate(names):
            template, phrase = TEMPLATES[name]
            offset = template.split().index(phrase.split()[0])
            offset = next(i for i in range(offset, len(template.split())) if template.split()[i : i + len(phrase.split())] == phrase.split())
            out = F.when(x["k"] == k, _is("_words", x["rel"] + offset, phrase)).otherwise(out)
        return out

    label_of = F.array(*[F.lit(k) for k in names])
    found = F.transform(F.filter("_runs", verified), lambda x: F.struct(F.element_at(label_of, x["k"] + 1).alias("label"), x["rel"].cast("long").alias("place"), x["share"].alias("share")))
    rows = rows.select(*keep, "n_words", "_base", found.alias("found"))
    base_labels = F.array_sort(F.array_distinct(F.transform("_base", lambda x: x["label"])))
    own = F.transform("found", lambda x: x["label"])
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.when(F.size("_base") > 0, 0.5), F.lit(0.0))
    return rows.select(
        "_row.*",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(F.transform("_base", lambda x: x["i"])).alias("first_word"),
        F.array_max(F.transform("_base", lambda x: x["i"])).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, own)), ",").alias("labels"),
        best.alias("score"),
        "found",
    )
