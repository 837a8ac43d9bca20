"""Licence scan by a positional rare-token index over notice templates.

DataFrame expressions only.  The index is small and fixed (templates x words), so it travels as
literals inside the plan; documents never leave their rows.  Words are weighed by inverse document
frequency over the whole corpus.  The two rarest words of each template's mandatory key phrases are
looked up in the postings (word -> template, position); if both agree on the template's start they
propose it there, and the proposal stands if every word of its key phrases stands where the template has
it.  So every template whose key phrases stand in a text is proposed, however long the rest of it is.
The score is the share of the template's weight that stands in place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Label, words of a usual notice, its mandatory key phrases.
NOTICES = (
    ("mit", "mit license", ("mit license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    ("apache", "apache license", ("apache license",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("gpl", "gnu general public license", ("general public license",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", ("general public license",)),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("bsd", "bsd license", ("bsd license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    ("mpl", "subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", ("permission to use copy modify and or distribute",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("boost", "boost software license version 1 0", ("boost software license",)),
    ("epl", "eclipse public license version 2 0", ("eclipse public license",)),
    ("cddl", "common development and distribution license", ("common development and distribution license",)),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution 4",)),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
)
#: Label, words of a whole licence (of a long licence: of the whole notice it asks to be put in files), its mandatory key phrases.
TEXTS = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
        ("permission is hereby granted free of charge", "included in all copies or substantial portions of the software"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
        ("permission to use copy modify and or distribute", "permission notice appear in all copies"),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        ("redistribution and use in source and binary forms", "redistributions in binary form must reproduce the above copyright notice"),
    ),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products derived from this software without specific prior written permission",)),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        ("apache license", "you may not use this file except in compliance with the license"),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version "
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
        ("general public license", "distributed in the hope that it will be useful"),
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version "
        "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license for more details",
        ("lesser general public license", "distributed in the hope that it will be useful"),
    ),
    (
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version "
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero general public license for more details",
        ("affero general public license", "distributed in the hope that it will be useful"),
    ),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ("mozilla public license", "if a copy of the mpl was not distributed with this file")),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means "
        "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors",
        ("free and unencumbered software", "dedicate any and all copyright interest"),
    ),
    (
        "zlib",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
        ("permission is granted to anyone to use this software",),
    ),
    ("boost", "boost software license version 1 0 august 17th 2003 permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", ("boost software license", "covered by this license")),
)
TEMPLATES = NOTICES + TEXTS
#: A document without any of these has no key phrase of any template.
KEY_STEMS = ("licen", "permission", "redistribution", "unencumbered", "commons", "cc")
#: Phrase and label that always count.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(lowered: Column) -> Column:
    return F.filter(F.split(lowered, WORD_GAP), lambda w: w != "")


def _strings(items: list[str]) -> str:
    return "array(" + ", ".join("'" + x + "'" for x in items) + ")"


def _before(spaced: Column) -> Column:
    """Words in a prefix of the spaced text: its spaces after the leading one."""
    return F.regexp_count(spaced, F.lit(" ")).cast("long") - 1


def word_weights(words_df: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """ln((1 + rows) / (1 + rows with the word)) of each licence word over all rows; the collected table has a row a word at most."""
    seen = words_df.select(F.explode(F.array_append(F.array_intersect(F.expr(_strings(vocabulary)), "w"), "")).alias("word"))
    found = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}
    rows = found.get("", 0)  # the mark that every row carries
    return {w: math.log((1 + rows) / (1 + found.get(w, 0))) for w in vocabulary}


def mandatory(text: str, keys: tuple[str, ...]) -> list[int]:
    """Positions in a template that its key phrases cover, each phrase taken where it first stands."""
    ws, out = text.split(), set()
    for ks in (k.split() for k in keys):
        at = next(i for i in range(len(ws)) if ws[i : i + len(ks)] == ks)
        out |= set(range(at, at + len(ks)))
    return sorted(out)


def rare_postings(weight: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """word -> (template, position) of the two rarest mandatory words of each template; ties go by position."""
    out = {}
    for t, (_, text, keys) in enumerate(TEMPLATES):
        ws = text.split()
        for i in sorted(mandatory(text, keys), key=lambda i: -weight[ws[i]])[:2]:
            out.setdefault(ws[i], []).append((t, i))
    return out


def scan_licenses(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Return ``id_col``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels`` and ``labels`` (array<string>, sorted), ``places`` (template number, first word, score), ``score``.

    One row per input row, repeated and null ids included; null text counts as empty (no words, no
    labels, score 0); a-z and A-Z are the only letters that are one (other scripts' capitals stay as they
    are); an empty table gives an empty result.  Only the two named columns are read.
    """
    vocabulary = list(dict.fromkeys(w for _, t, _ in TEMPLATES for w in t.split()))
    low = docs.select(F.col(id_col).alias("__id"), F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, UPPER.lower()).alias("__low"))
    split = low.select("__id", _words(F.col("__low")).alias("w"), F.expr(" or ".join(f"contains(__low, '{s}')" for s in KEY_STEMS)).alias("__key"))
    weight = word_weights(split.select("w"), vocabulary)

    spaced = F.when(F.col("__key"), F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")))
    df = split.select("__id", "w", F.size("w").cast("long").alias("n_words"), spaced.alias("__s"))
    any_phrase = "(?:" + "|".join(p for p, _ in PHRASES) + ")"
    df = df.withColumn("n_base", F.coalesce(F.regexp_count("__s", F.lit(f" {any_phrase}(?= )")), F.lit(0)).cast("long"))
    has = F.col("n_base") > 0
    df = df.withColumns(
        {
            "first_word": F.when(has, _before(F.concat(F.regexp_extract("__s", f"(?s)^(.*?) {any_phrase} ", 1), F.lit(" ")))),
            "last_word": F.when(has, _before(F.concat(F.regexp_extract("__s", f"(?s)^(.*) {any_phrase} ", 1), F.lit(" ")))),
            "base_labels": F.when(has, F.array_sort(F.array_compact(F.array(*[F.when(F.contains("__s", F.lit(f" {p} ")), F.lit(x)) for p, x in PHRASES])))).otherwise(F.array().cast("array<string>")),
        }
    )
    # proposals: (template, start) named by both rare words
    postings = rare_postings(weight)
    table = "map(" + ", ".join(f"'{w}', array({', '.join(f'named_struct("t", {t}, "p", {i})' for t, i in found)})" for w, found in postings.items()) + ")"
    looked = ", ".join(f"'{w}'" for w in postings)
    df = df.withColumn(
        "__hits",
        F.expr(
            f"sort_array(flatten(transform(filter(if(__s is null, null, transform(w, (x, i) -> struct(x, i))), y -> y.x in ({looked})), "
            f"y -> transform(element_at({table}, y.x), q -> named_struct('t', q.t, 'at', y.i - q.p)))))"
        ),
    )
    df = df.withColumn("__open", F.expr("array_distinct(filter(transform(__hits, (h, k) -> if(h = get(__hits, k - 1), h, null)), h -> h is not null))"))
    shapes = []
    for label, text, keys in TEMPLATES:
        ws, must = text.split(), ", ".join(map(str, mandatory(text, keys)))
        total = sum(weight[w] for w in ws) or 1.0
        shares = ", ".join(f"{weight[w] / total if any(weight[x] for x in ws) else 1 / len(ws)}D" for w in ws)
        shapes.append(f"named_struct('label', '{label}', 'ws', {_strings(ws)}, 'share', array({shares}), 'must', array({must}))")
    shape = f"get(array({', '.join(shapes)}), o.t)"
    df = df.withColumn("__tried", F.expr(f"transform(__open, o -> struct(o.t as t, o.at as at, {shape} as s))"))
    df = df.withColumn(
        "places",
        F.expr(
            "transform(filter(__tried, x -> forall(x.s.must, j -> coalesce(get(w, x.at + j) = get(x.s.ws, j), false))), "
            "x -> named_struct('template', x.t, 'label', x.s.label, 'word', x.at, 'score', "
            "round(least(1D, aggregate(transform(x.s.ws, (v, j) -> if(coalesce(get(w, x.at + j) = v, false), get(x.s.share, j), 0D)), 0D, (a, b) -> a + b)), 9)))"
        ),
    )
    places = F.coalesce("places", F.expr("cast(array() as array<struct<template:int,label:string,word:int,score:double>>)"))
    return df.select(
        F.col("__id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        F.array_sort(F.array_union("base_labels", F.transform(places, lambda p: p.label))).alias("labels"),
        places.alias("places"),
        F.coalesce(F.array_max(F.transform(places, lambda p: p.score)), F.lit(0.0)).alias("score"),
    )
