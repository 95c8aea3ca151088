"""Licence notices by a positional index of rare words, in DataFrame expressions only.

The index is data: for each of a template notice's rarest words (by inverse document frequency over the templates) a
posting of template and place. A file's licence words, those with a posting, are looked up from the rarest on; each hit
votes for the place at which its template would begin. Places with enough votes are kept, and the template's key phrase
must then stand in the file, word for word, at its place. Everything is an expression of one row, of one size for any
number of templates: no shuffle, no group, and files without any licence word stop at a few substring tests.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows get equal values; very long
texts are handled whole (votes are sorted, not compared pairwise); other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Label, notice in lower-case words, key phrase that has to stand in it word for word.
TEMPLATES = (
    ("agpl-3.0", "gnu affero general public license as published by the free software foundation either version 3 of the license", "gnu affero general public license as published by the free software foundation either version 3"),
    ("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "may be used to endorse or promote products derived from this software"),
    ("cc-by-4.0", "creative commons attribution 4 0 international license", "creative commons attribution 4 0 international"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike 4 0 international"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0-1.0", "creative commons cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-2.0", "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "gnu general public license as published by the free software foundation either version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-3.0", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gnu general public license as published by the free software foundation either version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("lgpl-2.1", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license", "gnu lesser general public license as published by the free software foundation either version 2 1"),
    ("lgpl-3.0", "gnu lesser general public license as published by the free software foundation either version 3 of the license", "gnu lesser general public license as published by the free software foundation either version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit-notice", "released under the mit license", "under the mit license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", "mozilla public license version 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
)
#: Identifiers that follow "SPDX-License-Identifier:".
SPDX = (
    "0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0",
    "Unlicense", "Zlib",
)
RARE, ENOUGH = 4, 0.75


def notices() -> list[tuple[str, list[str], list[str]]]:
    """Label, words of the notice, words of the key phrase, of all templates."""
    tagged = [(x.lower(), f"spdx license identifier {x.lower().replace('-', ' ').replace('.', ' ')}") for x in SPDX]
    return [*((label, notice.split(), key.split()) for label, notice, key in TEMPLATES), *((label, notice.split(), notice.split()) for label, notice in tagged)]


def index(templates: list[tuple[str, list[str], list[str]]]) -> tuple[dict[str, list[dict]], list[dict]]:
    """Postings (template, place) of the rare words, rarest words first, and of each template its label, votes, key."""
    seen = Counter(w for _, notice, _ in templates for w in set(notice))
    idf = {w: math.log((1 + len(templates)) / n) for w, n in seen.items()}
    postings: dict[str, list[dict]] = {}
    about = []
    for t, (label, notice, key) in enumerate(templates):
        at = next(i for i in range(len(notice)) if notice[i : i + len(key)] == key)
        rare = sorted(range(at, at + len(key)), key=lambda i: (-idf[notice[i]], i))[:RARE]
        for i in rare:
            postings.setdefault(notice[i], []).append({"t": t, "p": i})
        about.append({"label": label, "votes": len(rare), "need": math.ceil(len(rare) * ENOUGH), "at": at, "key": key})
    return dict(sorted(postings.items(), key=lambda x: (-idf[x[0]], x[0]))), about


def gate_words(templates: list[tuple[str, list[str], list[str]]]) -> list[str]:
    """Few words of which each key phrase, and each base phrase, holds one: the most shared go first, short ones last."""
    left = [set(key) for _, _, key in templates] + [set(p.split()) for p in BASE]
    out = []
    while left:
        seen = Counter(w for words in left for w in words if len(w) > 3) or Counter(w for words in left for w in words)
        word = max(sorted(seen, reverse=True), key=lambda w: (seen[w], len(w)))
        out.append(word)
        left = [words for words in left if word not in words]
    return out


def _data(value: object, kind: str) -> Column:
    """A constant of a nested type."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _stands(words: Column, start: Column, phrase: list[str]) -> Column:
    """Whether phrase stands in words from place start on."""
    out = F.lit(True)
    for i, w in enumerate(phrase):
        out = out & F.coalesce(F.get(words, start + i) == w, F.lit(False))
    return out


def scan(docs: DataFrame, templates: list[tuple[str, list[str], list[str]]] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and places: label and first word.

    templates: label, words of a notice, words of the key phrase in it.
    """
    templates = notices() if templates is None else templates
    postings, about = index(templates)
    text = F.coalesce("text", F.lit(""))
    small, gated = F.lower(text), F.lit(False)
    for word in gate_words(templates):
        gated = gated | (small.contains(word) if len(word) > 3 else small.rlike(f"(?<![a-z0-9]){word}(?![a-z0-9])"))
    none = F.array().cast("array<string>")
    words = F.when(gated, F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))).otherwise(none)
    rows = docs.select("doc_id", F.regexp_count(text, F.lit(ANY_CASE)).cast("long").alias("n_words"), words.alias("words"))
    known = sorted({*postings, *(p.split()[0] for p in BASE)})
    marks = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda m: m["w"].isin(known))
    rows = rows.withColumn("marks", F.when(F.size("words") > 0, marks).otherwise(F.array().cast("array<struct<w:string,i:int>>")))

    lists = F.map_from_entries(_data([{"w": w, "l": p} for w, p in postings.items()], "array<struct<w:string,l:array<struct<t:int,p:int>>>>"))
    facts = _data(about, "array<struct<label:string,votes:int,need:int,at:int,key:array<string>>>")
    fact = lambda t: F.get(facts, t)

    def hits(m: Column) -> Column:
        return F.transform(F.coalesce(F.try_element_at(lists, m["w"]), F.array().cast("array<struct<t:int,p:int>>")), lambda p: F.struct(p["t"].alias("t"), (m["i"] - p["p"]).alias("o")))

    def backed(v: Column, i: Column) -> Column:
        """How many votes, of those that its template can have, begin at place i of the sorted votes."""
        more = F.filter(F.sequence(F.lit(1), fact(v["t"])["votes"]), lambda k: F.coalesce(F.get(F.col("votes"), i + k - 1) == v, F.lit(False)))
        return F.struct(v["t"].alias("t"), v["o"].alias("o"), F.size(more).alias("n"))

    def holds(v: Column) -> Column:
        about_it, at = fact(v["t"]), v["o"] + fact(v["t"])["at"]
        return (v["n"] >= about_it["need"]) & (at >= 0) & (F.slice(F.col("words"), F.greatest(at, F.lit(0)) + 1, F.size(about_it["key"])) == about_it["key"])

    rows = rows.withColumn("votes", F.array_sort(F.flatten(F.transform("marks", hits))))
    fresh = F.filter(F.transform("votes", lambda v, i: F.struct(v["t"].alias("t"), v["o"].alias("o"), i.alias("i"))), lambda x: (x["i"] == 0) | (F.get(F.col("votes"), x["i"] - 1) != F.struct(x["t"].alias("t"), x["o"].alias("o"))))
    found = F.filter(F.transform(fresh, lambda x: backed(F.struct(x["t"].alias("t"), x["o"].alias("o")), x["i"])), holds)
    rows = rows.withColumn("found", F.when(F.size("votes") > 0, found).otherwise(F.array().cast("array<struct<t:int,o:int,n:int>>")))

    def base(phrase: str) -> Column:
        first, *rest = phrase.split()
        here = F.filter("marks", lambda m: (m["w"] == first) & _stands(F.col("words"), m["i"] + 1, rest))
        return F.when(F.size("marks") == 0, F.array().cast("array<int>")).otherwise(F.transform(here, lambda m: m["i"]))

    rows = rows.select("doc_id", "n_words", "found", *(base(p).alias(f"base_{b}") for p, b in BASE.items()))
    starts = F.concat(*(F.col(f"base_{b}") for b in BASE.values()))
    mine = F.array_compact(F.array(*(F.when(F.size(f"base_{b}") > 0, F.lit(b)) for b in BASE.values())))
    own = F.transform("found", lambda x: fact(x["t"])["label"])
    shares = F.concat(F.transform("found", lambda x: x["n"] / fact(x["t"])["votes"].cast("double")), F.when(F.size(starts) > 0, F.array(F.lit(0.5))).otherwise(F.array().cast("array<double>")))
    places = F.transform("found", lambda x: F.struct(fact(x["t"])["label"].alias("label"), x["o"].alias("first_word")))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return rows.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"), joined(mine).alias("base_labels"),
        joined(F.concat(mine, own)).alias("labels"), F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"), places.alias("places"),
    )
