"""License scan: exact set-similarity join of text blocks and templates.

A block is a run of consecutive words of the whole text, wherever its lines end,
and at most the template's number of words / ``THRESHOLD`` long.  It matches
when it holds at least ``THRESHOLD`` of the template's distinct words and the
words that tell it from its neighbours (``REQUIRED``).  Template
words are ordered by the number of documents in the whole corpus that hold them.
A text with a matching block must hold one of a template's ``size - needed + 1``
rarest words (prefix filter) and enough of its words at all (length filter); a
block must have enough template words from its first one on (positional filter);
what is left is verified exactly.  The phrase labels are
found beside this at every place where a phrase's words stand consecutively.

Defined cases: null texts are empty; repeated document rows
get equal reports; a null ``doc_id`` is kept; no templates: phrases only; very long
texts are scanned whole; only ``doc_id`` and ``text`` are read, so other columns can't
clash; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidgraph.llm.common import bind, broadcast_if_small, scratch, text_hash, words

# Phrases and their labels; license notices.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation",
    "mit-notice": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files",
}
# Further notices, as their licenses give them.
_GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the {0} General Public "
        "License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any "
        "later version")
_CC = "This work is licensed under a Creative Commons {0} 4.0 International License"
_CC_KINDS = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives",
             "by-nc": "Attribution-NonCommercial", "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
             "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
NOTICES = {
    "agpl-3.0-header": _GPL.format("GNU Affero", "3"),
    "bsd-2-clauses": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-3rd-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission",
    "gpl-2.0-header": _GPL.format("GNU", "2"),
    "gpl-3.0-header": _GPL.format("GNU", "3"),
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
    "your option) any later version",
    "lgpl-3.0-header": _GPL.format("GNU Lesser", "3"),
    "mit-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at",
    **{f"cc-{kind}-4.0-notice": _CC.format(name) for kind, name in _CC_KINDS.items()},
    **{f"cc-{kind}-4.0": f"Licensed under CC {kind.upper()} 4.0" for kind in _CC_KINDS if kind != "by-nc"},
}
# What tells a notice from its neighbours: a block must also hold these words, each phrase's consecutively.
REQUIRED = {
    "agpl-3.0-header": ["gnu affero general public license", "version 3 of the license"],
    "apache-2.0": ["apache license version 2 0"],
    "apache-2.0-header": ["apache license version 2 0"],
    "gpl-2.0-header": ["gnu general public license", "version 2 of the license"],
    "gpl-3.0": ["gnu general public license version 3"],
    "gpl-3.0-header": ["gnu general public license", "version 3 of the license"],
    "gpl-header": ["gnu general public license"],
    "isc": ["this permission notice appear in all copies"],
    "lgpl-2.1-header": ["gnu lesser general public license", "version 2 1 of the license"],
    "lgpl-3.0-header": ["gnu lesser general public license", "version 3 of the license"],
    "mit-full": ["associated documentation files"],
    "mit-notice": ["mit license"],
    "mit-permission": ["associated documentation files"],
    "mpl-2.0": ["mozilla public license v 2 0"],
    **{f"cc-{kind}-4.0-notice": [f"commons {name.lower().replace('-', ' ')} 4 0"] for kind, name in _CC_KINDS.items()},
    **{f"cc-{kind}-4.0": [f"cc {kind.replace('-', ' ')} 4 0"] for kind in _CC_KINDS},
}
THRESHOLD = 0.8


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def template_words(spark, templates: dict[str, str]) -> dict[str, list[str]]:
    """The distinct words of each template (split as texts are)."""
    rows = spark.range(1).select(*[words(F.lit(t)).alias(f"t{i}") for i, t in enumerate(templates.values())]).first()
    found = {name: sorted(set(rows[i])) for i, name in enumerate(templates)} if templates else {}
    return {name: ws for name, ws in found.items() if ws}


def template_sizes(spark, templates: dict[str, str]) -> dict[str, int]:
    """The number of words of each template, repeats counted."""
    rows = spark.range(1).select(*[F.size(words(F.lit(t))).alias(f"t{i}") for i, t in enumerate(templates.values())]).first()
    return {name: rows[i] for i, name in enumerate(templates)} if templates else {}


def _places(w: Column, phrase: str) -> Column:
    parts = phrase.split(" ")
    every = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - len(parts)))

    def here(p: Column) -> Column:
        ok = F.get(w, p) == parts[0]
        for i, x in enumerate(parts[1:], 1):
            ok = ok & (F.get(w, p + i) == x)
        return F.coalesce(ok, F.lit(False))

    # Only texts that hold the phrase's last word are walked through.
    return F.when(F.array_contains(w, parts[-1]), F.filter(every, here)).otherwise(F.array().cast("array<int>"))


def _labelled(places: Column, label: str) -> Column:
    return F.transform(places, lambda at: F.struct(at.alias("at"), F.lit(label).alias("label")))


def word_ranks(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Rank of each template word by its number of documents, rarest first; the
    counts (one per template word) are all that reaches the driver."""
    held = F.array_intersect(words(F.col("text")), _strings(vocabulary))
    rows = docs.select(F.explode_outer(held).alias("word")).where(F.col("word").isNotNull()).groupBy("word").count()
    freq = {r["word"]: r["count"] for r in rows.collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (freq.get(w, 0), w)))}


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
                  phrases: dict[str, str] | None = None, required: dict[str, list[str]] | None = None) -> DataFrame:
    """One report per row of ``docs`` (``doc_id, text``): ``doc_id, n_words,
    n_base, first_word, last_word, base_labels, template_labels, labels`` (arrays)
    and ``score`` (1 with a phrase, else the best containment).  ``required``:
    by template, phrases of its own words that a block must hold (default:
    ``REQUIRED`` with the default templates, none with others)."""
    spark = docs.sparkSession
    phrases = PHRASES if phrases is None else phrases
    chosen = {**TEMPLATES, **NOTICES} if templates is None else templates
    required = (REQUIRED if templates is None else {}) if required is None else required
    sets = template_words(spark, chosen)
    needed = {name: math.ceil(threshold * len(ws) - 1e-9) for name, ws in sets.items()}
    longest = {name: math.ceil(n / threshold - 1e-9) for name, n in template_sizes(spark, chosen).items() if name in sets}
    ranks = word_ranks(docs, sorted({w for ws in sets.values() for w in ws})) if sets else {}
    ordered = {name: sorted(ws, key=ranks.__getitem__) for name, ws in sets.items()}
    prefix = {name: ws[: len(ws) - needed[name] + 1] for name, ws in ordered.items()}
    vocabulary, rare = _strings(sorted(ranks, key=ranks.__getitem__)), _strings(
        sorted({w for ws in prefix.values() for w in ws}))

    def candidates(held: Column) -> Column:
        """The templates that a text with these template words may hold."""
        near = [F.when(F.arrays_overlap(held, _strings(prefix[name]))
                       & (F.size(F.array_intersect(held, _strings(ordered[name]))) >= needed[name]), F.lit(name))
                for name in ordered]
        return F.array_compact(F.array(*near)) if near else F.array().cast("array<string>")

    def report(w: Column) -> Column:
        places = [_labelled(_places(w, phrase), label) for phrase, label in phrases.items()]
        every = F.transform(w, lambda x, i: F.struct(i.alias("at"), x.alias("word")))
        hits = F.filter(every, lambda h: F.array_contains(vocabulary, h["word"]))
        near = bind(F.array_intersect(vocabulary, w), candidates)
        near = bind(F.when(F.arrays_overlap(w, rare), near), lambda names: F.when(F.size(names) > 0, F.struct(
            names.alias("names"), hits.alias("hits"))))
        return F.struct(F.size(w).cast("bigint").alias("n_words"), F.concat(*places).alias("places"), near.alias("near"))

    scan = docs.select("doc_id", text_hash(F.col("text")).alias("xh"),
                       bind(words(F.coalesce("text", F.lit(""))), report).alias("r"))
    scan = scratch(scan.select("doc_id", "xh", "r.*"), "license-scan")

    index = spark.createDataFrame(
        [(name, ordered[name], needed[name], longest[name], [p.split(" ") for p in required.get(name, [])]) for name in ordered],
        "template string, t_words array<string>, needed int, longest int, required array<array<string>>")
    cand = scan.where(F.col("near").isNotNull()).select("doc_id", "xh", "near.hits", F.explode("near.names").alias("template"))
    cand = cand.join(F.broadcast(index), "template")  # as many rows as the few candidates of each text
    own = F.filter("hits", lambda h: F.array_contains(F.col("t_words"), h["word"]))

    def best(hits: Column) -> Column:
        """The most distinct template words of a block, over all that start with one."""
        def holds(run: Column, p: Column) -> Column:
            starts = F.filter(F.transform(run, lambda x, j: F.struct(x.alias("x"), j.alias("j"))),
                              lambda s: s["x"]["word"] == F.get(p, F.lit(0)))
            return F.exists(starts, lambda s: (F.slice(run, s["j"] + 1, F.size(p))["word"] == p)
                            & (F.get(run, s["j"] + F.size(p) - 1)["at"] == s["x"]["at"] + F.size(p) - 1))

        def block(h: Column, i: Column) -> Column:
            last = F.get(hits, i + F.col("needed") - 1)["at"]
            run = F.filter(F.slice(hits, i + 1, F.col("longest")), lambda x: x["at"] < h["at"] + F.col("longest"))
            shared = bind(run, lambda r: F.when(F.forall("required", lambda p: holds(r, p)), F.size(F.array_distinct(r["word"]))))
            return F.when(last < h["at"] + F.col("longest"), shared).otherwise(0)
        return F.array_max(F.transform(hits, block))

    match = cand.select("doc_id", "xh", "template", "needed", F.size("t_words").alias("t_size"), bind(own, best).alias("shared"))
    match = match.where(F.col("shared") >= F.col("needed"))
    match = (match.groupBy("doc_id", "xh").agg(F.collect_set("template").alias("found"),
                                               F.max(F.col("shared") / F.col("t_size")).alias("best")))
    match = scratch(match.select(F.col("doc_id").alias("__id"), F.col("xh").alias("__xh"), "found", "best"), "license-hits")

    out = scan.join(broadcast_if_small(match), F.col("doc_id").eqNullSafe(F.col("__id"))
                    & (F.col("xh") == F.col("__xh")), "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    base = F.array_sort(F.array_distinct(F.col("places.label").cast("array<string>")))
    n_base = F.size("places").cast("bigint")
    return out.select("doc_id", "n_words", n_base.alias("n_base"),
                      F.array_min("places.at").cast("bigint").alias("first_word"),
                      F.array_max("places.at").cast("bigint").alias("last_word"), base.alias("base_labels"),
                      F.array_sort(found).alias("template_labels"),
                      F.array_sort(F.array_union(base, found)).alias("labels"),
                      F.when(n_base > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
