"""License scans: lines and whole texts against licence templates; DataFrame functions only.

Text and templates are normalised to lower-case words.  A passage is compared with the templates whose
size the Dice coefficient allows: D = 2 c / (a + b) >= T and c <= min(a, b) bound each size by the other
times (2 - T) / T.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Wordings of common licence notices, by licence and whether reuse is restricted.
TEMPLATES = (
    ("Apache-2.0", False, "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", False, (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    )),
    ("BSD-3-Clause", False, "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", False, "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", True, "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", True, "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", True, "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", True, (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    )),
    ("MIT", False, "Released under the MIT License."),
    ("MIT", False, (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so."
    )),
    ("proprietary", True, "All rights reserved."),
)
NO_WORD = "[^a-z0-9]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NO_WORD), "")


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words; none below two words."""
    n = F.size(words)
    pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(words, i, 2), " "))
    return F.array_distinct(F.when(n > 1, pairs).otherwise(F.array().cast("array<string>")))


def template_bigrams(text: str) -> list[str]:
    clean = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(clean, clean[1:])})


def license_scan(docs: DataFrame, text_col="text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds license, restricted, dice and n_passages to all columns of `docs`.

    The best template over all lines and the whole text (ties: first by licence name); null and 0
    where none reaches the threshold.  n_passages counts the different matching passages.  Null text
    matches nothing.  Columns of `docs` with the added names are replaced.
    """
    added = ("license", "restricted", "dice", "n_passages")
    known = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(bound).alias("restricted"), F.array(*[F.lit(g) for g in grams]).alias("grams"), F.lit(len(grams)).alias("n"))
        for name, bound, grams in ((n, r, template_bigrams(t)) for n, r, t in TEMPLATES)
    ])
    ratio = (2 - threshold) / threshold
    sizes = [len(template_bigrams(t)) for *_, t in TEMPLATES]
    d = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    passages = F.transform(F.concat(F.split(text_col, "\n"), F.array(text_col)), words_of)
    # A passage has at most one bigram less than words: too few words can be left out unseen.
    passages = F.filter(passages, lambda w: F.size(w) > min(sizes) / ratio)
    grams = F.array_distinct(F.transform(passages, bigrams))

    def matches(g):
        fitting = F.filter(known, lambda t: (t["n"] <= F.size(g) * ratio) & (F.size(g) <= t["n"] * ratio))
        return F.filter(F.transform(fitting, lambda t: F.struct(
            (-2.0 * F.size(F.array_intersect(g, t["grams"])) / (F.size(g) + t["n"])).alias("d"),
            t["name"].alias("name"), t["restricted"].alias("restricted"),
        )), lambda m: m["d"] <= -threshold)

    short = F.filter(grams, lambda g: (F.size(g) * ratio >= min(sizes)) & (F.size(g) <= max(sizes) * ratio))
    found = F.filter(F.transform(short, matches), lambda m: F.size(m) > 0)
    d = d.withColumn("lic__found", found)
    best = F.array_min(F.flatten("lic__found"))
    return d.withColumns({
        "license": best["name"], "restricted": F.coalesce(best["restricted"], F.lit(False)),
        "dice": F.coalesce(-best["d"], F.lit(0.0)),
        "n_passages": F.coalesce(F.size("lic__found"), F.lit(0)).cast("long"),
    }).withColumn("n_passages", F.greatest("n_passages", F.lit(0))).drop("lic__found")
