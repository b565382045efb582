"""Licence notices in documents: Dice coefficient of word bigrams with licence templates.

Every line and every whole text is normalised and compared with the templates.
Dice >= t bounds the sizes: a text of `a` bigrams can only match a template of
`b` if t/(2-t) * b <= a <= (2-t)/t * b, so long and short lines never build
bigrams, and a line is compared only with templates of its size. Templates are a
fixed list in the plan: no join, no shuffle of texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.llm.columns import let

# Usual short notices by licence.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files, to deal in the Software without restriction",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "all-rights-reserved": ("All rights reserved.",),
}
THRESHOLD = 0.8


def bigrams_of(template: str) -> list[str]:
    """Distinct word bigrams of a normalised text, in order."""
    words = re.sub(r"[^a-z0-9]+", " ", template.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Fewest and most bigrams of a text whose Dice coefficient with `size` bigrams may reach the threshold."""
    low = threshold / (2 - threshold)
    return math.ceil(size * low - 1e-9), math.floor(size / low + 1e-9)


def _bigrams(words: Column) -> Column:
    return F.array_distinct(
        F.transform(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
            lambda x, i: F.concat(x, F.lit(" "), F.get(words, i + 1)),
        )
    )


def scanned(
    docs: DataFrame,
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`doc_id, n_notices, licenses, best_license, best_dice`, one row per row of `docs`.

    `n_notices` counts the distinct normalised lines (or the whole text) that
    reach the threshold, `licenses` lists their best licences, sorted and joined
    by commas, and `best_dice` is the highest coefficient (ties: first licence
    name). A null or empty text, or one without a notice, has 0, '' and NULLs.
    Letters are lower-cased, everything but a-z and 0-9 separates words.
    Repeated rows stay; a null `doc_id` stays null; other columns are ignored.
    Templates of fewer than two words never match.
    """
    listed = [(name, grams) for name in sorted(templates) for grams in map(bigrams_of, templates[name]) if grams]
    empty = F.array().cast("array<struct<dice: double, license: string>>")
    bounds = [size_bounds(len(g), threshold) for _, g in listed]
    fewest, most = (min(b[0] for b in bounds), max(b[1] for b in bounds)) if bounds else (0, -1)
    text = F.regexp_replace(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^a-z0-9\n]+", " ")
    distinct_lines = F.array_distinct(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)))

    def best(unit: Column) -> Column:
        def compared(grams: Column) -> Column:
            size = F.size(grams)
            scores = F.array_compact(
                F.array(
                    *[
                        F.when(
                            size.between(*bound),
                            F.struct(
                                (F.lit(2.0) * F.size(F.array_intersect(grams, F.array(*map(F.lit, known)))) / (size + len(known))).alias("dice"),
                                F.lit(name).alias("license"),
                            ),
                        )
                        for (name, known), bound in zip(listed, bounds, strict=True)
                    ]
                )
            )
            good = F.filter(scores, lambda s: s["dice"] >= threshold - 1e-12)
            # Highest coefficient first, then the first licence name.
            return F.get(
                F.array_sort(
                    good,
                    lambda a, b: F.when(a["dice"] > b["dice"], -1)
                    .when(a["dice"] < b["dice"], 1)
                    .when(a["license"] < b["license"], -1)
                    .when(a["license"] > b["license"], 1)
                    .otherwise(0),
                ),
                F.lit(0),
            )

        # Every distinct word but the first begins a new bigram, so v words have v - 1 distinct bigrams at least.
        return let(
            F.split(unit, " "),
            lambda words: F.when(
                (F.size(words) > fewest) & (F.size(F.array_distinct(words)) - 1 <= most),
                let(_bigrams(words), compared),
            ),
        )

    def results(lines: Column) -> Column:
        whole = F.trim(F.regexp_replace(text, "[ \n]+", " "))
        return F.array_compact(F.transform(F.array_distinct(F.concat(lines, F.array(whole))), best))

    hits = let(distinct_lines, results) if listed else empty
    order = lambda h: F.struct((-h["dice"]).alias("d"), h["license"].alias("license"))
    return docs.select("doc_id", hits.alias("hits")).select(
        "doc_id",
        F.size("hits").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["license"]))), ",").alias("licenses"),
        F.array_min(F.transform("hits", order))["license"].alias("best_license"),
        F.round(-F.array_min(F.transform("hits", order))["d"], 6).alias("best_dice"),
    )
