"""Licence scans: n-gram logistic regression with an unknown class, confirmed by templates."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstrata.llm.common import least_hashed

UNKNOWN = "unknown"
# Paragraphs of the corpus that stand for "no licence" when fitting, at most.
MAX_NEGATIVES = 3_000
# An n-gram in more than this share of those paragraphs says nothing about licences.
COMMON = 0.01
MIN_HITS = 2
MIN_PROBABILITY = 0.5
MIN_AGREEMENT = 0.6

# Wording of public licences and their usual notices, by family and version.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    "MIT-0": (
        "Licensed under the MIT No Attribution license.",
        "SPDX-License-Identifier: MIT-0",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Apache-1.1": (
        "Licensed under the Apache Software License, Version 1.1.",
        "SPDX-License-Identifier: Apache-1.1",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "SPDX-License-Identifier: Unlicense",
    ),
}
CONDITIONS = {"": "", "SA": "ShareAlike", "ND": "NoDerivatives", "NC": "NonCommercial"}
for _one, _two in (("", ""), ("SA", ""), ("ND", ""), ("NC", ""), ("NC", "SA"), ("NC", "ND")):
    _short = "-".join(filter(None, ("BY", _one, _two)))
    _long = "-".join(filter(None, ("Attribution", CONDITIONS[_one], CONDITIONS[_two])))
    TEMPLATES[f"CC-{_short}"] = tuple(
        text
        for version in ("4.0", "3.0", "2.5", "2.0")
        for text in (
            f"Licensed under CC {_short} {version}.",
            f"This work is licensed under a Creative Commons {_long} {version} International License.",
        )
    )
# Words that tell these licences and their versions apart. A paragraph and the
# template that confirms it have the same ones.
MARKS = (
    "mit isc apache bsd gnu gpl lgpl agpl lesser library affero cc cc0 creative sharealike sa noncommercial nc "
    "noderivatives noderivs nd attribution mozilla mpl eclipse epl unlicense unencumbered 0 1 2 3 4 5"
).split()


def paragraphs(documents: DataFrame) -> DataFrame:
    """(doc_id, paragraph from 0, line) of every line with a word."""
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    return lines.where(F.col("line").rlike("[A-Za-z0-9]"))


def ngrams(line: Column) -> Column:
    """Distinct hashes of a line's lower-cased words and word pairs."""
    words = F.filter(F.split(F.lower(line), r"[^\p{L}0-9]+"), lambda w: w != "")

    def build(w: Column) -> Column:
        single = F.transform(w, lambda x: F.xxhash64(x))
        shifted = F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0)))
        pairs = F.zip_with(w, shifted, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
        return F.array_distinct(F.array_compact(F.concat(single, pairs)))

    return F.element_at(F.transform(F.array(words), build), 1)


@dataclass(frozen=True)
class LicenceModel:
    """Softmax regression over template n-grams; the last class is unknown."""

    families: tuple[str, ...]
    grams: tuple[int, ...]
    weights: np.ndarray  # grams x classes
    bias: np.ndarray
    temperature: float


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(examples: list[tuple[list[int], str]], families: tuple[str, ...], grams: tuple[int, ...], rounds: int = 400) -> LicenceModel:
    """Fit by gradient steps on the bounded examples; a held-out fifth sets the temperature.

    The temperature is the one of a small grid that gives the held-out examples the highest
    likelihood, so that the unknown class keeps honest probabilities.
    """
    column = {g: i for i, g in enumerate(grams)}
    classes = {name: i for i, name in enumerate((*families, UNKNOWN))}
    # Examples with the same n-grams and class are one with their number as weight: most
    # paragraphs of a corpus share no n-gram with any licence.
    alike = Counter((tuple(sorted(column[g] for g in set(found) if g in column)), classes[name]) for found, name in examples)
    x, y = np.zeros((len(alike), len(grams))), np.zeros((len(alike), len(classes)))
    for i, (found, name) in enumerate(alike):
        x[i, list(found)] = 1
        y[i, name] = 1
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    times = np.array(list(alike.values()), dtype=float)
    share = np.maximum((y * times[:, None]).sum(axis=0), 1)
    weight = times * (y / share).sum(axis=1) * times.sum() / len(classes)
    held = np.arange(len(alike)) % 5 == 4

    def descend(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b = np.zeros((len(grams), len(classes))), np.zeros(len(classes))
        total = weight[rows].sum()
        for _ in range(rounds):
            error = (_softmax(x[rows] @ w + b) - y[rows]) * weight[rows, None] / total
            w -= 4.0 * (x[rows].T @ error + 1e-4 * w)
            b -= 1.0 * error.sum(axis=0)
        return w, b

    w, b = descend(np.flatnonzero(~held))
    grid = (0.5, 0.7, 1.0, 1.4, 2.0)
    likely = [
        float((weight[held, None] * y[held] * np.log(_softmax((x[held] @ w + b) / t) + 1e-12)).sum()) for t in grid
    ]
    w, b = descend(np.arange(len(alike)))
    return LicenceModel(tuple(families), grams, w, b, grid[int(np.argmax(likely))] if held.any() else 1.0)


def _template_rows(spark: SparkSession) -> DataFrame:
    rows = [
        F.struct(F.lit(family).alias("family"), F.lit(text).alias("line"))
        for family, texts in TEMPLATES.items()
        for text in texts
    ]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("grams", ngrams(F.col("line")))


def train(documents: DataFrame, max_negatives: int = MAX_NEGATIVES) -> tuple[LicenceModel, DataFrame]:
    """Learn from the templates, their halves and a bounded sample of the corpus' paragraphs.

    The sample is the distinct paragraphs of least hash; those that agree with a template stand out
    as licences already and are left out of it.
    """
    templates = _template_rows(documents.sparkSession)
    known = [(r["family"], r["grams"]) for r in templates.collect()]
    vocabulary = sorted({g for _, grams in known for g in grams})
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    expected = documents.agg(F.sum(breaks + 1)).first()[0] or 0
    lines = paragraphs(documents).select("line", F.xxhash64("line").alias("by"))
    grams = ngrams(F.col("line")).alias("grams")
    sample = least_hashed(lines.distinct(), "by", ["line"], max_negatives, expected, grams)
    negatives = [r["grams"] for r in sample]

    def agrees(grams: list[int]) -> bool:
        return any(len(set(grams) & set(t)) >= MIN_AGREEMENT * len(set(grams)) for _, t in known)

    negatives = [g for g in negatives if g and not agrees(g)]
    seen = {g: 0 for g in vocabulary}
    for grams in negatives:
        for g in set(grams) & seen.keys():
            seen[g] += 1
    kept = tuple(g for g in vocabulary if seen[g] <= COMMON * len(negatives))
    examples = [(grams, family) for family, grams in known]
    examples += [(part, family) for family, g in known for part in (g[: len(g) // 2], g[len(g) // 2 :], g[::2]) if len(part) > 3]
    examples += [(g, UNKNOWN) for g in negatives]
    # A single n-gram of a template is no evidence.
    examples += [([g], UNKNOWN) for g in kept]
    return fit(examples, tuple(TEMPLATES), kept), templates


def classify(lines: DataFrame, model: LicenceModel, templates: DataFrame) -> DataFrame:
    """doc_id, paragraph, family, probability, agreement of paragraphs that hold a licence.

    All row by row with built-in functions. Paragraphs with fewer than two of the model's
    n-grams are unknown without a score; a predicted family counts if its calibrated
    probability reaches MIN_PROBABILITY and a template of it holds MIN_AGREEMENT of the
    paragraph's n-grams, or the paragraph holds all n-grams of the template. That template
    has the paragraph's own MARKS, so that a name, a condition or a version that disagrees
    leaves the paragraph unknown.
    """
    spark = lines.sparkSession
    known = F.lit(list(model.grams))
    scored = lines.select("doc_id", "paragraph", ngrams(F.col("line")).alias("grams"))
    scored = scored.withColumn("hits", F.array_intersect("grams", known)).where(F.size("hits") >= MIN_HITS)
    names = [f"w{i}" for i in range(len(model.bias))]
    lists = [known.alias("gram"), *[F.lit(w).alias(n) for n, w in zip(names, model.weights.T.tolist())]]
    weights = spark.range(1).select(F.inline(F.arrays_zip(*lists)))
    # Outer, as there is always a hit: the inner form would test the hits twice more.
    exploded = scored.select(
        "doc_id", "paragraph", "grams", F.size("hits").alias("n"), F.explode_outer("hits").alias("gram")
    )
    sums = [(F.sum(n) / F.sqrt(F.first("n")) + float(b)) / model.temperature for n, b in zip(names, model.bias)]
    by_line = exploded.join(F.broadcast(weights), "gram").groupBy("doc_id", "paragraph", "grams")
    logits = by_line.agg(F.array(*sums).alias("z"))
    top = F.array_max("z")
    total = F.aggregate("z", F.lit(0.0), lambda acc, v: acc + F.exp(v - F.array_max("z")))
    classes = F.array(*[F.lit(c) for c in (*model.families, UNKNOWN)])
    guess = logits.select(
        "doc_id",
        "paragraph",
        "grams",
        F.element_at(classes, F.array_position("z", top).cast("int")).alias("family"),
        (1 / total).alias("probability"),
    ).where((F.col("family") != UNKNOWN) & (F.col("probability") >= MIN_PROBABILITY))
    known = templates.groupBy("family").agg(F.collect_list("grams").alias("templates"))
    compared = guess.join(F.broadcast(known), "family")

    marks = F.array(*[F.xxhash64(F.lit(m)) for m in MARKS])

    def shared(t: Column) -> Column:
        both = F.size(F.array_intersect(F.col("grams"), t))
        told = F.array_intersect(marks, F.col("grams")) == F.array_intersect(marks, t)
        share = F.greatest(both / F.size("grams"), F.when(both == F.size(t), 1.0).otherwise(0.0))
        return F.when(told, share).otherwise(0.0)

    agreement = F.array_max(F.transform("templates", shared))
    return compared.select("doc_id", "paragraph", "family", "probability", agreement.alias("agreement")).where(
        F.col("agreement") >= MIN_AGREEMENT
    )


def licences(documents: DataFrame, max_negatives: int = MAX_NEGATIVES) -> DataFrame:
    """One row per paragraph (line) that holds a licence: doc_id, paragraph, family,
    probability, agreement.

    Null, empty and wordless texts have no paragraphs; repeated rows with one doc_id give
    one row per paragraph; a null doc_id is reported as null; other columns are not read;
    an empty table gives an empty result. Texts are read whole, every paragraph is scored.
    """
    model, templates = train(documents, max_negatives)
    return classify(paragraphs(documents), model, templates)
