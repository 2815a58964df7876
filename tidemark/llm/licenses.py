"""License scans with DataFrame functions only.

Texts become lower-case alphanumeric words and five-word shingles. Templates
of about one length share a window size of twice that length, stepped by the
length, so every occurrence lies whole in some window. A window's MinHash
values (bands of one row) retrieve templates; the number of bands makes a
window that contains ``CONTAINMENT`` of a template collide with probability
``RECALL`` at least. The exact share of the template's shingles found in the
window decides.

Windows without any shingle of a template of their size cannot match and are
dropped before hashing. Only retrieved windows are shuffled, to find the best
of each document and template; the templates are fixed values of known size.

Defined cases: null and short texts have no shingles and no match; repeated
rows are scanned one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
RECALL = 0.999

#: Notices by which public licenses are stated.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain.",
}


def alnum_words(text: Column) -> Column:
    """Lower-case alphanumeric words of a text (none if too few for a shingle)."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return F.when(F.size(words) >= SHINGLE, words).otherwise(F.array().cast("array<string>"))


def _runs(words: Column) -> Column:
    return F.when(F.size(words) >= SHINGLE, F.transform(F.sequence(F.lit(1), F.size(words) - SHINGLE + 1),
                                                        lambda k: F.xxhash64(F.slice(words, k, SHINGLE)))).otherwise(F.array().cast("array<bigint>"))


def bands_needed(share: float) -> int:
    """Bands of one row that collide with probability ``RECALL`` at a Jaccard similarity."""
    return math.ceil(math.log(1 - RECALL) / math.log(1 - min(share, 1 - 1e-9)))


def _signature(shingles: Column, bands: int) -> Column:
    """MinHash values, each mixed with its band number."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                       lambda j: F.xxhash64(j, F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, j)))))


def _literal(values: list[int]) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values))


class Template:
    def __init__(self, name: str, words: int, shingles: list[int]):
        self.name, self.words = name, words
        self.shingles = sorted(set(shingles))
        # Words of the window step: lengths within a quarter share one.
        self.step = math.ceil(1.25 ** math.ceil(round(math.log(max(words, SHINGLE), 1.25), 9)))
        found, window = math.ceil(CONTAINMENT * len(self.shingles)), 2 * self.step - SHINGLE + 1
        self.jaccard = found / (window + len(self.shingles) - found)


def templates(spark: SparkSession, texts: dict[str, str]) -> list[Template]:
    """Shingles of the templates, by the same functions as the documents'."""
    rows = spark.createDataFrame(list(texts.items()), "name string, text string").withColumn("words", alnum_words(F.col("text")))
    return [Template(r["name"], r["n"], r["h"]) for r in rows.select("name", F.size("words").alias("n"), _runs(F.col("words")).alias("h")).collect() if r["h"]]


def _windows(step: int, wanted: list[int]) -> Column:
    """Step, first word and shingles of the windows with any wanted shingle."""
    starts = F.sequence(F.lit(0), F.floor((F.size("h") - 1) / step).cast("int"))
    windows = F.transform(starts, lambda k: F.struct(F.lit(step).alias("step"), (k * step).alias("at"),
                                                     F.slice("h", k * step + 1, 2 * step - SHINGLE + 1).alias("h")))
    return F.filter(windows, lambda x: F.arrays_overlap(x["h"], _literal(wanted)))


def _once(value: Column) -> Column:
    """A generator of one row: keeps the optimizer from repeating a costly value."""
    return F.explode(F.array(value))


def scan(docs: DataFrame, texts: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, template, containment, first_word`` of the best window of each match."""
    spark = docs.sparkSession
    known = templates(spark, TEMPLATES if texts is None else texts)
    steps = {step: [t for t in known if t.step == step] for step in sorted({t.step for t in known})}
    bands = {step: max(bands_needed(t.jaccard) for t in mine) for step, mine in steps.items()}
    signature = F.coalesce(*(F.when(F.col("step") == step, _signature(F.col("h"), n)) for step, n in bands.items()))
    # One row for each template and band: a fixed number.
    named = spark.createDataFrame([(t.name, t.step, t.shingles) for t in known], "template string, step int, h array<long>")
    keyed = F.broadcast(named.select("template", "step", F.col("h").alias("template_h"), F.explode(signature).alias("key")))

    rows = (docs.select("doc_id", F.monotonically_increasing_id().alias("row"), _once(alnum_words(F.col("text").cast("string"))).alias("words"))
            .select("doc_id", "row", _once(_runs(F.col("words"))).alias("h"))
            .where(F.arrays_overlap("h", _literal(sorted({h for t in known for h in t.shingles})))))
    near = F.concat(*(_windows(step, sorted({h for t in mine for h in t.shingles})) for step, mine in steps.items()))
    windows = rows.select("doc_id", "row", F.explode(near).alias("w")).select("doc_id", "row", "w.*")
    retrieved = windows.select("doc_id", "row", "at", "h", "step", F.explode(signature).alias("key")).join(keyed, ["step", "key"])
    share = F.size(F.array_intersect("h", "template_h")) / F.size("template_h")
    best = (retrieved.groupBy("row", "doc_id", "template")
            .agg(F.max(F.struct(share.alias("containment"), (-F.col("at")).alias("back"))).alias("best")))
    return best.where(F.col("best.containment") >= CONTAINMENT).select(
        "doc_id", "template", F.col("best.containment").alias("containment"), (-F.col("best.back")).alias("first_word"))
