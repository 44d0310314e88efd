"""License scan: MinHash bands retrieve templates for text windows, exact containment verifies them.

Templates are grouped by size: a group's windows hold one and a half times its largest template and start
every half template, so each stretch as long as a template lies whole in some window. A window that
holds ``CONTAINED`` of a template then has a Jaccard likeness of at least 0.25 with it. With one hash a band and
``BANDS`` bands, the two meet in some band with a probability of at least 1 - 0.75^24 = 0.999. Windows and templates are joined on
size, band and hash; a pair that agrees in several bands goes on from the first of them. Every such
pair is checked exactly: the share of the template's five-word shingles that the window holds.

A window without any shingle of any template cannot pass, so it is dropped before it is hashed; that loses
nothing and leaves few windows. All of it is DataFrame functions, and nothing but findings is shuffled. The templates' bands are broadcast, ``BANDS`` rows for
each template of the tuple that the caller passes; more than ``BROADCAST_TEMPLATES`` are joined without.

Versions of one license share most of their words. Of a family (``FAMILIES``), a document's finding that is not contained wholly goes if another version is
contained better.

Defined cases: null text is empty. A text of fewer words than a shingle has no finding. Rows of one doc_id give
one row per license, with the best window, the first of equals; a null doc_id stays null. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SHINGLE_WORDS, SIMILAR, picked_hashes, text_or_empty, words

BANDS = 24
CONTAINED = SIMILAR
BROADCAST_TEMPLATES = 5_000

# Names that begin alike are versions of one license.
FAMILIES = ("AGPL", "LGPL", "GPL", "MPL", "EPL", "BSD", "CC-BY-NC-SA", "CC-BY-NC", "CC-BY-SA", "CC-BY-ND", "CC-BY", "CC0")

# Public license notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License",
    ),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("EPL-1.0", "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\")"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable"),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license",
    ),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License"),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
)


def family(license_: str) -> str:
    """The first of ``FAMILIES`` that the name begins with and that a version follows, else the name itself."""
    return next((f for f in FAMILIES if license_ == f or re.fullmatch(re.escape(f) + r"-[\d.]+", license_)), license_)


def template_shingles(text: str) -> list[str]:
    found = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return sorted({" ".join(found[i : i + SHINGLE_WORDS]) for i in range(len(found) - SHINGLE_WORDS + 1)})


def _group(n: int) -> int:
    """The power of two that holds ``n`` shingles."""
    return 1 << (n - 1).bit_length()


def window_size(group: int) -> int:
    return group + group // 2


def window_step(group: int) -> int:
    return max(1, group // 2)


def _bands(shingles: str):
    def least(band: int):
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(F.lit(band), s)))

    return F.array(*(least(b) for b in range(BANDS)))


def _shingled(df: DataFrame, keep: list[str]) -> DataFrame:
    hashed = df.select(*keep, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    return hashed.select(*keep, picked_hashes("hashes", list(range(SHINGLE_WORDS)), 0).alias("shingles"))


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """doc_id, license, containment, first_word of the best window; one row per document and license."""
    spark = docs.sparkSession
    sized = [(n, name, text, _group(len(template_shingles(text)))) for n, (name, text) in enumerate(templates)]
    known = _shingled(
        spark.createDataFrame([(*r, family(r[1])) for r in sized], "template int, license string, text string, size int, family string"),
        ["template", "license", "size", "family"],
    ).withColumn("shingles", F.array_distinct("shingles"))
    # as many values as the fixed templates have words
    all_shingles = F.array(*(F.lit(r[0]) for r in known.select(F.explode("shingles")).distinct().orderBy("col").collect()))

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    texts = _shingled(texts, ["doc_id"])

    def windows(group: int):
        def window(at):
            held = F.array_distinct(F.slice("shingles", at + 1, F.lit(window_size(group))))
            return F.struct(F.lit(group).alias("size"), at.alias("first_word"), held.alias("window"))

        starts = F.sequence(F.lit(0), F.size("shingles") - 1, F.lit(window_step(group)))
        return F.filter(F.transform(starts, window), lambda w: F.arrays_overlap(w["window"], all_shingles))

    groups = sorted({s for *_, s in sized})
    # no filter, and an outer generator: either would be tested below, where each text is shingled again
    held = F.when(F.arrays_overlap("shingles", all_shingles), F.concat(*map(windows, groups)))
    windowed = texts.select("doc_id", F.explode_outer(held).alias("w")).filter("w IS NOT NULL").select("doc_id", "w.*")
    signed = windowed.select("*", _bands("window").alias("bands")).select("*", F.posexplode("bands").alias("band", "hash"))
    retrieved = known.select("template", "license", "family", "size", "shingles", _bands("shingles").alias("template_bands"))
    retrieved = retrieved.select("*", F.posexplode("template_bands").alias("band", "hash"))
    if len(templates) <= BROADCAST_TEMPLATES:
        retrieved = F.broadcast(retrieved)
    # a window that meets a template in several bands is one candidate, in the first of them
    agree = F.zip_with("bands", "template_bands", lambda a, b: a == b)
    candidates = signed.join(retrieved, ["size", "band", "hash"]).filter(F.array_position(agree, True) == F.col("band") + 1)
    contained = F.size(F.array_intersect("window", "shingles")) / F.size("shingles")
    best = F.max(F.struct("containment", (-F.col("first_word")).alias("at"))).alias("best")
    return (
        candidates.withColumn("containment", contained)
        .filter(F.col("containment") >= CONTAINED)
        .groupBy("doc_id", "license", "family")
        .agg(best)
        # a row for each license of a document is left
        .withColumn("most", F.max("best.containment").over(Window.partitionBy("doc_id", "family")))
        .filter((F.col("best.containment") == 1) | (F.col("best.containment") == F.col("most")))
        .select("doc_id", "license", "best.containment", (-F.col("best.at")).alias("first_word"))
    )


def _sql() -> str:
    rows = []
    for n, (name, text) in enumerate(TEMPLATES):
        found = template_shingles(text)
        g = _group(len(found))
        rows += [f"({n}, '{name}', '{family(name)}', {len(found)}, {window_size(g)}, {window_step(g)}, '{s}')" for s in found]
    return rf"""
WITH t(template, license, family, n, size, step, shingle) AS (VALUES {", ".join(rows)}
), d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, p, m, w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] || ' ' || w[p + 4] || ' ' || w[p + 5] AS shingle
  FROM (SELECT doc_id, w, len(w) - {SHINGLE_WORDS - 1} AS m, unnest(range(len(w) - {SHINGLE_WORDS - 1})) AS p
        FROM d WHERE len(w) >= {SHINGLE_WORDS})
), h AS (
  SELECT doc_id, template, license, family, n, step, shingle,
         unnest(range(greatest(0, -((size - 1 - p) // step)), p // step + 1)) AS k, p, size
  FROM s JOIN t USING (shingle)
), v AS (
  SELECT doc_id, license, family, k * step AS first_word, count(DISTINCT shingle) / n AS containment
  FROM h WHERE k * step <= p AND p < k * step + size
  GROUP BY doc_id, license, family, template, n, step, k HAVING count(DISTINCT shingle) >= {CONTAINED} * n
), r AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY containment DESC, first_word) AS r,
    max(containment) OVER (PARTITION BY doc_id, family) AS most FROM v
)
SELECT doc_id, license, containment, CAST(first_word AS INTEGER) AS first_word FROM r WHERE r = 1 AND (containment = 1 OR containment = most)
"""


SQL = _sql()
