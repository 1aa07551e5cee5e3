"""License texts inside documents: MinHash bands over overlapping windows, then exact containment.

A template with L shingles belongs to the class c, the power of two from L
on. Windows of a class are c + c/2 shingles wide and c/2 apart, so any run of
c shingles lies whole in one window. A window that holds 80 % of a template
has a Jaccard similarity of at least ``LEAST_SIMILARITY`` with it, and bands of
one minhash each are as many as bring the chance of a miss under ``MISS``.

A window without any shingle of a template can't share a minhash with one, so
bands are computed only where a template's shingle occurs. Candidates are
verified by counting the template's shingles in the window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkclaims.storage import local_table, materialize

SHINGLE = 5
CONTAINED = 0.8
MISS = 1e-6
# 0.8 L of L + 1.5 c - 0.8 L shingles at L = c / 2, the worst length of a class.
LEAST_SIMILARITY = 0.25
BANDS = math.ceil(math.log(MISS) / math.log(1 - LEAST_SIMILARITY))
SEPARATOR = "[^0-9a-z]+"

# Notices of public licenses.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
    "International License.",
    "CC-BY-ND-4.0 notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
    "International License.",
    "CC-BY-NC-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
    "International License.",
    "CC-BY-NC-ND-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
    "International License.",
    "CC-BY-4.0 short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0 short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0 short": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0 short": "Licensed under CC0 1.0.",
    "CC0-1.0 waiver": "has waived all copyright and related or neighboring rights to",
    # The words that set these apart: their further text is also that of the GPL or BSD-2-Clause.
    "LGPL notice": "under the terms of the GNU Lesser General Public License as published by",
    "AGPL notice": "under the terms of the GNU Affero General Public License as published by",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
    "binary, for any purpose, commercial or non-commercial, and by any means.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
    "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the Software.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above "
    "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form "
    "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
    "in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
    'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
    "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
    "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
    "the GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


def license_words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def _shingles(words: Column) -> Column:
    """The hash of each run of five words; none for shorter texts."""
    return F.when(
        F.size(words) >= SHINGLE,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)),
            lambda start: F.xxhash64(F.slice(words, start, SHINGLE)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _bands(shingles: Column) -> Column:
    """The minhash of each band."""
    return F.transform(
        F.array(*[F.lit(seed) for seed in range(BANDS)]),
        lambda seed: F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, seed))),
    )


def template_class(shingles: int) -> int:
    return 1 << (shingles - 1).bit_length()


def stride(width_class: int) -> int:
    return max(1, width_class // 2)


def template_table(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """template, shingles, needed, class. A template needs five words at least."""
    rows = local_table(
        spark, {"template": list(templates), "text": list(templates.values())}, "template string, text string"
    )
    sets = rows.select("template", license_words(F.col("text")).alias("words")).select(
        "template", F.array_distinct(_shingles(F.col("words"))).alias("shingles")
    )
    count = F.size("shingles")
    return sets.filter(count > 0).select(
        "template",
        "shingles",
        count.alias("needed"),
        F.pow(F.lit(2), F.ceil(F.log2(count.cast("double")))).cast("int").alias("class"),
    )


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    contained: float = CONTAINED,
) -> DataFrame:
    """doc_id, template, containment, first_word, windows: one row per document and template found.

    ``containment`` is the largest share of the template's distinct shingles
    in one window, ``first_word`` the start of the first window that reaches
    ``contained``, ``windows`` how many do. Texts of under five words and null
    have no windows; a null id is reported as null; repeated rows are reported
    each. An empty table, or no template, gives no rows. The templates are a
    parameter of the scan: their shingles are part of the plan.
    """
    spark = docs.sparkSession
    known = [row.asDict() for row in template_table(spark, templates).collect()] if templates else []
    members = sorted({s for row in known for s in row["shingles"]})
    table = local_table(
        spark,
        {key: [row[key] for row in known] for key in ("template", "shingles", "needed", "class")},
        "template string, shingles array<bigint>, needed int, class int",
    )
    by_band = table.select("class", "template", F.posexplode(_bands(F.col("shingles"))).alias("band", "value"))

    hit = F.lit(members) if members else F.array().cast("array<bigint>")
    texts = (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.monotonically_increasing_id().alias("row_no"),
            license_words(F.col(text_col)).alias("words"),
        )
        .select("doc_id", "row_no", _shingles(F.col("words")).alias("shingles"))
        .filter(F.arrays_overlap("shingles", hit))
    )
    places = materialize(
        texts.select(
            "*",
            F.filter(
                F.transform("shingles", lambda s, at: F.when(F.array_contains(hit, s), at)),
                lambda at: at.isNotNull(),
            ).alias("hits"),
        ),
        "hits",
    )

    def windows(width_class: int) -> Column:
        """The windows of a class that hold a template's shingle."""
        apart = stride(width_class)
        wide = width_class + apart
        numbers = F.array_distinct(
            F.flatten(
                F.transform(
                    "hits",
                    lambda at: F.sequence(
                        F.greatest(F.lit(0), F.ceil((at - (wide - 1)) / apart)).cast("int"),
                        F.floor(at / apart).cast("int"),
                    ),
                )
            )
        )
        return F.transform(
            numbers,
            lambda k: F.struct(
                F.lit(width_class).alias("class"),
                (k * apart).alias("first"),
                F.slice("shingles", k * apart + 1, wide).alias("inside"),
            ),
        )

    classes = sorted({row["class"] for row in known})
    every = F.concat(*[windows(c) for c in classes]) if classes else F.array().cast(
        "array<struct<class:int,first:int,inside:array<bigint>>>"
    )
    banded = (
        places.select("doc_id", "row_no", F.explode(every).alias("w"))
        .select("doc_id", "row_no", "w.*")
        .select("*", F.posexplode(_bands(F.col("inside"))).alias("band", "value"))
    )
    # As many rows as templates times bands.
    candidates = banded.join(F.broadcast(by_band), ["class", "band", "value"]).dropDuplicates(
        ["row_no", "class", "first", "template"]
    )
    found = F.size(F.array_intersect("inside", "shingles")) / F.col("needed")
    verified = (
        candidates.drop("class")
        .join(F.broadcast(table.select("template", "shingles", "needed")), "template")
        .withColumn("containment", found)
        .filter(F.col("containment") >= contained)
    )
    return (
        verified.groupBy("row_no", "template")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("containment").alias("containment"),
            F.min("first").cast("long").alias("first_word"),
            F.count("*").alias("windows"),
        )
        .select("doc_id", "template", "containment", "first_word", "windows")
    )


def scan_sql(templates: Mapping[str, str] = TEMPLATES) -> str:
    """The exact result over the same windows, without bands, for the check."""
    rows = ", ".join("('{}', '{}')".format(n.replace("'", "''"), t.replace("'", "''")) for n, t in templates.items())
    words = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^0-9a-z]+'), lambda w: w <> '')"
    grams = "list_transform(range(1, len(words) - 3), lambda p: array_to_string(words[p:p + 4], ' '))"
    return f"""WITH t AS (SELECT template, list_distinct(grams) AS grams, len(list_distinct(grams)) AS needed,
        CAST(pow(2, ceil(log2(len(list_distinct(grams))))) AS BIGINT) AS c FROM
        (SELECT template, {grams} AS grams FROM (SELECT template, {words} AS words FROM (VALUES {rows}) AS v(template, text)))),
      tg AS (SELECT template, needed, c, greatest(1, c // 2) AS s, unnest(grams) AS gram FROM t),
      dg AS (SELECT doc_id, unnest(range(0, len(words) - 4)) AS p, unnest({grams}) AS gram
        FROM (SELECT doc_id, {words} AS words FROM documents)),
      hit AS (SELECT doc_id, template, needed, s, gram, unnest(range(CAST(greatest(0, ceil((p - (c + s - 1)) / s)) AS BIGINT),
        p // s + 1)) AS k FROM dg JOIN tg USING (gram)),
      w AS (SELECT doc_id, template, k * s AS first, count(DISTINCT gram) / any_value(needed) AS containment
        FROM hit GROUP BY doc_id, template, k, s)
      SELECT doc_id, template, max(containment) AS containment, CAST(min(first) AS BIGINT) AS first_word,
        count(*) AS windows FROM w WHERE containment >= {CONTAINED} GROUP BY doc_id, template"""
