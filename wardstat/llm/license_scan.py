"""License scan by MinHash bands over text windows (operator 6), built-in functions only.

Texts and templates are reduced to words of [a-z0-9] and to shingles of
`SHINGLE` words (a shorter template is one shingle of all its words).
Templates fall into classes by length; class w (16, 32, 64, ...) holds those
of w/4 to w/2 words and looks at windows of w words that overlap by half, so
every run as long as a template lies within one window.

* A window without any template shingle cannot hold a template, so positions
  are filtered by the set of all template shingles first (a bounded set:
  `MAX_SHINGLES`).
* Every window that is left gets MinHash values, one row to a band. The
  number of bands of a class follows from the least Jaccard similarity that a
  window with `PERCENT` of a template can have, so that such a window shares a
  band with a probability of at least 1 - `MISS`.
* Template bands retrieve candidates (templates are broadcast: bounded as
  above); a candidate counts if the window holds `PERCENT` of the template's
  shingles exactly.

Defined results: null, empty and blank texts match nothing; rows with a null
id match under a null id; rows that repeat an id are one document; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._store import keep

SHINGLE, PERCENT, MISS = 5, 80, 0.001
MAX_SHINGLES = 20_000

# Short public license notices and the opening words of licenses.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                  "in compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
               "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def template_words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def size_class(words: int) -> int:
    w = 2 * SHINGLE
    while w < 2 * words:
        w *= 2
    return w


def bands_of(window: int, shingle: int, shingles: int) -> int:
    """One-row bands that find a window with PERCENT of `shingles` shingles."""
    need = math.ceil(shingles * PERCENT / 100)
    least = need / ((window - shingle + 1) + shingles - need)
    return math.ceil(math.log(MISS) / math.log(1 - least)) if least < 1 else 1


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " ")), " ")


def _pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that the optimizer computes once per row: a generator of
    one row keeps it from being copied into every expression that uses it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _shingle_at(words: Column, n: int):
    return lambda i: F.xxhash64(F.slice(words, i, n))


def _positions(n_words: Column, n: int) -> Column:
    """1-based first words of all n-word shingles (none: empty array)."""
    return F.when(n_words >= n, F.sequence(F.lit(1), n_words - n + 1)).otherwise(F.array().cast("array<int>"))


def _minhash(shingles: Column, bands: int) -> Column:
    def seeded(k):
        return lambda h: F.xxhash64(h, F.lit(k))

    return F.array(*[F.xxhash64(F.lit(k), F.array_min(F.transform(shingles, seeded(k)))) for k in range(bands)])


def scan(spark: SparkSession, docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, template, n_shared, n_template, first_word, n_windows: one row per document and template found."""
    tokens = {k: template_words(v) for k, v in templates.items()}
    tokens = {k: v for k, v in tokens.items() if v}
    groups: dict[tuple[int, int], list[str]] = {}  # (shingle length, window) -> templates
    for name, ws in tokens.items():
        groups.setdefault((min(SHINGLE, len(ws)), size_class(len(ws))), []).append(name)
    if sum(max(1, len(ws) - SHINGLE + 1) for ws in tokens.values()) > MAX_SHINGLES:
        raise ValueError(f"templates hold more than {MAX_SHINGLES} shingles")

    base = spark.createDataFrame(list(tokens.items()), "template string, ws array<string>")
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    t = _pin(t.where("text is not null"), "w", _words(F.col("text"))).select("doc_id", "w", F.size("w").alias("n"))
    lengths = sorted({n for n, _ in groups})
    # hashes of the template shingles, by shingle length (Spark hashes them, so both sides agree)
    known, held = {}, {}
    for n in lengths:
        mine = [k for k, ws in tokens.items() if min(SHINGLE, len(ws)) == n]
        held[n] = (base.where(F.col("template").isin(mine)).withColumn("n", F.size("ws"))
                   .select("template", F.array_distinct(F.transform(_positions(F.col("n"), n), _shingle_at(F.col("ws"), n))).alias("ts")))
        known[n] = sorted({h for r in held[n].collect() for h in r["ts"]})  # bounded by MAX_SHINGLES

    def positions(n):
        at = _shingle_at(F.col("w"), n)
        return F.filter(_positions(F.col("n"), n), lambda i: at(i).isin(known[n])).alias(f"hit{n}")

    hits = _pin(t, "h", F.struct(*[positions(n) for n in lengths])).select("doc_id", "w", "h.*")
    hits = keep(spark, hits.where(sum((F.size(f"hit{n}") for n in lengths), F.lit(0)) > 0), "license-hits")

    found = None
    for (n, w), names in sorted(groups.items()):
        step = w // 2
        # windows (by number) that hold a hit: those that start at or up to w - n words before it
        of = F.array_distinct(F.flatten(F.transform(F.col(f"hit{n}"), lambda i: F.sequence(
            F.greatest(F.lit(0), F.floor((i + n - 1 - w + step - 1) / step).cast("int")),  # noqa: B023
            F.floor((i - 1) / step).cast("int")))))  # noqa: B023
        win = (hits.where(F.size(f"hit{n}") > 0).select("doc_id", "w", F.explode(of).alias("win"))
               .select("doc_id", (F.col("win") * step).alias("first"), F.slice("w", F.col("win") * step + 1, w).alias("slice")))
        win = _pin(win, "ws", F.col("slice"))
        win = _pin(win, "s", F.array_distinct(F.transform(_positions(F.size("ws"), n), _shingle_at(F.col("ws"), n))))
        win = win.select("doc_id", "first", "s").where(F.size("s") > 0)
        mine = held[n].where(F.col("template").isin(names))
        bands = max(bands_of(w, n, len(set(zip(*[tokens[k][i:] for i in range(n)])))) for k in names)
        left = win.withColumn("band", F.explode(_minhash(F.col("s"), bands)))
        right = mine.withColumn("band", F.explode(_minhash(F.col("ts"), bands)))
        got = (left.join(F.broadcast(right), "band").dropDuplicates(["doc_id", "first", "template"])
               .withColumn("n_shared", F.size(F.array_intersect("s", "ts")))
               .where(F.col("n_shared") * 100 >= F.size("ts") * PERCENT)
               .select("doc_id", "template", "first", "n_shared", F.size("ts").alias("n_template")))
        found = got if found is None else found.unionAll(got)
    return (found.groupBy("doc_id", "template")
            .agg(F.max("n_shared").cast("long").alias("n_shared"), F.max("n_template").cast("long").alias("n_template"),
                 F.min("first").cast("long").alias("first_word"), F.count_distinct("first").alias("n_windows")))
