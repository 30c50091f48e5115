"""License scan: MinHash bands over overlapping windows, then exact containment.

Words are lower-cased runs of letters and digits, shingles five of them.  A
template of m shingles is looked for in windows of 2 M shingles, one every M,
where M is the least power of two not below m: any m shingles in a row lie
whole in one of them.  So a window that holds 80 % of a template has a Jaccard
similarity with it of at least 0.8 m / (2 M + 0.2 m) > 0.19.  With ``BANDS``
bands of one row, such a pair shares a band with a probability of
1 - 0.81^64 > 0.999998 (see ``collision_probability``).  What shares a band is
verified: the exact share of the template's shingles that are in the window.

A band value is the hash of one of a template's shingles, so a window without
any template shingle cannot share a band: only windows around such shingles get
a signature, which keeps the scan one projection.

The templates are a small fixed table, its shingles literals of the plan; it
covers the notices named in ``TEMPLATES``, each version its own, and no whole
license texts.  Notices of the GNU family differ in a word or two, so of these a
document's best matches count and the others do not.  Null
and empty texts, and those of under five words, have no shingle and no match.
Rows that repeat an id are reported under that id once per license.  Equal
containment goes by the first place.  Empty tables give no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
TOKEN = r"[\p{L}\p{N}]+"

# Notices by which public licenses are named or granted.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
           "Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
               "option) any later version.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version.",
    "lgpl-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                "(at your option) any later version.",
    "lgpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                "(at your option) any later version.",
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                "(at your option) any later version.",
    "cc0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
               "rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                 "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                 "binary, for any purpose, commercial or non-commercial, and by any means.",
}
#: Licenses whose notices differ in a few words: of those a document holds, only the best matches are reported.
FAMILY = "^[al]?gpl"


def collision_probability(similarity: float, bands: int = BANDS, rows: int = 1) -> float:
    return 1.0 - (1.0 - similarity ** rows) ** bands


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def _shingles(words: Column, n: int) -> Column:
    """Distinct shingles of an array of words."""
    some = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, F.array_distinct(some)).otherwise(F.array().cast("array<string>"))


def _hash(words: Column, n: int) -> Column:
    """Hash of the shingle that starts at each word; the last n - 1 have none."""
    one = F.transform(words, lambda w: F.xxhash64(w))
    return F.transform(F.array(one), lambda o: F.slice(F.transform(o, lambda x, i: F.xxhash64(
        x, *[F.get(o, i + k) for k in range(1, n)])), F.lit(1), F.greatest(F.size(o) - (n - 1), F.lit(0))))[0]


def _signature(window: Column, bands: int) -> Column:
    """The least hash of the window's shingles under each band's hash function."""
    return F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda b: F.array_min(F.transform(window, lambda x: F.xxhash64(x, b))))


def _starts(hits: Column, step: int) -> Column:
    """``(step, start)`` of the windows around each hit."""
    def around(p: Column) -> Column:
        at = F.floor(p / step)
        return F.array(*[F.struct(F.lit(step).alias("step"), (j * step).cast("int").alias("start")) for j in (at, at - 1)])

    return F.array_distinct(F.flatten(F.transform(hits, around)))


def template_table(df: DataFrame, templates: Mapping[str, str], bands: int, shingle: int) -> DataFrame:
    """``license, m (its shingles), step (M), shingles, hashes, signature`` of each template."""
    spark = df.sparkSession
    pairs = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("notice")) for k, v in templates.items()])
    rows = spark.range(1).select(F.explode(pairs).alias("t")).select("t.license", tokens(F.col("t.notice")).alias("words"))
    rows = rows.select("license", _shingles(F.col("words"), shingle).alias("shingles"), _hash(F.col("words"), shingle).alias("hashes"))
    rows = rows.withColumn("m", F.size("shingles"))
    step = F.pow(F.lit(2), F.ceil(F.log2("m"))).cast("int")
    return rows.withColumn("step", step).withColumn("signature", _signature(F.col("hashes"), bands))


def scan(df: DataFrame, templates: Mapping[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text",
         shingle: int = SHINGLE, containment: float = CONTAINMENT, bands: int = BANDS) -> DataFrame:
    """``doc_id, license, containment, n_windows, first_word``: licenses found, by document.

    ``first_word``: where the first of the best windows starts.
    """
    table = template_table(df, templates, bands, shingle)
    known = table.select("license", "m", "step", "hashes").collect()  # one row per template
    if short := [r.license for r in known if r.m == 0]:
        raise ValueError(f"templates of under {shingle} words: {short}")
    wanted = sorted({h for r in known for h in r.hashes})
    steps = sorted({r.step for r in known})
    words = df.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("words"))
    hashed = words.withColumn("hashes", _hash(F.col("words"), shingle))
    hits = F.filter(F.transform("hashes", lambda h, i: F.when(h.isin(*wanted), i)), lambda i: i.isNotNull())
    found = hashed.withColumn("hits", hits).where(F.size("hits") > 0)
    starts = F.flatten(F.array(*[_starts(F.col("hits"), s) for s in steps]))
    windows = found.select("doc_id", "words", "hashes", F.explode(starts).alias("w")).where("w.start >= 0").select(
        "doc_id", "w.step", F.col("w.start").alias("start"),
        F.slice("words", F.col("w.start") + 1, 2 * F.col("w.step") + shingle - 1).alias("words"),
        F.slice("hashes", F.col("w.start") + 1, 2 * F.col("w.step")).alias("hashes"))
    banded = windows.select("doc_id", "step", "start", "words", F.posexplode(_signature(F.col("hashes"), bands)).alias("band", "value"))
    bands_of = table.select("license", "step", "shingles", F.posexplode("signature").alias("band", "value"))
    met = banded.join(F.broadcast(bands_of), ["step", "band", "value"]).dropDuplicates(["doc_id", "step", "start", "license", "words"])
    share = F.size(F.array_intersect(_shingles(F.col("words"), shingle), "shingles")) / F.size("shingles")
    sure = met.withColumn("containment", share).where(F.col("containment") >= containment)
    found = sure.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.count_distinct("step", "start").alias("n_windows"),
        F.max_by("start", F.struct("containment", -F.col("start"))).cast("long").alias("first_word"))
    family = F.when(F.col("license").rlike(FAMILY), "gnu").otherwise(F.col("license"))
    best = F.max("containment").over(Window.partitionBy("doc_id", family))
    return found.withColumn("best", best).where("containment = best").drop("best")
