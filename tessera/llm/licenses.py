"""License scans with MinHash bands, in DataFrame functions only (operator 6).

Texts are sequences of lower-case ASCII words; windows of WINDOW words (that
is, WINDOW - 4 five-word shingles) start at every STRIDE-th word and overlap.
A window's signature has BANDS minima, one for each order of the shingles'
hashes.  Templates, the license notices below or others given, are cut into
such windows at every word.  A document window and a template window that share
a band are a candidate.  With one row a band, windows of Jaccard similarity s
meet with probability 1 - (1 - s) ** BANDS, above 0.99998 from 0.5 on if the
orders are independent (bit flips at four places of the hash nearly are).  The
shortest notice, one shingle, has s = 1/4 with each of the two windows that
hold it (0.99 each); longer ones have windows of their own.  A candidate is
verified exactly: the share of the template's shingles, compared as text, that
stand around the window must be CONTAINED or more.

Templates are a parameter of bounded size (MAX_WORDS words in all), so their
bands are shipped to every task; window rows carry no text, and the documents
of the few candidates bring theirs by a join.

Defined cases: null and empty texts, and texts of less than five words, match
nothing; a notice that occurs twice is reported once, with its first place and
its best containment; repeated rows are reported one by one; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import persisted

SHINGLE, WINDOW, STRIDE, BANDS, CONTAINED, MAX_WORDS = 5, 8, 2, 16, 0.8, 20_000

# ---------------------------------------------------------------- fixed values
# Standard notices of common public licenses, in their own words.
TEMPLATES = {
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    "agpl-3.0-header": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
                       "either version 3 of the License, or (at your option) any later version",
    "apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                           "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "boost-1.0": "Distributed under the Boost Software License, Version 1.0",
    "bsd-3-endorse": "may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License",
    "cc-by-nc-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nc-nd-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "cc-by-nc-sa-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nd-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-sa-3.0": "Text is available under the Creative Commons Attribution-ShareAlike License",
    "cc0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
               "software to the public domain worldwide",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "gfdl-1.3": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation "
                "License, Version 1.3",
    "gpl-2.0-header": "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 "
                      "of the License, or (at your option) any later version",
    "gpl-3.0-header": "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
                      "of the License, or (at your option) any later version",
    "lgpl-2.1-header": "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
                       "either version 2.1 of the License, or (at your option) any later version",
    "lgpl-3.0-header": "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either "
                       "version 3 of the License, or (at your option) any later version",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-short": "This project is licensed under the terms of the MIT license",
    "ofl-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1",
    "wtfpl": "This work is free. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
            "damages arising from the use of this software",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-header": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                  "the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


def _words(text_col: str) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^a-z0-9]+", " ")), " ")


def _hashes(words: str) -> Column:
    """A hash for every run of SHINGLE words."""
    last = F.size(words) - SHINGLE
    of = lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(SHINGLE)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), of))


def _texts(words: Column) -> Column:
    """The runs of SHINGLE words themselves, each once (words: at least SHINGLE)."""
    each = F.sequence(F.lit(1), F.size(words) - SHINGLE + 1)
    return F.array_distinct(F.transform(each, lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))


def _windows(stride: int) -> Column:
    """The windows over the shingle hashes ``_h``: structs of ``at`` (first
    word) and h0, h1, ... (null beyond the text's end)."""
    return F.transform(F.sequence(F.lit(0), F.size("_h") - 1, F.lit(stride)),
                       lambda i: F.struct(i.alias("at"), *[F.get("_h", i + j).alias(f"h{j}") for j in range(WINDOW - SHINGLE + 1)]))


def _bands(window: Column) -> list[Column]:
    """The least of a window's hashes under BANDS orders: each starts at one
    of four places of the hash and flips its bits by a constant of its own.
    (Plain code: with products and remainders the generated method grows
    beyond what the JVM compiles, and runs ten times slower.)"""
    flips = [mixed if mixed < 2**63 else mixed - 2**64 for mixed in
             ((0x9E3779B97F4A7C15 * (k + 1) ^ 0xD1B54A32D192ED03 * (k * k + 7)) % 2**64 for k in range(BANDS))]
    return [F.least(*[F.shiftleft(window[f"h{j}"], 8 * (k % 4)).bitwiseXOR(F.lit(x)) for j in range(WINDOW - SHINGLE + 1)])
            for k, x in enumerate(flips)]


def _low(h: Column) -> Column:
    """The bits of a hash that every band keeps (none is shifted by more than 24 bits)."""
    return h.bitwiseAND(F.lit(2**40 - 1))


def _index(spark: SparkSession, templates: dict[str, str]) -> tuple[DataFrame, list[list[int]], list[int]]:
    """(band, value, license, n_words, wanted) of all template windows, the
    values of each band, and the low bits of all hashes that make them."""
    if (words := sum(len(t.split()) for t in templates.values())) > MAX_WORDS:
        raise ValueError(f"{words} words of templates; at most {MAX_WORDS} can be shipped to every task")
    t = (spark.createDataFrame(list(templates.items()), "license string, text string").withColumn("words", _words("text"))
         .withColumn("_h", _hashes("words")).filter("_h IS NOT NULL").withColumn("wanted", _texts(F.col("words")))
         .select("license", F.size("words").alias("n_words"), "wanted", "_h"))
    rows = (t.select("license", "n_words", "wanted", F.explode(_windows(1)).alias("w"))
            .select("license", "n_words", "wanted", *[b.alias(f"b{k}") for k, b in enumerate(_bands(F.col("w")))]).collect())
    entries = sorted({(k, r[f"b{k}"], r["license"], r["n_words"], tuple(r["wanted"])) for r in rows for k in range(BANDS)})
    index = spark.createDataFrame([(*e[:4], list(e[4])) for e in entries],
                                  "band int, value bigint, license string, n_words int, wanted array<string>")
    lows = t.select(F.explode("_h").alias("h")).select(_low(F.col("h")).alias("low")).distinct().collect()
    return index, [sorted({e[1] for e in entries if e[0] == k}) for k in range(BANDS)], sorted(r["low"] for r in lows)


def scan(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", templates: dict[str, str] | None = None,
         contained: float = CONTAINED) -> DataFrame:
    """id, license, containment, first_word (of the first window that shows
    the notice; words are runs of ASCII letters and digits): the notices found in each document."""
    index, values, lows = _index(docs.sparkSession, TEMPLATES if templates is None else templates)
    base = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), _words(text_col).alias("words"))
    hashed = base.withColumn("_h", _hashes("words")).filter("_h IS NOT NULL")
    # a band's least hash is one of the window's own, so a text without any of the templates' has no equal band
    hashed = hashed.filter(F.exists("_h", lambda h: _low(h).isin(lows)))
    # window rows carry no text, so that they stay small; the few documents found bring theirs by a join
    windows = hashed.select("row", F.explode_outer(_windows(STRIDE)).alias("w")).filter("w IS NOT NULL")
    bands = _bands(F.col("w"))
    shared = reduce(lambda a, b: a | b, [b.isin(own) for b, own in zip(bands, values, strict=True)], F.lit(False))
    entries = F.array(*[F.struct(F.lit(k).alias("band"), b.alias("value")) for k, b in enumerate(bands)])
    index = F.broadcast(index)
    hits = persisted(windows.filter(shared).select("row", F.col("w.at").alias("at"), F.explode(entries).alias("e"))
                     .join(index, (F.col("e.band") == F.col("band")) & (F.col("e.value") == F.col("value")))
                     .select("row", "license", "at").distinct(), "license-hits")
    wanted = F.broadcast(index.select("license", "n_words", "wanted").distinct())
    found = base.join(hits, "row").join(wanted, "license")
    around = F.slice("words", F.greatest(F.lit(1), F.col("at") + 1 - F.col("n_words")), 2 * F.col("n_words") + WINDOW)
    share = F.size(F.array_intersect("wanted", _texts(F.col("around")))) / F.size("wanted")
    return (found.select("id", "row", "license", "at", "wanted", around.alias("around"))
            .select("id", "row", "license", "at", share.alias("containment")).filter(F.col("containment") >= contained)
            .groupBy("id", "row", "license").agg(F.max("containment").alias("containment"), F.min("at").alias("first_word"))
            .select(F.col("id").alias(id_col), "license", "containment", "first_word"))
