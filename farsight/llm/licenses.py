"""License scans with DataFrame functions only: MinHash bands of text windows, exact shingle containment."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.common import broadcast_if_small, keyed, made_once, saved

#: Words in a shingle, shingles in a window (a window begins at every word), and the share of shingles to be found.
SHINGLE, WINDOW, CONTAINMENT = 5, 3, 0.8
#: One hash function a band. A window that equals a template's is always met; one that shares a single shingle of three
#: with it (one of five different ones), in 1 - (4 / 5) ** 12 = 93 % of cases for each of its windows.
BANDS = 12
#: All templates together may have so many words, as their band values are part of the query.
MAX_WORDS = 20_000

# Notices of public licenses, by SPDX identifier.
TEMPLATES = {
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "CC-BY-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "GPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "Apache-2.0-text": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
}


def _words(text: Column) -> Column:
    """Lower-case words, without the signs around and between them; "" may stand first or last."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def _windows(rows: DataFrame) -> DataFrame:
    """`rows` (key, words) by window: key and s0, s1, ..., the hashes of its shingles (null after the last of the text)."""
    places = rows.select("key", "words", F.posexplode_outer("words").alias("at", "word"))
    names = [f"s{k}" for k in range(WINDOW)]
    hashes = []
    for k, name in enumerate(names):
        shingle = [F.get("words", F.col("at") + k + word) for word in range(SHINGLE)]
        full = F.col("at") + k + SHINGLE <= F.size("words")
        hashes.append(F.when(full, F.xxhash64(*shingle)).alias(name))
    return made_once(places.filter(F.col("at") + SHINGLE <= F.size("words")), *hashes).select("key", *names)


def _min_hash(band: int) -> Column:
    """The least value over a window's shingles of the band's hash function; nulls are passed over."""
    salt = (0x9E3779B97F4A7C15 * (2 * band + 1)) % (1 << 64)
    salt -= (salt >> 63) << 64
    return F.least(*[F.col(f"s{k}").bitwiseXOR(F.lit(salt)) for k in range(WINDOW)])


def _bands(windows: DataFrame) -> DataFrame:
    """(key, band, value) of each window."""
    return windows.select("key", F.posexplode(F.array(*map(_min_hash, range(BANDS)))).alias("band", "value"))


def _shingles(words: Column) -> Column:
    """The different shingles of a text, as strings."""
    starts = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(1), F.size(words) - SHINGLE + 1))
    return F.array_distinct(F.transform(starts, lambda at: F.array_join(F.slice(words, at, SHINGLE), " ")))


def _template_table(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    rows = spark.createDataFrame(sorted(templates.items()), "key string, text string")
    trimmed = F.array_remove(_words(F.col("text")), "")
    return rows.select("key", trimmed.alias("words")).withColumn("shingles", _shingles(F.col("words")))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """(id, license, containment, shingles) for each row of `docs` and each template found in its text.

    A template is found if at least `containment` of its different five-word shingles (lower case, no signs) are in the
    text; shingles is their number. Candidates are texts one of whose windows, of WINDOW shingles from every word on,
    agrees with a window of the template in the least value of one of BANDS hash functions. Templates must have
    SHINGLE words at least and MAX_WORDS together at most (else ValueError), so their values fit in the query itself and
    texts are filtered where they are read, before any shuffle; (text, template) pairs alone are shuffled.

    Null and empty texts and texts of fewer words hold nothing. Every row is reported by its own id, also where ids repeat
    or are null. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    counts = [len(text.split()) for text in templates.values()]
    if not templates or min(counts) < SHINGLE or sum(counts) > MAX_WORDS:
        raise ValueError(f"templates must have at least {SHINGLE} words each and at most {MAX_WORDS} together")
    table = saved(_template_table(spark, templates), "license-templates")
    signs = saved(_bands(_windows(table.select("key", "words"))).distinct(), "license-bands")
    values: dict[int, list[int]] = {band: [] for band in range(BANDS)}
    for _, band, value in signs.collect():
        values[band].append(value)
    rows = keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "row")
    windows = _windows(made_once(rows, _words(F.col("text")).alias("words")).select(F.col("row").alias("key"), "words"))
    met = windows.filter(reduce(or_, [_min_hash(band).isin(values[band]) for band in range(BANDS)]))
    pairs = _bands(met).join(F.broadcast(signs.withColumnRenamed("key", "license")), ["band", "value"])
    pairs = saved(pairs.select(F.col("key").alias("row"), "license").distinct(), "license-candidates")
    found = rows.join(broadcast_if_small(pairs, 64), "row").join(
        F.broadcast(table.select(F.col("key").alias("license"), F.col("shingles").alias("sought"))), "license"
    )
    there = F.size(F.array_intersect("sought", _shingles(F.col("words"))))
    worded = made_once(made_once(found, _words(F.col("text")).alias("words")), there.alias("shingles"))
    return (
        worded.select(F.col("id").alias(id_col), "license", F.size("sought").alias("n"), "shingles")
        .withColumn("containment", F.col("shingles") / F.col("n"))
        .filter(F.col("containment") >= containment)
        .select(id_col, "license", "containment", "shingles")
    )
