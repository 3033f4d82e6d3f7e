"""Licence scan: sparse TF-IDF cosine of statements to licence templates, then inheritance from directories.

* *Terms.* Lower-case words of letters, digits, dots and dashes. A term's weight is its count times its idf; the idf of the
  templates' terms comes from all texts of the corpus, a term outside the templates weighs as one that no text has.
* *Statements.* Every line of a file is one (headers), and so is a whole licence file. Their cosine to each template is
  computed where it can reach ``ACCEPT``: a template's heaviest terms are its anchors, chosen so that a text without any of
  them stays below, whatever else it holds; lines without an anchor of any template are never looked at. That is exact.
* *Detection.* A file has the licence of its best statement; ties go to the template named first.
* *Inheritance.* A file without a licence of its own takes that of the nearest directory above it that has one: a directory
  has the licence of its best licence file. Directories are resolved first, by one join of each directory's ancestors with
  the directories that have a licence; files then join their own directory.

DataFrame functions only. NULL text: no statements, so the file inherits. NULL path: no directory, so nothing to inherit.
Repeated rows get equal results. Without licence files nothing is inherited.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

ACCEPT = 0.6
WORD = r"[^a-z0-9.\-]+"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"
#: Usual short statements of common licences.
TEMPLATES = {
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "ISC": ["Released under the ISC License."],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Proprietary": ["All rights reserved."],
}


def terms(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.lower(text), WORD), lambda w: F.btrim(w, F.lit(".-"))), lambda w: w != "")


def _terms(text: str) -> list[str]:
    return [w for w in (x.strip(".-") for x in re.split(WORD, text.lower())) if w]


def template_weights(idf: dict[str, float]) -> list[tuple[str, int, str, float]]:
    """(licence, number, term, weight) with weights of length one for each template."""
    out = []
    for name, texts in TEMPLATES.items():
        for k, text in enumerate(texts):
            found = _terms(text)
            weights = {t: found.count(t) * idf[t] for t in found}
            norm = math.sqrt(sum(w * w for w in weights.values())) or 1.0
            out.extend((name, k, t, w / norm) for t, w in sorted(weights.items()))
    return out


def anchors(weights: list[tuple[str, int, str, float]], accept: float = ACCEPT) -> list[str]:
    """Terms of which a text needs at least one to reach ``accept``: without a template's anchors its cosine is at most the
    length of what is left of the template."""
    out: set[str] = set()
    for key in {(n, k) for n, k, _, _ in weights}:
        own = sorted(((w, t) for n, k, t, w in weights if (n, k) == key), reverse=True)
        left = 1.0
        for w, t in own:
            if left < accept * accept:
                break
            out.add(t)
            left -= w * w
    return sorted(out)


def inverse_frequencies(files: DataFrame, text: str = "text") -> tuple[dict[str, float], float]:
    """idf of every template term over all texts, and of a term that no text has."""
    vocabulary = sorted({t for texts in TEMPLATES.values() for x in texts for t in _terms(x)})
    known = F.array(*(F.lit(t) for t in vocabulary))
    found = files.select(F.explode(F.array_intersect(terms(F.col(text)), known)).alias("term")).groupBy("term").count()
    total = files.count()
    df = {r["term"]: r["count"] for r in found.collect()}
    idf = {t: math.log((1 + total) / (1 + df.get(t, 0))) + 1 for t in vocabulary}
    return idf, math.log(1 + total) + 1


def statements(files: DataFrame, needed: list[str]) -> DataFrame:
    """``file``, ``statement``: lines, and whole licence files, that hold one of ``needed``."""
    starts = r"(?<![a-z0-9])(?:" + "|".join(re.escape(t) for t in needed) + ")"
    whole = F.when(F.col("name").rlike(LICENCE_FILE) & F.col("text").contains("\n"), F.array("text")).otherwise(F.array().cast("array<string>"))
    found = files.where(F.lower("text").rlike(starts)).select("file", F.explode(F.concat(F.split("text", "\n"), whole)).alias("statement"))
    # the expression only thins out; whole terms decide
    return found.where(F.lower("statement").rlike(starts)).where(
        F.arrays_overlap(terms(F.col("statement")), F.array(*(F.lit(t) for t in needed))))


def detected(files: DataFrame) -> DataFrame:
    """``file``, ``licence``, ``score`` of the best statement of each file that reaches ``ACCEPT``; ``files``: file, name, text."""
    spark = files.sparkSession
    idf, unknown = inverse_frequencies(files)
    weights = template_weights(idf)
    held = saved(statements(files, anchors(weights)), "statements")
    bag = held.select("statement").distinct()  # equal statements are scored once
    counts = bag.select("statement", F.explode(terms(F.col("statement"))).alias("term")).groupBy("statement", "term").agg(F.count("*").alias("n"))
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "term string, idf double"))
    tf = counts.join(known, "term", "left").select("statement", "term", (F.col("n") * F.coalesce("idf", F.lit(unknown))).alias("w"))
    norm = tf.groupBy("statement").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    table = F.broadcast(spark.createDataFrame(weights, "licence string, k int, term string, q double"))
    dots = tf.join(table, "term").groupBy("statement", "licence", "k").agg(F.sum(F.col("w") * F.col("q")).alias("dot"))
    scores = dots.join(norm, "statement").select("statement", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    best = scores.where(F.col("score") >= ACCEPT).groupBy("statement").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best"))
    return held.join(best, "statement").groupBy("file").agg(F.min("best").alias("best")).select(
        "file", F.col("best.licence").alias("licence"), (-F.col("best.s")).alias("score"))


def scanned(files: DataFrame, key: str = "path", text: str = "text", path: str = "path") -> DataFrame:
    """``key``, ``path``, ``licence``, ``score``, ``origin`` (own, inherited, none) and ``origin_dir`` for every row."""
    folder = F.regexp_replace(path, r"/?[^/]*$", "")
    data = files.select(F.col(key).alias("key"), F.col(path).alias("path"), F.col(text).alias("text"))
    data = data.select("key", "path", "text", F.xxhash64("path", "text").alias("file"), folder.alias("dir"),
                       F.substring_index("path", "/", -1).alias("name"))
    own = saved(detected(data), "licences")
    rows = data.drop("text").join(own, "file", "left")
    licensed = rows.where(F.col("licence").isNotNull() & F.col("name").rlike(LICENCE_FILE)).groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "name", "licence")).alias("best"))
    licensed = licensed.select(F.col("dir").alias("up"), F.col("best.licence").alias("of"), (-F.col("best.s")).alias("of_score"))
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    dirs = data.where("dir is not null").select("dir").distinct().select("dir", F.explode(F.array_distinct(up)).alias("up"))
    nearest = dirs.join(licensed, "up").groupBy("dir").agg(
        F.max(F.struct(F.length("up").alias("depth"), "up", "of", "of_score")).alias("n")).select("dir", "n.up", "n.of", "n.of_score")
    full = rows.join(nearest, "dir", "left")
    has = F.col("licence").isNotNull()
    return full.select(
        "key", "path", F.coalesce("licence", "of").alias("licence"), F.coalesce("score", "of_score").alias("score"),
        F.when(has, "own").when(F.col("of").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(has, F.lit(None)).otherwise(F.col("up")).alias("origin_dir"))
