"""License scans: notices matched to templates by sparse TF-IDF cosine, then inherited from the nearest directory.

In every file the lines with a cue word are candidates, in licence files (by name) the whole text as well. So are windows of
terms, whatever the lines and comment marks: a header or notice template is laid with its first cue term on each equal term
of the text, and the terms that it covers are one candidate, be the notice wrapped or inside a long line. Distinct candidates
are scored once: their terms, weighted by how often they stand there and how few templates have them, meet the
templates' terms in a join, and the products add up to cosines. A file's own licence is its best match of at least
``least`` (ties: the first identifier). What denies a licence ("is not licensed under", "no license is granted") is left out before, with the rest of its sentence up to 80
characters, but where a whole text is compared. A directory's licence is the best among its licence files. A file without an
own licence inherits from the nearest directory on its path that has one: paths of directories are exploded into their
ancestors, joined to the licensed directories, and the deepest match is kept. Documents without paths don't inherit.

Defined cases. NULL text is empty; a NULL path stands in the top directory. Every row is a file; rows equal in id, path and
text get the same result. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantscope.llm import license_texts
from grantscope.llm.common import null_safe, stored

# Identifiers, notices, headers and whole texts of common licences, by identifier.
TEMPLATES = (
    *license_texts.BODIES, *license_texts.HEADERS, *license_texts.SPDX,
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Use of this source code is governed by the BSD 2-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
CUE = r"(?i)licen[sc]e|copyright|spdx|permission|public domain|redistribut|creative commons"
# possessive: Java matches these loops without recursion, so a term may be of any length
TERM = r"[a-z0-9]++(?:[.+-][a-z0-9]++)*+"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|copyright|notice|unlicense)([._-]|$)"
DENIED = (r"(?i)\b(?:not|never|nor|neither|isn't|aren't|wasn't),?\s++(?:\S++\s++){0,2}"
          r"(?:licen[sc]ed|released|distributed|available|governed|dedicated|published|provided|offered|under)\b|\bno\s++(?:\S++\s++){0,2}licen[sc]e\b")
REST_OF_SENTENCE = "[^.]{0,80}"
LEAST = 0.7
#: Terms that a template is laid on by, and the longest template laid so (whole texts of more terms are matched as files).
ANCHOR = r"licen[sc]e|spdx|permission|public|redistribut|creative"
WINDOW_TERMS = 256


def terms_of(text: str) -> Counter:
    """Terms of a text, as the scan finds them (A-Z in lower case)."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return Counter(re.findall(TERM, lower))


def term_weight(in_templates: int) -> float:
    """Weight of a term that so many templates have."""
    return math.log((1 + len(TEMPLATES)) / (1 + in_templates)) + 1


def template_terms(spark: SparkSession) -> DataFrame:
    """(template, license, t_term, t_value, weight): unit-length sparse vectors; as many rows as the templates have terms."""
    counts = [terms_of(text) for _, text in TEMPLATES]
    held = Counter(t for c in counts for t in c)
    rows = []
    for i, ((license, _), c) in enumerate(zip(TEMPLATES, counts)):
        norm = math.sqrt(sum((n * term_weight(held[t])) ** 2 for t, n in c.items()))
        rows += [(i, license, t, n * term_weight(held[t]) / norm, term_weight(held[t])) for t, n in sorted(c.items())]
    return spark.createDataFrame(rows, "template int, license string, t_term string, t_value double, weight double")


def anchors() -> dict[str, list[tuple[int, int]]]:
    """By the first cue term of the templates: where it stands in them, and how many terms they have."""
    found: dict[str, set[tuple[int, int]]] = {}
    for _, text in TEMPLATES:
        terms = re.findall(TERM, text.lower())
        at = next((i for i, t in enumerate(terms) if re.search(ANCHOR, t)), None)
        if at is not None and len(terms) <= WINDOW_TERMS:
            found.setdefault(terms[at], set()).add((at, len(terms)))
    return {t: sorted(w) for t, w in sorted(found.items())}


def windows(terms: Column) -> Column:
    """The windows of the array ``terms`` (a column that is there already, not an expression) that templates cover."""
    laid = anchors()
    by_term = F.create_map(*(x for t, w in laid.items() for x in (
        F.lit(t), F.array(*[F.struct(F.lit(at).alias("at"), F.lit(n).alias("n")) for at, n in w]))))
    hits = F.filter(F.transform(terms, lambda t, i: F.when(t.isin(*laid), F.struct(t.alias("term"), i.alias("i")))), lambda h: h.isNotNull())
    window = lambda h, w: F.array_join(F.slice(  # noqa: E731  one that begins before the text is cut there
        terms, F.greatest(h["i"] - w["at"], F.lit(0)) + 1, w["n"] + F.least(h["i"] - w["at"], F.lit(0))), " ")
    return F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(by_term, h["term"]), lambda w: window(h, w))))


def notice_key(notice: Column) -> Column:
    """128 bits that stand for a notice, so that its text travels once and not with each of its terms."""
    return F.unhex(F.md5(notice))


def match_notices(candidates: DataFrame, least: float = LEAST) -> DataFrame:
    """(notice_key, license, score): the best template of each distinct ``notice``, where its cosine is at least ``least``."""
    templates = template_terms(candidates.sparkSession)
    weights = templates.select(F.col("t_term").alias("w_term"), "weight").distinct()
    lower = F.translate("notice", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = candidates.select(notice_key(F.col("notice")).alias("notice_key"), "notice").dropDuplicates(["notice_key"])
    terms = terms.select("notice_key", F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
    terms = terms.groupBy("notice_key", "term").agg(F.count(F.lit(1)).alias("n")).join(weights, F.col("term") == F.col("w_term"), "left")
    terms = terms.select("notice_key", "term", (F.col("n") * F.coalesce("weight", F.lit(term_weight(0)))).alias("value"))
    norms = terms.groupBy(F.col("notice_key").alias("n_key")).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    dots = terms.join(templates, F.col("term") == F.col("t_term")).groupBy("notice_key", "template", "license").agg(
        F.sum(F.col("value") * F.col("t_value")).alias("dot"))
    scored = dots.join(norms, F.col("notice_key") == F.col("n_key")).select(
        "notice_key", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    return _best(scored.where(F.col("score") >= least), ["notice_key"])


def _best(scored: DataFrame, by: list[str]) -> DataFrame:
    """The highest score, then the first identifier, of each group."""
    best = F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("best")
    return scored.groupBy(*by).agg(best).select(*by, F.col("best.license").alias("license"), (-F.col("best.less")).alias("score"))


def scan_files(files: DataFrame, least: float = LEAST, edges: bool = False) -> DataFrame:
    """Per file of ``files`` (file_id, path, text): its own licence and score, its licence, and where that comes from.

    ``origin``: "own", "inherited" (``from_dir`` tells the directory) or "none". With ``edges``, texts longer than any window whose
    first or last line has a cue word are compared as a whole too, whatever their name.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    path = F.coalesce(F.col("path"), F.lit(""))
    told = F.regexp_replace(text, f"(?:{DENIED}){REST_OF_SENTENCE}", " ")
    lines = F.filter(F.split(told, "\n"), lambda x: x.rlike(CUE))
    name = F.substring_index(path, "/", -1)
    is_licence = name.rlike(LICENCE_FILE)
    lower = F.translate(told, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    at_edge = F.lit(edges) & (F.substring_index(text, "\n", 1).rlike(CUE) | F.substring_index(text, "\n", -1).rlike(CUE))
    files = files.select(
        F.col("file_id").cast("long").alias("file_id"), path.alias("path"), F.xxhash64(text).alias("text_hash"), is_licence.alias("is_licence"),
        F.regexp_replace(path, "/?[^/]*$", "").alias("own_dir"), F.when(text.rlike(CUE), lines).alias("lines"),
        F.when(text.rlike(CUE) & (is_licence | at_edge), text).alias("whole"),
        F.when(text.rlike(CUE), F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("terms"))
    whole = F.when(F.col("whole").isNotNull() & (F.col("is_licence") | (F.size("terms") > WINDOW_TERMS)), F.array("whole")).otherwise(F.array())
    notices = F.array_distinct(F.concat("lines", whole, windows(F.col("terms"))))
    files = stored(files.select("file_id", "path", "text_hash", "is_licence", "own_dir",
                                F.coalesce(notices, F.array().cast("array<string>")).alias("notices")), "license-notices")
    key = ["file_id", "path", "text_hash"]
    held = files.where(F.size("notices") > 0).select(*key, "own_dir", "is_licence", F.explode("notices").alias("notice"))
    matched = stored(match_notices(held, least), "license-matches")
    held = held.select(*key, "own_dir", "is_licence", notice_key(F.col("notice")).alias("h_key"))
    own = _best(held.join(matched, F.col("h_key") == F.col("notice_key")), [*key, "own_dir", "is_licence"])
    licensed = _best(own.where("is_licence"), ["own_dir"]).select(F.col("own_dir").alias("l_dir"), F.col("license").alias("l_license"))
    # Directories, then their ancestors (themselves included, the top directory '' last), deepest licensed one first.
    dirs = files.select(F.col("own_dir").alias("d_dir")).distinct()
    parts = F.split("d_dir", "/")
    ups = dirs.select("d_dir", F.explode(F.when(F.col("d_dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(parts)))).alias("depth"))
    ups = ups.withColumn("up", F.array_join(F.slice(F.split("d_dir", "/"), 1, F.col("depth")), "/"))
    nearest = ups.join(licensed, F.col("up") == F.col("l_dir")).groupBy("d_dir").agg(
        F.max(F.struct("depth", "up", "l_license")).alias("near"))
    own = own.select(*(F.col(c).alias(f"o_{c}") for c in key), F.col("license").alias("own_license"), F.col("score").alias("own_score"))
    out = files.join(own, null_safe(files, own, [(c, f"o_{c}") for c in key]), "left")
    out = out.join(nearest, F.col("own_dir") == F.col("d_dir"), "left")
    origin = F.when(F.col("own_license").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none")
    return out.select("file_id", "path", "own_license", "own_score", F.coalesce("own_license", F.col("near.l_license")).alias("license"),
                      origin.alias("origin"), F.when(origin == "inherited", F.col("near.up")).alias("from_dir"))


def scan_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The scan over ``documents``; ``path`` names the column of their paths, if there is one. Without, each has its own licence or none."""
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    found = scan_files(docs.select(F.col("doc_id").alias("file_id"), where.alias("path"), "text"), edges=True)
    return found.withColumnRenamed("file_id", "doc_id")
