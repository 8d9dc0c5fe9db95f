"""License scans by TF-IDF cosine and inheritance along paths.

Sentences with a licence cue, from anywhere in a text, and the whole texts that
hold one are compared with templates as sparse TF-IDF vectors: terms are rows,
products are sums over joins on the term. A sentence that is near a template is a
licence header of its file; a text that is near one as a whole, or near the whole
text of a licence in `license_texts`, is a licence file, which speaks for its
directory. A file without a header of its own inherits from
the nearest directory above it that has a licence. Inheritance is resolved for
distinct directories and then joined to the files.

Document frequencies of the templates' terms are counted over all texts; other
terms count as in none, so that foreign words lower a cosine.

Defined cases: null and empty texts have no licence of their own; a null path has
no directory and inherits nothing; of several equally near templates, or licence
files of a directory, the nearest and then the first by name counts; repeated
rows are judged alike; an empty table gives an empty table; extra columns stay,
unless they have the names of the columns added here.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from importlib.resources import files as packaged

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import stage, table

#: Short notices by licence identifier.
TEMPLATES = [
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law, all copyright and related rights are waived under CC0 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
#: Whole licence texts by licence identifier; only whole texts are compared with them.
TEXTS = sorted(
    (f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in (packaged("panelcast.llm") / "license_texts").iterdir() if f.name.endswith(".txt")
)
#: What a sentence must hold to be compared.
CUES = "licen[sc]|spdx|permission is hereby|redistribut|public domain|cc0|creative commons"
TERM = r"[a-z0-9]+(?:[.][0-9]+)*"


@dataclass(frozen=True)
class Nearness:
    """Least cosine of a header sentence, of a whole text to be a licence file, and of one to a whole licence text."""

    header: float = 0.6
    file: float = 0.6
    text: float = 0.8


def _terms(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{TERM}', 0)"


def vocabulary(templates: list[tuple[str, str]]) -> list[str]:
    return sorted({w for _, text in templates for w in re.findall(TERM, text.lower())})


def frequencies(documents: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of texts, and how many of them hold each term of the templates."""
    listed = ", ".join(f"'{w}'" for w in vocabulary(TEMPLATES + TEXTS))
    held = documents.select(F.expr(f"array_intersect({_terms('text')}, array({listed}))").alias("h"))
    counts = held.select(F.explode("h").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    return documents.count(), {r["term"]: r["df"] for r in counts}  # the templates are a fixed list


def cosines(vectors: DataFrame, listed: list[tuple[str, str]], n: int, df: dict[str, int]) -> DataFrame:
    """Rows (_key, part, license, cosine): from rows (_key, part, words), one per text to compare with each listed template."""
    spark = vectors.sparkSession
    templates = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(listed)], "t int, license string, text string")
    templates = templates.select("t", "license", F.explode(F.expr(_terms("text"))).alias("term")).groupBy("t", "license", "term").count()
    idf = spark.createDataFrame([(w, df.get(w, 0)) for w in vocabulary(listed)], "term string, df long").select(
        "term", F.expr(f"ln(({n} + 1) / (df + 1)) + 1").alias("idf")
    )
    most = F.expr(f"ln({n} + 1) + 1")
    ours = vectors.select("_key", "part", F.explode("words").alias("term")).groupBy("_key", "part", "term").count()
    ours = ours.join(F.broadcast(idf), "term", "left").withColumn("w", (1 + F.log("count")) * F.coalesce("idf", most))
    length = ours.groupBy("_key", "part").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    theirs = templates.join(F.broadcast(idf), "term").withColumn("v", (1 + F.log("count")) * F.col("idf"))
    size = theirs.groupBy("t").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("size"))
    theirs = theirs.join(size, "t").select("t", "license", "term", (F.col("v") / F.col("size")).alias("v"))
    return (
        ours.join(F.broadcast(theirs), "term")
        .groupBy("_key", "part", "t", "license")
        .agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
        .join(length, ["_key", "part"])
        .select("_key", "part", "license", F.round(F.col("dot") / F.col("length"), 9).alias("cosine"))
    )


def best(rows: DataFrame, *keys: str) -> DataFrame:
    """The licence with the largest cosine by key, the first by name among equals."""
    least = F.min(F.struct((-F.col("cosine")).alias("c"), "license"))
    return rows.groupBy(*keys).agg(least.alias("b")).select(*keys, F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def own_licenses(files: DataFrame, near: Nearness) -> DataFrame:
    """Rows (_key, directory, header, header_cosine, file, file_cosine) of files with a licence of their own."""
    cue = stage(
        files.filter(F.col("text").rlike(f"(?i){CUES}")).dropDuplicates(["_key"]).select("_key", "directory", "text"), "license-files"
    )
    sentence = r"split(text, '[.!?;]+[\\x20\\x09]+|[\\x0A-\\x0D]+')"
    parts = cue.select("_key", F.posexplode(F.expr(f"filter({sentence}, x -> x rlike '(?i){CUES}')")).alias("part", "s"))
    vectors = parts.select("_key", "part", F.expr(_terms("s")).alias("words")).union(
        cue.select("_key", F.lit(-1), F.expr(_terms("text")))
    )
    vectors = stage(vectors, "license-parts")
    n, df = frequencies(files.select("text"))
    scores = stage(cosines(vectors, TEMPLATES, n, df), "license-cosines")
    texts = cosines(vectors.filter("part < 0"), TEXTS, n, df).filter(F.col("cosine") >= near.text)
    header = best(scores.filter(F.col("part") >= 0).filter(F.col("cosine") >= near.header), "_key")
    whole = best(scores.filter(F.col("part") < 0).filter(F.col("cosine") >= near.file).union(texts), "_key")
    return (
        cue.select("_key", "directory")
        .join(header.toDF("_key", "header", "header_cosine"), "_key", "left")
        .join(whole.toDF("_key", "file", "file_cosine"), "_key", "left")
        .filter("header IS NOT NULL OR file IS NOT NULL")
    )


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """Rows (directory, up, license): the nearest directory at or above each one that has a licence."""
    ladder = directories.withColumn("steps", F.expr("split(directory, '/')")).select(
        "directory", F.explode(F.expr("transform(sequence(0, size(steps)), i -> array_join(slice(steps, 1, i), '/'))")).alias("up")
    )
    return (
        ladder.join(licensed.select(F.col("directory").alias("up"), "license"), "up")
        .groupBy("directory")
        .agg(F.max(F.struct(F.length("up").alias("n"), "up", "license")).alias("m"))
        .select("directory", F.col("m.up").alias("up"), F.col("m.license").alias("license"))
    )


def scan_licenses(files: DataFrame, near: Nearness = Nearness()) -> DataFrame:
    """files (path, text) with license, license_cosine, license_by ('header', 'file' or 'inherited') and license_from."""
    kept = [c for c in files.columns if c not in ("license", "license_cosine", "license_by", "license_from")]
    rows = files.select(*kept).withColumns(
        {
            "_key": F.expr("xxhash64(path, text)"),
            "directory": F.expr("CASE WHEN path LIKE '%/%' THEN regexp_replace(path, '/[^/]*$', '') WHEN path IS NOT NULL THEN '' END"),
        }
    )
    own = stage(own_licenses(rows, near), "license-own")
    of_directory = best(
        own.filter("file IS NOT NULL AND directory IS NOT NULL").select("directory", F.col("file").alias("license"), F.col("file_cosine").alias("cosine")),
        "directory",
    )
    directories = stage(rows.select("directory").filter("directory IS NOT NULL").distinct(), "license-directories")
    above = stage(inherited(directories, of_directory), "license-inherited").select(
        "directory", F.col("up"), F.col("license").alias("from_above")
    )
    judged = rows.join(own.drop("directory"), "_key", "left").join(above, "directory", "left")
    return judged.select(
        *kept,
        F.expr("coalesce(header, file, from_above)").alias("license"),
        F.expr("CASE WHEN header IS NOT NULL THEN header_cosine ELSE file_cosine END").alias("license_cosine"),
        F.expr(
            "CASE WHEN header IS NOT NULL THEN 'header' WHEN file IS NOT NULL THEN 'file' WHEN from_above IS NOT NULL THEN 'inherited' END"
        ).alias("license_by"),
        F.expr("CASE WHEN header IS NULL AND file IS NULL THEN up END").alias("license_from"),
    )


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is a tree with a directory for each language."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "concat_ws('/', source, lang, doc_id) AS path", "text")
    return scan_licenses(docs).drop("text")


QUERIES = {"op4_license_scans": (op4, None)}
