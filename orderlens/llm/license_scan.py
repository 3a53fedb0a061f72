"""Licence texts in documents, by the Dice coefficient over word bigrams.

Everything here is DataFrame expressions; no Python runs on rows.

Documents are compared as a whole, by line and by block of lines, normalised to lower-case
words. A part of n bigrams reaches the threshold t with a template of m only if n lies
between m t / (2 - t) and m (2 - t) / t, and if it shares at least (n + m) t / 2 bigrams; so
parts of other sizes are dropped before any bigram is made, and a part that holds none
of a template's few guard bigrams cannot reach it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Notices under which texts are commonly published.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
    "License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD notice": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
}


def normalised(text: Column) -> Column:
    """Lower-case words of letters and digits, one space apart."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def bigrams_of(text: str) -> set[str]:
    """The same bigrams on the driver, for the templates."""
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return {" ".join(p) for p in zip(words, words[1:], strict=False)}


def _bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(
        F.zip_with(
            F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n),
            lambda x, y: F.concat_ws(" ", x, y),
        )
    )


def _guards(template: set[str], others: list[set[str]], threshold: float) -> list[str]:
    """Bigrams of which a part must hold one to reach the threshold: it shares at least
    m t / (2 - t) of the m, so it can't miss all of any m - that + 1. Those that fewest
    templates share come first."""
    must = math.ceil(len(template) * threshold / (2 - threshold) - 1e-9)
    rare = sorted(template, key=lambda b: (sum(b in o for o in others), b))
    return rare[: len(template) - must + 1]


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, kind (document, block or line), number and text of every part. A document
    of one block has no separate block, a block of one line no separate line; numbers
    count from 0 within the kind."""
    text = F.col("text")
    blocks = F.split(text, r"\n[ \t]*\n\s*")
    lines = F.split(text, r"\n")
    kind = lambda name, items: F.transform(
        items, lambda x, i: F.struct(F.lit(name).alias("kind"), i.alias("number"), x.alias("part"))
    )
    several = lambda name, items: F.when(F.size(items) > 1, kind(name, items)).otherwise(
        F.array().cast("array<struct<kind:string,number:int,part:string>>")
    )
    all_parts = F.concat(
        kind("document", F.array(text)), several("block", blocks), several("line", lines)
    )
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
        .filter("text IS NOT NULL")
        .select("doc_id", F.explode(all_parts).alias("p"))
        .select("doc_id", "p.kind", "p.number", "p.part")
    )


def scan(
    spark: SparkSession,
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, kind, number, template, shared, dice of all parts and templates with a Dice
    coefficient of at least ``threshold``.

    Null, empty and one-word texts have no bigrams and match nothing; rows without an id
    carry null; repeated rows give repeated results; other columns are ignored. Long texts are
    read whole; parts whose size no template can match are dropped before any bigram is made.
    Templates of equal coefficients are all returned. An empty table gives no rows. Templates
    go to every task, so they are limited to about ten thousand bigrams; divide a larger
    set and unite the results.
    """
    known = {name: grams for name, t in templates.items() if (grams := bigrams_of(t))}
    total = sum(map(len, known.values()))
    if total > 10_000:
        raise ValueError(f"{total} bigrams of templates are too many for one scan")
    if not known:
        known = {"": {"\0"}}
    sizes = {len(g) for g in known.values()}
    # The bounds only prune, so they leave room for rounding.
    reach = (2 - threshold) / threshold + 1e-9
    least, most = min(sizes) / reach, max(sizes) * reach
    guards = sorted({b for n, g in known.items()
                     for b in _guards(g, [o for m, o in known.items() if m != n], threshold)})
    guarded = r"(^| )(" + "|".join(map(re.escape, guards)) + r")( |$)"

    candidates = (
        parts(docs.filter(F.lower("text").rlike(_loosely(guards))))
        # A word and a space are two characters at least.
        .filter(F.length("part") >= 2 * least)
        .withColumn("clean", normalised(F.col("part")))
        .filter(F.col("clean").rlike(guarded))
        .withColumn("grams", _bigrams(F.split("clean", " ")))
        .withColumn("n", F.size("grams"))
        .filter((F.col("n") >= least) & (F.col("n") <= most))
        .select("doc_id", "kind", "number", "grams", "n")
    )
    rows = [(name, len(g), sorted(g)) for name, g in sorted(known.items())]
    listed = F.array(*[
        F.struct(F.lit(n).alias("template"), F.lit(m).alias("m"),
                 F.array(*map(F.lit, g)).alias("template_grams")) for n, m, g in rows
    ])
    n, m = F.col("n"), F.col("t.m")
    in_size = (n * reach >= m) & (m * reach >= n)
    return (
        candidates.withColumn("t", F.explode(listed))
        .filter(in_size)
        .withColumn("shared", F.size(F.array_intersect("grams", "t.template_grams")))
        .withColumn("dice", 2 * F.col("shared") / (n + m))
        .filter(F.col("dice") >= threshold)
        .select("doc_id", "kind", "number", F.col("t.template").alias("template"), "shared", "dice")
    )


def _loosely(guards: list[str]) -> str:
    """Finds the guard bigrams in a text that isn't normalised yet, with any signs between
    the words. The first characters are looked at before the alternatives."""
    first = "".join(sorted({re.escape(g[0]) for g in guards}))
    between = r"[^\p{L}\p{N}]+"
    either = "|".join(between.join(map(re.escape, g.split(" "))) for g in guards)
    return rf"(?<![a-z0-9])(?=[{first}])(?:{either})"


def oracle(templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same result in DuckDB SQL, without any pruning."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(
        f"({quoted(n)}, [{', '.join(map(quoted, sorted(bigrams_of(t))))}])"
        for n, t in sorted(templates.items())
    )
    clean = r"trim(regexp_replace(lower(part), '[^\p{L}\p{N}]+', ' ', 'g'))"
    return rf"""
WITH d AS (
  SELECT doc_id, text, string_split_regex(text, '\n[ \t]*\n\s*') AS blocks,
         string_split(text, chr(10)) AS lines
  FROM documents WHERE text IS NOT NULL
), parts AS (
  SELECT doc_id, 'document' AS kind, 0 AS number, text AS part FROM d
  UNION ALL
  SELECT doc_id, 'block', unnest(range(len(blocks))), unnest(blocks) FROM d WHERE len(blocks) > 1
  UNION ALL
  SELECT doc_id, 'line', unnest(range(len(lines))), unnest(lines) FROM d WHERE len(lines) > 1
), words AS (
  SELECT doc_id, kind, number, string_split({clean}, ' ') AS w FROM parts
), grams AS (
  SELECT doc_id, kind, number,
    list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g
  FROM words WHERE len(w) > 1
), templates(template, t) AS (VALUES {rows})
SELECT doc_id, kind, CAST(number AS INTEGER) AS number, template,
  CAST(len(list_intersect(g, t)) AS INTEGER) AS shared,
  2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice
FROM grams, templates
WHERE 2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) >= {threshold}
"""
