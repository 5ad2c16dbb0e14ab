"""Licence scan by sparse TF-IDF cosine and inheritance along directories (DataFrame operations only)."""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.common import fresh, stored
from verdigrid.llm.license_blocks import LICENCE_FILE, license_texts, matching_blocks, with_blocks

# Notices by licence.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "proprietary": "All rights reserved.",
}
LEAST = 0.8
_SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+()-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[A-Za-z0-9.+()-]+)*)"
_BREAK = r"[^a-z0-9.\p{L}\p{N}]+"


def _words(lowered: Column) -> Column:
    """Terms in order, with repeats and empty ones; dots inside a term stay (version numbers), those around it go."""
    return F.transform(F.split(lowered, _BREAK), lambda w: F.trim(w, F.lit(".")))


def terms_of(line: Column) -> Column:
    """Different lower-case terms."""
    return F.array_remove(F.array_distinct(_words(F.lower(line))), "")


def plain_terms(line: str) -> set[str]:
    return {w.strip(".") for w in re.split(r"[^\w.]+|_", line.lower())} - {""}


def _lines(text: Column) -> Column:
    """The lines of the text in lower case."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), "\n")


def _known(terms: Column, vocabulary: list[str]) -> Column:
    """The different terms of the vocabulary, in the order of the line."""
    return F.array_distinct(F.filter(terms, lambda w: w.isin(vocabulary)))


def marks_of(templates: dict[str, str], weights: dict[str, float], least: float) -> list[str]:
    """Terms of which a line must have one to reach the cosine ``least`` to any template.

    The cosine is at most the length of the template on the shared terms over its whole length, so a line misses at most ``1 - least^2`` of the squared
    weights. The heaviest terms that hold more than this cannot all be missed.
    """
    marks = set()
    for template in templates.values():
        ranked = sorted(plain_terms(template), key=lambda w: (-weights[w], w))
        missed = (1 - least * least + 1e-9) * sum(weights[w] ** 2 for w in ranked)
        for w in ranked:
            marks.add(w)
            missed -= weights[w] ** 2
            if missed < 0:
                break
    return sorted(marks)


def term_weights(docs: DataFrame, text: str, templates: dict[str, str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the templates' terms over all lines of all texts, and that of a term of one line.

    Only counts of this fixed vocabulary reach the driver.
    """
    words = sorted(set().union(*map(plain_terms, templates.values())))
    lines = docs.select(F.explode(_lines(F.col(text))).alias("line"))
    known = lines.select(F.explode(F.concat(_known(_words(F.col("line")), words), F.array(F.lit("")))).alias("term"))
    counts = dict(known.groupBy("term").count().collect())
    total = counts.pop("", 0)
    return {w: 1 + math.log((1 + total) / (1 + counts.get(w, 0))) for w in words}, 1 + math.log((1 + total) / 2)


def notices(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with ``own_license`` and ``similarity`` of the line nearest to a template.

    Terms count once per line (binary term frequency). A term outside the templates weighs as one seen in a single line. The vocabulary is fixed, so its
    weights are part of the expression: nothing is exploded or shuffled. Only lines that hold a term without which no template is near enough are cut into
    terms (``marks_of``, an exact bound). Of equal cosines the licence named first wins.
    """
    weights, rare = term_weights(docs, text, templates)
    squares = {w: v * v for w, v in weights.items()}
    marks = marks_of(templates, weights, least)
    square = F.create_map(*[F.lit(x) for w in sorted(squares) for x in (w, squares[w])])

    def total(terms: Column) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda a, t: a + F.element_at(square, t))

    def best(line: Column) -> Column:
        # bound by lambdas, so that terms and known terms are found once
        return F.transform(F.array(terms_of(line)), lambda t: F.transform(F.array(_known(t, sorted(squares))), lambda k: nearest(t, k))[0])[0]

    def nearest(terms: Column, known: Column) -> Column:
        norm = F.sqrt(total(known) + (F.size(terms) - F.size(known)) * rare * rare)
        scores = []
        for name, template in templates.items():
            own = sorted(plain_terms(template))
            length = math.sqrt(sum(squares[w] for w in own))
            shared = total(F.array_intersect(known, F.array(*map(F.lit, own))))
            scores.append(F.struct((shared / (norm * length)).alias("similarity"), F.lit(name).alias("license")))
        return F.when(F.size(known) > 1, F.array_max(F.array(*[F.struct(s["similarity"].alias("similarity"), F.lit(-i).alias("order"), s["license"].alias("license")) for i, s in enumerate(scores)])))

    row, top = fresh(docs, "row", "top")
    lines = _lines(F.col(text))
    if least > 0:
        lines = F.filter(lines, lambda line: reduce(or_, [F.contains(line, F.lit(w)) for w in marks], F.lit(False)))
    scored = docs.select(F.struct("*").alias(row), F.array_max(F.transform(lines, best)).alias(top))
    found = F.col(f"{top}.similarity") >= least
    return scored.select(
        F.col(row).alias("row"), F.when(found, F.col(f"{top}.license")).alias("own_license"), F.when(found, F.col(f"{top}.similarity")).alias("similarity")
    )


def folder_of(path: Column) -> Column:
    """The directory of a path; the top is the empty string."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def folders_above(folder: Column) -> Column:
    """The folder and all above it, as structs of depth and name."""
    parts = F.split(folder, "/")
    names = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("folder"))
    )
    top = F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("folder")))
    return F.when(folder == "", top).otherwise(F.concat(top, names))


def declared(text: Column) -> Column:
    """The expression of the first ``SPDX-License-Identifier`` of a text, else null."""
    return F.when(F.contains(text, F.lit("SPDX-License-Identifier:")), F.nullif(F.regexp_extract(text, _SPDX, 1), F.lit("")))


def scan_licenses(
    docs: DataFrame, path: str = "path", text: str = "text", templates: dict[str, str] = TEMPLATES, least: float = LEAST,
    texts: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with ``own_license, similarity, license, inherited_from``.

    A file's own licence is that of its SPDX line (similarity 1); else the nearer of two: the line nearest to a short notice of ``templates``, and its
    header block, or whole text if it is a licence file, nearest to a licence text of ``texts`` (``license_texts()``) or to a notice. Equal cosines: the line.
    A file without an own licence takes that of the licence file in the nearest directory above it. Several licence files in a
    directory: the greater cosine wins, then the lesser licence name. A null text has no licence, a null path inherits nothing.
    Repeated rows get equal answers; an empty table gives an empty result.

    Only different directories are expanded to their ancestors; they join the licence directories by name, and the answer joins the files back.
    """
    known = (license_texts() if texts is None else texts) + list(templates.items())
    matched = matching_blocks(docs, path, text, known, least)
    at, whole = F.col(f"row.{path}"), F.col(f"row.{text}")
    scored = with_blocks(notices(docs, text, templates, least), matched, at, whole)
    spdx, nearer = declared(whole), F.col("block_similarity") > F.coalesce("similarity", F.lit(0.0))
    scored = scored.select(
        "row",
        F.when(spdx.isNotNull(), spdx).when(nearer, F.col("block_license")).otherwise(F.col("own_license")).alias("own_license"),
        F.when(spdx.isNotNull(), 1.0).when(nearer, F.col("block_similarity")).otherwise(F.col("similarity")).alias("similarity"),
    )
    files = scored.select("row", "own_license", "similarity", F.when(at.isNotNull(), folder_of(at)).alias("folder"))
    is_file = F.regexp_extract(at, r"([^/]*)$", 1).rlike(LICENCE_FILE)
    sources = files.where(is_file & F.col("own_license").isNotNull()).groupBy("folder").agg(
        F.min(F.struct((-F.col("similarity")).alias("far"), F.col("own_license").alias("license"))).alias("first")
    )
    sources = stored(sources.select("folder", F.col("first.license").alias("from_file")), "license-folders")
    folders = docs.select(folder_of(F.col(path)).alias("folder")).where("folder IS NOT NULL").distinct()
    above = folders.select("folder", F.explode(folders_above(F.col("folder"))).alias("up")).select("folder", "up.depth", F.col("up.folder").alias("above"))
    near = above.join(sources.withColumnRenamed("folder", "above"), "above").groupBy("folder").agg(F.max(F.struct("depth", "above", "from_file")).alias("near"))
    inherited = F.col("own_license").isNull()
    return files.join(near, "folder", "left").select(
        "row", "own_license", "similarity", F.coalesce("own_license", "near.from_file").alias("license"),
        F.when(inherited, F.col("near.above")).alias("inherited_from"),
    )
