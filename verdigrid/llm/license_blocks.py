"""Header blocks and whole licence files against licence texts: sparse TF-IDF vectors with term counts (DataFrame operations only).

The block of a file is its whole text if its name is that of a licence file, else its header: the leading run of comment lines, or the leading block
comment, or the leading paragraph. Comment marks are no terms, so a notice wrapped over several lines is one vector.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import accumulate
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.common import stored

LICENCE_FILE = r"(?i)^(?:LICEN[CS]E|COPYING)(?:[.-][a-z0-9.+-]+)?$"
#: Matching blocks that are broadcast on the way back (about 100 bytes each); more are joined by shuffle, over this many salts.
BROADCAST_BLOCKS = 100_000
SALTS = 16
#: Shares of a template's squared weight, heaviest terms first, whose terms are counted before a block is expanded; 1 must be among them.
SHARES = (0.4, 0.7, 1.0)
# Marks of line comments, and of block comments with their ends.
_LINE_MARKS = r"#|//|--|;|%|\.\\\"|'|REM\b|dnl\b"
_BLOCK_MARKS = {"/*": "*/", "<!--": "-->", '"""': '"""', "'''": "'''", "(*": "*)", "{-": "-}"}
_BREAK = r"[^a-z0-9\p{L}\p{N}]+"


def license_texts(folder: str | Path = Path(__file__).parent / "license_texts") -> list[tuple[str, str]]:
    """``(licence, text)`` of each ``<licence>.txt`` and standard header ``<licence>.header.txt``, read on the driver.

    The headers of the lesser and the Affero licence are those of the general one with the other name.
    """
    out = [(p.name.removesuffix(".txt").removesuffix(".header"), p.read_text()) for p in sorted(Path(folder).glob("*.txt"))]
    general = [(n, t) for n, t in out if n.startswith("GPL-") and len(t) < 1000]
    for name, text in general:
        lesser = {"GPL-3.0": "LGPL-3.0", "GPL-2.0": "LGPL-2.0"}[name]
        out.append((lesser, text.replace("General Public", "Lesser General Public")))
        if name == "GPL-3.0":
            out.append(("AGPL-3.0", text.replace("General Public", "Affero General Public")))
    return out


def counts_of(text: str) -> Counter:
    return Counter(w for w in re.split(r"[\W_]+", text.lower()) if w)


def block_of(path: Column, text: Column) -> Column:
    """The block of a file; null if it has none. A null path is no licence file."""
    is_file = F.coalesce(F.regexp_extract(path, r"([^/]*)$", 1).rlike(LICENCE_FILE), F.lit(False))

    def block(start: Column) -> Column:
        lines = F.when(start.rlike(rf"^(?:{_LINE_MARKS})"), F.split(start, rf"\n(?![ \t]*(?:{_LINE_MARKS}))", 2)[0])
        head = lines.otherwise(F.split(start, r"\n[ \t\r]*\n", 2)[0])
        for mark, end in _BLOCK_MARKS.items():
            head = F.when(F.startswith(start, F.lit(mark)), F.substring_index(F.substr(start, F.lit(len(mark) + 1)), end, 1)).otherwise(head)
        return F.nullif(F.when(is_file, start).otherwise(head), F.lit(""))

    # bound by a lambda, so that the text is trimmed once
    return F.transform(F.array(F.ltrim(text, F.lit(" \t\n\x0b\f\r"))), block)[0]


def _words(block: Column) -> Column:
    return F.array_remove(F.split(F.lower(block), _BREAK), "")


def _known(block: Column, vocabulary: list[str]) -> Column:
    """The different words of the vocabulary in a block."""
    return F.array_distinct(F.filter(F.split(F.lower(block), _BREAK), lambda w: w.isin(vocabulary)))


def _constant(words) -> Column:
    """An array of words as one folded literal."""
    return F.split(F.lit(" ".join(words)), " ")


def block_weights(blocks: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the vocabulary over all ``block`` rows, and that of a term of one block; only these counts reach the driver."""
    known = _known(F.col("block"), vocabulary)
    rows = blocks.select(F.explode(F.concat(known, F.array(F.lit("")))).alias("term")).groupBy("term").count()
    counts = dict(rows.collect())
    total = counts.pop("", 0)
    return {w: 1 + math.log((1 + total) / (1 + counts.get(w, 0))) for w in vocabulary}, 1 + math.log((1 + total) / 2)


def term_bounds(vector: dict[str, float], least: float) -> list[tuple[int, list[str]]]:
    """Sets of a template's heaviest terms, and how many of each set a block must have to reach the cosine ``least``.

    By Cauchy-Schwarz the cosine is at most the length of the template on the shared terms over its whole length, so a block misses at most
    ``1 - least^2`` of the squared weights. Of a set that holds more than this it therefore has the rest, for which the heaviest terms need the fewest.
    """
    ranked = sorted(vector, key=lambda w: (-vector[w], w))
    squares = [vector[w] ** 2 for w in ranked]
    whole = sum(squares)
    missed = (1 - least * least) * whole + 1e-9 * whole
    upto = list(accumulate(squares))
    out = []
    for share in SHARES:
        size = next((i for i, held in enumerate(upto, 1) if held >= share * whole), len(ranked))
        goal = upto[size - 1] - missed
        if goal > 0:
            out.append((next(i for i, held in enumerate(upto, 1) if held >= goal), ranked[:size]))
    return out


def matching_blocks(docs: DataFrame, path: str, text: str, templates: list[tuple[str, str]], least: float) -> DataFrame:
    """``block_id, block_license, block_similarity`` of each different block whose cosine to a template is ``least`` or more.

    Term frequency is ``1 + ln(count)``. A term outside the templates weighs as one of a single block. Only blocks that share enough different terms
    with a template to reach ``least`` (exact bounds, ``term_bounds``, checked in the scan) are grouped by content and expanded into vectors, so equal licence files
    are compared once. The greatest cosine wins, then the template named first. Null and empty texts have no block.
    """
    blocks = docs.select(block_of(F.col(path), F.col(text)).alias("block")).where("block IS NOT NULL")
    counts = [counts_of(t) for _, t in templates]
    weights, rare = block_weights(blocks, sorted(set().union(*counts)))
    vectors = [{w: (1 + math.log(n)) * weights[w] for w, n in c.items()} for c in counts]
    known = _known(F.col("block"), sorted(weights))
    # one folded literal; the block's known terms are bound once, for all templates
    bounds = F.array(
        *[F.array(*[F.struct(F.lit(need).alias("need"), _constant(words).alias("words")) for need, words in term_bounds(v, least)]) for v in vectors]
    )
    holds = lambda k: lambda b: (F.size(k) >= b["need"]) & (F.size(F.array_intersect(k, b["words"])) >= b["need"])
    enough = F.exists(F.array(known), lambda k: F.exists(bounds, lambda sets: F.forall(sets, holds(k))))
    near = blocks.where(enough).select(F.sha2("block", 256).alias("block_id"), "block")
    # the different blocks: copies meet by digest after one block of each has been kept per task
    near = stored(near.groupBy("block_id").agg(F.any_value("block").alias("block")), "license-blocks")
    terms = near.select("block_id", F.explode(_words(F.col("block"))).alias("term")).groupBy("block_id", "term").agg(F.count("*").alias("n"))
    spark = docs.sparkSession
    table = [
        (w, float(weights[w]), [(i, v[w] / math.sqrt(sum(x * x for x in v.values()))) for i, v in enumerate(vectors) if w in v]) for w in sorted(weights)
    ]
    table = spark.createDataFrame(table, "term string, idf double, parts array<struct<template int, part double>>")
    value = (1 + F.log("n")) * F.coalesce("idf", F.lit(rare))
    # both sums are over the terms of one block; the table of the templates' terms is fixed in size
    valued = terms.join(F.broadcast(table), "term", "left").select("block_id", value.alias("value"), "parts")
    norms = valued.groupBy("block_id").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    dots = valued.select("block_id", "value", F.explode("parts").alias("p")).groupBy("block_id", "p.template").agg(F.sum(F.col("value") * F.col("p.part")).alias("dot"))
    cosine = F.round(F.col("dot") / F.col("norm"), 9)
    best = dots.join(norms, "block_id").groupBy("block_id").agg(F.max(F.struct(cosine.alias("similarity"), (-F.col("template")).alias("order"))).alias("best"))
    names = _constant([name for name, _ in templates])
    found = best.where(F.col("best.similarity") >= least)
    return stored(found.select("block_id", F.get(names, -F.col("best.order")).alias("block_license"), F.col("best.similarity").alias("block_similarity")), "license-blocks")


def with_blocks(scored: DataFrame, matched: DataFrame, path: Column, text: Column) -> DataFrame:
    """``scored`` with ``block_license`` and ``block_similarity``. A frequent block is no hot key: it is broadcast, or salted."""
    keyed = scored.withColumn("block_id", F.sha2(block_of(path, text), 256))
    if matched.count() <= BROADCAST_BLOCKS:
        return keyed.join(F.broadcast(matched), "block_id", "left").drop("block_id")
    salt = F.pmod(F.xxhash64(path, text), F.lit(SALTS))
    spread = matched.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    keyed = keyed.withColumn("block_id", F.coalesce("block_id", F.hex(F.xxhash64(path)))).withColumn("salt", salt)
    return keyed.join(spread, ["block_id", "salt"], "left").drop("block_id", "salt")
