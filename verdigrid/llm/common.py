"""Helpers shared by the text operators: word rule, stored intermediate tables, connected components."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.session import scratch_path

#: Words are runs of characters other than these.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the session's shared checkpoint folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each wanted helper column a name that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def solid_key(value: F.Column) -> F.Column:
    """A text column as a join key that is never null."""
    return F.concat(F.when(value.isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(value.cast("string"), F.lit("")))


def uniform(*parts) -> F.Column:
    """A number in [0, 1) that depends on ``parts`` only; the same in any engine that has MD5."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(16**13))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once for each application, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "verdigrid-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def hand_back() -> None:
    """Give memory that this worker has freed back to the system, as workers stay after their task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` by a function of this package."""
    ship(df.sparkSession)

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            hand_back()

    return df.mapInArrow(tidy, schema)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges (a, b)`` as ``(node, root)``, root the smallest node.

    Alternating large-star and small-star rounds: every round is two grouped minima and two joins over at most
    as many edges as it began with, so a hub never gathers its neighbours. Each round is written to the shared
    checkpoint folder; only a count and a checksum reach the driver. Nodes without an edge are not returned.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    pairs = stored(pairs, "edges")
    state = None
    for _ in range(max_rounds):
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lower, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        pairs = stored(small, "edges")
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
