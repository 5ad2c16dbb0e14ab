"""Session defaults and the size checks that guard broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app: str = "verdigrid", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC times."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder that ``spark.checkpoint.dir`` names.

    Without that setting only a local session, where all tasks share the driver's disk, gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = _local_scratch()
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="verdigrid-")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared scratch folder and read back, for steps that read a frame many times."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def within(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` holds at most ``rows`` rows and about ``size`` bytes; reads no more than one row past the bound.

    The bytes are those of the rows written as JSON, an upper estimate of what a broadcast holds per row.
    """
    width = F.length(F.to_json(F.struct(*df.columns))) if df.columns else F.lit(0)
    found = df.limit(rows + 1).select(width.alias("w")).agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    return found[0] <= rows and found[1] <= size


def broadcast_within(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its rows and bytes are checked to be within the bounds.

    Beyond them the frame is returned unmarked and the join shuffles, with AQE splitting hot keys.
    """
    return F.broadcast(df) if within(df, rows, size) else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once for each application, for operators with Python helpers."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(), "verdigrid-library.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
