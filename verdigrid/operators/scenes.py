"""Image collections: many dated scenes per pixel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_range(
    df: DataFrame, start: str, end: str, satellite: str | None = None, time: str = "scene_date"
) -> DataFrame:
    """Scenes of one satellite from ``start`` up to, but not on, ``end``; pushed to the scan."""
    kind = df.schema[time].dataType
    out = df.filter((F.col(time) >= F.lit(start).cast(kind)) & (F.col(time) < F.lit(end).cast(kind)))
    return out if satellite is None else out.filter(F.col("satellite") == F.lit(satellite))


def max_composite(df: DataFrame, bands: Sequence[str], pixel: Sequence[str] = ("pixel_id",)) -> DataFrame:
    """Largest value per pixel and band over all scenes; combines map-side."""
    return df.groupBy(*pixel).agg(*[F.max(b).alias(b) for b in bands])


def first_scene(
    df: DataFrame, bands: Sequence[str], pixel: Sequence[str] = ("pixel_id",),
    order: Sequence[str] = ("scene_date",),
) -> DataFrame:
    """Per pixel the values of its first scene; ``order`` must tell scenes apart."""
    by = F.struct(*order)
    first = F.min_by(F.struct(*order, *[b for b in bands if b not in order]), by).alias("_first")
    return df.groupBy(*pixel).agg(first).select(*pixel, "_first.*")


def first_of_collection(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first row of the whole collection: a top-1 per task, merged once."""
    return df.orderBy(*order).limit(1)
