"""Stored image collections, one folder per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.operators.scenes import date_range

DAY = "scene_day"


def write_scenes(
    df: DataFrame, path: str, time: str = "scene_date", keys: Sequence[str] = ("pixel_id",), mode: str = "errorifexists"
) -> None:
    """Store a collection by day. A day with many rows is spread over several files by its pixels; rows without a time have a folder of their own."""
    if DAY in df.columns:
        raise ValueError(f"the column {DAY} names the folders")
    order = [DAY, *keys]
    dated = df.withColumn(DAY, F.to_date(time))
    dated.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy(DAY).parquet(path)


def scan_scenes(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None, satellite: str | None = None, time: str = "scene_date"
) -> DataFrame:
    """Scenes from ``start`` up to, but not on, ``end``: only the folders of these days are read.

    One day more is read on either side, as a session in another time zone may have stored it; the times themselves decide. Without both
    dates the whole collection comes, rows without a time included.
    """
    df = spark.read.parquet(path)
    if start is not None:
        df = df.filter(F.col(DAY) >= F.date_sub(F.lit(start).cast("date"), 1))
    if end is not None:
        df = df.filter(F.col(DAY) <= F.date_add(F.lit(end).cast("date"), 1))
    df = df.drop(DAY)
    if start is not None or end is not None:
        return date_range(df, start or "0001-01-01", end or "9999-12-31", satellite, time)
    return df if satellite is None else df.filter(F.col("satellite") == F.lit(satellite))
