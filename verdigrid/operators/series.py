"""Station series: flatten nested observations, filter, rank."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdigrid.session import broadcast_within

# Meteorological summer months, and the first full year of the satellite in use.
SUMMER = (6, 8)
OBSERVED_SINCE = 2013


def flatten_observations(records: DataFrame) -> DataFrame:
    """One row per observation, with source and time of its record."""
    return records.select(
        F.col("sourceId").alias("source_id"),
        F.col("referenceTime").alias("reference_time"),
        F.inline("observations"),
    ).withColumnsRenamed({"elementId": "element_id", "timeOffset": "time_offset"})


def parse_time(df: DataFrame, name: str = "reference_time", strict: bool = True) -> DataFrame:
    """ISO text to timestamp. Text that is no time raises; with ``strict=False`` it becomes null."""
    time = F.try_to_timestamp(F.col(name))
    if strict:
        malformed = F.raise_error(F.concat(F.lit(f"{name} holds no time: "), F.col(name))).cast("timestamp")
        time = F.when(time.isNull() & F.col(name).isNotNull(), malformed).otherwise(time)
    return df.withColumn(name, time)


def summer_filter(df: DataFrame, time: str = "reference_time", months: tuple[int, int] = SUMMER) -> DataFrame:
    return df.filter(F.month(time).between(*months))


def observation_period(df: DataFrame, since: int = OBSERVED_SINCE, time: str = "reference_time") -> DataFrame:
    """Records from the start of the year on, in the session's time zone; the comparison with a literal is pushed to the scan."""
    return df.filter(F.col(time) >= F.lit(f"{since:04d}-01-01").cast(df.schema[time].dataType))


def attribute_filter(df: DataFrame, name: str, *values) -> DataFrame:
    """Rows whose attribute equals one of the values; pushed to the scan."""
    return df.filter(F.col(name).isin(*values) if len(values) > 1 else F.col(name) == F.lit(values[0]))


def concat_rows(*frames: DataFrame) -> DataFrame:
    """Append frames by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sort_desc(df: DataFrame, by: str = "value", tie: Sequence[str] = ("reference_time",)) -> DataFrame:
    return df.orderBy(F.desc(by), *tie)


def head(df: DataFrame, n: int = 5, order: Sequence = ()) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def top_k_per_station(
    df: DataFrame, k: int = 3, station: Sequence[str] = ("source_id",), by: str = "value",
    tie: Sequence[str] = ("reference_time",),
) -> DataFrame:
    """The ``k`` largest records of each station.

    The rank filter is applied before the exchange too (a group limit per task), so a station that
    holds most rows sends ``k`` rows per task.
    """
    ranked = Window.partitionBy(*station).orderBy(F.desc_nulls_last(by), *tie)
    return df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def station_lookup(df: DataFrame, stations: DataFrame, on: Sequence[str] = ("source_id",)) -> DataFrame:
    """Add city and acquisition year; one station may serve several cities."""
    return df.join(broadcast_within(stations), list(on))


def hottest_summer(
    df: DataFrame, stations: DataFrame, since: int = OBSERVED_SINCE, time: str = "reference_time"
) -> DataFrame:
    """Per city the warmest summer record ever and since a year, from one pass over the series.

    Both are mergeable aggregates, so no ranking window and no second scan is needed.
    """
    summer = summer_filter(df.filter(F.col("value").isNotNull()), time)
    # largest value first, earlier time on a tie: minimum of (-value, time)
    key = F.struct((-F.col("value")).alias("n"), F.col(time).alias("t"))
    recent = F.when(F.year(time) >= since, key)
    best = summer.groupBy("source_id").agg(F.min(key).alias("ever"), F.min(recent).alias("recent"))
    return station_lookup(best, stations).select(
        "city", "source_id",
        F.year("recent.t").alias("year_observed"), (-F.col("recent.n")).alias("value_observed"),
        F.year("ever.t").alias("year_record"), (-F.col("ever.n")).alias("value_record"),
    )
