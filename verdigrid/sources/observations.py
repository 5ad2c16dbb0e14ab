"""Nested station records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.sources.documents import RANGE_BYTES, scan_array

RECORD_SCHEMA = (
    "sourceId string, referenceTime string, observations array<struct<"
    "elementId: string, value: double, unit: string, timeOffset: string>>"
)


def scan_observations(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Records from JSON lines with a given schema; no inference pass over the data."""
    return spark.read.schema(schema).json(path)


def scan_response(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA, range_bytes: int | None = RANGE_BYTES) -> DataFrame:
    """Records from saved service answers, JSON documents with a ``data`` array, read by ranges of bytes.

    With ``range_bytes=None`` each document is parsed by one task, for file systems that Arrow cannot open.
    """
    if range_bytes is not None:
        return scan_array(spark, path, "data", range_bytes).select(F.from_json("value", schema).alias("r")).select("r.*")
    records = T.StructType([T.StructField("data", T.ArrayType(T.StructType.fromDDL(schema)))])
    return spark.read.option("multiLine", True).schema(records).json(path).selectExpr("inline(data)")
