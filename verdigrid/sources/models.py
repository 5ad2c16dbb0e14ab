"""Versioned model store."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from verdigrid.operators.regression import OlsModel


def save_model(spark: SparkSession, model: OlsModel, path: str, version: str | None = None) -> str:
    """Store the coefficients as ``path/version=<time>``; a version is never overwritten."""
    version = version or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H.%M.%S.%fZ")
    model.to_df(spark).coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")
    return version


def load_model(spark: SparkSession, path: str, version: str | None = None) -> OlsModel:
    """The newest version, or the one asked for."""
    stored = spark.read.schema(
        "term string, coefficient double, position int, version string"
    ).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == F.lit(version))
    if version is None or rows.isEmpty():
        raise ValueError(f"no model version {version} at {path}")
    return OlsModel.from_df(rows)
