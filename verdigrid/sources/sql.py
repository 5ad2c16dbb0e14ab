"""SQL text as source and sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def sql_source(spark: SparkSession, query: str, tables: Mapping[str, str | DataFrame] | None = None) -> DataFrame:
    """Run a SQL text over named Parquet paths or frames.

    Frames and paths are handed to ``spark.sql`` as arguments under ``{name}``, so no view of the
    session is replaced.
    """
    frames = {
        name: spark.read.parquet(source) if isinstance(source, str) else source
        for name, source in (tables or {}).items()
    }
    return spark.sql(query, **frames)


def sql_table_sink(spark: SparkSession, query: str, table: str = "data", path: str | None = None) -> None:
    """Create a table from a query; an existing table is an error."""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {table} USING parquet{location} AS {query}")
