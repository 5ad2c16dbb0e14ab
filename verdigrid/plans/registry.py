"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.plans import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; ``needs`` names the views its SQL uses, inlined as common table expressions."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = with_views(sql, needs)
        return function

    return add


def with_views(sql: str, needs: tuple[str, ...]) -> str:
    """Put the view definitions before a query that may bring further CTEs as ``WITH ...``."""
    if "crown_edges" in needs and "crown_centres" not in needs:
        needs = ("crown_centres", *needs)
    parts = [f"{name} AS ({views.SQL[name].strip()})" for name in needs]
    body = sql.strip()
    if body.startswith("WITH RECURSIVE "):
        raise ValueError("recursive checks are not supported")
    if body.startswith("WITH "):
        return "WITH " + ",\n".join([*parts, body[len("WITH "):]])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})
