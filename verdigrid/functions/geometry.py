"""Rings, edges and the point-in-polygon test as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of one closed ring ``array<array<double>>``."""
    return F.transform(
        F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))),
        lambda vertex, i: F.struct(
            vertex[0].alias("x1"),
            vertex[1].alias("y1"),
            F.get(ring, i + 1)[0].alias("x2"),
            F.get(ring, i + 1)[1].alias("y2"),
        ),
    )


def spans(y1: Column, y2: Column, y: Column) -> Column:
    """The edge crosses height ``y``; half-open, so a shared vertex counts once."""
    return (y1 > y) != (y2 > y)


def crosses_right(x1, y1, x2, y2, x, y) -> Column:
    """The edge crosses the horizontal ray from ``(x, y)`` to the right."""
    return F.when(spans(y1, y2, y), x < (x2 - x1) * (y - y1) / (y2 - y1) + x1).otherwise(F.lit(False))


def on_edge(x1, y1, x2, y2, x, y) -> Column:
    """The point lies on the closed edge."""
    return (
        ((x2 - x1) * (y - y1) == (y2 - y1) * (x - x1))
        & x.between(F.least(x1, x2), F.greatest(x1, x2))
        & y.between(F.least(y1, y2), F.greatest(y1, y2))
    )


def inside_cell(base: Column, edges: Column, x: Column, y: Column) -> Column:
    """Inside-or-on test of a point against one index cell (see ``operators.spatial``)."""
    odd = F.aggregate(
        edges,
        base,
        lambda acc, e: acc
        != (crosses_right(e.x1, e.y1, e.x2, e.y2, x, y) != F.coalesce(e.y_right > y, F.lit(False))),
    )
    touches = F.exists(edges, lambda e: on_edge(e.x1, e.y1, e.x2, e.y2, x, y))
    return odd | touches
