"""Row/column to map coordinates and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdigrid.meta import GridMeta


def centre_x(meta: GridMeta, col: Column) -> Column:
    return F.round(F.lit(float(meta.x0)) + F.lit(float(meta.dx)) * (col + F.lit(0.5)), 9)


def centre_y(meta: GridMeta, row: Column) -> Column:
    return F.round(F.lit(float(meta.y0)) - F.lit(float(meta.dy)) * (row + F.lit(0.5)), 9)


def col_of(meta: GridMeta, x: Column) -> Column:
    return F.floor((x - F.lit(float(meta.x0))) / F.lit(float(meta.dx)))


def row_of(meta: GridMeta, y: Column) -> Column:
    return F.floor((F.lit(float(meta.y0)) - y) / F.lit(float(meta.dy)))


def block_of(index: Column, k: int) -> Column:
    """Coarse index of a fine one, ``k`` fine cells per coarse cell and axis."""
    return F.floor(index / F.lit(float(k)))
