"""Projection of points and reprojection of rasters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.functions import affine, utm
from verdigrid.meta import GridMeta
from verdigrid.operators.bands import PIXEL_KEY
from verdigrid.operators.grid import absent_cells, pixel_centres


#: Share of a projected cell by which its edges may bend beyond its corners; below 0.3 per cent for cells of a degree.
BEND = 0.01


def project_points(
    df: DataFrame, zone: int, lon: str = "lon", lat: str = "lat", names: tuple[str, str] = ("x", "y")
) -> DataFrame:
    """Geographic degrees to easting and northing of a UTM zone."""
    return utm.add_utm(df, F.col(lon), F.col(lat), zone, names)


def unproject_points(
    df: DataFrame, zone: int, x: str = "x", y: str = "y", names: tuple[str, str] = ("lon", "lat")
) -> DataFrame:
    """Easting and northing of a UTM zone to geographic degrees."""
    return utm.add_lonlat(df, F.col(x), F.col(y), zone, names)


def reproject_nearest(
    df: DataFrame,
    meta: GridMeta,
    target: GridMeta,
    bands: Sequence[str],
    fill: float | None = None,
    keep_outside: bool = True,
) -> tuple[DataFrame, GridMeta]:
    """Every band onto the target grid, nearest neighbour, in one pass over the source.

    A source cell projects its four corners into the target CRS, takes the target cells whose centre may lie in their
    box (a little wider, as edges bend), and keeps those whose centre projects back into the source cell. Any pair of
    supported CRS works, degrees included. Each target cell has one such source cell, so these rows need no shuffle.

    With ``keep_outside`` every cell of the target grid comes out: those without a source row, off the source grid or missing in a
    sparse raster, hold ``fill`` (null by default). They are found by bitmaps of the moved cells' keys (``absent_cells``), for which the keys
    are projected once more; no band is shuffled.
    """
    cells = pixel_centres(df.select(*PIXEL_KEY, *bands), meta, "_x", "_y")
    corners = []
    for i, (a, b) in enumerate(((-0.5, -0.5), (-0.5, 0.5), (0.5, -0.5), (0.5, 0.5))):
        names = (f"_tx{i}", f"_ty{i}")
        cells = utm.add_converted(
            cells, F.col("_x") + F.lit(a * meta.dx), F.col("_y") + F.lit(b * meta.dy), meta.crs, target.crs, names
        )
        corners.append(names)
    left, right = F.least(*[x for x, _ in corners]), F.greatest(*[x for x, _ in corners])
    bottom, top = F.least(*[y for _, y in corners]), F.greatest(*[y for _, y in corners])
    wide, high, half = F.lit(BEND) * (right - left), F.lit(BEND) * (top - bottom), F.lit(0.5)
    first_col = F.greatest(F.ceil((left - wide - F.lit(target.x0)) / F.lit(target.dx) - half), F.lit(0))
    last_col = F.least(F.floor((right + wide - F.lit(target.x0)) / F.lit(target.dx) - half), F.lit(target.width - 1))
    first_row = F.greatest(F.ceil((F.lit(target.y0) - top - high) / F.lit(target.dy) - half), F.lit(0))
    last_row = F.least(F.floor((F.lit(target.y0) - bottom + high) / F.lit(target.dy) - half), F.lit(target.height - 1))

    def span(first, last):
        return F.when(first <= last, F.sequence(first.cast("int"), last.cast("int")))

    candidates = (
        cells.withColumnsRenamed({"row_id": "_row", "col_id": "_col"})
        .withColumn("row_id", F.explode(span(first_row, last_row)))
        .withColumn("col_id", F.explode(span(first_col, last_col)))
        .select("_row", "_col", *PIXEL_KEY, *bands)
    )
    back = _source_cell(candidates, target, meta)
    inside = back.filter(
        (F.col("_back_row") == F.col("_row")) & (F.col("_back_col") == F.col("_col"))
    ).select(*PIXEL_KEY, *bands)
    if not keep_outside:
        return inside, target
    outside = absent_cells(inside.select(*PIXEL_KEY), target)
    empty = outside.select(*PIXEL_KEY, *[F.lit(fill).cast(df.schema[b].dataType).alias(b) for b in bands])
    return inside.unionByName(empty), target


def _source_cell(cells: DataFrame, target: GridMeta, meta: GridMeta) -> DataFrame:
    """Add the source row and column that hold the centre of each target cell."""
    centred = pixel_centres(cells, target, "_cx", "_cy")
    moved = utm.add_converted(centred, F.col("_cx"), F.col("_cy"), target.crs, meta.crs, ("_sx", "_sy"))
    return moved.withColumns(
        {"_back_row": affine.row_of(meta, F.col("_sy")), "_back_col": affine.col_of(meta, F.col("_sx"))}
    )


def grid_lookup(
    points: DataFrame, df: DataFrame, meta: GridMeta, bands: Sequence[str], x: str = "x", y: str = "y"
) -> DataFrame:
    """Band values of the raster cell under each point; null off the raster or where it has no row.

    A left equi-join on integer cell keys. Points off the raster keep their real cell numbers, so they
    spread over the partitions rather than meeting in one null key.
    """
    keyed = points.withColumns(
        {"_row": affine.row_of(meta, F.col(y)), "_col": affine.col_of(meta, F.col(x))}
    )
    cells = df.select(
        F.col("row_id").cast("long").alias("_row"), F.col("col_id").cast("long").alias("_col"), *bands
    )
    return keyed.join(cells, ["_row", "_col"], "left").drop("_row", "_col")
