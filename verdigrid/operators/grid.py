"""Grids: cell centres, extents, crop windows, regular cells."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.functions import affine, utm
from verdigrid.meta import GridMeta


#: Columns of a raster row that share a bitmap.
RUN = 64
#: Runs of the grid that a task expands to cells (eight million cells at most).
TASK_RUNS = 1 << 17


def pixel_centres(df: DataFrame, meta: GridMeta, x: str = "x", y: str = "y") -> DataFrame:
    """Map coordinates of the pixel centres, rows running from top to bottom."""
    return df.withColumns(
        {x: affine.centre_x(meta, F.col("col_id")), y: affine.centre_y(meta, F.col("row_id"))}
    )


def point_geometry(df: DataFrame, crs: str, x: str = "x", y: str = "y") -> DataFrame:
    """Point column with its CRS; encoded only when a sink asks for it."""
    return df.withColumn(
        "geometry", F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.lit(crs).alias("crs"))
    )


def layer_bounds(edges: DataFrame) -> DataFrame:
    """One row: the bounding box of a polygon layer."""
    return edges.agg(
        F.min(F.least("x1", "x2")).alias("min_x"),
        F.min(F.least("y1", "y2")).alias("min_y"),
        F.max(F.greatest("x1", "x2")).alias("max_x"),
        F.max(F.greatest("y1", "y2")).alias("max_y"),
    )


def extent(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row: the range of the coordinates."""
    return points.agg(
        F.min(x).alias("min_x"), F.min(y).alias("min_y"),
        F.max(x).alias("max_x"), F.max(y).alias("max_y"),
    )


def bounds_of(one_row: DataFrame) -> tuple[float, float, float, float]:
    """The four numbers of ``layer_bounds`` or ``extent`` on the driver."""
    row = one_row.first()
    if row["min_x"] is None:
        raise ValueError("an empty layer has no bounds")
    return row["min_x"], row["min_y"], row["max_x"], row["max_y"]


def crop_to_extent(
    df: DataFrame, meta: GridMeta, bounds: tuple[float, float, float, float]
) -> tuple[DataFrame, GridMeta]:
    """The grid window that covers ``bounds``, renumbered from 0.

    The window is computed from the metadata, so the scan gets literal row and column ranges.
    """
    r0, r1, c0, c1 = meta.cover(bounds)
    window = df.filter(
        (F.col("row_id") >= r0) & (F.col("row_id") < r1)
        & (F.col("col_id") >= c0) & (F.col("col_id") < c1)
    ).withColumns(
        {
            "row_id": (F.col("row_id") - F.lit(r0)).cast(df.schema["row_id"].dataType),
            "col_id": (F.col("col_id") - F.lit(c0)).cast(df.schema["col_id"].dataType),
        }
    )
    return window, meta.window(r0, r1, c0, c1)


def make_grid(
    spark: SparkSession, bounds: tuple[float, float, float, float], cell: float
) -> DataFrame:
    """Regular cells over an extent, numbered from the upper-left corner, with centre and corners.

    Whole cells only: the extent is filled up to the next full cell on the right and below.
    """
    min_x, min_y, max_x, max_y = bounds
    # a remainder far below the cell size is noise in the corner coordinates, not another cell
    n_cols = max(math.ceil((max_x - min_x) / cell - 1e-6), 0)
    n_rows = max(math.ceil((max_y - min_y) / cell - 1e-6), 0)
    ids = spark.range(n_cols * n_rows)
    row, col = F.expr(f"id div {max(n_cols, 1)}"), F.col("id") % F.lit(max(n_cols, 1))
    meta = GridMeta("", min_x, max_y, cell, cell, n_cols, n_rows)
    return (
        ids.select(
            F.col("id").alias("cell_id"), row.cast("int").alias("row_id"), col.cast("int").alias("col_id")
        )
        .transform(lambda d: pixel_centres(d, meta))
        .withColumns(
            {
                "min_x": F.col("x") - F.lit(cell / 2.0),
                "min_y": F.col("y") - F.lit(cell / 2.0),
                "max_x": F.col("x") + F.lit(cell / 2.0),
                "max_y": F.col("y") + F.lit(cell / 2.0),
            }
        )
    )


def grid_pixels(spark: SparkSession, meta: GridMeta) -> DataFrame:
    """The key of every cell of a grid."""
    width = max(meta.width, 1)
    return spark.range(meta.width * meta.height).select(
        F.expr(f"cast(id div {width} as int)").alias("row_id"),
        F.expr(f"cast(id % {width} as int)").alias("col_id"),
    )


def absent_cells(rows: DataFrame, meta: GridMeta) -> DataFrame:
    """The keys of the grid's cells that have no row in ``rows``.

    Rows become bitmaps, one for each run of 64 columns of a raster row, combined before the exchange; only these are joined to the
    runs of the grid, so neither cells nor bands are shuffled. The runs with absent cells are dealt once more, to as many tasks as the size of the grid asks
    for: by their bytes Spark would give a task hundreds of millions of cells.
    """
    runs = -(-max(meta.width, 1) // RUN)
    row, col = F.col("row_id").cast("long"), F.col("col_id").cast("long")
    inside = rows.where(row.between(0, meta.height - 1) & col.between(0, meta.width - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (col % RUN).cast("int"))
    present = inside.select((row * runs + F.expr(f"col_id div {RUN}")).alias("id"), bit.alias("bit")).groupBy("id").agg(F.bit_or("bit").alias("bits"))
    n_runs = meta.height * runs
    tasks = -(-n_runs // TASK_RUNS)
    spark = rows.sparkSession
    grid = spark.range(0, n_runs, 1, max(tasks, min(spark.sparkContext.defaultParallelism, n_runs), 1)).join(present, "id", "left")
    last = meta.width - (runs - 1) * RUN
    whole = F.when(F.col("id") % runs == runs - 1, F.lit((1 << last) - 1 if last < RUN else -1)).otherwise(F.lit(-1)).cast("long")
    absent = whole.bitwiseAND(F.bitwise_not(F.coalesce("bits", F.lit(0).cast("long"))))
    places = F.filter(F.sequence(F.lit(0), F.lit(RUN - 1)), lambda i: F.getbit(F.col("absent"), i) == 1)
    lacking = grid.select("id", absent.alias("absent")).where("absent <> 0")
    if tasks > 1:
        lacking = lacking.repartition(tasks, "id")
    found = lacking.select("id", F.explode(places).alias("at"))
    return found.select(F.expr(f"cast(id div {runs} as int)").alias("row_id"), (F.col("id") % runs * RUN + F.col("at")).cast("int").alias("col_id"))


def target_grid(spark: SparkSession, meta: GridMeta, dst_crs: str, cell: float) -> GridMeta:
    """Grid in another CRS that covers the source, snapped outwards to multiples of ``cell``.

    Only the outline of the source is projected (2 * (width + height) corner points); the interior
    of a raster cannot reach beyond its outline. One row comes back.
    """
    w, h = meta.width, meta.height
    step = F.col("id")
    outline = spark.range(2 * (w + h)).select(
        F.when(step < w, step).when(step < w + h, F.lit(w))
        .when(step < 2 * w + h, F.lit(2 * w + h) - step).otherwise(F.lit(0)).alias("i"),
        F.when(step < w, F.lit(0)).when(step < w + h, step - F.lit(w))
        .when(step < 2 * w + h, F.lit(h)).otherwise(F.lit(2 * (w + h)) - step).alias("j"),
    )
    corners = utm.add_converted(
        outline,
        F.lit(float(meta.x0)) + F.lit(float(meta.dx)) * F.col("i"),
        F.lit(float(meta.y0)) - F.lit(float(meta.dy)) * F.col("j"),
        meta.crs, dst_crs, ("x", "y"),
    )
    min_x, min_y, max_x, max_y = bounds_of(extent(corners))
    left, bottom = math.floor(min_x / cell), math.floor(min_y / cell)
    right, top = math.ceil(max_x / cell), math.ceil(max_y / cell)
    return GridMeta(
        crs=dst_crs, x0=left * cell, y0=top * cell, dx=cell, dy=cell,
        width=right - left, height=top - bottom, bands=meta.bands, nodata=meta.nodata, name=meta.name,
    )


def collection_size(df: DataFrame) -> DataFrame:
    """One row: number of pixels, rows, columns and bands."""
    bands = [c for c in df.columns if c not in ("row_id", "col_id", "x", "y")]
    return df.agg(
        F.count(F.lit(1)).alias("n_pixels"),
        (F.max("row_id").cast("long") + 1).alias("n_rows"),
        (F.max("col_id").cast("long") + 1).alias("n_cols"),
    ).withColumn("n_bands", F.lit(len(bands)))
