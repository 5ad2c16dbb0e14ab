"""Pixel tables with their metadata."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.functions import affine
from verdigrid.meta import GridMeta
from verdigrid.operators.bands import PIXEL_KEY, STACK_BANDS, nodata_to_null, select_bands
from verdigrid.operators.grid import collection_size, crop_to_extent, pixel_centres
from verdigrid.operators.spatial import mask_and_crop
from verdigrid.operators.stack import check_same_grid

TILE = 256
TILE_KEY = ("tile_row", "tile_col")
#: Uncompressed bytes of a file, and those below which no further task is worth it.
FILE_BYTES, LEAST_BYTES = 256 << 20, 4 << 20


def scan_pixels(
    spark: SparkSession, path: str, bands: Sequence[str] | None = None, nodata: float | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The wanted bands of a pixel table, missing values as null; only these columns are read."""
    df = spark.read.parquet(path)
    wanted = list(bands) if bands is not None else [
        c for c in df.columns if c not in (*PIXEL_KEY, *keep)
    ]
    return nodata_to_null(select_bands(df, wanted, (*PIXEL_KEY, *keep)), wanted, nodata)


def read_raster(
    spark: SparkSession, path: str, bands: Sequence[str] | None = None, mask: DataFrame | None = None,
    polygon: Sequence[str] = ("district_id",), mask_crs: str | None = None,
) -> tuple[DataFrame, GridMeta]:
    """Pixel table and metadata as written by ``write_pixels``.

    With ``mask`` (edges of a polygon layer) the window around the layer is read and pixels outside its polygons are null;
    a layer that does not meet the raster raises.
    """
    meta = GridMeta.from_df(spark.read.parquet(f"{path}/meta"))
    names = list(bands) if bands is not None else list(meta.bands)
    df, meta = scan_pixels(spark, f"{path}/pixels", names, meta.nodata), meta.with_bands(names)
    if mask is None:
        return df, meta
    masked, window = mask_and_crop(pixel_centres(df, meta), meta, mask, names, polygon, mask_crs)
    return masked.select(*PIXEL_KEY, *names), window


def write_pixels(
    df: DataFrame, meta: GridMeta, path: str, mode: str = "errorifexists", files: int | None = None
) -> None:
    """Store a pixel table and its metadata row.

    Rows are range-partitioned by tile and sorted inside each file, so the row-group statistics of
    row, column and coordinates cut scans to the wanted window; there is no folder per tile. Without ``files`` their
    number follows from the size of the grid, which the metadata gives.
    """
    bands = [c for c in df.columns if c not in (*PIXEL_KEY, "x", "y")]
    if list(meta.bands) != bands:
        raise ValueError(f"band names {list(meta.bands)} do not match the bands {bands}")
    tile = [affine.block_of(F.col(k), TILE).cast("long") for k in PIXEL_KEY]
    order = [*tile, *[F.col(k) for k in PIXEL_KEY]]
    size = 8 * meta.width * meta.height * (len(bands) + len(PIXEL_KEY))
    cores = df.sparkSession.sparkContext.defaultParallelism
    files = files or max(math.ceil(size / FILE_BYTES), min(cores, math.ceil(size / LEAST_BYTES)), 1)
    laid_out = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    laid_out.write.mode(mode).parquet(f"{path}/pixels")
    meta.to_df(df.sparkSession).coalesce(1).write.mode(mode).parquet(f"{path}/meta")


def export_image(
    df: DataFrame, meta: GridMeta, bounds: tuple[float, float, float, float], path: str,
    mode: str = "errorifexists",
) -> GridMeta:
    """Store the window of a raster that covers a region."""
    window, cropped = crop_to_extent(df, meta, bounds)
    write_pixels(window, cropped, path, mode)
    return cropped


def from_footers(spark: SparkSession, path: str) -> DataFrame:
    """A stored table whose ungrouped counts, minima and maxima of plain numbers come from the Parquet footers; no pages are read.

    The frame belongs to a session of its own, as these are settings of a session.
    """
    session = spark.newSession()
    others = [s for s in session.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path)


def stored_size(spark: SparkSession, path: str) -> DataFrame:
    """``collection_size`` of a raster written by ``write_pixels``, from footers."""
    size = collection_size(from_footers(spark, f"{path}/pixels"))
    # files without row groups add no count at all, and no last row either
    return size.withColumn("n_pixels", F.when(F.col("n_rows").isNotNull(), F.col("n_pixels")).otherwise(F.lit(0).cast("long")))


def stored_extent(spark: SparkSession, path: str) -> DataFrame:
    """``extent`` of the pixel centres of a raster written by ``write_pixels``, from footers; nulls for one without rows."""
    meta = GridMeta.from_df(spark.read.parquet(f"{path}/meta"))
    ends = from_footers(spark, f"{path}/pixels").agg(*[f(k).alias(f"{n}_{k}") for k in PIXEL_KEY for f, n in ((F.min, "min"), (F.max, "max"))])
    return ends.select(
        affine.centre_x(meta, F.col("min_col_id")).alias("min_x"), affine.centre_y(meta, F.col("max_row_id")).alias("min_y"),
        affine.centre_x(meta, F.col("max_col_id")).alias("max_x"), affine.centre_y(meta, F.col("min_row_id")).alias("max_y"),
    )


def write_tiles(df: DataFrame, meta: GridMeta, table: str, buckets: int, mode: str = "errorifexists") -> None:
    """Store a raster as a catalog table bucketed by tile, and its metadata as ``<table>_meta``.

    Rasters of one grid with the same number of buckets are stacked without a shuffle (``stack_tiles``). All rows of a tile are in one bucket, sorted
    by pixel; take as many buckets as tasks are wanted.
    """
    bands = [c for c in df.columns if c not in (*PIXEL_KEY, "x", "y")]
    if list(meta.bands) != bands:
        raise ValueError(f"band names {list(meta.bands)} do not match the bands {bands}")
    tile = [affine.block_of(F.col(k), TILE).cast("long").alias(t) for k, t in zip(PIXEL_KEY, TILE_KEY)]
    rows = df.select(*tile, *PIXEL_KEY, *bands).repartition(buckets, *TILE_KEY)
    rows.write.mode(mode).bucketBy(buckets, *TILE_KEY).sortBy(*TILE_KEY, *PIXEL_KEY).format("parquet").saveAsTable(table)
    meta.to_df(df.sparkSession).coalesce(1).write.mode(mode).format("parquet").saveAsTable(f"{table}_meta")


def stack_tiles(spark: SparkSession, tables: Sequence[str], names: Sequence[str] = STACK_BANDS) -> tuple[DataFrame, GridMeta]:
    """The rasters stored by ``write_tiles`` side by side, renamed by position as ``stack_bands`` does, at most one row per pixel each.

    With equal numbers of buckets no pixel is exchanged: one row per tile is dealt like the buckets and grows to the keys of its cells there, which
    the rasters join in turn. The frame belongs to a session of its own, in which a join on tile and pixel may use buckets made of tiles alone.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    rasters = [session.table(t) for t in tables]
    metas = [GridMeta.from_df(session.table(f"{t}_meta")) for t in tables]
    check_same_grid(metas)
    if sum(len(m.bands) for m in metas) != len(names):
        raise ValueError(f"{sum(len(m.bands) for m in metas)} bands for {len(names)} names")
    meta, key = metas[0], [*TILE_KEY, *PIXEL_KEY]
    across = max(-(-meta.width // TILE), 1)
    tiles = session.range(across * -(-meta.height // TILE)).select(F.expr(f"id div {across}").alias(TILE_KEY[0]), (F.col("id") % across).alias(TILE_KEY[1]))

    def cells(tile: str, size: int):
        first = F.col(tile) * TILE
        return F.explode(F.sequence(first, F.least(first + (TILE - 1), F.lit(size - 1))).cast("array<int>"))

    dealt = tiles.repartition(_buckets(session, tables[0]), *TILE_KEY)
    stacked = dealt.withColumn(PIXEL_KEY[0], cells(TILE_KEY[0], meta.height)).withColumn(PIXEL_KEY[1], cells(TILE_KEY[1], meta.width))
    left, marks = list(names), []
    for n, (df, m) in enumerate(zip(rasters, metas)):
        taken, left = left[: len(m.bands)], left[len(m.bands):]
        marks.append(f"_present_{n}")
        side = df.select(*key, *[F.col(b).alias(name) for b, name in zip(m.bands, taken)], F.lit(True).alias(marks[-1]))
        stacked = stacked.join(side.hint("merge"), key, "left")
    return stacked.where(F.coalesce(*marks)).select(*PIXEL_KEY, *names), meta.with_bands(names)


def _buckets(session: SparkSession, table: str) -> int:
    described = session.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    if described is None:
        raise ValueError(f"{table} is not bucketed")
    return int(described["data_type"])
