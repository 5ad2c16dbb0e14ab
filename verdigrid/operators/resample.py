"""Change of cell size, zonal and block statistics, zone growth.

Resampling is driven from the source: every output cell belongs to exactly one source cell (nearest) or
to one block of 2 x 2 source cells (bilinear), so source rows emit their outputs and the large output
grid is never joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigrid.functions import affine
from verdigrid.meta import GridMeta
from verdigrid.operators.bands import PIXEL_KEY
from verdigrid.operators.grid import absent_cells

# A weight below this is rounding noise of the position, and a missing neighbour does not matter.
NO_WEIGHT = 1e-9

#: Side of the tiles that bilinear resampling is dealt by.
TILE = 256

# Statistics offered per zone or block.
STATS = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count}


def _outputs(first: Column, last: Column) -> Column:
    """The integers first..last, or an empty array."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.expr("array_repeat(0L, 0)"))


def _complete(df: DataFrame, meta: GridMeta, bands: Sequence[str]) -> DataFrame:
    """The raster with a row for every cell; bitmaps of the keys show which have none."""
    rows = df.select(*[F.col(k).cast("int").alias(k) for k in PIXEL_KEY], *bands)
    missing = absent_cells(rows.select(*PIXEL_KEY), meta)
    return rows.unionByName(missing.select(*PIXEL_KEY, *[F.lit(None).cast(df.schema[b].dataType).alias(b) for b in bands]))


def resample_nearest(
    df: DataFrame, meta: GridMeta, cell: float, bands: Sequence[str], sparse: bool = False
) -> tuple[DataFrame, GridMeta]:
    """Snap to another cell size on the same upper-left corner.

    Every output cell comes out, null where its source cell has no row. With ``sparse=True`` only cells with a source row do, and
    nothing is shuffled.
    """
    df = df if sparse else _complete(df, meta, bands)
    out = replace(
        meta, dx=cell, dy=cell,
        width=round(meta.width * meta.dx / cell), height=round(meta.height * meta.dy / cell),
    )

    def owned(index: str, ratio: float, n_in: int, count: int) -> Column:
        # output o belongs to source i when floor((o + 0.5) * ratio) = i; one spare candidate on
        # both ends, then the exact rule decides
        i = F.col(index)
        first = F.greatest(F.ceil(i / F.lit(ratio) - 0.5) - 1, F.lit(0)).cast("long")
        last = F.least(F.ceil((i + 1) / F.lit(ratio) - 0.5), F.lit(count - 1)).cast("long")
        return F.filter(
            _outputs(first, last),
            lambda o: F.least(F.floor((o + F.lit(0.5)) * F.lit(ratio)), F.lit(n_in - 1)) == i,
        )

    rows = df.select(
        owned("row_id", cell / meta.dy, meta.height, out.height).alias("_rows"),
        owned("col_id", cell / meta.dx, meta.width, out.width).alias("_cols"),
        *bands,
    )
    return (
        rows.withColumn("row_id", F.explode("_rows"))
        .withColumn("col_id", F.explode("_cols"))
        .select(*[F.col(k).cast("int").alias(k) for k in PIXEL_KEY], *bands),
        out,
    )


def resample_bilinear(
    df: DataFrame, meta: GridMeta, factor: float, bands: Sequence[str], sparse: bool = False
) -> tuple[DataFrame, GridMeta]:
    """Scale rows and columns by ``factor``, bilinear between pixel centres of first and last cell.

    Output ``i`` sits at source position ``i * (n_in - 1) / (n_out - 1)``. The one exchange deals the source by square
    tiles; of each tile only the first row and column also go to the neighbours before it, which need them for their last
    blocks. Blocks of 2 x 2 cells and the outputs they own are made within the tile. A missing neighbour with weight
    makes the output missing. Every output cell comes out, unless ``sparse=True`` leaves out those whose block has no row.
    """
    df = df if sparse else _complete(df, meta, bands)
    out = replace(
        meta,
        width=round(meta.width * factor), height=round(meta.height * factor),
    )
    out = replace(out, dx=meta.dx * meta.width / out.width, dy=meta.dy * meta.height / out.height)

    def step(n_in: int, n_out: int) -> float:
        return (n_in - 1) / (n_out - 1) if n_out > 1 else 0.0

    s_row, s_col = step(meta.height, out.height), step(meta.width, out.width)

    def owned(anchor: Column, s: float, n_in: int, n_out: int) -> Column:
        # outputs whose position has floor() equal to the anchor
        if s == 0.0:
            return F.when(anchor == 0, _outputs(F.lit(0).cast("long"), F.lit(n_out - 1).cast("long"))).otherwise(
                F.expr("array_repeat(0L, 0)")
            )
        first = F.greatest(F.floor(anchor / F.lit(s)) - 1, F.lit(0)).cast("long")
        last = F.least(F.ceil((anchor + 1) / F.lit(s)) + 1, F.lit(n_out - 1)).cast("long")
        return F.filter(
            _outputs(first, last), lambda o: F.least(F.floor(o * F.lit(s)), F.lit(n_in - 1)) == anchor
        )

    def used(row: Column, col: Column) -> Column:
        """An anchor that owns outputs: all of an enlarging grid, some of a shrinking one."""
        if factor >= 1:
            return F.lit(True)
        return (F.size(owned(row, s_row, meta.height, out.height)) > 0) & (F.size(owned(col, s_col, meta.width, out.width)) > 0)

    corners = [(a, b) for a in (0, 1) for b in (0, 1)]
    row, col = F.col("row_id").cast("long"), F.col("col_id").cast("long")
    tile = F.floor(row / F.lit(TILE)), F.floor(col / F.lit(TILE))
    homes = F.array(*[
        F.when((row % TILE == 0 if a else F.lit(True)) & (col % TILE == 0 if b else F.lit(True)), F.struct((tile[0] - a).alias("_tr"), (tile[1] - b).alias("_tc")))
        for a, b in corners
    ])
    wanted = reduce(lambda x, y: x | y, [used(row - a, col - b) for a, b in corners])
    homes = F.filter(homes, lambda t: t.isNotNull() & (t["_tr"] >= 0) & (t["_tc"] >= 0))
    dealt = df.where(wanted).select(row.alias("_row"), col.alias("_col"), *bands, F.inline(homes)).repartition("_tr", "_tc")
    # within a tile every cell is the (0|1, 0|1) corner of up to four anchors
    places = dealt.withColumn("_at", F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in corners])))
    places = places.select(
        "_tr", "_tc", (F.col("_row") - F.col("_at.a")).alias("_r"), (F.col("_col") - F.col("_at.b")).alias("_c"),
        F.col("_at.a").alias("_a"), F.col("_at.b").alias("_b"), *bands,
    ).where((F.floor(F.col("_r") / F.lit(TILE)) == F.col("_tr")) & (F.floor(F.col("_c") / F.lit(TILE)) == F.col("_tc")))
    places = places.where(used(F.col("_r"), F.col("_c")))
    blocks = places.groupBy("_tr", "_tc", "_r", "_c").agg(*[
        F.max(F.when((F.col("_a") == a) & (F.col("_b") == b), F.col(band))).alias(f"{band}_{a}{b}")
        for band in bands for a, b in corners
    ])
    cells = (
        blocks.withColumn("row_id", F.explode(owned(F.col("_r"), s_row, meta.height, out.height)))
        .withColumn("col_id", F.explode(owned(F.col("_c"), s_col, meta.width, out.width)))
        .withColumns(
            {
                "_wr": F.least(F.col("row_id") * F.lit(s_row), F.lit(meta.height - 1.0)) - F.col("_r"),
                "_wc": F.least(F.col("col_id") * F.lit(s_col), F.lit(meta.width - 1.0)) - F.col("_c"),
            }
        )
    )

    def value(band: str) -> Column:
        total = None
        for a in (0, 1):
            for b in (0, 1):
                w = (F.col("_wr") if a else 1 - F.col("_wr")) * (F.col("_wc") if b else 1 - F.col("_wc"))
                term = F.when(w > NO_WEIGHT, w * F.col(f"{band}_{a}{b}")).otherwise(F.lit(0.0))
                total = term if total is None else total + term
        return total.alias(band)

    return (
        cells.select(
            *[F.col(k).cast("int").alias(k) for k in PIXEL_KEY], *[value(b) for b in bands]
        ),
        out,
    )


def zonal_stats(
    df: DataFrame, meta: GridMeta, value: str, stats: Sequence[str] = ("sum",), x: str = "x", y: str = "y"
) -> DataFrame:
    """Statistics of fine values per cell of ``meta``'s grid; missing values are ignored.

    The zone is arithmetic on the coordinates and the aggregate combines map-side, so a zone that
    holds most rows still sends one partial row per task.
    """
    return (
        df.groupBy(
            affine.row_of(meta, F.col(y)).alias("zone_row"), affine.col_of(meta, F.col(x)).alias("zone_col")
        )
        .agg(*[STATS[s](value).alias(f"{s}_{value}") for s in stats])
    )


def zonal_sum(df: DataFrame, meta: GridMeta, value: str, x: str = "x", y: str = "y") -> DataFrame:
    return zonal_stats(df, meta, value, ("sum",), x, y)


def block_mean(
    df: DataFrame, k: int, bands: Sequence[str], row: str = "row_id", col: str = "col_id"
) -> DataFrame:
    """Mean per block of ``k`` x ``k`` fine cells; missing values are ignored."""
    return df.groupBy(
        affine.block_of(F.col(row), k).cast("int").alias("row_id"),
        affine.block_of(F.col(col), k).cast("int").alias("col_id"),
    ).agg(*[F.avg(b).alias(b) for b in bands])


def block_mean_weighted(
    df: DataFrame, meta: GridMeta, target: GridMeta, bands: Sequence[str]
) -> DataFrame:
    """Area-weighted mean on a coarser grid whose borders need not fall on fine borders.

    A fine cell is split over the target cells it overlaps; a missing value carries no weight.
    """

    def shares(index: str, origin_shift: float, size: float, coarse: float, count: int) -> Column:
        lo = F.lit(origin_shift) + F.col(index) * F.lit(size)
        hi = lo + F.lit(size)
        first = F.greatest(F.floor(lo / F.lit(coarse)), F.lit(0)).cast("long")
        last = F.least(F.ceil(hi / F.lit(coarse)) - 1, F.lit(count - 1)).cast("long")
        return F.transform(
            _outputs(first, last),
            lambda t: F.struct(
                t.alias("t"),
                (F.least(hi, (t + 1) * F.lit(coarse)) - F.greatest(lo, t * F.lit(coarse))).alias("w"),
            ),
        )

    parts = (
        df.withColumn("_r", F.explode(shares("row_id", target.y0 - meta.y0, meta.dy, target.dy, target.height)))
        .withColumn("_c", F.explode(shares("col_id", meta.x0 - target.x0, meta.dx, target.dx, target.width)))
        .withColumn("_w", F.col("_r.w") * F.col("_c.w"))
        .filter(F.col("_w") > 0)
    )
    return parts.groupBy(
        F.col("_r.t").cast("int").alias("row_id"), F.col("_c.t").cast("int").alias("col_id")
    ).agg(*[
        (F.sum(F.col("_w") * F.col(b)) / F.sum(F.when(F.col(b).isNotNull(), F.col("_w")))).alias(b)
        for b in bands
    ])


def expand_zone(
    df: DataFrame, value: str, zones: Sequence[float] = (0.0,), cells: int = 1,
    key: Sequence[str] = PIXEL_KEY,
) -> DataFrame:
    """Grow the cells of the zone values by ``cells`` cells into all eight directions.

    Zone cells emit a mark for each neighbour and one grouped aggregate merges marks with cells: one
    exchange in all. Where several zones reach a cell, the first in ``zones`` wins; cells that are a
    zone already keep their value. Marks outside the raster vanish.
    """
    row, col = key
    payload = [c for c in df.columns if c not in key]
    rank = F.lit(None).cast("int")
    for i, zone in reversed(list(enumerate(zones))):
        rank = F.when(F.col(value) == F.lit(zone), F.lit(i)).otherwise(rank)
    near = [(a, b) for a in range(-cells, cells + 1) for b in range(-cells, cells + 1) if (a, b) != (0, 0)]
    types = {k: df.schema[k].dataType for k in key}
    marks = (
        df.select(*key, rank.alias("_mark"))
        .filter(F.col("_mark").isNotNull())
        .select(
            "_mark", *key,
            F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in near])).alias("_d"),
        )
        .select(
            (F.col(row) + F.col("_d.a")).cast(types[row]).alias(row),
            (F.col(col) + F.col("_d.b")).cast(types[col]).alias(col),
            "_mark",
        )
    )
    merged = (
        df.select(*key, F.struct(*payload).alias("_cell"), F.lit(None).cast("int").alias("_mark"))
        .unionByName(marks.withColumn("_cell", F.lit(None)), allowMissingColumns=True)
        .groupBy(*key)
        .agg(F.first("_cell", ignorenulls=True).alias("_cell"), F.min("_mark").alias("_mark"))
        .filter(F.col("_cell").isNotNull())
    )
    current = F.col(f"_cell.{value}")
    grown = F.when(
        F.col("_mark").isNotNull() & ~F.coalesce(current.isin(*zones), F.lit(False)),
        F.get(F.array(*[F.lit(z) for z in zones]), F.col("_mark")),
    ).otherwise(current)
    return merged.select(
        *key, *[grown.cast(df.schema[c].dataType).alias(c) if c == value else F.col(f"_cell.{c}").alias(c) for c in payload]
    )
