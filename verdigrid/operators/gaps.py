"""Fill gaps along the global pixel order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigrid.session import broadcast_within, materialise

GAP_BANDS = ("dtm", "fraction_grass", "fraction_cropland", "fraction_built", "fraction_water")
#: Columns of a raster row that make a block; it fits the in-memory buffer of the window operator.
BLOCK = 1 << 12
#: Raster rows, or with ``by_row`` blocks of one row, whose summaries meet in one task.
GROUP = 1 << 8


def _blocks(df: DataFrame, by_row: bool, block: int) -> DataFrame:
    """``df`` with its line, group and block numbers: a block is a run of ``block`` columns of one raster row.

    Blocks are in order within a group, groups within a line, and no width of the raster has to be known.
    """
    row, piece = F.col("row_id").cast("long"), F.floor(F.col("col_id") / F.lit(block)).cast("long")
    if by_row:
        return df.withColumns({"_line": row, "_g": F.floor(piece / F.lit(GROUP)).cast("long"), "_b": piece})
    return df.withColumns({"_line": F.lit(0).cast("long"), "_g": F.floor(row / F.lit(GROUP)).cast("long"), "_b": row * F.lit(1 << 32) + piece})


def interpolate_linear(
    df: DataFrame, bands: Sequence[str] = GAP_BANDS, by_row: bool = False, block: int = BLOCK,
) -> DataFrame:
    """Linear interpolation by position in row-major order over the whole table.

    A leading gap stays missing, a trailing gap repeats the last value. Positions count the rows that
    exist, not column numbers. ``by_row`` restarts at each raster row.

    A prefix scan in two phases. The source is read once: dealt by block, each row gets its place within
    the block and a missing value the nearest valid points there, and this is stored. One summary row per
    block (rows, first and last valid point per band), taken from the stored rows, is then carried over block
    borders in groups of ``GROUP`` raster rows, and a summary of those groups, one row each, in a single task.
    Last, the stored rows meet the carried points of their block.
    """
    columns = df.columns
    cells = _blocks(df.withColumns({b: F.nanvl(b, F.lit(None).cast("double")) for b in bands}), by_row, block)
    inner = Window.partitionBy("_line", "_b").orderBy("col_id")
    back = inner.rowsBetween(Window.unboundedPreceding, 0)
    # a growing frame in reverse order: a frame that ends at the partition's end costs rows squared
    ahead = Window.partitionBy("_line", "_b").orderBy(F.desc("col_id")).rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("_i", F.row_number().over(inner).cast("long"))

    def at(b: str) -> Column:
        return F.when(F.col(b).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(b).alias("v")))

    def near(b: str, frame) -> Column:
        return F.when(F.col(b).isNull(), F.last(at(b), ignorenulls=True).over(frame))

    placed = placed.withColumns({f"_prev_{b}": near(b, back) for b in bands})
    placed = placed.withColumns({f"_next_{b}": near(b, ahead) for b in bands})
    placed = materialise(placed, "placed")

    summary = placed.groupBy("_line", "_g", "_b").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.min(at(b)).alias(f"_first_{b}") for b in bands],
        *[F.max(at(b)).alias(f"_last_{b}") for b in bands],
    )
    joined = placed.drop("_g").join(broadcast_within(materialise(_carry(summary, bands), "carried")), ["_line", "_b"])

    def filled(b: str) -> Column:
        here = F.col("_offset") + F.col("_i")
        prev_i = F.coalesce(F.col("_offset") + F.col(f"_prev_{b}.i"), F.col(f"_before_{b}.i"))
        prev_v = F.coalesce(F.col(f"_prev_{b}.v"), F.col(f"_before_{b}.v"))
        next_i = F.coalesce(F.col("_offset") + F.col(f"_next_{b}.i"), F.col(f"_after_{b}.i"))
        next_v = F.coalesce(F.col(f"_next_{b}.v"), F.col(f"_after_{b}.v"))
        return (
            F.when(F.col(b).isNotNull(), F.col(b))
            .when(prev_v.isNull(), F.lit(None))
            .when(next_v.isNull(), prev_v)
            .otherwise(prev_v + (next_v - prev_v) * (here - prev_i) / (next_i - prev_i))
            .alias(b)
        )

    return joined.select(*[filled(c) if c in bands else F.col(c) for c in columns])


def row_index(df: DataFrame, name: str = "index", block: int = BLOCK) -> DataFrame:
    """Dense row numbers from 0 in row-major order, by the same blocks; the source is read once."""
    inner = Window.partitionBy("_line", "_b").orderBy("col_id")
    placed = materialise(_blocks(df, False, block).withColumn("_i", F.row_number().over(inner)), "placed")
    carried = _carry(placed.groupBy("_line", "_g", "_b").agg(F.count(F.lit(1)).alias("_rows")), ())
    joined = placed.drop("_g").join(broadcast_within(materialise(carried, "carried")), ["_line", "_b"])
    return joined.select(*df.columns, (F.col("_offset") + F.col("_i") - 1).alias(name))


def _carry(summary: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Per block: rows before it, last valid point before it and first valid point after it.

    Two levels of the same running window: over the groups of blocks, then inside each group.
    """
    local = _running(summary, bands, ("_line", "_g"), "_b")
    groups = local.groupBy("_line", "_g").agg(
        F.sum("_rows").alias("_rows"),
        *[F.min(_shift(f"_first_{b}", "_offset")).alias(f"_first_{b}") for b in bands],
        *[F.max(_shift(f"_last_{b}", "_offset")).alias(f"_last_{b}") for b in bands],
    )
    # the groups of one line: one row per ``GROUP`` raster rows
    outer = _running(groups, bands, ("_line",), "_g").select(
        "_line", "_g", F.col("_offset").alias("_g_offset"),
        *[F.col(f"_before_{b}").alias(f"_g_before_{b}") for b in bands],
        *[F.col(f"_after_{b}").alias(f"_g_after_{b}") for b in bands],
    )
    return local.join(outer, ["_line", "_g"]).select(
        "_line", "_b", (F.col("_g_offset") + F.col("_offset")).alias("_offset"),
        *[F.coalesce(_shift(f"_before_{b}", "_g_offset"), F.col(f"_g_before_{b}")).alias(f"_before_{b}") for b in bands],
        *[F.coalesce(_shift(f"_after_{b}", "_g_offset"), F.col(f"_g_after_{b}")).alias(f"_after_{b}") for b in bands],
    )


def _shift(point: str, offset: str) -> Column:
    """A (position, value) point moved by an offset; null stays null."""
    return F.when(
        F.col(point).isNotNull(),
        F.struct((F.col(point)["i"] + F.col(offset)).alias("i"), F.col(point)["v"].alias("v")),
    )


def _running(df: DataFrame, bands: Sequence[str], within: Sequence[str], order: str) -> DataFrame:
    """Running offset, and for each band the nearest valid point before and after the row."""
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*within).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    for side, frame, point in (("before", before, "last"), ("after", after, "first")):
        out = out.withColumns({
            f"_{side}_{b}": F.last(_shift(f"_{point}_{b}", "_offset"), ignorenulls=True).over(frame) for b in bands
        })
    return out
