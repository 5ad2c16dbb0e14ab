"""Land-cover fractions and canopy fraction per cell."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.functions import affine
from verdigrid.functions.bands import class_mask
from verdigrid.meta import GridMeta
from verdigrid.operators.bands import CLASS_GROUPS
from verdigrid.operators.grid import grid_pixels
from verdigrid.operators.spatial import covered_spans


def land_cover_fractions(
    df: DataFrame, k: int, code: str = "class", groups: Mapping[str, Sequence[int]] = CLASS_GROUPS,
    row: str = "frow", col: str = "fcol",
) -> DataFrame:
    """Share of each class group per block of ``k`` x ``k`` fine cells, in one aggregate."""
    return df.groupBy(
        affine.block_of(F.col(row), k).cast("int").alias("row_id"),
        affine.block_of(F.col(col), k).cast("int").alias("col_id"),
    ).agg(*[F.avg(class_mask(F.col(code), codes)).alias(g) for g, codes in groups.items()])


def canopy_fraction(
    crowns: DataFrame, fine: GridMeta, k: int, polygon: Sequence[str] = ("crown_id",)
) -> DataFrame:
    """Crown area over cell area for every block of ``k`` x ``k`` fine cells; 0 where no crown reaches.

    Overlapping crowns cover a fine cell once. The cells of a block are counted from merged spans, without a row per cell; the coarse grid joins
    the covered blocks on their keys.
    """
    fine_area, cell_area = fine.dx * fine.dy, fine.dx * fine.dy * k * k
    coarse = replace(fine, dx=fine.dx * k, dy=fine.dy * k, width=-(-fine.width // k), height=-(-fine.height // k))
    block = F.col("col_id")
    parts = covered_spans(crowns, fine, polygon).select(
        affine.block_of(F.col("row_id"), k).cast("int").alias("row_id"), "from_col", "to_col",
        F.explode(F.sequence(F.expr(f"from_col div {k}"), F.expr(f"to_col div {k}"))).alias("col_id"),
    )
    cells = F.least(F.col("to_col"), block * k + (k - 1)) - F.greatest(F.col("from_col"), block * k) + 1
    covered = (
        parts.select("row_id", block.cast("int").alias("col_id"), cells.alias("cells"))
        .groupBy("row_id", "col_id").agg((F.sum("cells") * F.lit(fine_area)).alias("area"))
    )
    return (
        grid_pixels(crowns.sparkSession, coarse).join(covered, ["row_id", "col_id"], "left")
        .withColumn("area", F.coalesce("area", F.lit(0.0)))
        .withColumn("fraction_canopy", F.col("area") / F.lit(cell_area))
    )
