"""Stack rasters of one grid into one pixel table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.meta import GridMeta, require_same_crs
from verdigrid.operators.bands import PIXEL_KEY, STACK_BANDS


def check_same_grid(metas: Sequence[GridMeta]) -> None:
    """CRS, shape and transform must agree; positional stacking would misplace pixels otherwise."""
    require_same_crs(*[m.crs for m in metas])
    first = metas[0]
    for other in metas[1:]:
        if (other.width, other.height) != (first.width, first.height):
            raise ValueError(
                f"cannot stack: shape {other.height} x {other.width} of {other.name}, {first.height} x {first.width} of {first.name}"
            )
        if not other.same_grid(first):
            raise ValueError("input rasters must have the same transform")


def stack_bands(
    rasters: Sequence[tuple[DataFrame, GridMeta]],
    names: Sequence[str] = STACK_BANDS,
    key: Sequence[str] = PIXEL_KEY,
) -> tuple[DataFrame, GridMeta]:
    """Bring the bands of all rasters side by side, renamed by position.

    Every raster has at most one row per pixel, so a union and one grouped aggregate give the full
    outer join of all of them with a single exchange, where a chain of outer joins would shuffle
    the growing intermediate again for each raster.
    """
    check_same_grid([m for _, m in rasters])
    remaining = list(names)
    parts = []
    for df, _ in rasters:
        bands = [c for c in df.columns if c not in key]
        taken, remaining = remaining[: len(bands)], remaining[len(bands):]
        if len(taken) != len(bands):
            raise ValueError("more bands than names")
        parts.append(df.select(*key, *[F.col(b).alias(n) for b, n in zip(bands, taken)]))
    if remaining:
        raise ValueError(f"no bands left for {remaining}")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    stacked = merged.groupBy(*key).agg(*[F.max(n).alias(n) for n in names])
    return stacked, rasters[0][1].with_bands(names)
