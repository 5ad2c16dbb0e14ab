"""Grid metadata kept beside a pixel table."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

META_SCHEMA = (
    "name string, crs string, x0 double, y0 double, dx double, dy double, "
    "width long, height long, nodata double, bands array<string>"
)


@dataclass(frozen=True)
class GridMeta:
    """North-up grid: ``(x0, y0)`` is the upper-left corner, ``dx`` and ``dy`` are positive cell sizes."""

    crs: str
    x0: float
    y0: float
    dx: float
    dy: float
    width: int
    height: int
    bands: tuple[str, ...] = field(default_factory=tuple)
    nodata: float | None = None
    name: str = "raster"

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        """(min x, min y, max x, max y), always derived so that it can never be stale."""
        return (self.x0, self.y0 - self.dy * self.height, self.x0 + self.dx * self.width, self.y0)

    def window(self, row_start: int, row_stop: int, col_start: int, col_stop: int) -> GridMeta:
        """Metadata of the sub-grid of the given half-open row and column ranges."""
        return replace(
            self,
            x0=self.x0 + self.dx * col_start,
            y0=self.y0 - self.dy * row_start,
            width=max(col_stop - col_start, 0),
            height=max(row_stop - row_start, 0),
        )

    def cover(self, bounds: tuple[float, float, float, float]) -> tuple[int, int, int, int]:
        """Row and column ranges (half-open) of the cells that touch ``bounds``, cut to this grid.

        Bounds that do not meet the grid raise.
        """
        min_x, min_y, max_x, max_y = bounds
        window = (
            max(math.floor((self.y0 - max_y) / self.dy), 0),
            min(math.ceil((self.y0 - min_y) / self.dy), self.height),
            max(math.floor((min_x - self.x0) / self.dx), 0),
            min(math.ceil((max_x - self.x0) / self.dx), self.width),
        )
        if window[0] >= window[1] or window[2] >= window[3]:
            raise ValueError(f"bounds {bounds} do not meet the grid {self.bounds}")
        return window

    def same_grid(self, other: GridMeta) -> bool:
        tolerance = 1e-6 * min(self.dx, self.dy)
        return (self.width, self.height) == (other.width, other.height) and all(
            abs(a - b) <= tolerance
            for a, b in zip(
                (self.x0, self.y0, self.dx, self.dy), (other.x0, other.y0, other.dx, other.dy)
            )
        )

    def with_bands(self, bands) -> GridMeta:
        return replace(self, bands=tuple(bands))

    def to_df(self, spark: SparkSession) -> DataFrame:
        row = (
            self.name, self.crs, self.x0, self.y0, self.dx, self.dy,
            self.width, self.height, self.nodata, list(self.bands),
        )
        return spark.createDataFrame([row], META_SCHEMA).withColumn(
            "created_at", F.current_timestamp()
        )

    @classmethod
    def from_df(cls, df: DataFrame) -> GridMeta:
        """Read back the one-row form."""
        row = df.limit(2).collect()
        if len(row) != 1:
            raise ValueError("raster metadata must hold exactly one row")
        row = row[0]
        return cls(
            name=row["name"], crs=row["crs"], x0=row["x0"], y0=row["y0"], dx=row["dx"],
            dy=row["dy"], width=row["width"], height=row["height"], nodata=row["nodata"],
            bands=tuple(row["bands"] or ()),
        )


def require_same_crs(*crs: str) -> None:
    if len(set(crs)) > 1:
        raise ValueError(f"inputs must share one CRS, got {sorted(set(crs))}")
