"""Band-level operators on a pixel table (one row per pixel, one DOUBLE column per band)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigrid.functions import bands as fb

# Band order of the stacked raster, and the land-cover codes of each class group.
STACK_BANDS = (
    "dtm",
    "fraction_built",
    "fraction_cropland",
    "fraction_grass",
    "fraction_water",
    "lst",
    "fraction_canopy",
)
CLASS_GROUPS = {
    "fraction_grass": (20, 30, 60, 90),
    "fraction_cropland": (40,),
    "fraction_built": (50,),
    "fraction_water": (70, 80),
}
PIXEL_KEY = ("row_id", "col_id")


def _require(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")


def select_bands(df: DataFrame, names: Sequence[str], key: Sequence[str] = PIXEL_KEY) -> DataFrame:
    """Keep the pixel key and the named bands; the scan reads nothing else."""
    _require(df, names)
    return df.select(*key, *names)


def rename_bands(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    _require(df, list(names))
    return df.withColumnsRenamed(dict(names))


def rename_all_bands(df: DataFrame, names: Sequence[str], key: Sequence[str] = PIXEL_KEY) -> DataFrame:
    """Give the bands new names by position, as a stack does."""
    bands = [c for c in df.columns if c not in key]
    if len(bands) != len(names):
        raise ValueError(f"{len(bands)} bands cannot take {len(names)} names")
    return df.select(*key, *[F.col(b).alias(n) for b, n in zip(bands, names)])


def drop_band(df: DataFrame, *names: str) -> DataFrame:
    _require(df, names)
    return df.drop(*names)


def set_constant(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Scenario: the named bands take one value on every row, missing rows included."""
    return df.withColumns({name: F.lit(float(v)) for name, v in values.items()})


def scale_offset(df: DataFrame, names: Sequence[str], scale: float, offset: float) -> DataFrame:
    _require(df, names)
    return df.withColumns({n: fb.scale_offset(F.col(n), scale, offset) for n in names})


def band_math(df: DataFrame, **expressions: str) -> DataFrame:
    """Raster calculator: ``band_math(df, fraction="area / 10000")``."""
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def null_to_value(df: DataFrame, name: str, missing: float = 0.0, present: float = 4.0) -> DataFrame:
    _require(df, [name])
    return df.withColumn(name, fb.null_to_value(F.col(name), missing, present))


def add_bands(df: DataFrame, bands: Mapping[str, Column]) -> DataFrame:
    """Append bands computed on the same grid; an existing name is an error."""
    clash = [n for n in bands if n in df.columns]
    if clash:
        raise ValueError(f"bands exist already: {clash}")
    return df.withColumns(dict(bands))


def class_masks(
    df: DataFrame, code: str = "class", groups: Mapping[str, Sequence[int]] = CLASS_GROUPS
) -> DataFrame:
    """One 0/1 band per class group; codes in no group (trees among them) are 0 everywhere."""
    _require(df, [code])
    return add_bands(df, {g: fb.class_mask(F.col(code), codes) for g, codes in groups.items()})


def nodata_to_null(df: DataFrame, names: Sequence[str], nodata: float | None = None) -> DataFrame:
    """The sentinel and NaN become null in all named bands, not only the first."""
    _require(df, names)
    return df.withColumns({n: fb.nodata_to_null(F.col(n), nodata) for n in names})


def valid_pixels(df: DataFrame, first_band: str = "dtm") -> DataFrame:
    """Rows whose first band is valid; the other bands do not matter."""
    _require(df, [first_band])
    return df.filter(F.col(first_band).isNotNull())


def drop_missing(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows without null or NaN in the named columns (all columns by default)."""
    return df.na.drop(subset=list(names) if names else None)
