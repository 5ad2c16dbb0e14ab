"""Per-pixel band arithmetic."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def nodata_to_null(band: Column, nodata: float | None = None) -> Column:
    """NaN, and the sentinel when there is one, become null."""
    value = F.nanvl(band.cast("double"), F.lit(None).cast("double"))
    return value if nodata is None else F.nullif(value, F.lit(float(nodata)))


def scale_offset(band: Column, scale: float, offset: float) -> Column:
    return band * F.lit(float(scale)) + F.lit(float(offset))


def null_to_value(band: Column, missing: float, present: float) -> Column:
    """``missing`` where the band is null, ``present`` everywhere else."""
    return F.when(band.isNull(), F.lit(missing)).otherwise(F.lit(present))


def class_mask(code: Column, codes: Iterable[int]) -> Column:
    """1.0 where the class code is in the group, 0.0 where it is not, null where it is missing."""
    return code.isin(*codes).cast("double")


def linear_prediction(intercept: float, coefficients: Mapping[str, float]) -> Column:
    """``intercept + sum(coefficient * column)`` as one expression inside whole-stage codegen."""
    total = F.lit(float(intercept))
    for name, weight in coefficients.items():
        total = total + F.lit(float(weight)) * F.col(name)
    return total
