"""Transverse Mercator as column expressions (third-order Krueger series on GRS80)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# GRS80 ellipsoid, UTM scale and false easting, and the two ETRS89 zones in use.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
SCALE = 0.9996
FALSE_EASTING = 500000.0
ZONES = {"EPSG:25832": 32, "EPSG:25833": 33}
GEOGRAPHIC = "EPSG:4258"

_F = 1.0 / INVERSE_FLATTENING
N = _F / (2.0 - _F)
RECTIFYING = SEMI_MAJOR / (1.0 + N) * (1.0 + N**2 / 4.0 + N**4 / 64.0)
ALPHA = (
    N / 2.0 - 2.0 * N**2 / 3.0 + 5.0 * N**3 / 16.0,
    13.0 * N**2 / 48.0 - 3.0 * N**3 / 5.0,
    61.0 * N**3 / 240.0,
)
BETA = (
    N / 2.0 - 2.0 * N**2 / 3.0 + 37.0 * N**3 / 96.0,
    N**2 / 48.0 + N**3 / 15.0,
    17.0 * N**3 / 480.0,
)
DELTA = (
    2.0 * N - 2.0 * N**2 / 3.0 - 2.0 * N**3,
    7.0 * N**2 / 3.0 - 8.0 * N**3 / 5.0,
    56.0 * N**3 / 15.0,
)
CONFORMAL = 2.0 * math.sqrt(N) / (1.0 + N)


def zone_of(crs: str) -> int:
    if crs not in ZONES:
        raise ValueError(f"unsupported CRS {crs}; known: {sorted(ZONES)}")
    return ZONES[crs]


def central_meridian(zone: int) -> float:
    return 6.0 * zone - 183.0


def add_utm(df: DataFrame, lon: Column, lat: Column, zone: int, names: tuple[str, str]) -> DataFrame:
    """Add easting and northing of geographic degrees.

    The shared terms are staged as columns, so each is computed once per row.
    """
    out = df.withColumns(
        {"_sin": F.sin(F.radians(lat)), "_lam": F.radians(lon - F.lit(central_meridian(zone)))}
    )
    sin_phi = F.col("_sin")
    out = out.withColumn(
        "_t", F.sinh(F.atanh(sin_phi) - F.lit(CONFORMAL) * F.atanh(F.lit(CONFORMAL) * sin_phi))
    )
    t, lam = F.col("_t"), F.col("_lam")
    out = out.withColumns(
        {"_xi": F.atan2(t, F.cos(lam)), "_eta": F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + t * t))}
    )
    xi, eta = F.col("_xi"), F.col("_eta")
    east, north = eta, xi
    for j, a in enumerate(ALPHA, start=1):
        k = F.lit(2.0 * j)
        east = east + F.lit(a) * F.cos(k * xi) * F.sinh(k * eta)
        north = north + F.lit(a) * F.sin(k * xi) * F.cosh(k * eta)
    radius = F.lit(SCALE * RECTIFYING)
    return out.withColumns(
        {names[0]: F.lit(FALSE_EASTING) + radius * east, names[1]: radius * north}
    ).drop("_sin", "_lam", "_t", "_xi", "_eta")


def add_lonlat(df: DataFrame, x: Column, y: Column, zone: int, names: tuple[str, str]) -> DataFrame:
    """Add geographic degrees of easting and northing."""
    radius = F.lit(SCALE * RECTIFYING)
    out = df.withColumns({"_xi": y / radius, "_eta": (x - F.lit(FALSE_EASTING)) / radius})
    xi, eta = F.col("_xi"), F.col("_eta")
    xi_c, eta_c = xi, eta
    for j, b in enumerate(BETA, start=1):
        k = F.lit(2.0 * j)
        xi_c = xi_c - F.lit(b) * F.sin(k * xi) * F.cosh(k * eta)
        eta_c = eta_c - F.lit(b) * F.cos(k * xi) * F.sinh(k * eta)
    out = out.withColumns({"_xic": xi_c, "_etac": eta_c})
    xi_c, eta_c = F.col("_xic"), F.col("_etac")
    out = out.withColumn("_chi", F.asin(F.sin(xi_c) / F.cosh(eta_c)))
    lat = F.col("_chi")
    for j, d in enumerate(DELTA, start=1):
        lat = lat + F.lit(d) * F.sin(F.lit(2.0 * j) * F.col("_chi"))
    lon = F.degrees(F.atan2(F.sinh(eta_c), F.cos(xi_c))) + F.lit(central_meridian(zone))
    return out.withColumns({names[0]: lon, names[1]: F.degrees(lat)}).drop(
        "_xi", "_eta", "_xic", "_etac", "_chi"
    )


def add_converted(
    df: DataFrame, x: Column, y: Column, src: str, dst: str, names: tuple[str, str]
) -> DataFrame:
    """Add coordinates in ``dst`` of coordinates in ``src``, through geographic degrees where needed."""
    if src == dst:
        return df.withColumns({names[0]: x, names[1]: y})
    if src == GEOGRAPHIC:
        out = add_utm(df, x, y, zone_of(dst), ("_tx", "_ty"))
    elif dst == GEOGRAPHIC:
        out = add_lonlat(df, x, y, zone_of(src), ("_tx", "_ty"))
    else:
        out = add_lonlat(df, x, y, zone_of(src), ("_lon", "_lat"))
        out = add_utm(out, F.col("_lon"), F.col("_lat"), zone_of(dst), ("_tx", "_ty"))
    # A later filter on the result must not be pushed below the staged terms, which would repeat the
    # whole series inside the predicate; a one-element generator keeps it above.
    pair = F.struct(F.col("_tx").alias(names[0]), F.col("_ty").alias(names[1]))
    return out.select(*df.columns, F.inline(F.array(pair)))
