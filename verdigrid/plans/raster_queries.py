"""Grids, containment, projection, resampling, composites, stacks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from verdigrid.functions import utm
from verdigrid.meta import GridMeta
from verdigrid.operators import bands as ob
from verdigrid.operators import grid as og
from verdigrid.operators import landcover as ol
from verdigrid.operators import resample as orr
from verdigrid.operators import scenes as osc
from verdigrid.operators import spatial as osp
from verdigrid.operators import stack as ost
from verdigrid.operators import warp as ow
from verdigrid.plans import views, workflows
from verdigrid.plans.registry import query, rounded
from verdigrid.session import scratch_path
from verdigrid.sources import pixels as sp
from verdigrid.sources import scenes as ss

MEMBERS = """
members AS (
  SELECT p.row_id, p.col_id, e.district_id
  FROM pixels p JOIN district_edges e
    ON (e.y1 > p.y) <> (e.y2 > p.y) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"""
PIX = ("pixels", "district_edges")


# ---------------------------------------------------------------- masks, crops, clips


@query(
    "mask_by_polygons",
    f"""WITH {MEMBERS}
SELECT p.row_id, p.col_id, CASE WHEN m.row_id IS NOT NULL THEN dtm END AS dtm,
       CASE WHEN m.row_id IS NOT NULL THEN round(lst, 7) END AS lst
FROM pixels p LEFT JOIN (SELECT DISTINCT row_id, col_id FROM members) m USING (row_id, col_id)""",
    PIX,
)
def mask_by_polygons(spark, sf):
    df = views.pixels(spark, sf, ("dtm", "lst"))
    masked = osp.mask_by_polygons(df, views.district_edges(spark), ["dtm", "lst"])
    return rounded(masked.drop("x", "y"), 7, "lst")


@query(
    "crop_to_extent",
    "SELECT row_id, col_id - 30 AS col_id, x, y, round(lst, 7) AS lst FROM pixels WHERE row_id < 6 AND col_id BETWEEN 30 AND 60",
    ("pixels",),
)
def crop_to_extent(spark, sf):
    bounds = og.bounds_of(og.layer_bounds(views.district_edges(spark).filter("district_id = 3")))
    window, _ = og.crop_to_extent(views.pixels(spark, sf, ("lst",)), views.pixel_meta(spark, sf), bounds)
    return rounded(window, 7, "lst")


@query(
    "masked_read",
    f"""WITH {MEMBERS}
SELECT p.row_id, p.col_id - 30 AS col_id, CASE WHEN m.row_id IS NOT NULL THEN dtm END AS dtm
FROM pixels p LEFT JOIN (SELECT DISTINCT row_id, col_id FROM members WHERE district_id = 3) m USING (row_id, col_id)
WHERE p.row_id < 6 AND p.col_id BETWEEN 30 AND 60""",
    PIX,
)
def masked_read(spark, sf):
    edges = views.district_edges(spark).filter("district_id = 3")
    out, _ = osp.mask_and_crop(
        views.pixels(spark, sf, ("dtm",)), views.pixel_meta(spark, sf), edges, ["dtm"], edges_crs=views.CRS
    )
    return out.drop("x", "y")


@query(
    "masked_load",
    f"""WITH {MEMBERS}
SELECT p.row_id, p.col_id - 30 AS col_id, CASE WHEN m.row_id IS NOT NULL THEN dtm END AS dtm,
       CASE WHEN m.row_id IS NOT NULL THEN round(lst, 7) END AS lst
FROM pixels p LEFT JOIN (SELECT DISTINCT row_id, col_id FROM members WHERE district_id = 3) m USING (row_id, col_id)
WHERE p.row_id < 6 AND p.col_id BETWEEN 30 AND 60""",
    PIX,
)
def masked_load(spark, sf):
    """A stored raster read through a mask: only the window around the polygons is scanned."""
    path = scratch_path(spark, "masked-load")
    sp.write_pixels(views.pixels(spark, sf), views.pixel_meta(spark, sf), path)
    edges = views.district_edges(spark).filter("district_id = 3")
    return rounded(sp.read_raster(spark, path, ["dtm", "lst"], edges, mask_crs=views.CRS)[0], 7, "lst")


@query(
    "clip_points",
    f"WITH {MEMBERS} SELECT row_id, col_id, dtm, round(lst, 7) AS lst FROM pixels SEMI JOIN members USING (row_id, col_id)",
    PIX,
)
def clip_points(spark, sf):
    df = views.pixels(spark, sf, ("dtm", "lst"))
    clipped = osp.clip_points(df, views.district_edges(spark), crs=views.CRS, edges_crs=views.CRS)
    return rounded(clipped.drop("x", "y"), 7, "lst")


CROWN_MEMBERS = """
boxes AS (SELECT crown_id, min(least(x1, x2)) AS bx1, max(greatest(x1, x2)) AS bx2,
                 min(least(y1, y2)) AS by1, max(greatest(y1, y2)) AS by2 FROM crown_edges GROUP BY crown_id),
near_boxes AS (SELECT p.row_id, p.col_id, p.x, p.y, b.crown_id FROM pixels p JOIN boxes b
          ON p.x >= b.bx1 AND p.x <= b.bx2 AND p.y >= b.by1 AND p.y <= b.by2),
members AS (SELECT n.row_id, n.col_id, n.crown_id FROM near_boxes n JOIN crown_edges e ON n.crown_id = e.crown_id
            AND (e.y1 > n.y) <> (e.y2 > n.y) AND n.x < (e.x2 - e.x1) * (n.y - e.y1) / (e.y2 - e.y1) + e.x1
            GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"""


@query(
    "spatial_semi_join",
    f"WITH {CROWN_MEMBERS} SELECT row_id, col_id, x, y FROM pixels SEMI JOIN members USING (row_id, col_id)",
    ("pixels", "crown_edges"),
)
def spatial_semi_join(spark, sf):
    """Pixels whose centre stands under a crown: many small polygons."""
    crowns = osp.edges_of_polygons(views.crowns(spark, sf))
    points = views.pixels(spark, sf, ("dtm",)).drop("dtm")
    return osp.spatial_semi_join(points, crowns, ("crown_id",))


@query(
    "spatial_inner_join",
    f"WITH {MEMBERS} SELECT row_id, col_id, district_id FROM members",
    PIX,
)
def spatial_inner_join(spark, sf):
    points = views.pixels(spark, sf, ("dtm",)).drop("dtm")
    return osp.spatial_inner_join(points, views.district_edges(spark)).drop("x", "y")


@query(
    "layer_bounds",
    """SELECT round(min(least(x1, x2)), 6) AS min_x, round(min(least(y1, y2)), 6) AS min_y,
       round(max(greatest(x1, x2)), 6) AS max_x, round(max(greatest(y1, y2)), 6) AS max_y FROM crown_edges""",
    ("crown_edges",),
)
def layer_bounds(spark, sf):
    bounds = og.layer_bounds(osp.edges_of_polygons(views.crowns(spark, sf)))
    return rounded(bounds, 6, *bounds.columns)


SIZE = """SELECT count(*) AS n_pixels, CAST(max(row_id) + 1 AS BIGINT) AS n_rows, CAST(max(col_id) + 1 AS BIGINT) AS n_cols, 7 AS n_bands
FROM pixels"""
EXTENT = "SELECT min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y FROM pixels"


@query("extent", EXTENT, ("pixels",))
def extent(spark, sf):
    return og.extent(views.pixels(spark, sf, ("dtm",)))


def _stored(spark, sf):
    path = scratch_path(spark, "stored")
    sp.write_pixels(views.pixels(spark, sf), views.pixel_meta(spark, sf), path)
    return path


@query("stored_extent", EXTENT, ("pixels",))
def stored_extent(spark, sf):
    """The extent of a stored raster, from footers."""
    return sp.stored_extent(spark, _stored(spark, sf))


@query("stored_size", SIZE, ("pixels",))
def stored_size(spark, sf):
    """The size of a stored raster, from footers."""
    return sp.stored_size(spark, _stored(spark, sf))


@query(
    "edges_of_polygons",
    "SELECT crown_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM crown_edges",
    ("crown_edges",),
)
def edges_of_polygons(spark, sf):
    return rounded(osp.edges_of_polygons(views.crowns(spark, sf)), 6, *osp.EDGE)


# ---------------------------------------------------------------- projection


def sql_utm(source: str, keep: str, lon: str, lat: str, zone: int, name: str, x: str, y: str) -> str:
    """CTEs for easting and northing, ending in one called ``name``."""
    (a1, a2, a3), c = utm.ALPHA, utm.CONFORMAL
    keep = f"{keep}, " if keep else ""
    series = lambda t, f, g: " + ".join(
        f"{a!r} * {f}({2.0 * j!r} * xi) * {g}({2.0 * j!r} * eta)" for j, a in enumerate((a1, a2, a3), 1)
    )
    return f"""
{name}_1 AS (SELECT {keep}sin(radians({lat})) AS s, radians({lon} - {utm.central_meridian(zone)!r}) AS lam FROM {source}),
{name}_2 AS (SELECT {keep}lam, sinh(atanh(s) - {c!r} * atanh({c!r} * s)) AS t FROM {name}_1),
{name}_3 AS (SELECT {keep}atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1E0 + t * t)) AS eta FROM {name}_2),
{name} AS (SELECT {keep}500000E0 + {utm.SCALE * utm.RECTIFYING!r} * (eta + {series(0, 'cos', 'sinh')}) AS {x},
                  {utm.SCALE * utm.RECTIFYING!r} * (xi + {series(0, 'sin', 'cosh')}) AS {y} FROM {name}_3)"""


def sql_lonlat(source: str, keep: str, x: str, y: str, zone: int, name: str) -> str:
    """CTEs for geographic degrees, ending in one called ``name`` with columns lon and lat."""
    r, keep = utm.SCALE * utm.RECTIFYING, f"{keep}, " if keep else ""
    terms = lambda f, g: " ".join(
        f"- {b!r} * {f}({2.0 * j!r} * xi) * {g}({2.0 * j!r} * eta)" for j, b in enumerate(utm.BETA, 1)
    )
    deltas = " ".join(f"+ {d!r} * sin({2.0 * j!r} * chi)" for j, d in enumerate(utm.DELTA, 1))
    return f"""
{name}_1 AS (SELECT {keep}{y} / {r!r} AS xi, ({x} - 500000E0) / {r!r} AS eta FROM {source}),
{name}_2 AS (SELECT {keep}xi {terms('sin', 'cosh')} AS xic, eta {terms('cos', 'sinh')} AS etac FROM {name}_1),
{name}_3 AS (SELECT {keep}xic, etac, asin(sin(xic) / cosh(etac)) AS chi FROM {name}_2),
{name} AS (SELECT {keep}degrees(atan2(sinh(etac), cos(xic))) + {utm.central_meridian(zone)!r} AS lon,
                  degrees(chi {deltas}) AS lat FROM {name}_3)"""


@query(
    "project_points",
    f"WITH {sql_utm('lonlat', 'id', 'lon', 'lat', 32, 'east', 'x', 'y')} SELECT id, round(x, 3) AS x, round(y, 3) AS y FROM east",
    ("lonlat",),
)
def project_points(spark, sf):
    out = ow.project_points(views.lonlat(spark, sf), utm.zone_of("EPSG:25832")).select("id", "x", "y")
    return rounded(out, 3, "x", "y")


@query(
    "unproject_points",
    f"WITH {sql_lonlat('pixels', 'row_id, col_id', 'x', 'y', 32, 'geo')} "
    "SELECT row_id, col_id, round(lon, 8) AS lon, round(lat, 8) AS lat FROM geo",
    ("pixels",),
)
def unproject_points(spark, sf):
    out = ow.unproject_points(views.pixels(spark, sf, ("dtm",)), 32).select("row_id", "col_id", "lon", "lat")
    return rounded(out, 8, "lon", "lat")


TARGET_CELL = 100
TARGET_SQL = f"""
shape AS (SELECT max(row_id) + 1 AS h, max(col_id) + 1 AS w FROM pixels),
ticks AS (SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j FROM shape, unnest(generate_series(0, w)) AS a(i), unnest(generate_series(0, h)) AS b(j)
          WHERE i = 0 OR j = 0 OR i = w OR j = h),
outline AS (SELECT 440000E0 + 100E0 * i AS ox, 6450000E0 - 100E0 * j AS oy FROM ticks),
{sql_lonlat('outline', '', 'ox', 'oy', 32, 'outline_geo')},
{sql_utm('outline_geo', '', 'lon', 'lat', 33, 'outline_east', 'x', 'y')},
target AS (SELECT floor(min(x) / {TARGET_CELL}E0) AS l, ceil(max(x) / {TARGET_CELL}E0) AS r,
                  floor(min(y) / {TARGET_CELL}E0) AS b, ceil(max(y) / {TARGET_CELL}E0) AS t FROM outline_east)"""


@query(
    "target_grid",
    f"""WITH {TARGET_SQL}
SELECT 'EPSG:25833' AS crs, l * {TARGET_CELL}E0 AS x0, t * {TARGET_CELL}E0 AS y0, CAST(r - l AS BIGINT) AS width, CAST(t - b AS BIGINT) AS height
FROM target""",
    ("pixels",),
)
def target_grid(spark, sf):
    target = og.target_grid(spark, views.pixel_meta(spark, sf), "EPSG:25833", float(TARGET_CELL))
    return target.to_df(spark).select("crs", "x0", "y0", "width", "height")


@query(
    "reproject_nearest",
    f"""WITH {TARGET_SQL},
cells AS (SELECT CAST(i AS INT) AS row_id, CAST(j AS INT) AS col_id, l * {TARGET_CELL}E0 + {TARGET_CELL}E0 * (j + 0.5E0) AS cx,
                 t * {TARGET_CELL}E0 - {TARGET_CELL}E0 * (i + 0.5E0) AS cy
          FROM target, unnest(generate_series(0, CAST(t - b AS BIGINT) - 1)) AS a(i), unnest(generate_series(0, CAST(r - l AS BIGINT) - 1)) AS c(j)),
{sql_lonlat('cells', 'row_id, col_id', 'cx', 'cy', 33, 'cell_geo')},
{sql_utm('cell_geo', 'row_id, col_id', 'lon', 'lat', 32, 'cell_east', 'sx', 'sy')}
SELECT c.row_id, c.col_id, p.dtm, round(p.lst, 7) AS lst
FROM cell_east c LEFT JOIN pixels p
  ON p.row_id = floor((6450000E0 - c.sy) / 100E0) AND p.col_id = floor((c.sx - 440000E0) / 100E0)""",
    ("pixels",),
)
def reproject_nearest(spark, sf):
    meta = views.pixel_meta(spark, sf, ("dtm", "lst"))
    target = og.target_grid(spark, meta, "EPSG:25833", float(TARGET_CELL))
    out, _ = ow.reproject_nearest(views.pixels(spark, sf, ("dtm", "lst")), meta, target, ["dtm", "lst"])
    return rounded(out, 7, "lst")


# ---------------------------------------------------------------- resampling and zones


@query(
    "resample_bilinear",
    """WITH shape AS (SELECT max(row_id) + 1 AS h, max(col_id) + 1 AS w FROM pixels),
cells AS (SELECT CAST(i AS INT) AS row_id, CAST(j AS INT) AS col_id, h, w,
                 least(i * (CAST(h - 1 AS DOUBLE) / (2 * h - 1)), h - 1E0) AS pr, least(j * (CAST(w - 1 AS DOUBLE) / (2 * w - 1)), w - 1E0) AS pc
          FROM shape, unnest(generate_series(0, 2 * h - 1)) AS a(i), unnest(generate_series(0, 2 * w - 1)) AS b(j)),
parts AS (SELECT c.row_id, c.col_id, least(floor(pr) + a, h - 1) AS r, least(floor(pc) + b, w - 1) AS k,
                 (CASE WHEN a = 1 THEN pr - floor(pr) ELSE 1 - (pr - floor(pr)) END)
                 * (CASE WHEN b = 1 THEN pc - floor(pc) ELSE 1 - (pc - floor(pc)) END) AS weight
          FROM cells c, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS o(a, b))
SELECT n.row_id, n.col_id,
       CASE WHEN count(p.dtm) = count(*) THEN round(sum(weight * p.dtm), 6) END AS dtm,
       CASE WHEN count(p.fraction_canopy) = count(*) THEN round(sum(weight * p.fraction_canopy), 6) END AS fraction_canopy
FROM (SELECT * FROM parts WHERE weight > 1E-9) n LEFT JOIN pixels p ON p.row_id = n.r AND p.col_id = n.k
GROUP BY 1, 2""",
    ("pixels",),
)
def resample_bilinear(spark, sf):
    bands = ("dtm", "fraction_canopy")
    out, _ = orr.resample_bilinear(views.pixels(spark, sf, bands), views.pixel_meta(spark, sf, bands), 2.0, bands)
    return rounded(out, 6, *bands)


@query(
    "resample_nearest",
    """WITH shape AS (SELECT max(row_id) + 1 AS h, max(col_id) + 1 AS w FROM pixels),
cells AS (SELECT CAST(i AS INT) AS row_id, CAST(j AS INT) AS col_id, h, w
          FROM shape, unnest(generate_series(0, CAST(round(h * 100E0 / 30E0) AS BIGINT) - 1)) AS a(i),
               unnest(generate_series(0, CAST(round(w * 100E0 / 30E0) AS BIGINT) - 1)) AS b(j))
SELECT c.row_id, c.col_id, p.dtm
FROM cells c JOIN pixels p ON p.row_id = least(floor((c.row_id + 0.5E0) * 0.3E0), h - 1)
                          AND p.col_id = least(floor((c.col_id + 0.5E0) * 0.3E0), w - 1)""",
    ("pixels",),
)
def resample_nearest(spark, sf):
    meta = views.pixel_meta(spark, sf, ("dtm",))
    return orr.resample_nearest(views.pixels(spark, sf, ("dtm",)), meta, 30.0, ["dtm"])[0]


@query(
    "make_grid",
    """WITH box AS (SELECT min(x) AS x1, max(y) AS y1, CAST(ceil((max(x) - min(x)) / 250E0 - 1E-6) AS BIGINT) AS w,
             CAST(ceil((max(y) - min(y)) / 250E0 - 1E-6) AS BIGINT) AS h FROM pixels)
SELECT i * w + j AS cell_id, CAST(i AS INT) AS row_id, CAST(j AS INT) AS col_id,
       round(x1 + 250E0 * (j + 0.5E0), 6) AS x, round(y1 - 250E0 * (i + 0.5E0), 6) AS y
FROM box, unnest(generate_series(0, h - 1)) AS a(i), unnest(generate_series(0, w - 1)) AS b(j)""",
    ("pixels",),
)
def make_grid(spark, sf):
    bounds = og.bounds_of(og.extent(views.pixels(spark, sf, ("dtm",))))
    return rounded(og.make_grid(spark, bounds, 250.0).select("cell_id", "row_id", "col_id", "x", "y"), 6, "x", "y")


@query(
    "zonal_sum",
    """SELECT CAST(floor((6450000E0 - y) / 1000E0) AS BIGINT) AS zone_row, CAST(floor((x - 440000E0) / 1000E0) AS BIGINT) AS zone_col,
       round(sum(dtm), 5) AS sum_dtm FROM pixels GROUP BY 1, 2""",
    ("pixels",),
)
def zonal_sum(spark, sf):
    zones = GridMeta(views.CRS, *views.ORIGIN, 1000.0, 1000.0, 10, 0)
    return rounded(orr.zonal_sum(views.pixels(spark, sf, ("dtm",)), zones, "dtm"), 5, "sum_dtm")


@query(
    "zonal_stats",
    """SELECT CAST(floor((6450000E0 - y) / 500E0) AS BIGINT) AS zone_row, CAST(floor((x - 440000E0) / 500E0) AS BIGINT) AS zone_col,
       round(avg(lst), 6) AS mean_lst, round(min(lst), 7) AS min_lst, round(max(lst), 7) AS max_lst, count(lst) AS count_lst
FROM pixels GROUP BY 1, 2""",
    ("pixels",),
)
def zonal_stats(spark, sf):
    zones = GridMeta(views.CRS, *views.ORIGIN, 500.0, 500.0, 20, 0)
    out = orr.zonal_stats(views.pixels(spark, sf, ("lst",)), zones, "lst", ("mean", "min", "max", "count"))
    return rounded(rounded(out, 6, "mean_lst"), 7, "min_lst", "max_lst")


@query(
    "block_mean",
    """SELECT CAST(floor(row_id / 10E0) AS INT) AS row_id, CAST(floor(col_id / 10E0) AS INT) AS col_id,
       round(avg(dtm), 7) AS dtm, round(avg(lst), 6) AS lst FROM pixels GROUP BY 1, 2""",
    ("pixels",),
)
def block_mean(spark, sf):
    out = orr.block_mean(views.pixels(spark, sf, ("dtm", "lst")), 10, ["dtm", "lst"])
    return rounded(rounded(out, 7, "dtm"), 6, "lst")


@query(
    "block_mean_weighted",
    """WITH shape AS (SELECT max(row_id) + 1 AS h FROM pixels),
big AS (SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j FROM shape, unnest(generate_series(0, CAST(ceil(h * 100E0 / 270E0) AS BIGINT) - 1)) AS a(i),
        unnest(generate_series(0, 37)) AS b(j)),
shares AS (SELECT b.i AS row_id, b.j AS col_id, p.dtm,
       (least((p.row_id + 1) * 100E0, (b.i + 1) * 270E0) - greatest(p.row_id * 100E0, b.i * 270E0))
     * (least((p.col_id + 1) * 100E0, (b.j + 1) * 270E0) - greatest(p.col_id * 100E0, b.j * 270E0)) AS weight
FROM pixels p JOIN big b ON p.row_id * 100E0 < (b.i + 1) * 270E0 AND (p.row_id + 1) * 100E0 > b.i * 270E0
                        AND p.col_id * 100E0 < (b.j + 1) * 270E0 AND (p.col_id + 1) * 100E0 > b.j * 270E0)
SELECT row_id, col_id, round(sum(weight * dtm) / sum(CASE WHEN dtm IS NOT NULL THEN weight END), 6) AS dtm FROM shares GROUP BY 1, 2""",
    ("pixels",),
)
def block_mean_weighted(spark, sf):
    meta = views.pixel_meta(spark, sf, ("dtm",))
    target = GridMeta(views.CRS, *views.ORIGIN, 270.0, 270.0, 38, -(-meta.height * 100 // 270), ("dtm",))
    return rounded(orr.block_mean_weighted(views.pixels(spark, sf, ("dtm",)), meta, target, ["dtm"]), 6, "dtm")


@query(
    "max_composite",
    """SELECT pixel_id, max(value) AS value FROM scenes
WHERE scene_date >= TIMESTAMP '2024-01-05' AND scene_date < TIMESTAMP '2024-01-20' AND satellite = 'view' GROUP BY 1""",
    ("scenes",),
)
def max_composite(spark, sf):
    chosen = osc.date_range(views.scenes(spark, sf), "2024-01-05", "2024-01-20", "view")
    return osc.max_composite(chosen, ["value"])


@query(
    "stored_scenes",
    """SELECT pixel_id, max(value) AS value, count(*) AS n_scenes FROM scenes
WHERE scene_date >= TIMESTAMP '2024-01-05' AND scene_date < TIMESTAMP '2024-01-20' AND satellite = 'view' GROUP BY 1""",
    ("scenes",),
)
def stored_scenes(spark, sf):
    """A composite over a stored collection, of which only the folders of the period are read."""
    path = scratch_path(spark, "scenes")
    ss.write_scenes(views.scenes(spark, sf), path)
    chosen = ss.scan_scenes(spark, path, "2024-01-05", "2024-01-20", "view")
    return chosen.groupBy("pixel_id").agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("n_scenes"))


@query(
    "first_scene",
    """SELECT pixel_id, scene_date, event_id, value FROM
  (SELECT *, row_number() OVER (PARTITION BY pixel_id ORDER BY scene_date, event_id) AS rn FROM scenes) WHERE rn = 1""",
    ("scenes",),
)
def first_scene(spark, sf):
    return osc.first_scene(views.scenes(spark, sf), ["value"], order=("scene_date", "event_id"))


@query(
    "first_of_collection",
    "SELECT pixel_id, scene_date, satellite, event_id, value FROM scenes ORDER BY scene_date, event_id LIMIT 1",
    ("scenes",),
)
def first_of_collection(spark, sf):
    return osc.first_of_collection(views.scenes(spark, sf), ["scene_date", "event_id"])


@query(
    "date_range",
    """SELECT pixel_id, scene_date, event_id, value FROM scenes
WHERE scene_date >= TIMESTAMP '2024-01-15' AND scene_date < TIMESTAMP '2024-01-31' AND satellite = 'click'""",
    ("scenes",),
)
def date_range(spark, sf):
    return osc.date_range(views.scenes(spark, sf), "2024-01-15", "2024-01-31", "click").drop("satellite")


@query(
    "land_cover_fractions",
    """SELECT CAST(floor(frow / 10E0) AS INT) AS row_id, CAST(floor(fcol / 10E0) AS INT) AS col_id,
       round(avg(CASE WHEN class IN (20, 30, 60, 90) THEN 1E0 ELSE 0E0 END), 6) AS fraction_grass,
       round(avg(CASE WHEN class = 40 THEN 1E0 ELSE 0E0 END), 6) AS fraction_cropland,
       round(avg(CASE WHEN class = 50 THEN 1E0 ELSE 0E0 END), 6) AS fraction_built,
       round(avg(CASE WHEN class IN (70, 80) THEN 1E0 ELSE 0E0 END), 6) AS fraction_water
FROM landcover GROUP BY 1, 2""",
    ("landcover",),
)
def land_cover_fractions(spark, sf):
    return rounded(ol.land_cover_fractions(views.landcover(spark, sf), 10), 6, *ob.CLASS_GROUPS)


CROWN_CELLS = """
boxes AS (SELECT crown_id, floor((6450000E0 - max(greatest(y1, y2))) / 2E0) AS r1, ceil((6450000E0 - min(least(y1, y2))) / 2E0) AS r2,
                 floor((min(least(x1, x2)) - 440000E0) / 2E0) AS c1, ceil((max(greatest(x1, x2)) - 440000E0) / 2E0) AS c2
          FROM crown_edges GROUP BY crown_id),
rows_of AS (SELECT crown_id, c1, c2, unnest(generate_series(CAST(r1 AS BIGINT), CAST(r2 AS BIGINT))) AS r FROM boxes),
cells AS (SELECT crown_id, r, unnest(generate_series(CAST(c1 AS BIGINT), CAST(c2 AS BIGINT))) AS c FROM rows_of),
centres AS (SELECT crown_id, r, c, 440000E0 + 2E0 * (c + 0.5E0) AS x, 6450000E0 - 2E0 * (r + 0.5E0) AS y FROM cells
            WHERE r BETWEEN 0 AND 749 AND c BETWEEN 0 AND 4999),
covered AS (SELECT n.crown_id, n.r, n.c FROM centres n JOIN crown_edges e ON n.crown_id = e.crown_id
            AND (e.y1 > n.y) <> (e.y2 > n.y) AND n.x < (e.x2 - e.x1) * (n.y - e.y1) / (e.y2 - e.y1) + e.x1
            GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1),
crown_cells AS (SELECT DISTINCT r, c FROM covered)"""


@query(
    "rasterize_polygons",
    f"WITH {CROWN_CELLS} SELECT CAST(r AS INT) AS row_id, CAST(c AS INT) AS col_id FROM crown_cells",
    ("crown_edges",),
)
def rasterize_polygons(spark, sf):
    return osp.rasterize_polygons(osp.edges_of_polygons(views.crowns(spark, sf)), views.crown_grid())


@query(
    "canopy_fraction",
    f"""WITH {CROWN_CELLS}
, covered_blocks AS (SELECT CAST(floor(r / 50E0) AS INT) AS row_id, CAST(floor(c / 50E0) AS INT) AS col_id, count(*) * 4E0 AS area
FROM crown_cells GROUP BY 1, 2),
coarse AS (SELECT CAST(i AS INT) AS row_id, CAST(j AS INT) AS col_id FROM unnest(generate_series(0, 14)) AS a(i), unnest(generate_series(0, 99)) AS b(j))
SELECT g.row_id, g.col_id, coalesce(area, 0E0) AS area, round(coalesce(area, 0E0) / 10000E0, 6) AS fraction_canopy
FROM coarse g LEFT JOIN covered_blocks n ON g.row_id = n.row_id AND g.col_id = n.col_id""",
    ("crown_edges",),
)
def canopy_fraction(spark, sf):
    crowns = osp.edges_of_polygons(views.crowns(spark, sf))
    return rounded(ol.canopy_fraction(crowns, views.crown_grid(), 50), 6, "fraction_canopy")


@query(
    "expand_zone",
    """WITH zone_cells AS (SELECT frow, fcol FROM landcover WHERE class = 80),
hits AS (SELECT DISTINCT z.frow + a AS frow, z.fcol + b AS fcol FROM zone_cells z,
         (VALUES (-1), (0), (1)) AS o(a), (VALUES (-1), (0), (1)) AS q(b))
SELECT l.frow, l.fcol, CASE WHEN h.frow IS NOT NULL THEN 80 ELSE l.class END AS class
FROM landcover l LEFT JOIN hits h ON l.frow = h.frow AND l.fcol = h.fcol""",
    ("landcover",),
)
def expand_zone(spark, sf):
    return orr.expand_zone(views.landcover(spark, sf), "class", (80,), 1, ("frow", "fcol"))


# ---------------------------------------------------------------- stacks and composed tables


STACKED = """WITH t AS (SELECT row_id, col_id, dtm FROM pixels),
c AS (SELECT row_id, col_id, fraction_built, fraction_cropland, fraction_grass, fraction_water FROM pixels),
s AS (SELECT row_id, col_id, lst FROM pixels WHERE row_id % 2 = 0),
k AS (SELECT row_id, col_id, fraction_canopy FROM pixels WHERE col_id % 3 > 0)
SELECT row_id, col_id, dtm, round(fraction_built, 7) AS fraction_built, round(fraction_cropland, 7) AS fraction_cropland,
       round(fraction_grass, 7) AS fraction_grass, round(fraction_water, 7) AS fraction_water, round(lst, 7) AS lst,
       round(fraction_canopy, 7) AS fraction_canopy
FROM t FULL JOIN c USING (row_id, col_id) FULL JOIN s USING (row_id, col_id) FULL JOIN k USING (row_id, col_id)"""


@query("stack_bands", STACKED, ("pixels",))
def stack_bands(spark, sf):
    """Four rasters of 1 + 4 + 1 + 1 bands; two of them lack pixels."""
    stacked, _ = ost.stack_bands(_rasters(spark, sf))
    return rounded(stacked, 7, *(b for b in ob.STACK_BANDS if b != "dtm"))


@query("stack_tiles", STACKED, ("pixels",))
def stack_tiles(spark, sf):
    """The same four rasters, stored by tile and stacked without a shuffle."""
    tables = []
    for df, meta in _rasters(spark, sf):
        tables.append(f"tiles_{uuid.uuid4().hex}")
        sp.write_tiles(df, meta.with_bands(c for c in df.columns if c not in ob.PIXEL_KEY), tables[-1], 8)
    stacked, _ = sp.stack_tiles(spark, tables)
    return rounded(stacked, 7, *(b for b in ob.STACK_BANDS if b != "dtm"))


def _rasters(spark, sf):
    meta = views.pixel_meta(spark, sf)
    part = lambda *bands: ob.select_bands(views.pixels(spark, sf, bands), bands)
    return [
        (part("dtm"), meta),
        (part("fraction_built", "fraction_cropland", "fraction_grass", "fraction_water"), meta),
        (part("lst").filter("row_id % 2 = 0"), meta),
        (part("fraction_canopy").filter("col_id % 3 > 0"), meta),
    ]


@query(
    "pixel_table",
    f"""WITH {MEMBERS}
SELECT row_id, col_id, x, y, dtm, round(fraction_built, 7) AS fraction_built, round(fraction_cropland, 7) AS fraction_cropland,
       round(fraction_grass, 7) AS fraction_grass, round(fraction_water, 7) AS fraction_water, round(lst, 7) AS lst,
       round(fraction_canopy, 7) AS fraction_canopy
FROM pixels SEMI JOIN members USING (row_id, col_id) WHERE dtm IS NOT NULL""",
    PIX,
)
def pixel_table(spark, sf):
    stack = ob.select_bands(views.pixels(spark, sf), ob.STACK_BANDS)
    out = workflows.pixel_table(stack, views.pixel_meta(spark, sf), views.district_edges(spark), views.CRS)
    return rounded(out, 7, *(b for b in ob.STACK_BANDS if b != "dtm"))


@query(
    "grid_lookup",
    f"""WITH {sql_utm('lonlat', 'id', 'lon', 'lat', 32, 'east', 'x', 'y')}
SELECT e.id, p.dtm FROM east e LEFT JOIN pixels p
  ON p.row_id = floor((6450000E0 - (6440000E0 + e.y % 20000E0)) / 100E0) AND p.col_id = floor((440000E0 + e.x % 12000E0 - 440000E0) / 100E0)""",
    ("lonlat", "pixels"),
)
def grid_lookup(spark, sf):
    """Raster values under points; the points are folded onto the raster and its surroundings."""
    points = ow.project_points(views.lonlat(spark, sf), 32).select(
        "id", (F.lit(440000.0) + F.col("x") % 12000.0).alias("x"), (F.lit(6440000.0) + F.col("y") % 20000.0).alias("y")
    )
    meta = views.pixel_meta(spark, sf)
    return ow.grid_lookup(points, views.pixels(spark, sf, ("dtm",)), meta, ["dtm"]).select("id", "dtm")


@query("collection_size", SIZE, ("pixels",))
def collection_size(spark, sf):
    return og.collection_size(views.pixels(spark, sf))
