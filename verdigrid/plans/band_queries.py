"""Scans, sinks, projections, filters and scalar expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from verdigrid.operators import bands as ob
from verdigrid.operators import grid as og
from verdigrid.operators import spatial as os_
from verdigrid.plans import views
from verdigrid.plans.registry import query, rounded
from verdigrid.session import scratch_path
from verdigrid.sources import features, pixels as sp, sql as ss

FRACTIONS = ("fraction_built", "fraction_cropland", "fraction_grass", "fraction_water", "fraction_canopy")
ALL_BANDS = (
    "round(dtm, 7) AS dtm, round(fraction_built, 7) AS fraction_built, round(fraction_cropland, 7) AS fraction_cropland, "
    "round(fraction_grass, 7) AS fraction_grass, round(fraction_water, 7) AS fraction_water, round(lst, 7) AS lst, "
    "round(fraction_canopy, 7) AS fraction_canopy"
)
STACK = ob.STACK_BANDS


@query("scan_pixels", "SELECT row_id, col_id, dtm, round(lst, 7) AS lst FROM pixels", ("pixels",))
def scan_pixels(spark, sf):
    path = scratch_path(spark, "scan-pixels")
    sp.write_pixels(views.pixels(spark, sf), views.pixel_meta(spark, sf), path)
    return rounded(sp.scan_pixels(spark, f"{path}/pixels", ["dtm", "lst"]), 7, "lst")


@query("write_pixels", f"SELECT row_id, col_id, {ALL_BANDS} FROM pixels", ("pixels",))
def write_pixels(spark, sf):
    path = scratch_path(spark, "write-pixels")
    sp.write_pixels(views.pixels(spark, sf), views.pixel_meta(spark, sf), path)
    return rounded(sp.read_raster(spark, path)[0], 7, *STACK)


@query(
    "scan_features",
    "SELECT crown_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM crown_edges",
    ("crown_edges",),
)
def scan_features(spark, sf):
    """Crowns written as GeoJSON features, one per line, and read as edges."""
    path = scratch_path(spark, "features")
    polygon = F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates"))
    views.crowns(spark, sf).select(
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"), polygon.alias("geometry"),
                F.struct("crown_id").alias("properties"),
            )
        ).alias("value")
    ).write.text(path)
    edges = features.scan_edges(spark, path, "crown_id long", line_delimited=True)
    return rounded(edges.select("crown_id", *os_.EDGE), 6, *os_.EDGE)


@query(
    "scan_collection",
    "SELECT crown_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM crown_edges",
    ("crown_edges",),
)
def scan_collection(spark, sf):
    """Crowns written as feature collections of up to 5,000, each one JSON document, and read by byte ranges."""
    path = scratch_path(spark, "collections")
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates")).alias("geometry"),
        F.struct("crown_id").alias("properties"),
    )
    documents = views.crowns(spark, sf).groupBy(F.expr("crown_id div 5000").alias("part")).agg(F.collect_list(feature).alias("features"))
    collection = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")
    documents.select(collection, "part").repartition("part").write.partitionBy("part").text(path)
    edges = features.scan_edges(spark, path, "crown_id long")
    return rounded(edges.select("crown_id", *os_.EDGE), 6, *os_.EDGE)


@query(
    "write_features",
    "SELECT x, y, row_id, col_id, dtm, round(lst, 7) AS lst FROM pixels",
    ("pixels",),
)
def write_features(spark, sf):
    path = scratch_path(spark, "points")
    features.write_features(views.pixels(spark, sf, ("dtm", "lst")), path)
    back = features.scan_points(spark, path, "row_id int, col_id int, dtm double, lst double")
    return rounded(back, 7, "lst")


SQL_TEXT = (
    "SELECT row_id, count(lst) AS n_lst, round(max(dtm), 6) AS max_dtm FROM {pixels} "
    "WHERE dtm IS NOT NULL GROUP BY row_id HAVING count(lst) > 0"
)


@query("sql_source", SQL_TEXT.replace("{pixels}", "pixels"), ("pixels",))
def sql_source(spark, sf):
    return ss.sql_source(spark, SQL_TEXT, {"pixels": views.pixels(spark, sf)})


TABLE_TEXT = "SELECT o_orderstatus, count(*) AS n_orders, round(max(o_totalprice), 6) AS max_price FROM {} GROUP BY o_orderstatus"


@query("sql_table_sink", TABLE_TEXT.format("orders"))
def sql_table_sink(spark, sf):
    name = f"data_{uuid.uuid4().hex}"
    text = TABLE_TEXT.format(f"parquet.`{sf}/orders.parquet`")
    ss.sql_table_sink(spark, text, name, scratch_path(spark, "table"))
    return spark.table(name)


@query(
    "export_image",
    "SELECT row_id, col_id - 30 AS col_id, dtm, round(lst, 7) AS lst FROM pixels "
    "WHERE row_id < 6 AND col_id BETWEEN 30 AND 60",
    ("pixels",),
)
def export_image(spark, sf):
    path = scratch_path(spark, "image")
    region = og.bounds_of(og.layer_bounds(views.district_edges(spark).filter("district_id = 3")))
    meta = views.pixel_meta(spark, sf, ("dtm", "lst"))
    sp.export_image(views.pixels(spark, sf, ("dtm", "lst")).drop("x", "y"), meta, region, path)
    return rounded(sp.read_raster(spark, path)[0], 7, "lst")


@query("select_bands", "SELECT row_id, col_id, round(lst, 7) AS lst, dtm FROM pixels", ("pixels",))
def select_bands(spark, sf):
    return rounded(ob.select_bands(views.pixels(spark, sf, ("dtm", "lst")), ["lst", "dtm"]), 7, "lst")


@query(
    "rename_bands",
    "SELECT row_id, col_id, dtm AS elevation, round(lst, 7) AS surface_temperature FROM pixels",
    ("pixels",),
)
def rename_bands(spark, sf):
    df = views.pixels(spark, sf, ("dtm", "lst")).drop("x", "y")
    named = ob.rename_bands(ob.rename_all_bands(df, ["b1", "b2"]), {"b1": "elevation", "b2": "surface_temperature"})
    return rounded(named, 7, "surface_temperature")


@query(
    "drop_band",
    "SELECT row_id, col_id, x, y, dtm, round(fraction_canopy, 6) AS fraction_canopy FROM pixels",
    ("pixels",),
)
def drop_band(spark, sf):
    return rounded(
        ob.drop_band(views.pixels(spark, sf, ("dtm", "lst", "fraction_canopy")), "lst"), 6, "fraction_canopy"
    )


@query("set_constant", "SELECT row_id, col_id, dtm, 0E0 AS fraction_canopy FROM pixels", ("pixels",))
def set_constant(spark, sf):
    df = views.pixels(spark, sf, ("dtm", "fraction_canopy")).drop("x", "y")
    return ob.set_constant(df, {"fraction_canopy": 0.0})


@query(
    "scale_offset",
    "SELECT row_id, col_id, round(dtm * 0.0000275E0 + -0.2E0, 9) AS dtm FROM pixels",
    ("pixels",),
)
def scale_offset(spark, sf):
    df = views.pixels(spark, sf, ("dtm",)).drop("x", "y")
    return rounded(ob.scale_offset(df, ["dtm"], 0.0000275, -0.2), 9, "dtm")


@query(
    "band_math",
    "SELECT row_id, col_id, dtm, round(dtm / 10000E0, 12) AS fraction FROM pixels",
    ("pixels",),
)
def band_math(spark, sf):
    df = views.pixels(spark, sf, ("dtm",)).drop("x", "y")
    return rounded(ob.band_math(df, fraction="dtm / 10000"), 12, "fraction")


@query(
    "null_to_value",
    "SELECT row_id, col_id, CASE WHEN dtm IS NULL THEN 0E0 ELSE 4E0 END AS dtm FROM pixels",
    ("pixels",),
)
def null_to_value(spark, sf):
    return ob.null_to_value(views.pixels(spark, sf, ("dtm",)).drop("x", "y"), "dtm")


_MASKS = """
SELECT frow, fcol, class,
       CASE WHEN class IN (20, 30, 60, 90) THEN 1E0 ELSE 0E0 END AS fraction_grass,
       CASE WHEN class = 40 THEN 1E0 ELSE 0E0 END AS fraction_cropland,
       CASE WHEN class = 50 THEN 1E0 ELSE 0E0 END AS fraction_built,
       CASE WHEN class IN (70, 80) THEN 1E0 ELSE 0E0 END AS fraction_water
FROM landcover"""


@query("class_masks", _MASKS, ("landcover",))
def class_masks(spark, sf):
    return ob.class_masks(views.landcover(spark, sf))


@query(
    "add_bands",
    "SELECT frow, fcol, class, CASE WHEN class = 10 THEN 1E0 ELSE 0E0 END AS trees, class + 1 AS shifted FROM landcover",
    ("landcover",),
)
def add_bands(spark, sf):
    trees = F.when(F.col("class") == 10, 1.0).otherwise(0.0)
    return ob.add_bands(views.landcover(spark, sf), {"trees": trees, "shifted": F.col("class") + 1})


@query("valid_pixels", "SELECT row_id, col_id, dtm, round(lst, 7) AS lst FROM pixels WHERE dtm IS NOT NULL", ("pixels",))
def valid_pixels(spark, sf):
    return rounded(ob.valid_pixels(views.pixels(spark, sf, ("dtm", "lst")).drop("x", "y")), 7, "lst")


@query(
    "drop_missing",
    "SELECT row_id, col_id, dtm, round(lst, 7) AS lst FROM pixels WHERE dtm IS NOT NULL AND lst IS NOT NULL",
    ("pixels",),
)
def drop_missing(spark, sf):
    return rounded(ob.drop_missing(views.pixels(spark, sf, ("dtm", "lst")).drop("x", "y")), 7, "lst")


@query(
    "pixel_centres",
    "SELECT row_id, col_id, round(x, 9) AS x, round(y, 9) AS y FROM pixels",
    ("pixels",),
)
def pixel_centres(spark, sf):
    cells = views.pixels(spark, sf, ("dtm",)).select("row_id", "col_id")
    return og.pixel_centres(cells, views.pixel_meta(spark, sf))


@query(
    "point_geometry",
    "SELECT row_id, col_id, x AS point_x, y AS point_y, 'EPSG:25832' AS point_crs FROM pixels",
    ("pixels",),
)
def point_geometry(spark, sf):
    points = og.point_geometry(views.pixels(spark, sf, ("dtm",)), views.CRS)
    return points.select(
        "row_id", "col_id", F.col("geometry.x").alias("point_x"), F.col("geometry.y").alias("point_y"),
        F.col("geometry.crs").alias("point_crs"),
    )
