"""The composed steps end to end on the smallest tables."""

from verdigrid.operators import bands as ob
from verdigrid.operators import grid, spatial
from verdigrid.plans import views, workflows
from tests.conftest import SF_DIR


def test_rasters_to_district_figures(spark):
    meta = views.pixel_meta(spark, SF_DIR)
    groups = [("dtm",), ("fraction_built", "fraction_cropland", "fraction_grass", "fraction_water"), ("lst",), ("fraction_canopy",)]
    rasters = [(ob.select_bands(views.pixels(spark, SF_DIR, g), g), meta.with_bands(g)) for g in groups]
    districts = views.district_edges(spark)
    table, out = workflows.raster_processing(rasters, meta, districts, views.CRS)
    assert out.bands == ob.STACK_BANDS and 0 < table.count() < 935
    scores, predicted = workflows.data_science(table)
    assert {r["model"] for r in scores.collect()} == {"active", "candidate"}
    assert all(r["r2"] <= 1.0 for r in scores.collect())
    assert {r["fraction_canopy"] for r in predicted.select("fraction_canopy").distinct().collect()} == {0.0}
    figures = workflows.ecosystem_services(table, predicted, districts).collect()
    assert [r["district_id"] for r in sorted(figures, key=lambda r: r["district_id"])] == [1, 2, 3, 4]


def test_raster_in_another_crs_is_moved_onto_the_grid(spark):
    meta = views.pixel_meta(spark, SF_DIR)
    source = grid.target_grid(spark, meta, "EPSG:25833", 100.0).with_bands(("dtm",))
    df = grid.grid_pixels(spark, source).selectExpr("row_id", "col_id", "1000E0 * row_id + col_id AS dtm")
    rasters = [(df, source), (ob.select_bands(views.pixels(spark, SF_DIR, ("lst",)), ("lst",)), meta.with_bands(("lst",)))]
    table, out = workflows.raster_processing(rasters, meta, views.district_edges(spark), views.CRS, names=("dtm", "lst"))
    assert out.crs == views.CRS and table.columns == ["row_id", "col_id", "x", "y", "dtm", "lst"]
    assert table.count() == table.select("row_id", "col_id").distinct().count() > 0


def test_masked_rasters_hold_nothing_outside_their_mask(spark):
    meta = views.pixel_meta(spark, SF_DIR)
    source = grid.target_grid(spark, meta, "EPSG:25833", 100.0).with_bands(("dtm",))
    moved = grid.grid_pixels(spark, source).selectExpr("row_id", "col_id", "1E0 AS dtm")
    x0, y0, x1, y1 = source.bounds
    mid = (y0 + y1) / 2

    def half(low, high):
        corners = [(x0, low), (x1, low), (x1, high), (x0, high)]
        return spark.createDataFrame([(1, *a, *b) for a, b in zip(corners, corners[1:] + corners[:1])], "district_id int, x1 double, y1 double, x2 double, y2 double")

    districts = views.district_edges(spark)
    third = districts.filter("district_id = 3")
    rasters = [(ob.select_bands(views.pixels(spark, SF_DIR, ("lst",)), ("lst",)), meta.with_bands(("lst",))), (moved, source)]
    plain, _ = workflows.raster_processing(rasters, meta, districts, views.CRS, names=("lst", "dtm"))
    all_of_third = spatial.clip_points(plain, third).count()
    for mask, found in ((half(mid, y1), True), (half(y0, mid), False)):
        masked, _ = workflows.raster_processing(rasters, meta, districts, views.CRS, names=("lst", "dtm"), masks=[(third, views.CRS), (mask, "EPSG:25833")])
        assert 0 < masked.count() == all_of_third < plain.count()
        assert masked.where("dtm IS NOT NULL").count() == (all_of_third if found else 0)
