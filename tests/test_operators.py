"""Golden cases and properties of the operators besides containment."""

import json
import math
import os
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from verdigrid.functions import utm
from verdigrid.meta import GridMeta
from verdigrid.operators import bands as ob
from verdigrid.operators import gaps, grid, landcover, regression, resample, scenes, series, spatial, stack, warp
from verdigrid.session import within
from verdigrid.sources import features, models, observations, pixels, sql
from verdigrid.sources import scenes as stored_scenes

KEY = "row_id int, col_id int"


def raster(spark, values, name="v"):
    rows = [(r, c, v) for r, line in enumerate(values) for c, v in enumerate(line)]
    return spark.createDataFrame(rows, f"{KEY}, {name} double")


def as_array(df, name="v"):
    got = {(r["row_id"], r["col_id"]): r[name] for r in df.collect()}
    h, w = max(k[0] for k in got) + 1, max(k[1] for k in got) + 1
    assert len(got) == h * w
    return [[got[(r, c)] for c in range(w)] for r in range(h)]


def meta(h, w, size=100.0, crs="EPSG:25832"):
    return GridMeta(crs, 440000.0, 6450000.0, size, size, w, h, ("v",))


# ------------------------------------------------------------ bands and stacks


def test_nodata_and_nan_become_null(spark):
    df = spark.createDataFrame([(0, 0, -9999.0), (0, 1, float("nan")), (0, 2, 1.5)], f"{KEY}, v double")
    out = ob.nodata_to_null(df, ["v"], -9999.0)
    assert [r["v"] for r in out.orderBy("col_id").collect()] == [None, None, 1.5]
    assert ob.valid_pixels(out, "v").count() == 1


def test_set_constant_also_on_missing(spark):
    df = spark.createDataFrame([(0, 0, None), (0, 1, 0.4)], f"{KEY}, v double")
    assert {r["v"] for r in ob.set_constant(df, {"v": 0}).collect()} == {0.0}


def test_stack_checks_grids(spark):
    df = raster(spark, [[1.0, 2.0]])
    good = meta(1, 2)
    other_crs = GridMeta("EPSG:25833", good.x0, good.y0, 100.0, 100.0, 2, 1)
    moved = GridMeta(good.crs, good.x0 + 50, good.y0, 100.0, 100.0, 2, 1)
    for bad, word in ((other_crs, "CRS"), (meta(2, 2), "shape"), (moved, "transform")):
        with pytest.raises(ValueError, match=word):
            stack.stack_bands([(df, good), (df, bad)], ("a", "b"))


def test_stack_is_one_exchange_and_loses_no_pixel(spark):
    a, b = raster(spark, [[1.0, 2.0]]), raster(spark, [[3.0, 4.0], [5.0, 6.0]])
    out, m = stack.stack_bands([(a, meta(2, 2)), (b, meta(2, 2))], ("a", "b"))
    assert out.count() == 4 and m.bands == ("a", "b")
    assert plan_of(out).count("Exchange") <= 1


def test_class_fractions_stay_within_one(spark):
    df = spark.createDataFrame([(i // 4, i % 4, c) for i, c in enumerate([10, 20, 30, 40, 50, 60, 70, 80, 90, 95, 100, 110, 10, 20, 40, 40])], "frow int, fcol int, class int")
    rows = landcover.land_cover_fractions(df, 2).collect()
    for r in rows:
        assert 0.0 <= sum(r[g] for g in ob.CLASS_GROUPS) <= 1.0


# ------------------------------------------------------------ grid and resampling


def test_fishnet_of_published_extent(spark):
    cells = grid.make_grid(spark, (438884.999999274, 6444514.99987627, 443084.999999309, 6447814.9998763), 100.0)
    assert cells.count() == 42 * 33


def test_bilinear_equals_separable_interpolation(spark):
    values = [[1.0, 5.0, 2.0, 8.0], [3.0, 0.0, 7.0, 1.0], [4.0, 4.0, 9.0, 6.0]]
    for factor in (1.0, 2.0, 2.5, 0.5):
        out, m = resample.resample_bilinear(raster(spark, values), meta(3, 4), factor, ["v"])
        h, w = round(3 * factor), round(4 * factor)
        assert (m.height, m.width) == (h, w)
        rp = np.arange(h) * (2 / (h - 1) if h > 1 else 0)
        cp = np.arange(w) * (3 / (w - 1) if w > 1 else 0)
        by_col = np.array([np.interp(cp, range(4), line) for line in values])
        want = np.array([np.interp(rp, range(3), by_col[:, j]) for j in range(w)]).T
        np.testing.assert_allclose(np.array(as_array(out), dtype=float), want, atol=1e-9)


def test_nearest_without_shuffle_and_identity(spark):
    values = [[float(4 * r + c) for c in range(4)] for r in range(3)]
    df = raster(spark, values)
    same, _ = resample.resample_nearest(df, meta(3, 4), 100.0, ["v"])
    assert as_array(same) == values
    finer, m = resample.resample_nearest(df, meta(3, 4), 40.0, ["v"], sparse=True)
    assert (m.height, m.width) == (8, 10)
    got = as_array(finer)
    assert all(got[i][j] == values[min(int((i + 0.5) * 0.4), 2)][min(int((j + 0.5) * 0.4), 3)] for i in range(8) for j in range(10))
    assert "Exchange" not in plan_of(finer)


def test_expand_zone_grows_into_neighbours(spark):
    df = raster(spark, [[5.0, 5.0, 5.0, 5.0], [5.0, 0.0, 5.0, 5.0], [5.0, 5.0, 5.0, None]])
    got = as_array(resample.expand_zone(df, "v"))
    assert got == [[0.0, 0.0, 0.0, 5.0], [0.0, 0.0, 0.0, 5.0], [0.0, 0.0, 0.0, None]]


def test_weighted_block_mean(spark):
    df = raster(spark, [[1.0, 2.0, 3.0]])
    target = GridMeta("EPSG:25832", 440000.0, 6450000.0, 150.0, 100.0, 2, 1)
    got = resample.block_mean_weighted(df, meta(1, 3), target, ["v"]).orderBy("col_id").collect()
    assert [round(r["v"], 9) for r in got] == [round((100 + 2 * 50) / 150, 9), round((2 * 50 + 300) / 150, 9)]


# ------------------------------------------------------------ projection


def test_known_point_and_round_trip(spark):
    df = spark.createDataFrame([(9.0, 60.0), (6.0, 57.5), (12.5, 70.5)], "lon double, lat double")
    back = warp.unproject_points(warp.project_points(df, 32), 32, names=("lon2", "lat2")).collect()
    assert (round(back[0]["x"], 3), round(back[0]["y"], 3)) == (500000.0, 6651411.19)
    for r in back:
        assert abs(r["lon"] - r["lon2"]) < 2e-8 and abs(r["lat"] - r["lat2"]) < 2e-8


def test_reproject_to_same_grid_is_identity_without_shuffle(spark):
    values = [[float(4 * r + c) for c in range(4)] for r in range(3)]
    out, _ = warp.reproject_nearest(raster(spark, values), meta(3, 4), meta(3, 4), ["v"])
    assert as_array(out) == values
    moved, _ = warp.reproject_nearest(raster(spark, values), meta(3, 4), meta(3, 4), ["v"], keep_outside=False)
    assert as_array(moved) == values
    assert "Exchange" not in plan_of(moved)


def test_reproject_covers_target_once(spark):
    source = meta(30, 20)
    target = grid.target_grid(spark, source, "EPSG:25833", 60.0)
    values = [[float(20 * r + c) for c in range(20)] for r in range(30)]
    out, _ = warp.reproject_nearest(raster(spark, values), source, target, ["v"], fill=-1.0)
    keys = [(r["row_id"], r["col_id"]) for r in out.collect()]
    assert len(keys) == len(set(keys)) == target.width * target.height
    assert {r["v"] for r in out.collect()} >= {v for line in values for v in line}


@pytest.mark.parametrize(
    ("source", "crs", "cell"),
    [
        (meta(12, 10), "EPSG:25833", 70.0),
        (GridMeta("EPSG:4258", 8.5, 60.2, 0.02, 0.01, 12, 9), "EPSG:25832", 400.0),
        (meta(12, 10), "EPSG:4258", 0.0007),
    ],
)
def test_reprojection_of_sparse_rasters_and_degrees(spark, source, crs, cell):
    """Every target cell comes out; its value is that of the source cell under its centre, if there is a row."""
    target = grid.target_grid(spark, source, crs, cell)
    rows = [(r, c, float(100 * r + c)) for r in range(source.height) for c in range(source.width) if (r * 7 + c) % 5]
    df = spark.createDataFrame(rows, "row_id int, col_id int, v double")
    out, _ = warp.reproject_nearest(df, source, target, ["v"], fill=-1.0)
    got = {(r["row_id"], r["col_id"]): r["v"] for r in out.collect()}
    assert len(got) == out.count() == target.width * target.height
    centres = spark.createDataFrame(
        [(i, j, target.x0 + target.dx * (j + 0.5), target.y0 - target.dy * (i + 0.5)) for i in range(target.height) for j in range(target.width)],
        "i int, j int, cx double, cy double",
    )
    values = {(r, c): v for r, c, v in rows}
    for p in utm.add_converted(centres, F.col("cx"), F.col("cy"), crs, source.crs, ("sx", "sy")).collect():
        at = (math.floor((source.y0 - p["sy"]) / source.dy), math.floor((p["sx"] - source.x0) / source.dx))
        assert got[p["i"], p["j"]] == values.get(at, -1.0)
    assert sum(v >= 0 for v in got.values()) > 0


def test_malformed_times_raise_unless_asked(spark):
    df = spark.createDataFrame([("2020-07-01T00:00:00Z",), ("soon",), (None,)], "reference_time string")
    with pytest.raises(Exception, match="holds no time"):
        series.parse_time(df).collect()
    assert [r[0] is None for r in series.parse_time(df, strict=False).collect()] == [False, True, True]


def test_period_is_pushed_to_the_scan(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP '2012-12-31 23:59:59' AS reference_time, 1.0D AS value UNION ALL SELECT TIMESTAMP '2013-01-01', 2.0D").write.parquet(f"{tmp_path}/s")
    found = series.observation_period(spark.read.parquet(f"{tmp_path}/s"))
    assert [r["value"] for r in found.collect()] == [2.0]
    assert "GreaterThanOrEqual(reference_time" in plan_of(found)


def test_resampling_of_sparse_rasters_gives_every_cell(spark):
    df = raster(spark, [[float(4 * r + c) for c in range(4)] for r in range(4)]).filter("(row_id + col_id) % 3 > 0")
    near, m = resample.resample_nearest(df, meta(4, 4), 50.0, ["v"])
    got = {(r["row_id"], r["col_id"]): r["v"] for r in near.collect()}
    assert len(got) == near.count() == m.width * m.height == 64
    for (r, c), v in got.items():
        assert v == (None if (r // 2 + c // 2) % 3 == 0 else 4.0 * (r // 2) + c // 2)
    smooth, m = resample.resample_bilinear(df, meta(4, 4), 2.0, ["v"])
    assert smooth.count() == smooth.select(*["row_id", "col_id"]).distinct().count() == m.width * m.height == 64
    for how, args in ((resample.resample_nearest, 50.0), (resample.resample_bilinear, 2.0)):
        assert 0 < how(df, meta(4, 4), args, ["v"], sparse=True)[0].count() < 64


def test_crop_without_overlap_raises(spark):
    with pytest.raises(ValueError, match="do not meet"):
        grid.crop_to_extent(raster(spark, [[1.0]]), meta(1, 1), (0.0, 0.0, 1.0, 1.0))


def test_canopy_covers_the_whole_grid(spark):
    fine = GridMeta("EPSG:25832", 0.0, 40.0, 1.0, 1.0, 40, 40)
    crown = [(1, 1.0, 31.0, 5.0, 31.0), (1, 5.0, 31.0, 5.0, 39.0), (1, 5.0, 39.0, 1.0, 39.0), (1, 1.0, 39.0, 1.0, 31.0)]
    edges = spark.createDataFrame(crown, "crown_id int, x1 double, y1 double, x2 double, y2 double")
    got = {(r["row_id"], r["col_id"]): r["fraction_canopy"] for r in landcover.canopy_fraction(edges, fine, 10).collect()}
    assert len(got) == 16 and got[0, 0] == 0.32 and sum(got.values()) == 0.32


def test_features_copies_count_once_and_bad_lines_raise(spark, tmp_path):
    square = '{"type":"Feature","properties":{},"geometry":{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]]]}}'
    (tmp_path / "good.jsonl").write_text(f"{square}\n{square}\n")
    edges = features.scan_edges(spark, f"{tmp_path}/good.jsonl", line_delimited=True)
    points = spark.createDataFrame([(0, 0, 1.5, 1.5), (0, 1, 9.0, 9.0)], "row_id int, col_id int, x double, y double")
    assert spatial.spatial_semi_join(points, edges, ("feature_id",)).count() == 1
    assert features.scan_features(spark, f"{tmp_path}/good.jsonl", line_delimited=True).count() == 2
    (tmp_path / "bad.jsonl").write_text(f"{square}\n{square[:40]}\n" + '{"type":"Feature","properties":{},"geometry":{"type":"Point","coordinates":[1,2]}}\n')
    with pytest.raises(Exception, match="no polygon feature"):
        features.scan_features(spark, f"{tmp_path}/bad.jsonl", line_delimited=True).collect()
    assert features.scan_features(spark, f"{tmp_path}/bad.jsonl", line_delimited=True, strict=False).where("reject IS NOT NULL").count() == 2


def test_masked_load_of_a_stored_raster(spark, tmp_path):
    values = [[float(10 * r + c) for c in range(8)] for r in range(8)]
    whole = GridMeta("EPSG:25832", 0.0, 80.0, 10.0, 10.0, 8, 8, ("v",))
    pixels.write_pixels(raster(spark, values), whole, f"{tmp_path}/r")
    corners = [(21.0, 21.0), (39.0, 21.0), (39.0, 44.0), (21.0, 44.0)]
    edges = spark.createDataFrame([(1, *a, *b) for a, b in zip(corners, corners[1:] + corners[:1])], "district_id int, x1 double, y1 double, x2 double, y2 double")
    df, window = pixels.read_raster(spark, f"{tmp_path}/r", mask=edges, mask_crs="EPSG:25832")
    assert plan_of(df).count("FileScan") == 1
    got = {(r["row_id"], r["col_id"]): r["v"] for r in df.collect()}
    assert (window.width, window.height, window.x0, window.y0) == (2, 3, 20.0, 50.0)
    assert got == {(0, 0): None, (0, 1): None, (1, 0): 42.0, (1, 1): 43.0, (2, 0): 52.0, (2, 1): 53.0}


def test_broadcast_is_bounded_by_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 20, "a string")
    assert within(df, 20) and not within(df, 19) and not within(df, 20, size=10_000)


def test_unknown_crs_raises():
    with pytest.raises(ValueError):
        utm.zone_of("EPSG:4326")


@pytest.mark.parametrize("tile", [1, 2, 3, 256])
@pytest.mark.parametrize("factor", [0.5, 1.7])
def test_bilinear_is_the_same_for_all_tiles(spark, monkeypatch, tile, factor):
    monkeypatch.setattr(resample, "TILE", tile)
    rng = np.random.default_rng(3)
    values = rng.random((7, 5))
    out, m = resample.resample_bilinear(raster(spark, values.tolist()), meta(7, 5), factor, ["v"])
    rows, cols = np.linspace(0, 6, m.height), np.linspace(0, 4, m.width)
    part = np.array([[np.interp(c, range(5), line) for c in cols] for line in values])
    want = np.array([np.interp(rows, range(7), part[:, j]) for j in range(len(cols))]).T
    assert np.allclose(np.array(as_array(out)), want)


def test_bilinear_shuffles_each_cell_once_but_for_tile_borders(spark):
    df = grid.grid_pixels(spark, meta(300, 600)).withColumn("v", F.col("row_id") * 1.0)
    out, _ = resample.resample_bilinear(df, meta(300, 600), 2.0, ["v"], sparse=True)
    assert plan_of(out).count("Exchange") == 1
    assert "hashpartitioning(_tr" in plan_of(out)


def test_absent_cells(spark):
    rng = np.random.default_rng(9)
    for height, width in ((1, 1), (3, 64), (2, 65), (4, 200)):
        held = {(int(r), int(c)) for r, c in zip(rng.integers(0, height, 90), rng.integers(0, width, 90))}
        rows = spark.createDataFrame([*held, *list(held)[:3], (-1, 0), (height, 0), (0, width)], KEY)
        got = [tuple(r) for r in grid.absent_cells(rows, meta(height, width)).collect()]
        assert sorted(got) == sorted({(r, c) for r in range(height) for c in range(width)} - held)


def test_reprojection_shuffles_no_band(spark):
    df = raster(spark, [[1.0, 2.0], [3.0, 4.0]]).withColumn("much", F.lit(7.0))
    out, _ = warp.reproject_nearest(df, meta(2, 2), meta(2, 2), ["v", "much"])
    for line in plan_of(out).splitlines():
        if "Exchange" in line:
            assert "id#" in line and "v#" not in line and "much" not in line


# ------------------------------------------------------------ gaps


@pytest.mark.parametrize("block,group", [(2, 256), (3, 1), (3, 2), (64, 4)])
def test_interpolation_equals_pandas(spark, monkeypatch, block, group):
    monkeypatch.setattr(gaps, "GROUP", group)
    rng = np.random.default_rng(block)
    rows = [(r, c, None if rng.random() < 0.5 else float(rng.random())) for r in range(9) for c in range(7) if rng.random() < 0.8]
    rows = [(r, c, None if r == 0 or r == 8 else v) for r, c, v in rows]
    df = spark.createDataFrame(rows, f"{KEY}, v double")
    got = {(r["row_id"], r["col_id"]): r["v"] for r in gaps.interpolate_linear(df, ["v"], block=block).collect()}
    want = pd.Series([v for *_, v in rows], dtype=float).interpolate()
    for (r, c, _), w in zip(rows, want):
        assert (got[(r, c)] is None) if math.isnan(w) else abs(got[(r, c)] - w) < 1e-12
    indexed = gaps.row_index(df, block=block).orderBy("row_id", "col_id").collect()
    assert [r["index"] for r in indexed] == list(range(len(rows)))


def test_interpolation_by_row_does_not_cross_rows(spark):
    df = raster(spark, [[1.0, None, 3.0], [None, 5.0, None]])
    got = as_array(gaps.interpolate_linear(df, ["v"], by_row=True))
    assert got == [[1.0, 2.0, 3.0], [None, 5.0, 5.0]]


def test_source_is_read_once_and_only_the_group_summary_meets_in_one_task(spark, monkeypatch):
    df = raster(spark, [[1.0, None], [3.0, 4.0]])
    plans, real = [], gaps.materialise
    monkeypatch.setattr(gaps, "materialise", lambda frame, label: (plans.append(plan_of(frame)), real(frame, label))[1])
    last = plan_of(gaps.interpolate_linear(df, ["v"]).select("v"))
    placed, carried = plans
    assert placed.count("Scan ExistingRDD") == 1 and placed.count("Exchange") == 1
    assert "ExistingRDD" not in carried + last and "SinglePartition" not in placed + last
    lines = carried.splitlines()
    single = [i for i, line in enumerate(lines) if re.search(r"hashpartitioning\(_line#\d+L?, \d+\)", line)]
    assert len(single) == 1 and re.search(r"Aggregate\(keys?=\[_line#\d+L?, _g#", lines[single[0] + 1])


# ------------------------------------------------------------ regression


def sample(spark, n=400):
    rng = np.random.default_rng(5)
    x = rng.random((n, 3))
    y = 3.0 + x @ np.array([1.5, -2.0, 0.25]) + rng.normal(0, 0.1, n)
    rows = [(i // 20, i % 20, *map(float, x[i]), float(y[i])) for i in range(n)]
    return x, y, spark.createDataFrame(rows, f"{KEY}, a double, b double, c double, lst double")


def test_split_is_exact_disjoint_repeatable(spark):
    _, _, df = sample(spark, 397)
    fit, test = regression.split_rows(df, 3)
    a, b = ({tuple(r) for r in part.select("row_id", "col_id").collect()} for part in (fit, test))
    assert len(b) == math.ceil(0.2 * 397) and not a & b and len(a | b) == 397
    again = regression.split_rows(df.repartition(5), 3)[1]
    assert {tuple(r) for r in again.select("row_id", "col_id").collect()} == b
    assert {tuple(r) for r in regression.split_rows(df, 8)[1].select("row_id", "col_id").collect()} != b
    assert "Exchange" not in plan_of(fit) and "Sort" not in plan_of(fit)


def test_split_narrows_down_large_bins(spark, monkeypatch):
    monkeypatch.setattr(regression, "_SMALL_BIN", 1)
    monkeypatch.setattr(regression, "_DIGITS", 1)
    _, _, df = sample(spark, 100)
    assert regression.split_rows(df, 3)[1].count() == 20


def test_fit_against_numpy_and_residuals(spark):
    x, y, df = sample(spark)
    want = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)[0]
    for solver in ("moments", "mllib"):
        model = regression.fit_ols(df, ["a", "b", "c"], solver=solver)
        np.testing.assert_allclose([model.intercept, *model.coefficients.values()], want, atol=1e-8)
    residual = F.col("lst") - F.col("predicted_lst")
    row = regression.predict(df, regression.fit_ols(df, ["a", "b", "c"])).agg(
        *[F.sum(residual * F.col(n)) for n in ("a", "b", "c")], F.sum(residual)
    ).first()
    assert max(map(abs, row)) < 1e-8


def test_collinear_features_get_minimum_norm(spark):
    _, _, df = sample(spark)
    model = regression.fit_ols(df.withColumn("d", F.col("a")).withColumn("k", F.lit(1.0)), ["a", "d", "k"])
    assert abs(model.coefficients["a"] - model.coefficients["d"]) < 1e-8 and model.coefficients["k"] == 0.0


def test_r_squared(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.5), (4.0, 3.5)], "lst double, predicted_lst double")
    mean = 7 / 3
    want = 1 - 0.5 / sum((v - mean) ** 2 for v in (1, 2, 4))
    assert abs(regression.r_squared(df).first()["r2"] - want) < 1e-12


# ------------------------------------------------------------ series and scenes


def test_top_k_limits_before_the_exchange(spark):
    df = spark.createDataFrame([("a", i, float(i % 4)) for i in range(20)], "source_id string, reference_time int, value double")
    top = series.top_k_per_station(df, 3)
    assert [(r["value"], r["reference_time"]) for r in top.orderBy("rank").collect()] == [(3.0, 3), (3.0, 7), (3.0, 11)]
    assert "WindowGroupLimit" in plan_of(top)


def test_composite_ignores_scene_order(spark):
    df = spark.createDataFrame([(p, d, float((p * 7 + d * 3) % 5)) for p in range(4) for d in range(6)], "pixel_id int, scene_date int, v double")
    a = scenes.max_composite(df, ["v"]).orderBy("pixel_id").collect()
    assert a == scenes.max_composite(df.orderBy(F.desc("scene_date")), ["v"]).orderBy("pixel_id").collect()


# ------------------------------------------------------------ sources and sinks


def test_pixels_round_trip_and_name_check(spark, tmp_path):
    df, m = raster(spark, [[1.0, None], [3.0, 4.0]]), meta(2, 2)
    with pytest.raises(ValueError, match="band names"):
        pixels.write_pixels(df, m.with_bands(("other",)), str(tmp_path / "bad"))
    pixels.write_pixels(df, m, str(tmp_path / "ok"))
    back, m2 = pixels.read_raster(spark, str(tmp_path / "ok"))
    assert as_array(back) == [[1.0, None], [3.0, 4.0]] and m2 == m


def test_geojson_collection_with_multipolygon(spark, tmp_path):
    square = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "p"}, "geometry": {"type": "Polygon", "coordinates": [square]}},
        {"type": "Feature", "properties": {"name": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [square, square]]}},
    ]}
    path = tmp_path / "layer.geojson"
    path.write_text(json.dumps(doc, indent=1))
    edges = features.scan_edges(spark, str(path), "name string")
    assert {r["name"]: r["count"] for r in edges.groupBy("name").count().collect()} == {"p": 3, "m": 9}


def test_nested_service_answer(spark, tmp_path):
    doc = {"data": [{"sourceId": "SN1:0", "referenceTime": "2018-06-01T00:00:00.000Z", "observations": [
        {"elementId": "t", "value": 18.8, "unit": "degC", "timeOffset": "PT0H"}]}]}
    (tmp_path / "answer.json").write_text(json.dumps(doc, indent=1))
    flat = series.parse_time(series.flatten_observations(observations.scan_response(spark, str(tmp_path / "answer.json"))))
    row = series.summer_filter(flat).first()
    assert (row["source_id"], row["value"], row["reference_time"].year) == ("SN1:0", 18.8, 2018)


def test_table_sink_refuses_existing_table(spark, tmp_path):
    sql.sql_table_sink(spark, "SELECT 1 AS a", "sink_once", str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)already exists"):
        sql.sql_table_sink(spark, "SELECT 2 AS a", "sink_once", str(tmp_path / "t"))
    spark.sql("DROP TABLE sink_once")


def test_newest_model_wins(spark, tmp_path):
    one, two = regression.OlsModel(1.0, {"a": 2.0}), regression.OlsModel(3.0, {"a": 4.0})
    models.save_model(spark, two, str(tmp_path / "m"), "2024-02-01")
    models.save_model(spark, one, str(tmp_path / "m"), "2024-01-01")
    assert models.load_model(spark, str(tmp_path / "m")) == two
    assert models.load_model(spark, str(tmp_path / "m"), "2024-01-01") == one


def test_features_that_share_an_id_lose_nothing(spark, tmp_path):
    square = lambda x: [[[x, 0.0], [x + 1, 0.0], [x + 1, 1.0], [x, 1.0], [x, 0.0]]]
    feature = lambda i, x: json.dumps({"type": "Feature", "id": i, "properties": {"name": "n"}, "geometry": {"type": "Polygon", "coordinates": square(x)}})
    (tmp_path / "same.jsonl").write_text("\n".join([feature("7", 0.0), feature("7", 5.0), feature("7", 0.0), feature("8", 9.0)]))
    edges = features.scan_edges(spark, f"{tmp_path}/same.jsonl", "name string", line_delimited=True)
    assert edges.count() == 12 and edges.select("feature_id").distinct().count() == 3
    points = spark.createDataFrame([(0.5, 0.5), (5.5, 0.5), (9.5, 0.5), (3.0, 0.5)], "x double, y double")
    assert spatial.spatial_inner_join(points, edges, ("feature_id",)).count() == 3


PERIOD = """
import sys
from collections import Counter
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from verdigrid.operators import series
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
for kind in ("timestamp", "timestamp_ntz"):
    rows = spark.sql("SELECT CAST(t AS " + kind + ") AS reference_time FROM VALUES ('2012-12-31 23:30:00'), ('2013-01-01 00:00:00') v(t)")
    assert [str(r[0]) for r in series.observation_period(rows).selectExpr("CAST(reference_time AS string)").collect()] == ["2013-01-01 00:00:00"], kind
"""


def test_period_starts_in_the_session_zone(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", PERIOD.format(root=root)], env={**os.environ, "TZ": "Europe/Oslo"}, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_stored_scenes_read_only_the_days_of_the_period(spark, tmp_path):
    rows = [(p, f"2024-01-{d:02d} {h:02d}:30:00", d % 2, float(d * p)) for p in range(6) for d in range(1, 29) for h in (0, 23)] + [(7, None, 0, 1.0)]
    df = spark.createDataFrame(rows, "pixel_id int, t string, satellite int, value double").selectExpr("pixel_id", "CAST(t AS timestamp) AS scene_date", "satellite", "value")
    path = f"{tmp_path}/scenes"
    stored_scenes.write_scenes(df, path)
    chosen = stored_scenes.scan_scenes(spark, path, "2024-01-10", "2024-01-12 12:00:00")
    plan = plan_of(chosen)
    assert "PartitionFilters: [isnotnull(scene_day" in plan and len(chosen.inputFiles()) > 0
    read = {r[0] for r in chosen.selectExpr("regexp_extract(input_file_name(), 'scene_day=([^/]*)', 1)").distinct().collect()}
    assert read == {"2024-01-10", "2024-01-11", "2024-01-12"}
    want = scenes.date_range(df, "2024-01-10", "2024-01-12 12:00:00")
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, want.collect())) != []
    assert stored_scenes.scan_scenes(spark, path).count() == len(rows)
    assert stored_scenes.scan_scenes(spark, path, satellite=1).count() == sum(r[2] == 1 for r in rows)
    with pytest.raises(ValueError):
        stored_scenes.write_scenes(df.withColumn("scene_day", F.lit(1)), path)


def test_absent_cells_are_dealt_by_the_size_of_the_grid(spark, monkeypatch):
    """By their bytes the runs fit one task, whatever number of cells they grow to."""
    m = meta(300, 70)
    rows = spark.createDataFrame([(0, 0), (5, 69), (299, 1)], "row_id int, col_id int")
    want = {(r, c) for r in range(300) for c in range(70)} - {(0, 0), (5, 69), (299, 1)}
    for runs in (1 << 17, 60):
        monkeypatch.setattr("verdigrid.operators.grid.TASK_RUNS", runs)
        found = grid.absent_cells(rows, m).withColumn("task", F.spark_partition_id()).collect()
        assert len(found) == len(want) and {(r["row_id"], r["col_id"]) for r in found} == want
    counts = Counter(r["task"] for r in found)
    assert len(counts) > 5 and max(counts.values()) < len(found) / 3
