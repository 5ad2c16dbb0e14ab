"""Stored rasters: footers answer for sizes, tiles are stacked where they lie; merged crown spans."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from verdigrid.meta import GridMeta
from verdigrid.operators import landcover, spatial, stack
from verdigrid.sources import pixels

META = GridMeta("EPSG:25832", 100.0, 900.0, 1.0, 1.0, 300, 270, ("a",))


def raster(spark, band, keep):
    cells = spark.range(300 * 270).select(F.expr("cast(id div 300 as int)").alias("row_id"), F.expr("cast(id % 300 as int)").alias("col_id"))
    return cells.where(keep).withColumn(band, F.col("row_id") * 1000.0 + F.col("col_id"))


def test_footers_answer_for_size_and_extent(spark, tmp_path):
    path = str(tmp_path / "r")
    pixels.write_pixels(raster(spark, "a", "row_id BETWEEN 3 AND 200 AND col_id > 6"), META, path)
    size = pixels.stored_size(spark, path)
    assert "PushedAggregation: [COUNT(*), MAX(row_id), MAX(col_id)]" in plan_of(size)
    assert tuple(size.first()) == (198 * 293, 201, 300, 1)
    ends = pixels.stored_extent(spark, path)
    pushed = plan_of(ends).split("PushedAggregation: [")[1].split("]")[0].split(", ")
    assert sorted(pushed) == ["MAX(col_id)", "MAX(row_id)", "MIN(col_id)", "MIN(row_id)"]
    assert tuple(ends.first()) == (107.5, 699.5, 399.5, 896.5)
    assert spark.conf.get("spark.sql.sources.useV1SourceList").find("parquet") >= 0


def test_an_empty_raster_has_no_extent(spark, tmp_path):
    path = str(tmp_path / "r")
    pixels.write_pixels(raster(spark, "a", "row_id < 0"), META, path)
    assert tuple(pixels.stored_size(spark, path).first())[:1] == (0,)
    assert tuple(pixels.stored_extent(spark, path).first()) == (None, None, None, None)


def test_tiles_are_stacked_where_they_lie(spark):
    parts = [("a", "true"), ("b", "row_id % 2 = 0"), ("c", "col_id > 280 AND row_id > 250")]
    rasters = [(raster(spark, band, f"({keep}) AND row_id <> 7"), META.with_bands([band])) for band, keep in parts]
    names, tables = ["x", "y", "z"], []
    for df, meta in rasters:
        tables.append(f"tiles_{uuid.uuid4().hex}")
        pixels.write_tiles(df, meta, tables[-1], 3)
    stacked, meta = pixels.stack_tiles(spark, tables, names)
    plan = plan_of(stacked)
    assert plan.count("SortMergeJoin") == 3 and plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    want = stack.stack_bands(rasters, names)[0]
    assert meta.bands == tuple(names) and stacked.count() == 269 * 300
    assert sorted(map(str, stacked.collect())) == sorted(map(str, want.collect()))
    for table in tables:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"DROP TABLE {table}_meta")


def test_tiles_need_one_grid_and_matching_names(spark):
    tables = []
    for meta in (META, META.window(0, 100, 0, 100)):
        tables.append(f"tiles_{uuid.uuid4().hex}")
        pixels.write_tiles(raster(spark, "a", "row_id < 2"), meta, tables[-1], 2)
    with pytest.raises(ValueError):
        pixels.stack_tiles(spark, tables, ["a", "b"])
    with pytest.raises(ValueError):
        pixels.stack_tiles(spark, tables[:1], ["a", "b"])
    for table in tables:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"DROP TABLE {table}_meta")


@pytest.mark.parametrize("strip", [8, 4096])
def test_spans_are_disjoint_and_cover_the_same_cells(spark, strip, monkeypatch):
    monkeypatch.setattr(spatial, "STRIP", strip)
    rng, boxes = random.Random(strip), []
    for i in range(40):
        x, y, w, h = rng.uniform(0, 50), rng.uniform(0, 30), rng.uniform(0.1, 30), rng.uniform(0.1, 8)
        boxes.append((i, x, y, x + w, y + h))
    rows = [(i, *e) for i, a, b, c, d in boxes for e in ((a, b, c, b), (c, b, c, d), (c, d, a, d), (a, d, a, b))]
    edges = spark.createDataFrame(rows, "crown_id long, x1 double, y1 double, x2 double, y2 double")
    fine = GridMeta("EPSG:25832", 0.0, 40.0, 0.5, 0.5, 120, 80)
    want = {
        (r, c) for r in range(80) for c in range(120)
        if any(a <= 0.5 * (c + 0.5) <= x and b <= 40 - 0.5 * (r + 0.5) <= y for _, a, b, x, y in boxes)
    }
    got = [(s["row_id"], c) for s in spatial.covered_spans(edges, fine).collect() for c in range(s["from_col"], s["to_col"] + 1)]
    assert len(got) == len(set(got)) and set(got) == want
    share = {(r["row_id"], r["col_id"]): r["fraction_canopy"] for r in landcover.canopy_fraction(edges, fine, 7).collect()}
    for (r, c), value in share.items():
        n = sum((i, j) in want for i in range(7 * r, 7 * r + 7) for j in range(7 * c, 7 * c + 7))
        assert abs(value - n / 49) < 1e-12
