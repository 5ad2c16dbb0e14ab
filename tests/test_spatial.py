"""Containment, masking, rasterising: golden cases, brute force, plan checks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from verdigrid.meta import GridMeta
from verdigrid.operators import spatial

EDGES = "poly_id int, x1 double, y1 double, x2 double, y2 double"
POINTS = "row_id int, col_id int, x double, y double"


def ring(poly, vertices):
    return [(poly, *map(float, a), *map(float, b)) for a, b in zip(vertices, vertices[1:] + vertices[:1])]


def brute_force(points, edges):
    """(row, col, poly) of every point in or on every polygon."""
    out = set()
    for poly in {e[0] for e in edges}:
        own = [e[1:] for e in edges if e[0] == poly]
        for r, c, x, y in points:
            odd = False
            touch = False
            for x1, y1, x2, y2 in own:
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    odd = not odd
                if (
                    (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
                    and min(x1, x2) <= x <= max(x1, x2)
                    and min(y1, y2) <= y <= max(y1, y2)
                ):
                    touch = True
            if odd or touch:
                out.add((r, c, poly))
    return out


def lattice(n, step=1.0, start=-2.0):
    return [(i, j, start + step * j, start + step * i) for i in range(n) for j in range(n)]


def random_layer(seed, polygons=4, span=32, vertices=9):
    """Integer vertices, so that corners, edges and index borders coincide often."""
    rng = random.Random(seed)
    edges = []
    for poly in range(polygons):
        loop = []
        while len(loop) < vertices:
            v = (rng.randint(0, span), rng.randint(0, span))
            if v not in loop[-1:]:
                loop.append(v)
        edges += ring(poly, loop)
    return edges


@pytest.mark.parametrize("seed,cell,crowd", [(1, None, 512), (2, 4.0, 512), (3, 1.0, 512), (4, 8.0, 6), (5, 32.0, 7), (7, 64.0, 5)])
def test_matches_brute_force(spark, seed, cell, crowd):
    edges, points = random_layer(seed), lattice(37)
    p, e = spark.createDataFrame(points, POINTS), spark.createDataFrame(edges, EDGES)
    want = brute_force(points, edges)
    options = dict(polygon=("poly_id",), cell=cell, cell_edges=crowd)
    pairs = [(r["row_id"], r["col_id"], r["poly_id"]) for r in spatial.containment(p, e, how="inner", **options).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == want
    inside = [(r["row_id"], r["col_id"]) for r in spatial.containment(p, e, how="left_semi", **options).collect()]
    assert sorted(inside) == sorted({w[:2] for w in want})
    outside = [(r["row_id"], r["col_id"]) for r in spatial.containment(p, e, how="left_anti", **options).collect()]
    assert sorted(outside) == sorted({q[:2] for q in points} - {w[:2] for w in want})


def test_shuffled_and_salted_form_agrees(spark):
    edges, points = random_layer(7), lattice(37)
    p, e = spark.createDataFrame(points, POINTS), spark.createDataFrame(edges, EDGES)
    got = spatial.containment(p, e, ("poly_id",), broadcast_edges=0)
    assert {(r["row_id"], r["col_id"], r["poly_id"]) for r in got.collect()} == brute_force(points, edges)


LIMITS = [dict(), dict(cell=32.0, cell_edges=6), dict(broadcast_edges=0), dict(cell=16.0, cell_edges=7, broadcast_edges=0)]


@pytest.mark.parametrize("options", LIMITS)
def test_points_need_no_key(spark, options):
    """Repeated keys, absent keys and repeated points give the same at every limit."""
    edges, points = random_layer(9), [(0, 0, x, y) for _, _, x, y in lattice(20, 1.5)] * 2
    e = spark.createDataFrame(edges, EDGES)
    want = brute_force([(i, 0, x, y) for i, (_, _, x, y) in enumerate(points)], edges)
    pairs = sorted((points[i][2], points[i][3], p) for i, _, p in want)
    inside = sorted((points[i][2], points[i][3]) for i in {i for i, _, _ in want})
    same = spark.createDataFrame(points, POINTS)
    for frame in (same, same.select("x", "y")):
        got = spatial.spatial_inner_join(frame, e, ("poly_id",), **options).collect()
        assert sorted((r["x"], r["y"], r["poly_id"]) for r in got) == pairs
        assert sorted((r["x"], r["y"]) for r in spatial.clip_points(frame, e, ("poly_id",), **options).collect()) == inside
        masked = spatial.mask_by_polygons(frame.withColumn("band", F.lit(1.0)), e, ["band"], ("poly_id",), **options).collect()
        assert len(masked) == len(points)
        assert sorted((r["x"], r["y"]) for r in masked if r["band"] is not None) == inside


def star(poly, n, spread):
    """A ring of ``n`` corners about the origin, every second one close to it: all edges meet within a small place."""
    out = []
    for i in range(n):
        far = spread if i % 2 else spread / 256
        out.append((far * math.cos(2 * math.pi * i / n), far * math.sin(2 * math.pi * i / n)))
    return ring(poly, out)


def test_many_edges_in_one_place(spark):
    edges = star(1, 10_000, 50.0) + ring(2, [(-60, -60), (60, -60), (60, 60), (-60, 60)])
    rng = random.Random(4)
    points = [(i, 0, rng.uniform(-1, 1) * 10.0 ** rng.randint(-3, 1), rng.uniform(-1, 1) * 10.0 ** rng.randint(-3, 1)) for i in range(60)]
    e, p = spark.createDataFrame(edges, EDGES), spark.createDataFrame(points, POINTS)
    leaves, tree, depth = spatial.quadtree(e, ("poly_id",), 128.0, len(edges), 256)
    assert tree is not None and depth > 3
    size = leaves.where(F.size("edges") > 0).agg(F.sum(F.size("edges")), F.max(F.size("edges")), F.count("*")).first()
    assert size[1] <= 256
    assert leaves.groupBy("poly_id", "level", "bx", "by").count().where("count > 1").isEmpty()
    got = spatial.spatial_inner_join(p, e, ("poly_id",), cell=128.0, cell_edges=256)
    assert {(r["row_id"], r["col_id"], r["poly_id"]) for r in got.collect()} == brute_force(points, edges)


def test_edges_that_all_meet_end_the_splitting(spark):
    fan = [(i, *map(float, e)) for i in range(40) for e in [(0, 0, 8, i), (8, i, 8, i + 1), (8, i + 1, 0, 0)]]
    points = lattice(12, 0.75, -0.5) + [(99, 0, 0.0, 0.0), (99, 1, 1e-7, 1e-7)]
    e, p = spark.createDataFrame(fan, EDGES), spark.createDataFrame(points, POINTS)
    got = spatial.spatial_inner_join(p, e, ("poly_id",), cell=16.0, cell_edges=8)
    assert {(r["row_id"], r["col_id"], r["poly_id"]) for r in got.collect()} == brute_force(points, fan)


def test_one_join_also_where_cells_are_split(spark):
    e = spark.createDataFrame(random_layer(9), EDGES)
    p = spark.createDataFrame(lattice(37), POINTS).withColumn("band", F.lit(1.0))
    plan = plan_of(spatial.mask_by_polygons(p, e, ["band"], ("poly_id",), cell=16.0, cell_edges=8))
    assert plan.count("Scan ExistingRDD") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hole_overlap_and_boundary(spark):
    outer = ring(1, [(0, 0), (10, 0), (10, 10), (0, 10)])
    hole = ring(1, [(3, 3), (6, 3), (6, 6), (3, 6)])
    other = ring(2, [(5, 5), (12, 5), (12, 12)])
    e = spark.createDataFrame(outer + hole + other, EDGES)
    points = [(0, 0, 0.0, 0.0), (0, 1, 10.0, 10.0), (0, 2, 4.0, 4.0), (0, 3, 3.0, 4.0), (0, 4, 9.0, 8.0), (0, 5, 10.5, 1.0)]
    p = spark.createDataFrame(points, POINTS)
    pairs = {(r["col_id"], r["poly_id"]) for r in spatial.spatial_inner_join(p, e, ("poly_id",)).collect()}
    assert pairs == {(0, 1), (1, 1), (1, 2), (3, 1), (4, 1), (4, 2)}
    assert spatial.clip_points(p, e, ("poly_id",)).count() == 4


def test_mask_keeps_rows(spark):
    e = spark.createDataFrame(ring(1, [(0, 0), (3, 0), (3, 3), (0, 3)]), EDGES)
    p = spark.createDataFrame(lattice(8), POINTS).withColumn("band", F.lit(1.0))
    out = spatial.mask_by_polygons(p, e, ["band"], ("poly_id",))
    assert out.count() == 64
    assert out.filter("band is not null").count() == 16


def test_masked_read_crops_window_and_shifts_grid(spark):
    meta = GridMeta("EPSG:25832", 0.0, 80.0, 10.0, 10.0, 8, 8)
    cells = [(r, c, 10.0 * c + 5, 75.0 - 10.0 * r, 1.0) for r in range(8) for c in range(8)]
    p = spark.createDataFrame(cells, POINTS + ", band double")
    e = spark.createDataFrame(ring(1, [(21, 21), (39, 21), (39, 44), (21, 44)]), EDGES)
    out, cropped = spatial.mask_and_crop(p, meta, e, ["band"], ("poly_id",), edges_crs="EPSG:25832")
    assert (cropped.width, cropped.height, cropped.x0, cropped.y0) == (2, 3, 20.0, 50.0)
    assert cropped.bounds == (20.0, 20.0, 40.0, 50.0)
    rows = {(r["row_id"], r["col_id"]): r["band"] for r in out.collect()}
    assert set(rows) == {(r, c) for r in range(3) for c in range(2)}
    assert {k for k, v in rows.items() if v is None} == {(0, 0), (0, 1)}


def test_clip_raises_on_other_crs(spark):
    e = spark.createDataFrame(ring(1, [(0, 0), (3, 0), (3, 3)]), EDGES)
    p = spark.createDataFrame(lattice(3), POINTS)
    with pytest.raises(ValueError, match="CRS"):
        spatial.clip_points(p, e, ("poly_id",), crs="EPSG:25832", edges_crs="EPSG:25833")


def test_no_nested_loop(spark):
    e = spark.createDataFrame(random_layer(8), EDGES)
    p = spark.createDataFrame(lattice(9), POINTS)
    for how in ("inner", "left_semi", "left_anti"):
        for limit in (0, 20_000):
            plan = plan_of(spatial.containment(p, e, ("poly_id",), how, broadcast_edges=limit))
            assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_large_index_is_not_broadcast(spark, tmp_path):
    """Spark's estimate of an index made by explode is far too low; above the limit neither it nor its tests may be broadcast."""
    spark.createDataFrame(random_layer(8), EDGES).write.parquet(f"{tmp_path}/edges")
    e = spark.read.parquet(f"{tmp_path}/edges")
    p = spark.createDataFrame(lattice(9), POINTS).withColumn("band", F.lit(1.0))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        for how in ("inner", "left_semi", "left_anti"):
            assert "Broadcast" not in plan_of(spatial.containment(p, e, ("poly_id",), how, broadcast_edges=0))
            assert "Broadcast" in plan_of(spatial.containment(p, e, ("poly_id",), how))
        assert "Broadcast" not in plan_of(spatial.mask_by_polygons(p, e, ["band"], ("poly_id",), broadcast_edges=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("seed", [11, 12])
def test_rasterize_equals_containment_of_centres(spark, seed):
    meta = GridMeta("EPSG:25832", -2.0, 34.0, 1.0, 1.0, 36, 36)
    shift = 0.5 if seed % 2 else 0.0  # with half-unit vertices centres lie on edges and corners
    edges = [(p, a + shift, b + shift, c + shift, d + shift) for p, a, b, c, d in random_layer(seed)]
    e = spark.createDataFrame(edges, EDGES)
    got = [(r["row_id"], r["col_id"]) for r in spatial.rasterize_polygons(e, meta, ("poly_id",)).collect()]
    centres = [(r, c, -1.5 + c, 33.5 - r) for r in range(36) for c in range(36)]
    assert len(got) == len(set(got))
    # an oblique edge may pass a centre within rounding of its crossing, never more
    want = {w[:2] for w in brute_force(centres, edges)}
    assert set(got) == want


def test_edges_of_polygons(spark):
    rows = [(1, [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 0.0]], [[1.0, 0.5], [1.5, 0.5], [1.5, 1.0], [1.0, 0.5]]])]
    features = spark.createDataFrame(rows, "poly_id int, rings array<array<array<double>>>")
    edges = spatial.edges_of_polygons(features)
    assert edges.columns == ["poly_id", "x1", "y1", "x2", "y2"]
    assert edges.count() == 6
    assert {tuple(r)[1:] for r in edges.collect()} >= {(0.0, 0.0, 2.0, 0.0), (2.0, 2.0, 0.0, 0.0)}
