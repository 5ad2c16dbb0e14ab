"""Containment of points in polygons, and what is built on it.

Polygons are edge rows ``(<polygon columns>, x1, y1, x2, y2)`` of closed rings, so a polygon of any
size is spread over many rows. Boundary points count as inside; holes follow from the even-odd rule.

The join works on a quadtree over the layer: square cells that are split in four while more than
``CELL_EDGES`` edges pass through them. Its leaves are the index, one row per polygon and leaf it
touches or covers:

* ``base`` is the parity that holds for the whole cell, and ``edges`` are the edges that pass through
  it. A point only tests the edges of its own leaf; a leaf that lies inside needs no test at all.
* For a point in a cell with right border X, the ray to the right is cut at X. Beyond X the parity
  depends only on edges with exactly one end right of X (all others pair up at shared vertices): such
  an edge adds 1 to points below the place where it meets X. If that place is in another row of cells
  the edge is constant for this cell and is summed into ``base``; else the edge carries ``y_right``, the
  height of its right end, and the test decides (``functions.geometry.inside_cell``).
* The size of the undivided cells is a power of two, so cell numbers and borders are exact in floating
  point. It follows from the layer itself so that the index has a row count linear in the number of edges.
* A point finds its leaf by one look at the tree of its undivided cell, a list of the cells that are
  split. So it meets the index in one equi-join, whatever the layer; no key of the points is needed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdigrid.functions import affine
from verdigrid.functions.geometry import inside_cell, ring_edges
from verdigrid.meta import GridMeta, require_same_crs
from verdigrid.operators.grid import bounds_of, crop_to_extent, layer_bounds
from verdigrid.session import broadcast_within, materialise

EDGE = ("x1", "y1", "x2", "y2")
BROADCAST_EDGES = 100_000  # about 16 index entries per edge at most, see ``layer_summary``: below 100 MB
#: Cells with more edges are split in four.
CELL_EDGES = 512
#: Times that a cell is split at most, and the least size: what is still crowded then is a point where many edges meet.
DEPTH = 16
LEAST_CELL = 2.0**-20
#: Index rows per edge that the own choice of the cell size stays below.
INDEX_ROWS = 16
#: Columns of a raster row that are swept together.
STRIP = 4096
SALTS = 8


def edges_of_polygons(features: DataFrame, rings: str = "rings") -> DataFrame:
    """Feature rows with ``rings array<array<array<double>>>`` to one row per edge."""
    keep = [c for c in features.columns if c != rings]
    return (
        features.withColumn("_ring", F.explode(rings))
        .select(*keep, F.inline(ring_edges(F.col("_ring"))))
    )


# ---------------------------------------------------------------- index


def layer_summary(edges: DataFrame, polygon: Sequence[str]) -> tuple[int, float, tuple[float, float, float, float] | None]:
    """Number of edges, cell size (a power of two) and bounds of a polygon layer, read once.

    The size is the larger of two bounds: about four cells per edge over the polygons' bounding
    boxes, and cells no smaller than an eighth of the mean edge extent. Both keep the index linear.
    """
    boxes = edges.groupBy(*polygon).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1"))).alias("reach"),
        F.min(F.least("x1", "x2")).alias("left"), F.min(F.least("y1", "y2")).alias("bottom"),
        F.max(F.greatest("x1", "x2")).alias("right"), F.max(F.greatest("y1", "y2")).alias("top"),
    )
    area = (F.col("right") - F.col("left")) * (F.col("top") - F.col("bottom"))
    row = boxes.agg(
        F.sum("n").alias("n"), F.sum("reach").alias("r"), F.sum(area).alias("a"),
        F.min("left").alias("left"), F.min("bottom").alias("bottom"), F.max("right").alias("right"), F.max("top").alias("top"),
    ).first()
    n = row["n"] or 0
    if n == 0:
        return 0, 1.0, None
    wanted = max(math.sqrt(row["a"] / (4.0 * n)), row["r"] / (8.0 * n), 2.0**-10)
    return n, 2.0 ** math.ceil(math.log2(wanted)), (row["left"], row["bottom"], row["right"], row["top"])


def _cell_number(value, cell: float):
    return F.floor(value / F.lit(cell)).cast("long")


def _near_edges(edges: DataFrame, polygon: Sequence[str], cell: float, columns: DataFrame | None = None) -> DataFrame:
    """One row per edge and index cell it passes through (closed, with a hair of slack).

    With ``columns (bx, rows)`` only the cells in the listed rows of the listed columns, and of every edge in such a column the
    first cell, which shapes the parity of the cells below.
    """
    lo_x, hi_x = F.least("x1", "x2"), F.greatest("x1", "x2")
    lo_y, hi_y = F.least("y1", "y2"), F.greatest("y1", "y2")
    by_col = edges.select(
        *polygon, *EDGE,
        F.explode(
            F.sequence(
                F.ceil(lo_x / F.lit(cell)).cast("long") - F.lit(1).cast("long"), _cell_number(hi_x, cell)
            )
        ).alias("bx"),
    )
    if columns is not None:
        by_col = by_col.join(columns, "bx")
    left, right = F.col("bx") * F.lit(cell), (F.col("bx") + F.lit(1)) * F.lit(cell)

    def height_at(border):
        x = F.least(F.greatest(border, lo_x), hi_x)
        slope = (F.col("y2") - F.col("y1")) / F.nullif(F.col("x2") - F.col("x1"), F.lit(0.0))
        return F.col("y1") + slope * (x - F.col("x1"))

    slack = F.lit(max(cell * 1e-6, 1e-8))
    # an upright edge has no slope: it fills its whole height range
    y_a, y_b = F.coalesce(height_at(left), lo_y), F.coalesce(height_at(right), hi_y)
    by_row = by_col.withColumns(
        {
            "_mixed": (F.col("x1") > right) != (F.col("x2") > right),
            "_first": _cell_number(F.greatest(F.least(y_a, y_b), lo_y) - slack, cell),
            "_last": _cell_number(F.least(F.greatest(y_a, y_b), hi_y) + slack, cell),
        }
    )
    if columns is None:
        by_row = by_row.withColumn("by", F.explode(F.sequence("_first", "_last")))
    else:
        passed = F.filter("rows", lambda r: r.between(F.col("_first"), F.col("_last")))
        by_row = by_row.withColumn("by", F.explode(F.array_union(F.array("_first"), passed)))
    return by_row.select(
        *polygon, "bx", "by", *EDGE,
        F.when(F.col("_mixed"), F.when(F.col("x1") > right, F.col("y1")).otherwise(F.col("y2"))).alias("y_right"),
        (F.col("_mixed") & (F.col("by") == F.col("_first"))).cast("long").alias("_starts"),
    )


def _leaves(near: DataFrame, polygon: Sequence[str], crowded: DataFrame | None, columns: DataFrame | None) -> DataFrame:
    """Rows ``(<polygon>, bx, by, base, edges)`` of one level: the cells a polygon touches or covers that are not split further.

    ``base`` of a cell is the parity of the edges that start above it in its column; cells between two listed ones have that of the upper. The
    window holds the cells of one column of one polygon, bounded by the cell size rule.
    """
    listed = near
    own = F.lit(True)
    if columns is not None:
        listed = listed.join(columns, "bx")
        own = own & F.array_contains("rows", F.col("by"))
    if crowded is not None:
        listed = listed.join(crowded.withColumn("_split", F.lit(True)), ["bx", "by"], "left")
        own = own & F.col("_split").isNull()
    rows = [F.first("rows").alias("rows")] if columns is not None else []
    listed = listed.withColumn("_own", own)
    grouped = listed.groupBy(*polygon, "bx", "by").agg(
        F.collect_list(F.when(F.col("_own"), F.struct(*EDGE, "y_right"))).alias("edges"),
        F.sum("_starts").alias("_starts"), F.first("_own").alias("_own"), *rows,
    )
    column = Window.partitionBy(*polygon, "bx").orderBy(F.desc("by"))
    above = F.coalesce(F.sum("_starts").over(column.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    full = grouped.withColumns({"_above": above, "_next": F.lead("by").over(column)})
    gap = (F.col("_above") + F.col("_starts")) % 2 == 1
    if columns is None:
        below = F.when(gap & (F.col("_next") + 1 < F.col("by")), F.sequence(F.col("_next") + 1, F.col("by") - 1))
    else:
        below = F.when(gap, F.filter("rows", lambda r: (r > F.col("_next")) & (r < F.col("by"))))
    nothing = F.filter(F.col("edges"), lambda e: F.lit(False))
    mine = F.struct(F.col("by").alias("by"), (F.col("_above") % 2 == 1).alias("base"), F.col("edges").alias("edges"))
    touched = F.filter(F.array(mine), lambda e: F.col("_own"))
    covered = F.transform(
        F.coalesce(below, F.expr("array_repeat(0L, 0)")),
        lambda r: F.struct(r.alias("by"), F.lit(True).alias("base"), nothing.alias("edges")),
    )
    leaves = full.select(*polygon, "bx", F.inline(F.concat(touched, covered)))
    return leaves if crowded is None else leaves.join(crowded, ["bx", "by"], "left_anti").select(*leaves.columns)


def quadtree(
    edges: DataFrame, polygon: Sequence[str], cell: float, n_edges: int, cell_edges: int = CELL_EDGES
) -> tuple[DataFrame, DataFrame | None, int]:
    """The leaves ``(<polygon>, level, bx, by, base, edges)``, the split cells as ``(bx, by, tree)`` and the depth.

    ``level`` 0 are cells of size ``cell``; each level halves it. Only the columns of cells that are split are looked at again, in the rows of these
    cells. ``tree`` lists the codes (``_code``) of all split cells within an undivided one. Without a crowded cell there is no tree.
    """
    near, columns, leaves, splits, level = _near_edges(edges, polygon, cell), None, [], [], 0
    while True:
        crowded = None
        if n_edges > cell_edges and level < DEPTH and cell / 2 >= LEAST_CELL:
            inside = near if columns is None else near.join(columns, "bx").where(F.array_contains("rows", F.col("by")))
            counts = inside.groupBy("bx", "by").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cell_edges)
            crowded = materialise(counts.select("bx", "by"), "crowded-cells")
            n_crowded = crowded.count()
            small = F.broadcast if n_crowded <= BROADCAST_EDGES else lambda df: df.hint("merge")  # also bounds what follows from it: two columns, four rows each
            crowded = small(crowded) if n_crowded else None
        leaves.append(_leaves(near, polygon, crowded, columns).select(*polygon, F.lit(level).alias("level"), "bx", "by", "base", "edges"))
        if crowded is None:
            break
        splits.append(crowded.select(F.lit(level).alias("level"), "bx", "by"))
        halves = F.array(F.col("by") * 2, F.col("by") * 2 + 1)
        parents = crowded.groupBy("bx").agg(F.flatten(F.collect_list(halves)).alias("rows"))
        columns = parents.select(F.explode(F.array(F.col("bx") * 2, F.col("bx") * 2 + 1)).alias("bx"), "rows")
        columns = small(columns)
        cell, level = cell / 2, level + 1
        near = _near_edges(edges, polygon, cell, columns)
    index = leaves[0]
    for more in leaves[1:]:
        index = index.unionByName(more)
    if not splits:
        return index, None, 0
    cells = splits[0]
    for more in splits[1:]:
        cells = cells.unionByName(more)
    root = [F.call_function("shiftright", F.col(c), F.col("level")) for c in ("bx", "by")]
    code = _code(F.col("level"), F.col("bx"), F.col("by"), *root)
    tree = cells.select(root[0].alias("_rx"), root[1].alias("_ry"), code.alias("_node")).groupBy("_rx", "_ry").agg(F.collect_list("_node").alias("_tree"))
    return materialise(index, "quadtree"), tree, level


def _code(level, bx, by, rx, ry):
    """A number for a cell within its undivided cell ``(rx, ry)``: a leading one, then its column and row there."""
    def moved(value, bits):
        return F.call_function("shiftleft", value, bits)

    one = F.lit(1).cast("long")
    return moved(one, 2 * level) + moved(bx - moved(rx, level), level) + (by - moved(ry, level))


# ---------------------------------------------------------------- join


def _within(bounds: tuple[float, float, float, float], x: str, y: str):
    """Literal ranges of the coordinates, which reach the scan."""
    return F.col(x).between(bounds[0], bounds[2]) & F.col(y).between(bounds[1], bounds[3])


def _located(points: DataFrame, tree: DataFrame | None, depth: int, cell: float, x: str, y: str) -> DataFrame:
    """``points`` with the leaf ``_pl, _px, _py`` each lies in. Without split cells nothing is joined."""
    points = points.withColumns({"_px": _cell_number(F.col(x), cell), "_py": _cell_number(F.col(y), cell)})
    if tree is None:
        return points.withColumn("_pl", F.lit(0))
    points = points.join(broadcast_within(tree), (F.col("_px") == F.col("_rx")) & (F.col("_py") == F.col("_ry")), "left")
    level = F.lit(0)
    for deep in range(depth):
        part = cell / 2**deep
        code = _code(F.lit(deep), _cell_number(F.col(x), part), _cell_number(F.col(y), part), F.col("_px"), F.col("_py"))
        level = level + F.array_contains("_tree", code).cast("int")
    size = F.lit(cell) / F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_pl"))
    return points.withColumn("_pl", F.coalesce(level, F.lit(0))).withColumns(
        {"_px": F.floor(F.col(x) / size).cast("long"), "_py": F.floor(F.col(y) / size).cast("long")}
    ).drop("_rx", "_ry", "_tree")


def _matched(points: DataFrame, index: DataFrame, how: str, small: bool, test, x: str, y: str) -> DataFrame:
    """Equi-join of points and index on the leaf, with ``test`` as further condition.

    Unless the index is small the points of a leaf are spread over several tasks by their coordinates.
    """
    on = (F.col("_pl") == F.col("level")) & (F.col("_px") == F.col("bx")) & (F.col("_py") == F.col("by"))
    if small:
        index = F.broadcast(index)
    else:
        points = points.withColumn("_salt", F.pmod(F.xxhash64(x, y), F.lit(SALTS)).cast("int"))
        # by its estimate of a frame made by explode, Spark would broadcast an index far above its limit
        index = index.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
        on = on & (F.col("_salt") == F.col("_slot"))
    return points.join(index, on if test is None else on & test, how)


class _Index:
    """The quadtree of a layer, and whether it may be broadcast."""

    def __init__(self, edges: DataFrame, polygon: Sequence[str], cell: float | None, broadcast_edges: int, cell_edges: int):
        n_edges, size, self.bounds = layer_summary(edges, polygon)
        self.cell = float(cell) if cell else size
        if math.log2(self.cell) != int(math.log2(self.cell)):
            raise ValueError("the index cell size must be a power of two")
        self.leaves, self.tree, self.depth = quadtree(edges, polygon, self.cell, n_edges, cell_edges)
        self.small = n_edges <= broadcast_edges
        if self.small and (cell or self.tree is not None):  # then the edge count alone sets no bound
            held = self.leaves.limit(INDEX_ROWS * max(n_edges, 64) + 1).agg(F.count(F.lit(1)), F.sum(F.size("edges"))).first()
            self.small = held[0] + (held[1] or 0) <= INDEX_ROWS * max(broadcast_edges, 64)


def containment(
    points: DataFrame,
    edges: DataFrame,
    polygon: Sequence[str] = ("district_id",),
    how: str = "inner",
    x: str = "x",
    y: str = "y",
    cell: float | None = None,
    broadcast_edges: int = BROADCAST_EDGES,
    cell_edges: int = CELL_EDGES,
) -> DataFrame:
    """Join points to the polygons that contain them.

    ``how``: ``inner`` gives a row per pair with the polygon columns, ``left_semi`` the points inside
    any polygon (each once), ``left_anti`` the points outside all of them. Repeated points are points
    of their own. One equi-join on the leaf of the quadtree at any size of the layer.

    The index is broadcast only if the edge count, read beforehand, bounds its size; otherwise both
    sides are shuffled by leaf, and points of one leaf are spread by their coordinates.
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    index = _Index(edges, polygon, cell, broadcast_edges, cell_edges)
    keep = [*points.columns, *polygon] if how == "inner" else points.columns
    if how != "left_anti" and index.bounds:
        points = points.filter(_within(index.bounds, x, y))
    located = _located(points, index.tree, index.depth, index.cell, x, y)
    test = inside_cell(F.col("base"), F.col("edges"), F.col(x), F.col(y))
    return _matched(located, index.leaves, how, index.small, test, x, y).select(*keep)


# ---------------------------------------------------------------- operators


def spatial_inner_join(points: DataFrame, edges: DataFrame, polygon=("district_id",), **options) -> DataFrame:
    """A row per point and polygon that contains it; overlaps give several rows."""
    return containment(points, edges, polygon, "inner", **options)


def spatial_semi_join(points: DataFrame, edges: DataFrame, polygon=("district_id",), **options) -> DataFrame:
    """The points inside any polygon, each once."""
    return containment(points, edges, polygon, "left_semi", **options)


def clip_points(
    points: DataFrame, edges: DataFrame, polygon=("district_id",),
    crs: str | None = None, edges_crs: str | None = None, **options,
) -> DataFrame:
    """Keep the pixels of the study area. The CRS of both sides is compared when given."""
    if crs or edges_crs:
        require_same_crs(str(crs), str(edges_crs))
    return spatial_semi_join(points, edges, polygon, **options)


def mask_by_polygons(
    df: DataFrame, edges: DataFrame, bands: Sequence[str], polygon=("district_id",), x: str = "x", y: str = "y",
    cell: float | None = None, broadcast_edges: int = BROADCAST_EDGES, cell_edges: int = CELL_EDGES,
) -> DataFrame:
    """All rows stay; bands of pixels whose centre is outside every polygon become null. One join at any size of the layer."""
    index = _Index(edges, polygon, cell, broadcast_edges, cell_edges)
    # one row per leaf holds the tests of all polygons, so one left join settles every pixel
    tests = index.leaves.groupBy("level", "bx", "by").agg(F.collect_list(F.struct("base", "edges")).alias("_tests"))
    joined = _matched(_located(df, index.tree, index.depth, index.cell, x, y), tests, "left", index.small, None, x, y)
    inside = F.coalesce(F.exists("_tests", lambda t: inside_cell(t["base"], t["edges"], F.col(x), F.col(y))), F.lit(False))
    return joined.select(*[F.when(inside, F.col(c)).alias(c) if c in bands else F.col(c) for c in df.columns])


def mask_and_crop(
    df: DataFrame, meta: GridMeta, edges: DataFrame, bands: Sequence[str],
    polygon=("district_id",), edges_crs: str | None = None, **options,
) -> tuple[DataFrame, GridMeta]:
    """Masked read of a raster: crop to the window around the polygons, then mask inside it."""
    if edges_crs:
        require_same_crs(meta.crs, edges_crs)
    window, cropped = crop_to_extent(df, meta, bounds_of(layer_bounds(edges)))
    return mask_by_polygons(window, edges, bands, polygon, **options), cropped


def covered_spans(edges: DataFrame, meta: GridMeta, polygon=("crown_id",)) -> DataFrame:
    """The cells of ``meta``'s grid whose centre lies in (or on) any polygon, as disjoint spans ``row_id, from_col, to_col``.

    Scan lines: each edge gives its crossing with every cell row it spans; between the odd and the next
    crossing of a polygon the cells are inside. Spans of several polygons are merged by a sweep along strips of a row, so rows number edges x rows
    (and one more for each strip that a span enters), however many cells the polygons cover.
    """
    d_x, d_y = F.lit(float(meta.dx)), F.lit(float(meta.dy))
    x0, y0 = F.lit(float(meta.x0)), F.lit(float(meta.y0))
    lo_y, hi_y = F.least("y1", "y2"), F.greatest("y1", "y2")
    first = F.greatest(F.floor((y0 - hi_y) / d_y - 0.5), F.lit(0)).cast("long")
    last = F.least(F.ceil((y0 - lo_y) / d_y - 0.5), F.lit(meta.height - 1)).cast("long")
    rows = (
        edges.select(*polygon, *EDGE, first.alias("_first"), last.alias("_last"))
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn("row_id", F.explode(F.sequence("_first", "_last")))
        .withColumn("_y", y0 - d_y * (F.col("row_id") + 0.5))
    )
    y = F.col("_y")
    crossings = rows.filter((F.col("y1") > y) != (F.col("y2") > y)).select(
        *polygon, "row_id",
        ((F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")).alias("_a"),
    )
    line = Window.partitionBy(*polygon, "row_id").orderBy("_a")
    spans = (
        crossings.withColumns({"_rank": F.row_number().over(line), "_b": F.lead("_a").over(line)})
        .filter(F.col("_rank") % 2 == 1)
        .select("row_id", "_a", "_b")
    )
    # boundary pieces that lie exactly on a row of centres: level edges and single vertices
    level = rows.filter((F.col("y1") == y) | (F.col("y2") == y))
    lying = level.select(
        "row_id",
        F.when(F.col("y1") == F.col("y2"), F.least("x1", "x2"))
        .otherwise(F.when(F.col("y1") == y, F.col("x1")).otherwise(F.col("x2"))).alias("_a"),
        F.when(F.col("y1") == F.col("y2"), F.greatest("x1", "x2"))
        .otherwise(F.when(F.col("y1") == y, F.col("x1")).otherwise(F.col("x2"))).alias("_b"),
    )
    centre = lambda col: x0 + d_x * (col + 0.5)
    from_col = F.greatest(F.floor((F.col("_a") - x0) / d_x - 0.5), F.lit(0)).cast("long")
    to_col = F.least(F.ceil((F.col("_b") - x0) / d_x - 0.5), F.lit(meta.width - 1)).cast("long")
    # the division may round to either side of a centre, so the ends are settled by the centres themselves
    ends = (
        spans.unionByName(lying).withColumns({"_from": from_col, "_to": to_col})
        .withColumn("_from", F.when(centre(F.col("_from")) < F.col("_a"), F.col("_from") + 1).otherwise(F.col("_from")))
        .withColumn("_from", F.when(centre(F.col("_from")) < F.col("_a"), F.col("_from") + 1).otherwise(F.col("_from")))
        .withColumn("_to", F.when(centre(F.col("_to")) > F.col("_b"), F.col("_to") - 1).otherwise(F.col("_to")))
        .withColumn("_to", F.when(centre(F.col("_to")) > F.col("_b"), F.col("_to") - 1).otherwise(F.col("_to")))
        .filter(F.col("_from") <= F.col("_to"))
    )
    strip = F.col("_strip")
    cut = ends.withColumn("_strip", F.explode(F.sequence(F.expr(f"_from div {STRIP}"), F.expr(f"_to div {STRIP}")))).select(
        "row_id", "_strip", F.greatest("_from", strip * STRIP).alias("_from"), F.least("_to", strip * STRIP + (STRIP - 1)).alias("_to")
    )
    # of spans with one start the longest is enough; it is found before the exchange
    longest = cut.groupBy("row_id", "_strip", "_from").agg(F.max("_to").alias("_to"))
    sweep = Window.partitionBy("row_id", "_strip").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("_from"), F.coalesce(F.max("_to").over(sweep) + 1, F.col("_from")))
    merged = longest.withColumn("_new", fresh).filter(F.col("_new") <= F.col("_to"))
    return merged.select(F.col("row_id").cast("int").alias("row_id"), F.col("_new").alias("from_col"), F.col("_to").alias("to_col"))


def rasterize_polygons(edges: DataFrame, meta: GridMeta, polygon=("crown_id",)) -> DataFrame:
    """Distinct cells of ``meta``'s grid whose centre lies in (or on) any polygon; cells are made from merged spans and never shuffled."""
    cells = covered_spans(edges, meta, polygon).select("row_id", F.explode(F.sequence("from_col", "to_col")).alias("col_id"))
    return cells.select("row_id", F.col("col_id").cast("int").alias("col_id"))


def district_services(
    predictions: DataFrame, edges: DataFrame, polygon=("district_id",), **options
) -> DataFrame:
    """Cooling by trees per district: mean, sum and pixel count; overlaps count in each district."""
    cooling = predictions.filter(F.col("predicted_lst").isNotNull() & F.col("lst").isNotNull())
    return (
        containment(cooling, edges, polygon, "inner", **options)
        .groupBy(*polygon)
        .agg(
            F.avg(F.col("predicted_lst") - F.col("lst")).alias("mean_cooling"),
            F.sum(F.col("predicted_lst") - F.col("lst")).alias("sum_cooling"),
            F.count(F.lit(1)).alias("n_pixels"),
        )
    )


def lookup_small(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join to a dimension table that is broadcast only after its size is checked."""
    return df.join(broadcast_within(small), list(on), how)
