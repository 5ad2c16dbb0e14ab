"""Pixel, scene, station and polygon views over the base tables.

Each view exists twice: as a DataFrame here, and as the same definition in SQL (``SQL``), which the
checks inline as a common table expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.meta import GridMeta
from verdigrid.operators.bands import STACK_BANDS

CRS = "EPSG:25832"
WIDTH = 100
ORIGIN = (440000.0, 6450000.0)
CELL = 100.0

# Four districts as closed rings; 3 overlaps 1 and 2, 4 has a hole.
DISTRICTS = {
    1: [[(440013, 6450007), (444517, 6450007), (444517, 6449203), (440013, 6449203)]],
    2: [[(444517, 6450007), (449981, 6450007), (447213, 6448611)]],
    3: [[(443011, 6449907), (446013, 6449907), (446013, 6449409), (443011, 6449409)]],
    4: [
        [(440003, 6449107), (443003, 6449107), (443003, 6448503), (440003, 6448503)],
        [(441007, 6448907), (442007, 6448907), (442007, 6448703), (441007, 6448703)],
    ],
}
STATIONS = [
    ("SN0:0", "city_a", 2018),
    ("SN0:0", "city_b", 2018),
    ("SN1:0", "city_c", 2023),
    ("SN2:0", "city_d", 2018),
]
# Crown outlines: four corners as multiples of the crown radius around its centre.
CROWN_CORNERS = [(-1.0, 0.37), (0.29, 1.0), (1.0, -0.41), (-0.33, -1.0)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixel_meta(spark: SparkSession, sf_dir: str, bands: Sequence[str] = STACK_BANDS) -> GridMeta:
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return GridMeta(CRS, *ORIGIN, CELL, CELL, WIDTH, last // WIDTH + 1, tuple(bands), None, "pixels")


def pixels(spark: SparkSession, sf_dir: str, bands: Sequence[str] = STACK_BANDS) -> DataFrame:
    """One row per order as a pixel of a grid 100 columns wide.

    Line items are only read when a wanted band depends on them.
    """
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    if set(bands) - {"dtm"}:
        items = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(
                (F.avg("l_discount") * 5.0).alias("b"),
                (F.avg("l_tax") * 5.0).alias("w"),
                F.avg(F.when(F.col("l_returnflag") == "A", 0.4).otherwise(0.0)).alias("a"),
                F.avg(F.when(F.col("l_returnflag") == "N", 0.3).otherwise(0.0)).alias("n"),
                F.avg(F.when(F.col("l_linestatus") == "F", 0.2).otherwise(0.0)).alias("f"),
            )
        )
        orders = orders.join(items, "o_orderkey", "left")
    defined = {
        "dtm": lambda: F.when(key % 11 != 0, F.col("o_totalprice") / 1000.0),
        "fraction_built": lambda: F.col("b"),
        "fraction_cropland": lambda: F.col("a"),
        "fraction_grass": lambda: F.col("n"),
        "fraction_water": lambda: F.col("w"),
        "lst": lambda: F.when(
            key % 7 != 0,
            F.lit(300.0) - F.lit(8.0) * F.col("f") + F.lit(5.0) * F.col("b")
            - F.lit(1e-5) * F.col("o_totalprice") + (key * 37 % 101).cast("double") / 50.0,
        ),
        "fraction_canopy": lambda: F.col("f"),
    }
    return orders.select(
        F.floor(key / F.lit(100.0)).cast("int").alias("row_id"),
        (key % 100).cast("int").alias("col_id"),
        (F.lit(440050.0) + F.lit(100.0) * (key % 100).cast("double")).alias("x"),
        (F.lit(6449950.0) - F.lit(100.0) * F.floor(key / F.lit(100.0))).alias("y"),
        *[defined[b]().alias(b) for b in bands],
    )


def landcover(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.floor(key / F.lit(100.0)).cast("int").alias("frow"),
        (key % 100).cast("int").alias("fcol"),
        (10 * (1 + (key * 7919) % 11)).cast("int").alias("class"),
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("pixel_id"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("scene_date"),
        F.col("event_type").alias("satellite"), "event_id", "value",
    )


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(
        F.concat(F.lit("SN"), (F.col("o_custkey") % 3).cast("string"), F.lit(":0")).alias("source_id"),
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("reference_time"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir).agg(F.avg("o_totalprice").alias("value"))


def station_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested form: one record per station and time, with one entry per element."""
    element = lambda name, value, unit: F.struct(
        F.lit(name).alias("elementId"), value.alias("value"),
        F.lit(unit).alias("unit"), F.lit("PT0H").alias("timeOffset"),
    )
    return (
        _series(spark, sf_dir)
        .agg(
            F.max("o_totalprice").alias("hi"), F.min("o_totalprice").alias("lo"),
            F.count(F.lit(1)).cast("double").alias("n"),
        )
        .select(
            F.col("source_id").alias("sourceId"),
            F.date_format("reference_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("referenceTime"),
            F.array(
                element("max", F.col("hi"), "degC"), element("min", F.col("lo"), "degC"),
                element("count", F.col("n"), "1"),
            ).alias("observations"),
        )
    )


def stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIONS, "source_id string, city string, acquisition_year int")


def _district_rows() -> list[tuple]:
    return [
        (district, *map(float, a), *map(float, b))
        for district, rings in DISTRICTS.items()
        for ring in rings
        for a, b in zip(ring, ring[1:] + ring[:1])
    ]


def district_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        _district_rows(), "district_id int, x1 double, y1 double, x2 double, y2 double"
    )


def lonlat(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        (F.lit(7.0) + (key % 400).cast("double") / 100.0).alias("lon"),
        (F.lit(58.0) + (key % 900).cast("double") / 100.0).alias("lat"),
    )


def crowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree crown per part: a four-cornered outline whose size follows the part size."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    placed = part.select(
        key.alias("crown_id"),
        (F.lit(440003.17) + F.lit(4.93) * (key * 7919 % 2003).cast("double")).alias("cx"),
        (F.lit(6449997.31) - F.lit(11.37) * (key * 104729 % 131).cast("double")).alias("cy"),
        (F.lit(2.13) + F.lit(0.21) * F.col("p_size").cast("double")).alias("r"),
    )
    corner = lambda i: F.array(
        F.col("cx") + F.lit(CROWN_CORNERS[i][0]) * F.col("r"),
        F.col("cy") + F.lit(CROWN_CORNERS[i][1]) * F.col("r"),
    )
    return placed.select("crown_id", F.array(F.array(*[corner(i) for i in (0, 1, 2, 3, 0)])).alias("rings"))


def crown_grid(cell: float = 2.0) -> GridMeta:
    """The fine grid over the area in which crowns stand (10 km x 1.5 km)."""
    return GridMeta(CRS, *ORIGIN, cell, cell, round(10000 / cell), round(1500 / cell), ("crown",))


def _values(rows) -> str:
    return ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else (f"{v!r}E0" if isinstance(v, float) else str(v)) for v in row) + ")"
        for row in rows
    )


def _crown_edge_sql() -> str:
    parts = []
    for (ax, ay), (bx, by) in zip(CROWN_CORNERS, CROWN_CORNERS[1:] + CROWN_CORNERS[:1]):
        parts.append(
            f"SELECT crown_id, cx + {ax}E0 * r AS x1, cy + {ay}E0 * r AS y1, "
            f"cx + {bx}E0 * r AS x2, cy + {by}E0 * r AS y2 FROM crown_centres"
        )
    return " UNION ALL ".join(parts)


SQL = {
    "pixels": """
SELECT CAST(floor(o_orderkey / 100E0) AS INT) AS row_id,
       CAST(o_orderkey % 100 AS INT) AS col_id,
       440050E0 + 100E0 * CAST(o_orderkey % 100 AS DOUBLE) AS x,
       6449950E0 - 100E0 * floor(o_orderkey / 100E0) AS y,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice / 1000E0 END AS dtm,
       l.b AS fraction_built, l.a AS fraction_cropland, l.n AS fraction_grass, l.w AS fraction_water,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            ELSE 300E0 - 8E0 * l.f + 5E0 * l.b - 1E-5 * o_totalprice
                 + CAST((o_orderkey * 37) % 101 AS DOUBLE) / 50E0 END AS lst,
       l.f AS fraction_canopy
FROM orders LEFT JOIN (
  SELECT l_orderkey, avg(l_discount) * 5E0 AS b, avg(l_tax) * 5E0 AS w,
         avg(CASE WHEN l_returnflag = 'A' THEN 4E-1 ELSE 0E0 END) AS a,
         avg(CASE WHEN l_returnflag = 'N' THEN 3E-1 ELSE 0E0 END) AS n,
         avg(CASE WHEN l_linestatus = 'F' THEN 2E-1 ELSE 0E0 END) AS f
  FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l.l_orderkey""",
    "landcover": """
SELECT CAST(floor(o_orderkey / 100E0) AS INT) AS frow, CAST(o_orderkey % 100 AS INT) AS fcol,
       CAST(10 * (1 + (o_orderkey * 7919) % 11) AS INT) AS class
FROM orders""",
    "scenes": """
SELECT user_id AS pixel_id, date_trunc('day', ts) AS scene_date, event_type AS satellite, event_id, value
FROM events""",
    "observations": """
SELECT concat('SN', CAST(o_custkey % 3 AS VARCHAR), ':0') AS source_id,
       date_trunc('month', o_orderdate) AS reference_time,
       avg(o_totalprice) AS value
FROM orders GROUP BY 1, 2""",
    "stations": f"SELECT * FROM (VALUES {_values(STATIONS)}) AS t(source_id, city, acquisition_year)",
    "district_edges": f"SELECT * FROM (VALUES {_values(_district_rows())}) AS t(district_id, x1, y1, x2, y2)",
    "lonlat": """
SELECT o_orderkey AS id, 7E0 + CAST(o_orderkey % 400 AS DOUBLE) / 100E0 AS lon,
       58E0 + CAST(o_orderkey % 900 AS DOUBLE) / 100E0 AS lat
FROM orders""",
    "crown_centres": """
SELECT p_partkey AS crown_id,
       440003.17E0 + 4.93E0 * CAST(p_partkey * 7919 % 2003 AS DOUBLE) AS cx,
       6449997.31E0 - 11.37E0 * CAST(p_partkey * 104729 % 131 AS DOUBLE) AS cy,
       2.13E0 + 0.21E0 * CAST(p_size AS DOUBLE) AS r
FROM part""",
    "crown_edges": _crown_edge_sql(),
}
