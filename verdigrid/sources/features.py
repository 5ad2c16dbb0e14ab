"""GeoJSON features: polygons in, points out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.operators.spatial import edges_of_polygons
from verdigrid.session import broadcast_within
from verdigrid.sources.documents import RANGE_BYTES, scan_array

RING = "array<array<double>>"
# Coordinates nest one level deeper in a multi-polygon, so they are read as text and parsed by type.
GEOMETRY = "struct<type: string, coordinates: string>"


def scan_features(
    spark: SparkSession, path: str, properties: str = "", line_delimited: bool = False, strict: bool = True,
    range_bytes: int | None = RANGE_BYTES,
) -> DataFrame:
    """Polygon features as ``feature_id, <properties>, rings``.

    ``properties`` is a DDL list such as ``"name string, population long"``. A feature collection is one
    JSON document: it is cut into ranges of ``range_bytes`` (see ``scan_array``), or parsed by one task with ``range_bytes=None``, for file
    systems that Arrow cannot open. Line-delimited layers are split like any text file. ``feature_id`` is the
    hash of geometry and properties when the file carries no ``id``, so it does not depend on partitioning; equal copies
    share it. A feature that is no JSON or no (multi)polygon raises; with ``strict=False`` it comes without rings and with
    its text in ``reject``, which is null for all others.
    """
    props = f"struct<{', '.join(_ddl_fields(properties))}>"
    feature = f"struct<id: string, geometry: {GEOMETRY}, properties: {props}>"
    if line_delimited or range_bytes is not None:
        texts = spark.read.text(path).filter(F.trim("value") != "") if line_delimited else scan_array(spark, path, "features", range_bytes)
        rows = texts.select(F.from_json("value", feature).alias("f"), F.col("value").alias("source"))
    else:
        whole = spark.read.option("multiLine", True).schema(f"features array<{feature}>").json(path)
        rows = whole.select(F.explode("features").alias("f")).repartition("f").withColumn("source", F.to_json("f"))
    text, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    rings = F.when(kind == "Polygon", F.from_json(text, f"array<{RING}>")).when(
        kind == "MultiPolygon", F.flatten(F.from_json(text, f"array<array<{RING}>>"))
    )
    feature_id = F.coalesce(F.col("f.id"), F.md5(F.to_json("f")))
    out = rows.select(feature_id.alias("feature_id"), "f.properties.*", rings.alias("rings"), "source")
    bad = F.col("rings").isNull()
    if strict:
        wrong = F.raise_error(F.concat(F.lit("no polygon feature: "), F.substring("source", 1, 200))).cast(out.schema["rings"].dataType)
        return out.withColumn("rings", F.when(bad, wrong).otherwise(F.col("rings"))).drop("source")
    return out.withColumn("reject", F.when(bad, F.col("source"))).drop("source")


def _ddl_fields(properties: str) -> list[str]:
    if not properties.strip():
        return []
    return [f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(properties).fields]


def scan_edges(spark: SparkSession, path: str, properties: str = "", line_delimited: bool = False) -> DataFrame:
    """Polygon features as edge rows, the form every containment operator takes.

    Features that are equal in id, properties and geometry become one polygon, else each edge would count twice. Different features that share
    an id stay polygons of their own: their ``feature_id`` is the id, ``#`` and the hash of the feature.
    """
    features = scan_features(spark, path, properties, line_delimited)
    content = F.md5(F.to_json(F.struct(*features.columns)))
    different = features.withColumn("_content", content).dropDuplicates(["_content"])
    shared = different.groupBy("feature_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("feature_id", F.lit(True).alias("_shared"))
    named = different.join(broadcast_within(shared), "feature_id", "left")
    own = F.when(F.col("_shared"), F.concat("feature_id", F.lit("#"), "_content")).otherwise(F.col("feature_id"))
    return edges_of_polygons(named.withColumn("feature_id", own).select(*features.columns))


def point_features(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One GeoJSON point feature per row, as text."""
    properties = [c for c in df.columns if c not in (x, y, "geometry")]
    return df.select(
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                F.struct(
                    F.lit("Point").alias("type"), F.array(F.col(x), F.col(y)).alias("coordinates")
                ).alias("geometry"),
                F.struct(*properties).alias("properties"),
            )
        ).alias("value")
    )


def write_features(df: DataFrame, path: str, x: str = "x", y: str = "y", mode: str = "errorifexists") -> None:
    """Pixel rows as line-delimited GeoJSON points, written in parallel."""
    point_features(df, x, y).write.mode(mode).text(path)


def scan_points(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Read back what ``write_features`` stored."""
    feature = (
        "struct<geometry: struct<type: string, coordinates: array<double>>, "
        f"properties: struct<{', '.join(_ddl_fields(properties))}>>"
    )
    rows = spark.read.text(path).select(F.from_json("value", feature).alias("f"))
    return rows.select(
        F.col("f.geometry.coordinates")[0].alias("x"), F.col("f.geometry.coordinates")[1].alias("y"),
        "f.properties.*",
    )
