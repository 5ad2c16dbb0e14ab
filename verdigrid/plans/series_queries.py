"""Station series."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.operators import series as os_
from verdigrid.plans import views
from verdigrid.plans.registry import query, rounded
from verdigrid.session import scratch_path
from verdigrid.sources.observations import scan_observations

RECORDS = """
records AS (
  SELECT concat('SN', CAST(o_custkey % 3 AS VARCHAR), ':0') AS source_id,
         date_trunc('month', o_orderdate) AS reference_time, max(o_totalprice) AS hi, min(o_totalprice) AS lo,
         CAST(count(*) AS DOUBLE) AS n
  FROM orders GROUP BY 1, 2),
flat AS (
  SELECT source_id, reference_time, 'max' AS element_id, hi AS value, 'degC' AS unit, 'PT0H' AS time_offset FROM records
  UNION ALL SELECT source_id, reference_time, 'min', lo, 'degC', 'PT0H' FROM records
  UNION ALL SELECT source_id, reference_time, 'count', n, '1', 'PT0H' FROM records)"""
FLAT = f"WITH {RECORDS} SELECT * FROM flat"


def _naive(df):
    return df.withColumn("reference_time", F.col("reference_time").cast("timestamp_ntz"))


@query("scan_observations", FLAT)
def scan_observations_query(spark, sf):
    """Nested records written as JSON lines, read with a schema, flattened, times parsed."""
    path = scratch_path(spark, "records")
    views.station_records(spark, sf).write.json(path)
    return _naive(os_.parse_time(os_.flatten_observations(scan_observations(spark, path))))


@query("flatten_observations", FLAT)
def flatten_observations(spark, sf):
    return _naive(os_.parse_time(os_.flatten_observations(views.station_records(spark, sf))))


@query(
    "parse_time",
    f"WITH {RECORDS} SELECT source_id, reference_time, CAST(year(reference_time) AS INT) AS y, CAST(month(reference_time) AS INT) AS m FROM records",
)
def parse_time(spark, sf):
    raw = views.station_records(spark, sf).select(
        F.col("sourceId").alias("source_id"), F.col("referenceTime").alias("reference_time")
    )
    out = _naive(os_.parse_time(raw))
    return out.withColumns({"y": F.year("reference_time"), "m": F.month("reference_time")})


@query(
    "attribute_filter",
    "SELECT source_id, reference_time, round(value, 6) AS value FROM observations WHERE source_id IN ('SN0:0', 'SN2:0')",
    ("observations",),
)
def attribute_filter(spark, sf):
    return rounded(os_.attribute_filter(views.observations(spark, sf), "source_id", "SN0:0", "SN2:0"), 6, "value")


@query(
    "summer_filter",
    "SELECT source_id, reference_time, round(value, 6) AS value FROM observations WHERE month(reference_time) BETWEEN 6 AND 8",
    ("observations",),
)
def summer_filter(spark, sf):
    return rounded(os_.summer_filter(views.observations(spark, sf)), 6, "value")


@query(
    "observation_period",
    "SELECT source_id, reference_time, round(value, 6) AS value FROM observations WHERE year(reference_time) >= 1997",
    ("observations",),
)
def observation_period(spark, sf):
    return rounded(os_.observation_period(views.observations(spark, sf), 1997), 6, "value")


@query(
    "top_k_per_station",
    """SELECT source_id, reference_time, round(value, 6) AS value, CAST(rn AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY value DESC, reference_time) AS rn
  FROM observations WHERE month(reference_time) BETWEEN 6 AND 8) WHERE rn <= 3""",
    ("observations",),
)
def top_k_per_station(spark, sf):
    summer = os_.summer_filter(views.observations(spark, sf))
    return rounded(os_.top_k_per_station(summer, 3), 6, "value")


@query(
    "hottest_summer",
    """WITH summer AS (SELECT * FROM observations WHERE month(reference_time) BETWEEN 6 AND 8),
ever AS (SELECT source_id, year(reference_time) AS y, value,
                row_number() OVER (PARTITION BY source_id ORDER BY value DESC, reference_time) AS rn FROM summer),
recent AS (SELECT source_id, year(reference_time) AS y, value,
                row_number() OVER (PARTITION BY source_id ORDER BY value DESC, reference_time) AS rn FROM summer
           WHERE year(reference_time) >= 1998)
SELECT s.city, s.source_id, CAST(r.y AS INT) AS year_observed, round(r.value, 6) AS value_observed,
       CAST(e.y AS INT) AS year_record, round(e.value, 6) AS value_record
FROM stations s JOIN (SELECT * FROM ever WHERE rn = 1) e ON s.source_id = e.source_id
LEFT JOIN (SELECT * FROM recent WHERE rn = 1) r ON s.source_id = r.source_id""",
    ("observations", "stations"),
)
def hottest_summer(spark, sf):
    best = os_.hottest_summer(views.observations(spark, sf), views.stations(spark), 1998)
    return rounded(best, 6, "value_observed", "value_record")


@query(
    "station_lookup",
    """SELECT o.source_id, o.reference_time, round(o.value, 6) AS value, s.city, s.acquisition_year
FROM observations o JOIN stations s ON o.source_id = s.source_id""",
    ("observations", "stations"),
)
def station_lookup(spark, sf):
    return rounded(os_.station_lookup(views.observations(spark, sf), views.stations(spark)), 6, "value")


@query(
    "sort_desc",
    """SELECT source_id, reference_time, round(value, 6) AS value FROM observations
ORDER BY observations.value DESC, reference_time, source_id""",
    ("observations",),
)
def sort_desc(spark, sf):
    ordered = os_.sort_desc(views.observations(spark, sf), "value", ("reference_time", "source_id"))
    return rounded(ordered, 6, "value")


@query(
    "head",
    "SELECT row_id, col_id, x, y, dtm FROM pixels ORDER BY row_id, col_id LIMIT 5",
    ("pixels",),
)
def head(spark, sf):
    return os_.head(views.pixels(spark, sf, ("dtm",)), 5, ("row_id", "col_id"))


@query(
    "concat_rows",
    """WITH a AS (SELECT source_id, reference_time, value FROM observations WHERE source_id = 'SN0:0'),
b AS (SELECT source_id, value FROM observations WHERE source_id = 'SN1:0'),
c AS (SELECT source_id, reference_time, value, 'degC' AS unit FROM observations WHERE source_id = 'SN2:0')
SELECT source_id, reference_time, round(value, 6) AS value, NULL AS unit FROM a
UNION ALL SELECT source_id, NULL, round(value, 6), NULL FROM b
UNION ALL SELECT source_id, reference_time, round(value, 6), unit FROM c""",
    ("observations",),
)
def concat_rows(spark, sf):
    series = views.observations(spark, sf)
    one = os_.attribute_filter(series, "source_id", "SN0:0")
    two = os_.attribute_filter(series, "source_id", "SN1:0").drop("reference_time")
    three = os_.attribute_filter(series, "source_id", "SN2:0").withColumn("unit", F.lit("degC"))
    return rounded(os_.concat_rows(one, two, three), 6, "value")
