"""As-of joins over events: views as primary, errors as secondary telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators import asof
from perigee.plans.base import query
from perigee.plans.fixtures import table


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Primary and secondary telemetry."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.unix_micros("ts").alias("us"), "ts", "value", "event_type")
    return events.filter("event_type = 'view'").drop("event_type"), events.filter("event_type = 'error'").drop("event_type")


ASOF = """
SELECT p.event_id, p.value, s.event_id AS error_event_id, s.value AS error_value
FROM (SELECT * FROM events WHERE event_type = 'view') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') s ON p.ts >= s.ts"""

SHOWN = ["event_id", "value", "error_event_id", "error_value"]


@query("j1_asof_join", ASOF)
def j1_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, secondary = sides(spark, sf_dir)
    return asof.asof_join(primary, secondary, "ts", prefix="error", order=["event_id"]).select(SHOWN)


@query("j2_asof_tolerance", ASOF + " WHERE p.ts - s.ts <= INTERVAL 10 MINUTE")
def j2_asof_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, secondary = sides(spark, sf_dir)
    tolerance = F.expr("interval 10 minutes")
    return asof.asof_join(primary, secondary, "ts", prefix="error", order=["event_id"], tolerance=tolerance).select(SHOWN)


@query(
    "j2_asof_tolerance_keep",
    """
SELECT p.event_id, p.value, CASE WHEN near THEN s_id END AS error_event_id, CASE WHEN near THEN s_value END AS error_value
FROM (SELECT p.event_id, p.value, s.event_id AS s_id, s.value AS s_value, p.ts - s.ts <= INTERVAL 10 MINUTE AS near
      FROM (SELECT * FROM events WHERE event_type = 'view') p
      ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') s ON p.ts >= s.ts) p""",
)
def j2_asof_tolerance_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, secondary = sides(spark, sf_dir)
    tolerance = F.expr("interval 10 minutes")
    joined = asof.asof_join(primary, secondary, "ts", prefix="error", order=["event_id"], tolerance=tolerance, keep_unmatched=True)
    return joined.select(SHOWN)


@query("j3_asof_small_buckets", ASOF)
def j3_asof_small_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, secondary = sides(spark, sf_dir)
    return asof.asof_join(primary, secondary, "ts", prefix="error", order=["event_id"], bucket_seconds=600).select(SHOWN)


@query(
    "j1_asof_join_by_key",
    """
SELECT p.event_id, p.value, s.event_id AS error_event_id, s.value AS error_value
FROM (SELECT * FROM events WHERE event_type = 'view') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') s ON p.user_id = s.user_id AND p.ts >= s.ts""",
)
def j1_asof_join_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, secondary = sides(spark, sf_dir)
    return asof.asof_join(primary, secondary, "ts", prefix="error", by=["user_id"], order=["event_id"]).select(SHOWN)


CURVE = [(0.0, 0.0), (10.0, 1.0), (50.0, 3.0), (200.0, 6.5)]


@query(
    "j15_interpolation_join",
    f"""
WITH curve AS (SELECT * FROM (VALUES {", ".join(map(str, CURVE))}) AS c(x, y)),
segments AS (SELECT x AS x0, y AS y0, lead(x) OVER (ORDER BY x) AS x1, lead(y) OVER (ORDER BY x) AS y1 FROM curve)
SELECT event_id, round(CASE WHEN x0 IS NULL THEN 0.0
                            ELSE y0 + coalesce((y1 - y0) / (x1 - x0) * (value - x0), 0.0) END, 9)::DOUBLE AS response
FROM events LEFT JOIN segments ON value >= x0 AND (value < x1 OR (x1 IS NULL AND value = x0))""",
)
def j15_interpolation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = spark.createDataFrame(CURVE, "value double, gain double")
    points = table(spark, sf_dir, "events").select("event_id", "value")
    return asof.interpolate(points, curve, "value", "gain").select("event_id", F.round("gain_interpolated", 9).alias("response"))
