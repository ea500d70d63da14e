"""Flights made from the sample table ``events``; the same SQL runs in Spark and in the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewright.operators.selection import SelectionParams
from framewright.storage import table

CELL_E, CELL_N = 50, 10
#: Fits the sample flights, whose frames lie some 50 m apart.
P = SelectionParams(bin_m=10.0, spacing_m=60.0, max_frames=20, target_views=3, warn_gap_m=150.0, max_gap_m=200.0, cluster_m=120.0)
CULL_VIEWS = 2

FRAMES = """
WITH o AS (
  SELECT user_id AS flight, event_id, value,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame,
         CAST(count(*) OVER (PARTITION BY user_id) AS BIGINT) AS n,
         CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100 AS easting
  FROM {events})
SELECT flight, frame, event_id, easting,
       CAST(event_id % 97 AS DOUBLE) AS northing,
       CAST(145 + 4 * LEAST(frame, n - 1 - frame, 20) AS DOUBLE) AS altamsl,
       CAST((event_id * 37) % 360 - 180 AS DOUBLE) * pi() / 180 AS yaw_rad,
       -CAST(30 + event_id % 60 AS DOUBLE) * pi() / 180 AS pitch_rad,
       CAST(0 AS DOUBLE) AS roll_rad,
       CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST((event_id * 7) % 500 AS DOUBLE) END AS feature_count,
       CASE WHEN event_id % 53 = 0 THEN NULL ELSE value END AS sharpness,
       CASE WHEN event_id % 67 = 0 THEN CAST(5 AS DOUBLE) ELSE 60 + value / 10 END AS agl_m,
       event_id % 41 <> 0 AS footprint_valid
FROM o
"""

FOOTPRINTS = f"""
SELECT flight, frame, CAST(floor(easting / {CELL_E}) AS BIGINT) + x.d AS cx,
       CAST(floor(northing / {CELL_N}) AS BIGINT) + y.d AS cy, footprint_valid
FROM {{frames}} CROSS JOIN (SELECT CAST(-1 AS BIGINT) AS d UNION ALL SELECT 0 UNION ALL SELECT 1) x
              CROSS JOIN (SELECT CAST(-1 AS BIGINT) AS d UNION ALL SELECT 0 UNION ALL SELECT 1) y
"""

#: Height of the ground in each cell, unknown in some.
GROUND = """
SELECT flight, cx, cy, CASE WHEN (cx + 3 * cy) % 13 <> 0 THEN CAST(20 + (cx * 7 + cy * 3) % 11 AS DOUBLE) END AS ground_z
FROM (SELECT DISTINCT flight, cx, cy FROM {cells}) c
"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FRAMES, events=table(spark, sf_dir, "events"))


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FOOTPRINTS, frames=frames(spark, sf_dir))


def ground(spark: SparkSession, cells: DataFrame) -> DataFrame:
    return spark.sql(GROUND, cells=cells)
