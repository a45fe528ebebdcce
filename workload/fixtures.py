"""Places, incidents and listings derived from the given tables by portable integer arithmetic.

The same SQL text defines the Spark input and the oracle's views. ``{name}`` stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

POI = """
SELECT c_custkey AS amnt_id,
  CASE c_custkey % 20 WHEN 0 THEN 'cafe' WHEN 1 THEN 'restaurant' WHEN 2 THEN 'fast_food' WHEN 3 THEN 'bank'
    WHEN 4 THEN 'atm;bank' WHEN 5 THEN 'police' WHEN 6 THEN 'library' WHEN 7 THEN 'cinema' WHEN 8 THEN 'gym'
    WHEN 9 THEN 'theatre' WHEN 10 THEN 'park' WHEN 11 THEN 'university' WHEN 12 THEN 'taxi' WHEN 13 THEN 'bus_station'
    WHEN 14 THEN 'pub' WHEN 15 THEN 'bar' WHEN 16 THEN 'playground' WHEN 17 THEN 'events_venue'
    WHEN 18 THEN 'parking' ELSE 'bench' END AS amenity,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS name,
  CAST(49.19 AS DOUBLE) + ((c_custkey*7919) % 100003) * CAST(0.0000014 AS DOUBLE) AS lat,
  CAST(-123.28 AS DOUBLE) + ((c_custkey*104729) % 100019) * CAST(0.0000028 AS DOUBLE) AS lon,
  CAST(c_nationkey AS VARCHAR(4)) AS neighbourhood
FROM {customer}
"""

INCIDENTS = """
SELECT o_orderkey AS c_id,
  CASE o_orderkey % 9 WHEN 0 THEN 'Break and Enter Commercial' WHEN 1 THEN 'Break and Enter Residential/Other'
    WHEN 2 THEN 'Mischief' WHEN 3 THEN 'Other Theft' WHEN 4 THEN 'Theft from Vehicle' WHEN 5 THEN 'Theft of Bicycle'
    WHEN 6 THEN 'Theft of Vehicle' WHEN 7 THEN 'Vehicle Collision or Pedestrian Struck (with Injury)'
    ELSE 'Vehicle Collision or Pedestrian Struck (with Fatality)' END AS type,
  CAST(2003 + o_orderkey % 18 AS VARCHAR(4)) AS year,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_custkey % 25 AS VARCHAR(4)) END AS neighbourhood,
  CASE WHEN o_orderkey % 53 = 0 THEN CAST(0 AS DOUBLE)
    ELSE CAST(483000 AS DOUBLE) + ((o_orderkey*7907) % 100003) * CAST(0.15 AS DOUBLE) END AS x,
  CASE WHEN o_orderkey % 53 = 0 THEN CAST(0 AS DOUBLE)
    ELSE CAST(5449000 AS DOUBLE) + ((o_orderkey*104723) % 100019) * CAST(0.12 AS DOUBLE) END AS y
FROM {orders}
"""

LISTINGS = """
SELECT p_partkey AS id, p_name AS name, p_brand AS neighbourhood,
  CAST(49.2 AS DOUBLE) + ((p_partkey*7919) % 100003) * CAST(0.00000117 AS DOUBLE) AS latitude,
  CAST(-123.26 AS DOUBLE) + ((p_partkey*104729) % 100019) * CAST(0.0000024 AS DOUBLE) AS longitude,
  p_type AS room_type, p_retailprice AS price, p_size - 2 AS minimum_nights,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE DATE '2016-01-01' + CAST((p_partkey*37) % 1800 AS INT) END AS last_review
FROM {part}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, sf_dir, name)})


def poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, POI, "customer")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, INCIDENTS, "orders")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, LISTINGS, "part")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round doubles so that the last bits of two engines' math libraries do not show."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
