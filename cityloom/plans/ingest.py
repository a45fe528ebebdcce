"""Map extract to cleaned places, and the two cleaned tables beside them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import cleaning
from ..operators.indexing import stable_id
from ..sources import tables, xml


READERS = {
    "fragments": xml.read_osm_fragments,
    "documents": xml.read_osm_document,
    "extract": xml.read_osm_extract,
}


def extract_places(spark: SparkSession, source: str, target: str, *, kind: str = "fragments") -> None:
    """XML to gzip JSON at ``target`` and Parquet at ``target-parquet``. The extract is small beside
    its source, so it is written once and the JSON is made from the Parquet copy."""
    tables.write_parquet(READERS[kind](spark, source), target + "-parquet")
    tables.write_json(tables.read_parquet(spark, target + "-parquet"), target)


def clip_places(spark: SparkSession, source: str, target: str) -> None:
    places = tables.read_table(spark, source, schemas.PLACES_RAW)
    tables.write_table(cleaning.clip_to_region(places), target)


def prepare_places(spark: SparkSession, source: str, target: str, *, parity: bool = False) -> None:
    places = tables.read_table(spark, source, schemas.PLACES_RAW)
    columns = ["amenity", "lat", "lon", "name", "category", "amnt_id"]
    cleaned = stable_id(cleaning.clean_places(places, parity=parity), "amnt_id")
    tables.write_table(cleaned.select(*columns), target)


def prepare_incidents(spark: SparkSession, source: str, target: str, *, float32: bool = False) -> None:
    incidents = tables.read_table(spark, source, schemas.INCIDENTS_RAW)
    tables.write_table(stable_id(cleaning.clean_incidents(incidents, float32=float32), "c_id"), target)


def prepare_listings(spark: SparkSession, source: str, target: str, *, as_of: dt.date | None = None) -> None:
    listings = tables.read_table(spark, source, schemas.LISTINGS_RAW, multi_line=True)
    tables.write_table(cleaning.clean_listings(listings, as_of=as_of), target)


def load_places(spark: SparkSession, path: str, *, labelled: bool = False) -> DataFrame:
    schema = schemas.PLACES_LABELLED if labelled else schemas.PLACES
    return tables.read_table(spark, path, schema, multi_line=True)


def load_incidents(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_table(spark, path, schemas.INCIDENTS)


def load_listings(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_table(spark, path, schemas.LISTINGS, multi_line=True)
