"""Is the category of a place related to the type of incidents near it?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions.geo import Distance
from ..operators.cleaning import without_types
from ..operators.contingency import chi_square, contingency, supported_rows
from ..operators.density import kernel_density
from ..operators.distance_join import count_within, distance_join, summarise_pairs
from ..session import materialise


def near_pairs(
    places: DataFrame,
    incidents: DataFrame,
    radius: float = V.RADIUS_M,
    *,
    block: str | None = "neighbourhood",
    distance: Distance = Distance(),
    ids_only: bool = False,
) -> DataFrame:
    """Pairs of a place and an incident within the radius, unsorted; sort where they are shown. ``ids_only`` leaves their
    ids and distance, packed for results that are written."""
    if ids_only:
        also = [block] if block else []
        left, right = places.select("amnt_id", "lat", "lon", *also), incidents.select("c_id", "latitude", "longitude", *also)
        pairs = distance_join(left, right, radius, block=block, distance=distance, packed=True)
        return pairs.select("amnt_id", "c_id", "distance_in_meters")
    left = ["amnt_id", "category", "amenity", "name", "lat", "lon", "neighbourhood"]
    right = ["c_id", F.col("type").alias("crime_type"), "latitude", "longitude"]
    if block:
        right.append(block)
    pairs = distance_join(places.select(*left), incidents.select(*right), radius, block=block, distance=distance)
    return pairs.drop("lat", "lon", "latitude", "longitude")


def near_counts(
    places: DataFrame,
    incidents: DataFrame,
    radius: float = V.RADIUS_M,
    *,
    by: tuple[str, ...] = ("category",),
    block: str | None = "neighbourhood",
    distance: Distance = Distance(),
) -> DataFrame:
    """Pairs per (*by, crime_type), counted without forming them. Distances that are not clamped have no
    bounds by cell: there the pairs are formed and grouped."""
    typed = incidents.withColumnRenamed("type", "crime_type")
    if not distance.clamp:
        left = [*by, "lat", "lon", *([block] if block else [])]
        right = ["crime_type", "latitude", "longitude", *([block] if block else [])]
        pairs = distance_join(places.select(*left), typed.select(*right), radius, block=block, distance=distance)
        return pairs.groupBy(*by, "crime_type").agg(F.count("*").alias("n"))
    return count_within(
        places, typed, radius, left_by=by, right_by=("crime_type",), block=block, distance=distance
    )


@dataclass
class Relation:
    """Results of the analysis; ``per_place`` is written once and feeds the others but the densities."""

    per_place: DataFrame
    counts: DataFrame
    densities: DataFrame
    summary: DataFrame
    table_all: DataFrame
    test_all: DataFrame
    table_petty: DataFrame
    test_petty: DataFrame


def relate(
    places: DataFrame,
    incidents: DataFrame,
    radius: float = V.RADIUS_M,
    *,
    block: str | None = "neighbourhood",
    distance: Distance = Distance(),
    min_support: int = V.MIN_SUPPORT,
    alpha: float = V.ALPHA,
) -> Relation:
    """Counts, densities by incident type, contingency tables and tests over all and over petty types.

    The radius search runs once, into at most one row per place and type; everything else reads
    that.
    """
    per_place = materialise(
        near_counts(
            places, incidents, radius, by=("amnt_id", "amenity", "category"), block=block, distance=distance
        ),
        "near-counts",
    )

    def table(rows: DataFrame, types: tuple[str, ...]) -> DataFrame:
        cells = contingency(rows, "category", "crime_type", types, weight="n")
        return supported_rows(cells, "category", "crime_type", types, min_support)

    table_all = table(per_place, V.INCIDENT_TYPES)
    table_petty = table(without_types(per_place, V.SERIOUS_TYPES), V.PETTY_TYPES)
    return Relation(
        per_place=per_place,
        counts=per_place.groupBy("category", "crime_type").agg(F.sum("n").alias("n")),
        densities=kernel_density(incidents, "type"),
        summary=summarise_pairs(per_place),
        table_all=table_all,
        test_all=chi_square(table_all, "category", "crime_type", alpha=alpha),
        table_petty=table_petty,
        test_petty=chi_square(table_petty, "category", "crime_type", alpha=alpha),
    )
