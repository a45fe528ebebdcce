"""Cleaning of places, incidents and listings. Row-local expressions only: one scan, no shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions.geo import with_lat_lon_from_utm

Box = tuple[float, float, float, float]


def _texts(values: Iterable[str]) -> str:
    """A list of SQL text literals."""
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def inside_box(lat: str, lon: str, box: Box, *, closed: bool) -> Column:
    """Whether a point lies in a (min lon, max lon, min lat, max lat) box."""
    west, east, south, north = (f"{float(v)!r}D" for v in box)
    if closed:
        return F.expr(f"{lon} BETWEEN {west} AND {east} AND {lat} BETWEEN {south} AND {north}")
    return F.expr(f"{lon} > {west} AND {lon} < {east} AND {lat} > {south} AND {lat} < {north}")


def clip_to_region(df: DataFrame, box: Box = V.REGION_BOX, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points strictly inside the greater region."""
    return df.filter(inside_box(lat, lon, box, closed=False))


def category_of(
    amenity: str,
    categories: Mapping[str, Sequence[str]] = V.CATEGORIES,
    *,
    fallback: str = V.FALLBACK_CATEGORY,
    parity: bool = False,
) -> Column:
    """Category by membership, else ``fallback``.

    ``parity`` sends playgrounds and event venues to the fallback, as the published figures do.
    """
    apart = set(V.PARITY_FALLBACK_AMENITIES) if parity else set()
    cases = {
        name: [a for a in amenities if a not in apart]
        for name, amenities in categories.items()
        if name != fallback
    }
    whens = " ".join(f"WHEN {amenity} IN ({_texts(v)}) THEN {_texts([n])}" for n, v in cases.items() if v)
    return F.expr(f"CASE {whens} ELSE {_texts([fallback])} END") if whens else F.lit(fallback)


def keep_places(
    df: DataFrame, box: Box = V.CITY_BOX, allowed: Sequence[str] = V.ALLOWED_AMENITIES
) -> DataFrame:
    """Named places of an allowed kind in the city; box edges count."""
    return df.filter(
        F.expr(f"amenity IN ({_texts(allowed)})")
        & inside_box("lat", "lon", box, closed=True)
        & F.col("name").isNotNull()
    )


def clean_places(
    df: DataFrame,
    *,
    box: Box = V.CITY_BOX,
    allowed: Sequence[str] = V.ALLOWED_AMENITIES,
    parity: bool = False,
) -> DataFrame:
    """Kept places with their category, without tags and timestamp."""
    kept = keep_places(df, box, allowed).drop("tags", "timestamp")
    return kept.withColumn("category", category_of("amenity", parity=parity))


def keep_incidents(
    df: DataFrame,
    *,
    first_year: int = V.FIRST_YEAR,
    excluded: Sequence[str] = V.COLLISION_TYPES,
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Incidents with a neighbourhood and a location, not of an excluded type, from a year on.

    A null type or coordinate drops the row, as a comparison with null is never true. A year that is
    not a number drops the row too instead of failing the job.
    """
    return df.filter(
        F.col("neighbourhood").isNotNull()
        & (F.col(x) != 0)
        & (F.col(y) != 0)
        & ~F.col("type").isin(*excluded)
        & (F.col("year").try_cast("int") >= first_year)
    )


def locate_incidents(
    df: DataFrame, *, zone: int = V.UTM_ZONE, x: str = "x", y: str = "y", float32: bool = False
) -> DataFrame:
    """Latitude and longitude from projected metres. ``float32`` first rounds the input to 32 bits,
    which moves points by up to half a metre, for comparison with results that did."""
    if float32:
        df = df.withColumns({x: F.col(x).cast("float").cast("double"), y: F.col(y).cast("float").cast("double")})
    return with_lat_lon_from_utm(df, x, y, zone=zone)


def clean_incidents(
    df: DataFrame,
    *,
    first_year: int = V.FIRST_YEAR,
    excluded: Sequence[str] = V.COLLISION_TYPES,
    zone: int = V.UTM_ZONE,
    float32: bool = False,
) -> DataFrame:
    """Kept incidents with latitude and longitude instead of projected metres."""
    kept = keep_incidents(df, first_year=first_year, excluded=excluded)
    return locate_incidents(kept, zone=zone, float32=float32).drop("hour", "minute", "hundred_block", "x", "y")


def clean_listings(
    df: DataFrame,
    *,
    as_of: dt.date | None = None,
    max_nights: int = V.MAX_NIGHTS,
    recent_days: int = V.RECENT_DAYS,
) -> DataFrame:
    """Listings for stays of 1 to ``max_nights`` nights, reviewed less than ``recent_days`` before
    ``as_of`` (today if not given). A listing without a review drops."""
    today = F.lit(as_of) if as_of else F.current_date()
    return (
        df.filter(f"minimum_nights > 0 AND minimum_nights <= {int(max_nights)}")
        .filter(F.datediff(today, F.col("last_review")) < recent_days)
        .drop(
            "host_id", "host_name", "neighbourhood_group", "reviews_per_month",
            "calculated_host_listings_count", "availability_365", "number_of_reviews", "last_review",
        )
    )


def without_types(df: DataFrame, excluded: Sequence[str], col: str = "crime_type") -> DataFrame:
    """Rows of other types; a null type drops."""
    return df.filter(~F.col(col).isin(*excluded))
