"""Distances, projection and the spherical grid, all as native column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

EARTH_RADIUS_M = 6371000.0

# Extra reach of a grid search over the radius: covers the rounding of the arc-cosine, whose steps
# near zero are about a tenth of a metre.
_REACH_SHARE = 1e-3
_REACH_M = 0.1


def haversine_m(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance in metres between points given as columns or SQL expressions; well
    conditioned at every distance."""
    return F.expr(
        f"asin(sqrt(least(1D, power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2)))) * {2 * EARTH_RADIUS_M}D"
    )


def cosine_law_m(
    lat1: str, lon1: str, lat2: str, lon2: str, *, clamp: bool = True, scaled: bool = False
) -> Column:
    """Great-circle distance by the spherical law of cosines.

    ``clamp`` keeps the cosine at or below 1; without it rounding makes some coincident points NaN,
    which no radius test keeps. ``scaled`` multiplies the arc by 180/pi as the published figures do,
    so a limit of 500 there means 500/57.2958 = 8.73 metres.
    """
    cosine = (
        f"cos(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon1}) - radians({lon2}))"
        f" + sin(radians({lat1})) * sin(radians({lat2}))"
    )
    arc = f"acos(least(1D, {cosine}))" if clamp else f"acos({cosine})"
    return F.expr(f"{f'degrees({arc})' if scaled else arc} * {EARTH_RADIUS_M}D")


@dataclass(frozen=True)
class Distance:
    """A distance formula and the metres one of its units stands for."""

    formula: str = "haversine"
    clamp: bool = True

    def __post_init__(self) -> None:
        if self.formula not in ("haversine", "cosine", "scaled_degrees"):
            raise ValueError(f"unknown distance formula {self.formula!r}")

    @property
    def metres_per_unit(self) -> float:
        return math.pi / 180 if self.formula == "scaled_degrees" else 1.0

    def __call__(self, lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
        if self.formula == "haversine":
            return haversine_m(lat1, lon1, lat2, lon2)
        return cosine_law_m(
            lat1, lon1, lat2, lon2, clamp=self.clamp, scaled=self.formula == "scaled_degrees"
        )


def with_lat_lon_from_utm(
    df: DataFrame,
    x: str,
    y: str,
    *,
    lat: str = "latitude",
    lon: str = "longitude",
    zone: int = 10,
    south: bool = False,
) -> DataFrame:
    """Add latitude and longitude for UTM metres on the WGS84 ellipsoid.

    Inverse Krueger series to the third order in the third flattening (Karney 2011). Over a city
    the error is some nanodegrees; no projection library or Python worker is needed.
    """
    flattening = 1 / 298.257223563
    n = flattening / (2 - flattening)
    meridian = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96,
        n**2 / 48 + n**3 / 15,
        17 * n**3 / 480,
    )
    delta = (
        2 * n - 2 * n**2 / 3 - 2 * n**3,
        7 * n**2 / 3 - 8 * n**3 / 5,
        56 * n**3 / 15,
    )
    xi, eta, phi = "__xi0", "__eta0", "__chi"
    for j, b in enumerate(beta, start=1):
        xi += f" - {b!r}D * sin(__xi0 * {2 * j}) * cosh(__eta0 * {2 * j})"
        eta += f" - {b!r}D * cos(__xi0 * {2 * j}) * sinh(__eta0 * {2 * j})"
    for j, d in enumerate(delta, start=1):
        phi += f" + {d!r}D * sin(__chi * {2 * j})"
    lambda_ = f"degrees(atan2(sinh(__eta), cos(__xi))) + {6.0 * zone - 183.0}D"
    # Steps used more than once are columns of their own, which keeps each expression short. The
    # generator at the end stops later filters from being pushed down as a copy of the whole series.
    kept = [f"`{c}`" for c in df.columns if c not in (lat, lon)]
    return (
        df.selectExpr(
            "*",
            f"(`{y}` - {1e7 if south else 0.0}D) / {meridian!r}D AS __xi0",
            f"(`{x}` - 500000D) / {meridian!r}D AS __eta0",
        )
        .selectExpr("*", f"{xi} AS __xi", f"{eta} AS __eta")
        .selectExpr("*", "asin(sin(__xi) / cosh(__eta)) AS __chi")
        .selectExpr(*kept, f"inline(array(struct(degrees({phi}), {lambda_}))) AS (`{lat}`, `{lon}`)")
    )


@dataclass(frozen=True)
class SphereGrid:
    """Cells on the sphere for radius searches.

    Rows have a fixed height in degrees; each row is cut into the largest whole number of equal
    cells that are at least that height wide at the row's widest edge. Cells thus keep their size in
    metres at every latitude, the date line is just a wrap-around of the cell number, and a polar
    row has a single cell.
    """

    radius_m: float
    per_radius: int = 1

    @property
    def reach_deg(self) -> float:
        reach = self.radius_m * (1 + _REACH_SHARE) + _REACH_M
        return math.degrees(min(reach / EARTH_RADIUS_M, math.pi))

    @property
    def margin_m(self) -> float:
        return self.radius_m * _REACH_SHARE + _REACH_M

    @property
    def height(self) -> float:
        return min(self.reach_deg / self.per_radius, 180.0)

    @property
    def cell_m(self) -> float:
        return math.radians(self.height) * EARTH_RADIUS_M

    def _row(self, lat: str) -> str:
        return f"floor(({lat} + 90D) / {self.height!r}D)"

    def _cells_in_row(self, row: str) -> str:
        south = f"({row} * {self.height!r}D - 90D)"
        nearest_equator = f"least(90D, greatest(0D, {south}, -({south} + {self.height!r}D)))"
        return f"greatest(1L, floor(cos(radians({nearest_equator})) * {360.0 / self.height!r}D))"

    def add_cell(self, df: DataFrame, lat: str, lon: str, row: str, cell: str, *inside: str) -> DataFrame:
        """Add the cell every point lies in. Coordinates must not be null.

        ``inside`` may name two columns for the position in the cell, from 0 up to 1 northwards and
        eastwards. The numbers are declared as never null: a join on them then needs no null test,
        which the optimiser would push down to the scan as a copy of the expression.
        """
        kept = [f"`{c}`" for c in df.columns]
        position = f"({lon} + 180D) * __n / 360D"
        extra = []
        if inside:
            extra = [
                f"({lat} + 90D) / {self.height!r}D - {row} AS {inside[0]}",
                f"{position} - floor({position}) AS {inside[1]}",
            ]
        return (
            df.selectExpr("*", f"coalesce({self._row(lat)}, -1L) AS {row}")
            .selectExpr("*", f"{self._cells_in_row(row)} AS __n")
            .selectExpr(*kept, row, f"coalesce(pmod(floor({position}), __n), -1L) AS {cell}", *extra)
        )

    def _rows_in_reach(self, df: DataFrame, lat: str, row: str) -> DataFrame:
        reach = f"{self.reach_deg!r}D"
        sine = f"{math.sin(math.radians(min(self.reach_deg, 90.0)))!r}D"
        half = (
            f"if(abs({lat}) + {reach} >= 90D, 180D,"
            f" degrees(asin(least(1D, {sine} / cos(radians({lat}))))) + 1e-9D)"
        )
        rows = f"sequence({self._row(f'greatest(-90D, {lat} - {reach})')}, {self._row(f'least(90D, {lat} + {reach})')})"
        return df.selectExpr("*", f"{half} AS __half", f"explode({rows}) AS {row}").selectExpr(
            "*", f"{self._cells_in_row(row)} AS __n"
        )

    def explode_reach(self, df: DataFrame, lat: str, lon: str, row: str, cell: str) -> DataFrame:
        """One row per cell that the search circle's bounding box touches; no cell twice."""
        kept = [f"`{c}`" for c in df.columns]
        return (
            self._rows_in_reach(df, lat, row)
            .selectExpr(*kept, row, "__n", *self._ends(lon))
            .selectExpr("*", _CELL_RANGE)
            .selectExpr(*kept, row, f"coalesce(pmod(__u, __n), -1L) AS {cell}")
        )

    def _ends(self, lon: str) -> list[str]:
        return [
            f"floor(({lon} - __half + 180D) * __n / 360D) AS __first",
            f"floor(({lon} + __half + 180D) * __n / 360D) AS __last",
        ]

    def explode_bounded(self, df: DataFrame, lat: str, lon: str, row: str, cell: str) -> DataFrame:
        """``explode_reach`` with each cell's bounds.

        Adds ``__low`` and ``__high``, bounds of sin^2(d/2R) for the distances d from the point to
        the points of the cell, and the cell's shape for ``split_bounded``: its south edge and
        height, its west edge seen from the point and width, all in degrees, and whether the cells
        go all round the row (then one may be nearer the other way than its west edge says).
        """
        kept = [f"`{c}`" for c in df.columns]
        return (
            self._rows_in_reach(df, lat, row)
            .selectExpr("*", f"{row} * {self.height!r}D - 90D AS __south", f"{self.height!r}D AS __tall")
            .selectExpr(*kept, row, "__n", *self._ends(lon), "__south", "__tall", *_lat_terms(lat))
            .selectExpr("*", _CELL_RANGE)
            .selectExpr(
                "*", f"__u * 360D / __n - 180D - {lon} AS __west", "360D / __n AS __wide",
                "__last - __first + 1 >= __n AS __round",
            )
            .selectExpr(*kept, row, f"coalesce(pmod(__u, __n), -1L) AS {cell}", *_SHAPE, *_LON_TERMS)
        )

    @staticmethod
    def split_bounded(df: DataFrame, lat: str, up: str, along: str, *, parts: int) -> DataFrame:
        """Cells of ``explode_bounded`` cut into ``parts`` x ``parts``, with new bounds; ``up`` and
        ``along`` number the pieces within the original cell."""
        new = {*_SHAPE, up, along, "__low", "__high"}
        kept = [f"`{c}`" for c in df.columns if c not in new]
        return (
            df.selectExpr("*", f"explode(sequence(0L, {parts - 1}L)) AS __i")
            .selectExpr(
                *kept, f"{up} * {parts} + __i AS {up}", along, "__west", "__wide", "__round",
                f"__south + __i * __tall / {parts} AS __south", f"__tall / {parts} AS __tall",
            )
            .selectExpr("*", *_lat_terms(lat))
            .selectExpr("*", f"explode(sequence(0L, {parts - 1}L)) AS __j")
            .selectExpr(
                *kept, up, f"{along} * {parts} + __j AS {along}", "__south", "__tall", "__round",
                f"__west + __j * __wide / {parts} AS __west", f"__wide / {parts} AS __wide", *_LAT_COLUMNS,
            )
            .selectExpr(*kept, up, along, *_SHAPE, *_LON_TERMS)
        )


def _half_sine(angle: str) -> str:
    return f"power(sin(radians({angle}) / 2), 2)"


def _lat_terms(lat: str) -> list[str]:
    """What of a cell's bounds depends on its row alone."""
    north = "(__south + __tall)"
    cosines = f"cos(radians(__south)), cos(radians{north})"
    return [
        _half_sine(f"greatest(0D, __south - {lat}, {lat} - {north})") + " AS __lat_low",
        _half_sine(f"greatest({lat} - __south, {north} - {lat})") + " AS __lat_high",
        f"cos(radians({lat})) * greatest(0D, least({cosines})) AS __cos_low",
        f"cos(radians({lat})) * if(__south <= 0 AND {north} >= 0, 1D, greatest({cosines})) AS __cos_high",
    ]


_CELL_RANGE = "explode(sequence(__first, least(__last, __first + __n - 1))) AS __u"
_LAT_COLUMNS = ("__lat_low", "__lat_high", "__cos_low", "__cos_high")
_SHAPE = ("__south", "__tall", "__west", "__wide", "__round")
_LON_TERMS = (
    "__lat_low + __cos_low * "
    + _half_sine("if(__round, 0D, greatest(0D, __west, -__west - __wide))") + " AS __low",
    "__lat_high + __cos_high * " + _half_sine("least(180D, greatest(-__west, __west + __wide))") + " AS __high",
)
