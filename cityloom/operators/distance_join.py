"""Pairs of points within a radius, and counts of such pairs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.geo import EARTH_RADIUS_M, Distance, SphereGrid
from ..session import materialise_bucketed, materialise_counted
from .skew import salted_sides

_BLOCK, _ROW, _CELL = "__block", "__row", "__cell"


def _keys(block: str | None) -> list[str]:
    return ([_BLOCK] if block else []) + [_ROW, _CELL]


def _located(df: DataFrame, lat: str, lon: str, block: str | None) -> DataFrame:
    """Drop points that can match nothing: no coordinates, or no block when blocks must agree."""
    df = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if block:
        df = df.filter(F.col(block).isNotNull()).withColumn(_BLOCK, F.col(block).cast("string"))
    return df


def distance_join(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    *,
    left_coords: tuple[str, str] = ("lat", "lon"),
    right_coords: tuple[str, str] = ("latitude", "longitude"),
    block: str | None = "neighbourhood",
    distance: Distance = Distance(),
    output: str = "distance_in_meters",
    packed: bool = False,
) -> DataFrame:
    """All pairs at most ``radius`` apart, with their distance.

    ``block`` names a column both sides must share (null matches nothing); ``None`` compares by
    radius alone. Give the smaller side as ``left``: it is repeated over the cells its circle
    touches, about nine, while every right row goes to one cell, so no pair shows up twice. The
    equi-join on the cell prunes, the exact distance decides. Cells in which many rows meet many are
    split over tasks on both sides. Apart from the block the columns of the two sides must have
    different names.

    ``packed`` pairs come in pieces of ``PACK_PAIRS`` sorted by their distance, for results that are written: a column of
    unsorted distances takes more of a Parquet file than all else of a pair, one of sorted distances next to nothing.
    Pairs are then formed in Arrow batches, in memory that follows the piece; the exact distance still decides. Only the
    columns that are wanted should be given.
    """
    spread, repeated, on, columns, total = _sides(left, right, radius, left_coords, right_coords, block, distance)
    if packed:
        radius_m = radius * distance.metres_per_unit
        # Without clamping some pairs have no distance, however near they are.
        pairer = _pairer(
            on, [*left.columns], [c for c in columns if c not in left.columns], left_coords, right_coords,
            radius_m, _margin(SphereGrid(radius_m), distance), distance.clamp,
        )
        fields = {f.name: f for f in [*repeated.schema.fields, *spread.schema.fields]}
        made = T.StructType([T.StructField(c, fields[c].dataType) for c in columns]).add("__sure", T.BooleanType())
        sides = repeated.withColumn("__left", F.lit(True)).unionByName(spread.withColumn("__left", F.lit(False)), allowMissingColumns=True)
        pairs = sides.withColumn("__task", _task(on, total)).groupBy("__task").applyInArrow(pairer, made)
        gap = distance(*right_coords, *left_coords)
        return pairs.filter(F.col("__sure") | (gap <= radius)).select(*columns, gap.alias(output))
    return (
        # The exploded side is many times what Spark takes it for by its file, so it must not be broadcast.
        spread.join(repeated.hint("merge"), on)
        .withColumn(output, distance(*right_coords, *left_coords))
        .filter(F.col(output) <= radius)
        .select(*columns, output)
    )


def _sides(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    left_coords: tuple[str, str],
    right_coords: tuple[str, str],
    block: str | None,
    distance: Distance,
) -> tuple[DataFrame, DataFrame, list[str], list[str], int]:
    """The right side's points, the left side's rows in every cell they reach, the columns they meet on, those of a
    pair, and the rows of both sides, about."""
    shared = set(left.columns) & set(right.columns) - {block}
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    grid = SphereGrid(radius * distance.metres_per_unit)
    points = grid.add_cell(_located(right, *right_coords, block), *right_coords, _ROW, _CELL)
    if block:
        points = points.drop(block)
    # Both sides are located once; counts per cell and the join read what was written.
    keys = _keys(block)
    points, n_points = materialise_counted(points, "join-points")
    places, n_places = materialise_counted(_located(left, *left_coords, block), "join-places")
    near = grid.explode_reach(places, *left_coords, _ROW, _CELL)

    def per_cell(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias("__rows"))

    total = n_points + 9 * n_places
    spread, repeated, on = salted_sides(points, near, keys, per_cell(points), per_cell(near), total)
    return spread, repeated, on, [*left.columns, *(c for c in right.columns if c != block)], total


@dataclass(frozen=True)
class RadiusLayout:
    """Both sides of a radius join as written files, bucketed by block, cell and part of a hot cell: joins on them need
    no exchange and no count, for any radius up to the one they were laid out for."""

    points: DataFrame
    near: DataFrame
    on: tuple[str, ...]
    columns: tuple[str, ...]
    left_coords: tuple[str, str]
    right_coords: tuple[str, str]
    radius: float
    distance: Distance

    def pairs(self, radius: float | None = None, *, output: str = "distance_in_meters") -> DataFrame:
        """All pairs at most ``radius`` apart (by default the layout's), with their distance."""
        radius = self.radius if radius is None else radius
        if radius > self.radius:
            raise ValueError(f"laid out for at most {self.radius}")
        joined = self.points.join(self.near.hint("merge"), list(self.on))
        gap = self.distance(*self.right_coords, *self.left_coords)
        return joined.withColumn(output, gap).filter(F.col(output) <= radius).select(*self.columns, output)

    def counts(self, by: Sequence[str], radius: float | None = None, output: str = "n") -> DataFrame:
        """Number of pairs per group."""
        return self.pairs(radius, output="__gap").groupBy(*by).agg(F.count("*").alias(output))


def lay_out(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    *,
    left_coords: tuple[str, str] = ("lat", "lon"),
    right_coords: tuple[str, str] = ("latitude", "longitude"),
    block: str | None = "neighbourhood",
    distance: Distance = Distance(),
) -> RadiusLayout:
    """Write both sides of ``distance_join`` so that it can be run many times. The cells are those of ``radius``; a much
    smaller radius compares more pairs than its own layout would. Arguments are those of ``distance_join``."""
    spread, repeated, on, columns, _ = _sides(left, right, radius, left_coords, right_coords, block, distance)
    return RadiusLayout(
        materialise_bucketed(spread, on, "layout-points"), materialise_bucketed(repeated, on, "layout-near"), tuple(on),
        tuple(columns), left_coords, right_coords, radius, distance,
    )


# Points of a cell that are compared one by one if there are no more; of more, boxes of a quarter as many are formed, and
# only those that the circle's edge may cross are opened. A task takes about TASK_POINTS rows of both sides.
MAX_COMPARED = 256
TASK_POINTS = 100_000
# Tasks of a count at least; small ones are put together.
LEAST_TASKS = 32
# Settled by the counter's own arithmetic are pairs farther than this from the radius; the others go through the formula.
_SURE_M = 1e-4
# Packed pairs are sorted so many at a time, in about 30 bytes each, and found in so many comparisons at a time.
PACK_PAIRS = 4_000_000
PACK_CELLS = 1_000_000


def _margin(grid: SphereGrid, distance: Distance) -> float:
    return min(_SURE_M, grid.margin_m) if distance.formula == "haversine" else grid.margin_m


def _task(on: list[str], total: int) -> Column:
    """The task in which rows that share ``on`` meet."""
    return F.pmod(F.xxhash64(*on), F.lit(max(LEAST_TASKS, math.ceil(total / TASK_POINTS)))).cast("int")


def _arrays() -> tuple[Callable, Callable, Callable, Callable]:
    """Array arithmetic on Arrow columns, as functions that go to the workers with what calls them."""
    earth = EARTH_RADIUS_M

    def chord(metres: float) -> float:
        """The square of the chord on the unit sphere."""
        return 4 * math.sin(min(metres / earth, math.pi) / 2) ** 2 if metres >= 0 else -1.0

    def sphere(lat: pa.ChunkedArray, lon: pa.ChunkedArray) -> np.ndarray:
        y, x = np.radians(lat.to_numpy()), np.radians(lon.to_numpy())
        return np.stack([np.cos(y) * np.cos(x), np.cos(y) * np.sin(x), np.sin(y)], axis=1)

    def codes(columns: list[pa.ChunkedArray]) -> np.ndarray:
        """A number for each row; rows have the same if and only if they agree in all columns."""
        code = np.zeros(len(columns[0]) if columns else 0, np.int64)
        for column in columns:
            values = column.combine_chunks()
            if pa.types.is_nested(values.type):
                values = pa.array([repr(v) for v in values.to_pylist()], pa.string())
            one = values.dictionary_encode(null_encoding="encode").indices.to_numpy()
            code = np.unique(code * (int(one.max(initial=0)) + 1) + one, return_inverse=True)[1]
        return code

    def runs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(np.diff(code, prepend=-1))
        return at, np.append(at[1:], len(code))

    return chord, sphere, codes, runs


def _pairer(
    keys: list[str], l_names: list[str], r_names: list[str], left_coords: tuple[str, str], right_coords: tuple[str, str],
    radius_m: float, margin_m: float, sure: bool,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Forms the pairs of left and right rows that share ``keys`` and may be within the radius, sorted by distance in
    pieces. ``__sure`` are those that need no exact distance to tell, if ``sure`` says that there are such."""
    chord, sphere, codes, runs = _arrays()
    least, beyond = chord(radius_m - margin_m) if sure else -1.0, chord(radius_m + margin_m)
    if radius_m + margin_m >= math.pi * EARTH_RADIUS_M:
        beyond = math.inf
    piece, cells = PACK_PAIRS, PACK_CELLS

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches([*batches]).combine_chunks()
        key, is_left = codes([rows[k] for k in keys]), rows["__left"].to_numpy()
        sides = []
        for side, names, coords in ((is_left, l_names, left_coords), (~is_left, r_names, right_coords)):
            at = np.flatnonzero(side)
            table = rows.select(names).take(pa.array(at))
            w = sphere(*(table[c].cast(pa.float64()) for c in coords))
            # Coordinates that are no numbers are near nothing.
            order = np.flatnonzero(np.isfinite(w).all(axis=1))
            order = order[np.argsort(key[at][order], kind="stable")]
            sides.append((table, w, order.astype(np.int32), key[at][order], *runs(key[at][order])))
        (left, u, order1, key1, at1, end1), (right, v, order2, key2, at2, end2) = sides
        held, n = [], 0
        _, i, j = np.intersect1d(key1[at1], key2[at2], assume_unique=True, return_indices=True)
        for x, y in zip(i, j, strict=True):
            p, q = order1[at1[x] : end1[x]], order2[at2[y] : end2[y]]
            a, b = u[p] - v[q[0]], v[q] - v[q[0]]
            slack = 1e-13 * (float((a * a).sum(axis=1).max()) + float((b * b).sum(axis=1).max()))
            left_side = np.concatenate([a, (a * a).sum(axis=1)[:, None], np.ones((len(p), 1))], axis=1)
            right_side = np.concatenate([-2 * b.T, np.ones((1, len(q))), (b * b).sum(axis=1)[None]])
            tall = max(1, cells // min(len(q), cells))
            for c in range(0, len(p), tall):
                for e in range(0, len(q), cells):
                    wide = right_side[:, e : e + cells]
                    d = (left_side[c : c + tall] @ wide).ravel()
                    near = np.flatnonzero(d <= beyond + slack)
                    d = d[near]
                    held.append((p[c + near // wide.shape[1]], q[e + near % wide.shape[1]], d.astype(np.float32), d <= least - slack))
                    n += len(near)
                    if n >= piece:
                        yield from sorted_piece(left, right, held)
                        n = 0
        if n:
            yield from sorted_piece(left, right, held)

    def sorted_piece(left: pa.Table, right: pa.Table, held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        p, q, d, is_sure = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        # Bits of numbers that are not negative are in the numbers' order, and whole numbers are sorted the fastest.
        by = np.maximum(d, np.float32(0)).view(np.uint32).astype(np.uint64)
        by <<= np.uint64(32)
        by |= np.arange(len(d), dtype=np.uint64)
        by.sort()
        order = by.astype(np.uint32)
        for c in range(0, len(order), 100_000):
            some = order[c : c + 100_000]
            made = {k: t[k].take(pa.array(at[some])) for t, names, at in ((left, l_names, p), (right, r_names, q)) for k in names}
            made["__sure"] = pa.array(is_sure[some])
            yield from pa.table(made).combine_chunks().to_batches()

    return pairs


def _counter(
    keys: list[str], l_by: list[str], r_by: list[str], output: str, radius_m: float, margin_m: float, per_radius: int
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Counts pairs of places and points that share ``keys``: weights of pairs within the radius per group, and the pairs
    too close to it to tell, with their coordinates. Distances are chords between points on the unit sphere."""
    chord, sphere, codes, runs = _arrays()
    most, cells, earth = max(1, MAX_COMPARED // 4), 1_000_000, EARTH_RADIUS_M
    crowd = MAX_COMPARED
    least = chord(radius_m - margin_m)
    beyond = chord(radius_m + margin_m) if (radius_m + margin_m) / earth < math.pi else math.inf

    def boxed(a: np.ndarray, b: np.ndarray, pieces: int) -> np.ndarray:
        """Numbers of the pieces of a grid over both coordinates."""
        number = np.zeros(len(a), np.int64)
        for v in (a, b):
            low, high = v.min(), v.max()
            at = np.floor((v - low) * (pieces / (high - low))) if high > low else np.zeros(len(v))
            number = number * pieces + np.minimum(at, pieces - 1).astype(np.int64)
        return number

    def edges(at: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.minimum.reduceat(v, at, axis=0), np.maximum.reduceat(v, at, axis=0)

    def count(places: pa.Table, points: pa.Table) -> pa.Table:
        n1, n2 = places["__n1"].to_numpy(), points["__n2"].to_numpy()
        u, v = sphere(places["__lat1"], places["__lon1"]), sphere(points["__lat2"], points["__lon2"])
        both = codes([pa.chunked_array([*places[k].chunks, *points[k].chunks], places.schema.field(k).type) for k in keys])
        key1, key2 = both[: len(places)], both[len(places) :]
        left = codes([places[c] for c in l_by]) if l_by else np.zeros(len(places), np.int64)
        right = codes([points[c] for c in r_by]) if r_by else np.zeros(len(points), np.int64)
        n_right = int(right.max(initial=0)) + 1
        # Coordinates that are no numbers are near nothing.
        order1, order2 = (np.flatnonzero(np.isfinite(w).all(axis=1)) for w in (u, v))
        order1, order2 = order1[np.argsort(key1[order1], kind="stable")], order2[np.argsort(key2[order2], kind="stable")]
        groups, weights, unsure, pending = [], [], [], 0

        def add(group: np.ndarray, weight: np.ndarray) -> None:
            nonlocal groups, weights, pending
            groups.append(group)
            weights.append(weight)
            pending += len(group)
            if pending > 2 * cells:
                groups, weights = ([x] for x in summed())
                pending = len(groups[0]) // 2

        def summed() -> tuple[np.ndarray, np.ndarray]:
            group, weight = np.concatenate([np.empty(0, np.int64), *groups]), np.concatenate([np.empty(0, np.int64), *weights])
            order = np.argsort(group, kind="stable")
            group, weight = group[order], weight[order]
            at = np.flatnonzero(np.diff(group, prepend=-1))
            return group[at], np.add.reduceat(weight, at) if len(at) else weight

        def meet(p: np.ndarray, q: np.ndarray) -> None:
            """Count the pairs of places ``p`` and points ``q``, which lie in one cell."""
            middle = v[q[0]]
            b = v[q] - middle
            kinds, kind = np.unique(right[q], return_inverse=True)
            few = len(kinds) <= 64
            share = np.zeros((len(q), len(kinds) if few else 0))
            if few:
                share[np.arange(len(q)), kind] = n2[q]
            crowded = len(q) > crowd
            if crowded:
                pieces = min(32, max(per_radius, math.ceil(math.sqrt(len(q) / most))))
                box = boxed(up[q], along[q], pieces)
                by = np.argsort(box, kind="stable")
                q, b, share, box = q[by], b[by], share[by], box[by]
                at, end = runs(box)
                low, high = edges(at, b)
                totals, size = np.add.reduceat(share, at, axis=0), end - at
                place_box = boxed(lat1[p], lon1[p], min(64, math.ceil(math.sqrt(len(p) / most))))
                by = np.argsort(place_box, kind="stable")
                p, starts = p[by], list(zip(*runs(place_box[by]), strict=True))
            else:
                starts = [(0, len(p))]
            a = u[p] - middle
            slack = 1e-13 * (float((a * a).sum(axis=1).max()) + float((b * b).sum(axis=1).max()))
            sure, out = least - slack, beyond + slack
            right_side = np.concatenate([-2 * b.T, np.ones((1, len(q))), (b * b).sum(axis=1)[None]])
            left_side = np.concatenate([a, (a * a).sum(axis=1)[:, None], np.ones((len(p), 1))], axis=1)
            for i, j in starts:
                found = np.zeros((j - i, share.shape[1]))
                opened = np.arange(len(q))
                if crowded:
                    south, north = a[i:j].min(axis=0), a[i:j].max(axis=0)
                    near = (np.maximum(0, np.maximum(low - north, south - high)) ** 2).sum(axis=1)
                    touched = near <= out
                    if few:
                        whole = (np.maximum(high - south, north - low) ** 2).sum(axis=1) <= sure
                        found += totals[whole].sum(axis=0)
                        touched &= ~whole
                    opened = np.flatnonzero(np.repeat(touched, size))
                side, held = right_side[:, opened], share[opened]
                for c in range(i, j if len(opened) else i, max(1, cells // max(1, len(opened)))):
                    d = left_side[c : min(j, c + max(1, cells // len(opened)))] @ side
                    inside = d <= sure
                    if few:
                        found[c - i : c - i + len(d)] += inside.astype(np.float64) @ held
                    else:
                        x, y = np.nonzero(inside)
                        x, y = p[c + x], q[opened[y]]
                        add(left[x] * n_right + right[y], n1[x] * n2[y])
                    close = d <= out
                    if np.count_nonzero(close) != np.count_nonzero(inside):
                        x, y = np.nonzero(close & ~inside)
                        unsure.append((p[c + x], q[opened[y]]))
                if few:
                    x, y = np.nonzero(found)
                    add(left[p[i + x]] * n_right + kinds[y], found[x, y].astype(np.int64) * n1[p[i + x]])

        lat1, lon1 = places["__lat1"].to_numpy(), places["__lon1"].to_numpy()
        up, along = points["__up"].to_numpy(), points["__along"].to_numpy()
        at1, end1 = runs(key1[order1])
        at2, end2 = runs(key2[order2])
        _, i, j = np.intersect1d(key1[order1][at1], key2[order2][at2], assume_unique=True, return_indices=True)
        for x, y in zip(i, j, strict=True):
            meet(order1[at1[x] : end1[x]], order2[at2[y] : end2[y]])
        group, weight = summed()
        of_left, of_right = np.zeros(int(left.max(initial=0)) + 1, np.int64), np.zeros(n_right, np.int64)
        of_left[left], of_right[right] = np.arange(len(left)), np.arange(len(right))
        p = np.concatenate([of_left[group // n_right], *(x for x, _ in unsure)])
        q = np.concatenate([of_right[group % n_right], *(y for _, y in unsure)])
        weight = np.concatenate([weight, n1[p[len(group) :]] * n2[q[len(group) :]]])
        known = np.arange(len(p)) < len(group)
        made = {c: t[c].take(pa.array(at)) for t, names, at in ((places, l_by, p), (points, r_by, q)) for c in names}
        made[output] = pa.array(weight, pa.int64())
        for t, names, at in ((places, ("__lat1", "__lon1"), p), (points, ("__lat2", "__lon2"), q)):
            for c in names:
                made[c] = pa.array(t[c].to_numpy()[at], pa.float64(), mask=known)
        return pa.table(made)

    return count


def count_within(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    *,
    left_by: Sequence[str],
    right_by: Sequence[str] = (),
    left_coords: tuple[str, str] = ("lat", "lon"),
    right_coords: tuple[str, str] = ("latitude", "longitude"),
    block: str | None = "neighbourhood",
    distance: Distance = Distance(),
    per_radius: int = 3,
    output: str = "n",
) -> DataFrame:
    """``distance_join(...).groupBy(*left_by, *right_by).count()`` without forming most pairs.

    Points of one place and group are first collapsed to one row with a weight. Cells are as large as the radius, so a
    place meets about nine; both sides are dealt to tasks by cell, and cells in which many rows meet many are cut on
    both sides. There, points of a crowded cell are put into boxes, at least ``per_radius`` a side: a box that lies
    inside the circles of all places of a box as a whole adds its total, one that the edge of a circle may cross is
    compared point by point. What is shuffled thus follows the rows of both sides, whatever the number of pairs. Array
    arithmetic decides pairs that are clearly nearer or farther than the radius; the few others are handed to the
    exact formula.
    """
    if not distance.clamp:
        raise ValueError("counting by cell needs the clamped distance; join and group instead")
    radius_m = radius * distance.metres_per_unit
    grid = SphereGrid(radius_m)
    block_by = [_BLOCK] if block else []
    l_by = {c: f"__l_{c}" for c in left_by}
    r_by = {c: f"__r_{c}" for c in right_by}

    def collapse(df: DataFrame, coords: tuple[str, str], by: dict[str, str], names: tuple[str, str, str]):
        return (
            _located(df, *coords, block)
            .groupBy(
                *block_by, F.col(coords[0]).cast("double").alias(names[0]), F.col(coords[1]).cast("double").alias(names[1]),
                *(F.col(c).alias(a) for c, a in by.items()),
            )
            .agg(F.count("*").alias(names[2]))
        )

    keys = _keys(block)
    points = collapse(right, right_coords, r_by, ("__lat2", "__lon2", "__n2"))
    points = grid.add_cell(points, "__lat2", "__lon2", _ROW, _CELL, "__up", "__along")
    points, n_points = materialise_counted(points, "count-points")
    places, n_places = materialise_counted(collapse(left, left_coords, l_by, ("__lat1", "__lon1", "__n1")), "count-places")
    near = grid.explode_reach(places, "__lat1", "__lon1", _ROW, _CELL)

    def per_cell(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias("__rows"))

    total = n_points + 9 * n_places
    spread, repeated, on = salted_sides(points, near, keys, per_cell(points), per_cell(near), total)
    part, margin_m = _task(on, total), _margin(grid, distance)
    counter = _counter(on, list(l_by.values()), list(r_by.values()), output, radius_m, margin_m, per_radius)
    coordinates = ("__lat1", "__lon1", "__lat2", "__lon2")
    asked = repeated.withColumn("__task", part).groupBy("__task")
    made = T.StructType(
        [f for f in places.schema.fields if f.name in l_by.values()] + [f for f in points.schema.fields if f.name in r_by.values()]
    ).add(output, T.LongType())
    for c in coordinates:
        made = made.add(c, T.DoubleType())
    counted = asked.cogroup(spread.withColumn("__task", part).groupBy("__task")).applyInArrow(counter, made)
    counted = counted.filter(F.col("__lat1").isNull() | (distance("__lat2", "__lon2", "__lat1", "__lon1") <= radius))
    names = [F.col(a).alias(c) for c, a in {**l_by, **r_by}.items()]
    return counted.groupBy(*names).agg(F.sum(output).alias(output))


def summarise_pairs(per_place: DataFrame, n: str = "n", *, approximate: bool = False) -> DataFrame:
    """One row: pairs, and distinct amenity kinds, amenities and categories among them.

    Takes the pair counts per (amnt_id, amenity, category), so the distinct counts run over places,
    never over pairs. Written in SQL over the frame itself: nothing is registered. ``approximate`` counts
    distinct values by HyperLogLog, within about 5 %, in memory that does not grow with them.
    """
    distinct = "approx_count_distinct({})" if approximate else "count(DISTINCT {})"
    return per_place.sparkSession.sql(
        f"""
        SELECT coalesce(sum({n}), 0) AS num_rows,
               {distinct.format("amenity")} AS distinct_amnt_types,
               {distinct.format("amnt_id")} AS distinct_amnt_id,
               {distinct.format("category")} AS dist_amnt_cat
        FROM {{places}}
        """,
        places=per_place,
    )
