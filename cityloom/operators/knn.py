"""Exact k-nearest-neighbour join in the plane, and labelling by majority vote."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window, functions as F, types as T

from ..functions.geo import SphereGrid, haversine_m
from ..session import materialise
from .skew import salted_join

# The tree splits a square until a leaf has about LEAF_ROWS points, or until there are MAX_LEAVES leaves; it is shaped
# on SAMPLE_ROWS points. A task takes about TASK_VISITS queries of a leaf, CHUNK_QUERIES next to each other at a time,
# and looks at the leaf's points in blocks.
LEAF_ROWS, MAX_LEAVES, SAMPLE_ROWS = 64, 4_096, 100_000
TASK_VISITS, CHUNK_QUERIES, BLOCK_ROWS = 100_000, 32, 16
_BITS = 30
_ROW, _PLACE = "__query", ["__qy", "__qx"]


def _coder(x0: float, y0: float, side: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Numbers points in Z-order: the square is halved ``_BITS`` times a side, and the binary digits of a cell's column and
    row are put between each other."""
    bits = _BITS

    def codes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        code = np.zeros(len(x), np.int64)
        for v, origin, shift in ((x, x0, 1), (y, y0, 0)):
            cell = np.clip(np.floor((v - origin) * (2.0**bits / side)), 0, 2**bits - 1).astype(np.int64)
            for i in range(bits):
                code |= (cell >> i & 1) << (2 * i + shift)
        return code

    return codes


def _split(x0: float, y0: float, side: float, codes: np.ndarray, most: float) -> list[tuple[int, tuple]]:
    """Leaves (first code; west, east, south and north edge) of a quad tree over sorted codes, in order: a cell is
    quartered while it holds more than ``most``; quarters of one cell next to each other that together hold no more stay
    one leaf."""

    def cell(code: int, west: float, south: float, bits: int, low: int, high: int) -> list[tuple[int, tuple, int]]:
        width = side / 2 ** (_BITS - bits)
        if high - low <= most or bits == 0:
            return [(code, (west, west + width, south, south + width), high - low)]
        size, leaves, last_small = 4 ** (bits - 1), [], False
        ends = [low, *np.searchsorted(codes[low:high], [code + size * i for i in (1, 2, 3)]) + low, high]
        for i in range(4):
            at = (west + (i >> 1) * width / 2, south + (i & 1) * width / 2)
            below = cell(code + size * i, *at, bits - 1, int(ends[i]), int(ends[i + 1]))
            small = len(below) == 1
            if last_small and small and leaves[-1][2] + below[0][2] <= most:
                (first, a, n), (_, b, m) = leaves.pop(), below[0]
                below = [(first, (min(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), max(a[3], b[3])), n + m)]
            last_small = small
            leaves += below
        return leaves

    return [(code, edges) for code, edges, _ in cell(0, x0, y0, _BITS, 0, len(codes))]


def _observed(df: DataFrame, y: str, x: str, label: str) -> tuple[DataFrame, dict]:
    """``df`` written, with the box of its points and their number."""
    seen = Observation()
    some = F.col(y).isNotNull() & F.col(x).isNotNull()
    box = [f(F.col(c)).alias(n) for f, c, n in ((F.min, x, "x0"), (F.max, x, "x1"), (F.min, y, "y0"), (F.max, y, "y1"))]
    made = materialise(df.observe(seen, F.count_if(some).alias("n"), *box), label)
    return made, seen.get


def _candidates(box: np.ndarray, n: np.ndarray, regions: np.ndarray, wanted: int, slack: float) -> tuple[np.ndarray, list]:
    """For each region, a bound for the squared distance of the ``wanted`` nearest points of any place in it, and the
    leaves that can hold one of them: going outwards by the farthest two points can be apart, so many points are there.
    ``box`` has least and largest y, least and largest x of each leaf, ``n`` its rows."""
    held = np.flatnonzero(n)
    y0, y1, x0, x1 = box[:, held]
    bounds, near_leaves = np.empty(len(regions)), []
    for i, (west, east, south, north) in enumerate(regions + np.array([-slack, slack, -slack, slack])):
        near = np.maximum(0, np.maximum(x0 - east, west - x1)) ** 2 + np.maximum(0, np.maximum(y0 - north, south - y1)) ** 2
        far = np.maximum(east - x0, x1 - west) ** 2 + np.maximum(north - y0, y1 - south) ** 2
        order = np.argsort(far, kind="stable")
        bounds[i] = far[order][np.searchsorted(np.cumsum(n[held][order]), wanted)] * (1 + 1e-9)
        near_leaves.append(held[near <= bounds[i]])
    return bounds, near_leaves


def _nearest(
    queries: DataFrame, asked: dict, train: DataFrame, k: int, carry: tuple[str, ...], metric: str = "plane"
) -> DataFrame:
    """(__query, __qy, __qx, __rank, __id, *carry, __d) for queries (__query, __qy, __qx), their box and number ``asked``, and
    training points (__id, __y, __x, *carry)."""
    # Only the k smallest ids of a place can win a tie, so a place with many rows keeps k.
    same = Window.partitionBy("__y", "__x").orderBy("__id")
    train = train.withColumn("__at", F.row_number().over(same)).filter(F.col("__at") <= k).drop("__at")
    train, size = _observed(train, "__y", "__x", "knn-train")
    queries = queries.filter("__qy IS NOT NULL AND __qx IS NOT NULL").select(_ROW, *_PLACE)
    if not size["n"] or not asked["n"]:
        return _ranked(queries.join(train, F.lit(False)).withColumn("__d", F.lit(0.0)), k)
    low = {c: min(b[c] for b in (size, asked)) for c in ("x0", "y0")}
    side = max(max(b[f"{c}1"] for b in (size, asked)) - low[f"{c}0"] for c in "xy") * (1 + 1e-9) + 1e-9
    square = (low["x0"], low["y0"], side)
    n, m, wanted = size["n"], asked["n"], min(k, size["n"])

    def sampled(df: DataFrame, rows: int, y: str, x: str) -> np.ndarray:
        share = min(1.0, SAMPLE_ROWS / rows)
        points = (df.sample(fraction=share, seed=7) if share < 1 else df).select(y, x).toArrow()
        return np.sort(_coder(*square)(points[x].to_numpy(), points[y].to_numpy()))

    # At most about SAMPLE_ROWS points of a side; they shape the tree, results don't depend on them.
    codes = sampled(train, n, "__y", "__x")
    most = max(1.0, LEAF_ROWS * len(codes) / n)
    leaves = _split(*square, codes, most)
    while len(leaves) > MAX_LEAVES:
        most *= 1.5
        leaves = _split(*square, codes, most)
    starts = np.array([code for code, _ in leaves])
    spark, coder = train.sparkSession, _coder(*square)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = coder(batch.column("__x").to_numpy(), batch.column("__y").to_numpy())
            leaf = np.searchsorted(starts, code, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32()), pa.array(code)], [*batch.schema.names, "leaf", "code"])

    placed = T.StructType([*train.schema.fields]).add("leaf", T.IntegerType()).add("code", T.LongType())
    points = materialise(train.mapInArrow(place, placed), "knn-leaves")
    sums = points.groupBy("leaf").agg(F.min("__y"), F.max("__y"), F.min("__x"), F.max("__x"), F.count("*"))
    box, rows = np.zeros((4, len(leaves))), np.zeros(len(leaves), np.int64)
    for leaf, *edges, count in sums.collect():  # one row per leaf
        box[:, leaf], rows[leaf] = edges, count
    bounds, near_leaves = _candidates(box, rows, np.array([edges for _, edges in leaves]), wanted, 4 * side / 2**_BITS)
    # How many queries a leaf gets is guessed from a sample; leaves with many are split over tasks.
    of_sample = np.searchsorted(starts, sampled(queries, m, *_PLACE), side="right") - 1
    homes = np.bincount(of_sample, minlength=len(starts)) * (m / max(len(of_sample), 1))
    visits = np.zeros(len(starts))
    for home, near in zip(homes, near_leaves, strict=True):
        visits[near] += home
    parts = np.ceil(np.maximum(visits, 1) / TASK_VISITS).astype(np.int32)
    first = np.concatenate(([0], np.cumsum([len(x) for x in near_leaves])))
    shared = spark.sparkContext.broadcast((starts, bounds, np.concatenate(near_leaves), first, box, rows, parts))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, bounds, near, first, box, rows, parts = shared.value
        for batch in batches:
            for i in range(0, len(batch), 4_096):
                part = batch.slice(i, 4_096)
                qy, qx = (part.column(c).to_numpy() for c in ("__qy", "__qx"))
                home = np.searchsorted(starts, coder(qx, qy), side="right") - 1
                each = first[home + 1] - first[home]
                begin = np.concatenate(([0], np.cumsum(each)))
                q = np.repeat(np.arange(len(home)), each)
                leaf = near[np.arange(begin[-1]) - begin[q] + first[home][q]]
                y0, y1, x0, x1 = box[:, leaf]
                far = np.maximum(qy[q] - y0, y1 - qy[q]) ** 2 + np.maximum(qx[q] - x0, x1 - qx[q]) ** 2
                limit = np.minimum.reduceat(np.where(rows[leaf] >= wanted, far, np.inf), begin[:-1])
                limit = np.minimum(limit, bounds[home])
                apart = np.maximum(0, np.maximum(y0 - qy[q], qy[q] - y1)) ** 2 + np.maximum(0, np.maximum(x0 - qx[q], qx[q] - x1)) ** 2
                kept = np.flatnonzero(apart <= limit[q])
                q, leaf = q[kept], leaf[kept]
                some = part.take(pa.array(q))
                share = (some.column("__query").to_numpy() * 2654435761 >> 16) % parts[leaf]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(limit[q]), pa.array(leaf, pa.int32()), pa.array(share, pa.int32())],
                    [*some.schema.names, "limit", "leaf", "part"],
                )

    visiting = queries.mapInArrow(route, f"{_ROW} long, __qy double, __qx double, limit double, leaf int, part int")
    split = F.array(*(F.struct(F.lit(int(i)).alias("leaf"), F.lit(int(parts[i])).alias("parts")) for i in np.flatnonzero(parts > 1)))
    held = points
    if (parts > 1).any():
        of = F.filter(split, lambda s: s["leaf"] == F.col("leaf"))
        held = points.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce(F.get(of, 0)["parts"], F.lit(1)) - 1)))
    else:
        held = points.withColumn("part", F.lit(0))
    block_rows, some_queries, cells, out = BLOCK_ROWS, CHUNK_QUERIES, 1_000_000, [f.name for f in train.schema.fields]

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        held = held.sort_by("code")
        y, x = held["__y"].to_numpy(), held["__x"].to_numpy()
        order = np.empty(len(held), np.int64)
        order[pc.sort_indices(held["__id"]).to_numpy()] = np.arange(len(held))
        at = np.arange(0, len(held), block_rows)
        size = np.diff(np.append(at, len(held)))
        y0, y1, x0, x1 = [f.reduceat(v, at) for v in (y, x) for f in (np.minimum, np.maximum)] if len(at) else [None] * 4
        qy, qx, limit = (asked[c].to_numpy() for c in ("__qy", "__qx", "limit"))
        # Queries next to each other are asked together, so that they share the blocks they open.
        near_by = np.argsort(coder(qx, qy), kind="stable")
        whose, which, gaps = [], [], []

        def squared(q: np.ndarray, p: np.ndarray) -> np.ndarray:
            dy, dx = qy[q, None] - y[p], qx[q, None] - x[p]
            return dy * dy + dx * dx

        def nearest(q: np.ndarray, p: np.ndarray) -> None:
            """The ``k`` nearest of points ``p`` for each of the queries ``q``, ties to the smaller id."""
            for j in range(0, len(q), max(1, cells // len(p))):
                part = q[j : j + max(1, cells // len(p))]
                d = squared(part, p)
                top = limit[part]
                if len(p) > k:
                    top = np.minimum(top, np.partition(d, k - 1, axis=1)[:, k - 1])
                row, col = np.nonzero(d <= top[:, None])
                gap, point = d[row, col], p[col]
                by = np.lexsort((order[point], gap, row))
                row, gap, point = row[by], gap[by], point[by]
                best = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row) < k)
                whose.append(part[row[best]])
                which.append(point[best])
                gaps.append(gap[best])

        for i in range(0, len(asked) if len(at) else 0, some_queries):
            q = near_by[i : i + some_queries]
            south, north, west, east = qy[q].min(), qy[q].max(), qx[q].min(), qx[q].max()
            apart = np.maximum(0, np.maximum(y0 - north, south - y1)) ** 2 + np.maximum(0, np.maximum(x0 - east, west - x1)) ** 2
            top = limit[q].max()
            if len(held) > wanted:
                # Some blocks near the queries bound how far the wanted nearest of each of them can be.
                first = np.argsort(apart, kind="stable")[: 1 + -(-wanted // block_rows)]
                p = np.concatenate([np.arange(at[b], at[b] + size[b]) for b in first])
                if len(p) >= wanted and len(p) <= cells // len(q):
                    top = np.minimum(limit[q], np.partition(squared(q, p), wanted - 1, axis=1)[:, wanted - 1]).max()
            # Squares of rounded differences keep the order of bounds; the slack is for their sum.
            opened = np.flatnonzero(apart <= top * (1 + 1e-12))
            if len(opened):
                p = (at[opened, None] + np.arange(block_rows)).ravel()
                nearest(q, p[p < len(held)])
        none = [np.empty(0, np.int64)]
        rows_of, points_of = (pa.array(np.concatenate(x or none)) for x in (whose, which))
        found = asked.select(["__query", "__qy", "__qx"]).take(rows_of)
        for c in out:
            found = found.append_column(c, held[c].take(points_of))
        return found.append_column("__d", pa.array(np.concatenate(gaps or [np.empty(0)])))

    made = T.StructType([*queries.schema.fields, *train.schema.fields]).add("__d", T.DoubleType())
    by_leaf = visiting.groupBy("leaf", "part").cogroup(held.groupBy("leaf", "part"))
    found = _ranked(by_leaf.applyInArrow(search, made), k)
    return _by_haversine(found, train, k, carry) if metric == "haversine" else found


def _ranked(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy(_ROW).orderBy("__d", "__id")
    return found.withColumn("__rank", F.row_number().over(nearest)).filter(F.col("__rank") <= k)


def pairs_in_reach(
    asked: DataFrame, points: DataFrame, asked_coords: tuple[str, str], point_coords: tuple[str, str]
) -> DataFrame:
    """Rows of ``asked`` with the points no farther than their own ``__reach`` (metres, haversine); adds
    ``__gap``. The columns of the two sides must have different names.

    One grid per power of two of the reach, so each row meets cells of about its own size: from a metre to
    half the globe there are 26 at most.
    """
    reach = F.col("__reach") * (1 + 1e-9) + 1e-6  # rounding must not lose the point that set it
    asked = materialise(
        asked.withColumn("__reach", reach).withColumn("__level", F.ceil(F.log2(F.greatest("__reach", F.lit(1.0)))).cast("int")),
        "reach",
    )
    keys = ["__row", "__cell"]
    gap = haversine_m(*point_coords, *asked_coords)

    def pairs(of: DataFrame, level: int) -> DataFrame:
        grid = SphereGrid(2.0**level)
        near = grid.explode_reach(of, *asked_coords, *keys)
        cells = grid.add_cell(points, *point_coords, *keys)
        joined = salted_join(
            cells, near, keys, counts=cells.groupBy(*keys).agg(F.count("*").alias("__rows")),
            build_counts=near.groupBy(*keys).agg(F.count("*").alias("__rows")),
        )
        return joined.withColumn("__gap", gap).filter("__gap <= __reach").drop(*keys, "__level")

    levels = [r[0] for r in asked.select("__level").distinct().orderBy("__level").collect()]
    found = [pairs(asked.filter(F.col("__level") == level), level) for level in levels]
    return reduce(DataFrame.unionByName, found) if found else pairs(asked, 0)


def _by_haversine(found: DataFrame, points: DataFrame, k: int, carry: tuple[str, ...]) -> DataFrame:
    """The k nearest on the sphere, from the k nearest in the plane: the farthest of those bounds how far
    any of the k can be."""
    reach = F.max(haversine_m("__y", "__x", "__qy", "__qx")).alias("__reach")
    near = pairs_in_reach(found.groupBy(_ROW, *_PLACE).agg(reach), points, ("__qy", "__qx"), ("__y", "__x"))
    return _ranked(near.withColumnRenamed("__gap", "__d"), k).select(_ROW, *_PLACE, "__id", *carry, "__d", "__rank")


def _scale(metric: str, lon_scale: float) -> float:
    if metric not in ("plane", "haversine"):
        raise ValueError("metric is plane or haversine")
    return 1.0 if metric == "haversine" else lon_scale


def _planar(df: DataFrame, lat: str, lon: str, lon_scale: float, y: str, x: str) -> DataFrame:
    """Coordinates as numbers; null for both if one is null or NaN."""
    values = f"CAST(`{lat}` AS DOUBLE)", f"CAST(`{lon}` AS DOUBLE) * {float(lon_scale)!r}D"
    there = " AND ".join(f"{v} IS NOT NULL AND NOT isnan({v})" for v in values)
    return df.selectExpr("*", *(f"if({there}, {v}, NULL) AS {c}" for v, c in zip(values, (y, x), strict=True)))


def _asked(queries: DataFrame, coords: tuple[str, str], lon_scale: float, kept: list[str]) -> tuple[DataFrame, dict]:
    """Queries as written, a number for each row, and their box."""
    planar = _planar(queries, *coords, lon_scale, "__qy", "__qx").select(*kept, *_PLACE)
    return _observed(planar.withColumn(_ROW, F.monotonically_increasing_id()), "__qy", "__qx", "knn-queries")


def _train_points(
    train: DataFrame, train_id: str, coords: tuple[str, str], lon_scale: float, carry: tuple[str, ...]
) -> DataFrame:
    points = _planar(train, *coords, lon_scale, "__y", "__x")
    return points.select(F.col(train_id).alias("__id"), "__y", "__x", *carry).filter(
        "__y IS NOT NULL AND __x IS NOT NULL"
    )


def knn_join(
    queries: DataFrame,
    train: DataFrame,
    *,
    key: str,
    train_id: str,
    k: int = 5,
    query_coords: tuple[str, str] = ("lat", "lon"),
    train_coords: tuple[str, str] = ("latitude", "longitude"),
    carry: tuple[str, ...] = (),
    lon_scale: float = 1.0,
    metric: str = "plane",
) -> DataFrame:
    """The k training rows nearest to every query row: (key, rank, train_id, *carry, sq_distance).

    Euclidean distance on the given coordinates; ``lon_scale`` shrinks the second one (1 compares
    raw degrees, the cosine of a city's latitude makes both axes equal in metres). ``metric="haversine"``
    takes the distance on the sphere instead, and the last column is ``metres``. ``train_id`` must
    be unique. Ties go to the smaller ``train_id``. Rows without coordinates have no neighbours and
    are none.

    Exact for any spread of the points:

    1. A place with many training rows keeps the k smallest ids.
    2. A quad tree whose leaves hold about as many rows is shaped on a sample, at most ``MAX_LEAVES`` leaves; every
       point is written with its leaf, and the leaves' boxes and rows are taken over all points.
    3. A leaf's region and the other leaves' boxes and rows tell which leaves can matter to it. A query takes that
       list of the leaf it lies in, tightens the bound with its own place and visits the leaves that the circle
       touches: one round, whatever the spread. Leaves that many visit are split over tasks.
    4. A task has one leaf and some of its visitors; there, visitors next to each other open blocks of points together,
       as far as the points of the nearest blocks allow for. Each visit gives at most k points, and Spark ranks them by query.

    Steps 3 and 4 are array arithmetic on Arrow batches: as array functions they are interpreted, which took ten times
    as long. The tree, at most ``MAX_LEAVES`` rows and their lists, is all that is broadcast.
    """
    lon_scale = _scale(metric, lon_scale)
    asked = _asked(queries, query_coords, lon_scale, [f"`{key}`"])
    points = _train_points(train, train_id, train_coords, lon_scale, carry)
    found = _nearest(*asked, points, k, carry, metric)
    keyed = found.join(asked[0].select(_ROW, key), _ROW)
    return keyed.select(
        key, F.col("__rank").alias("rank"), F.col("__id").alias(train_id), *carry,
        F.col("__d").alias("metres" if metric == "haversine" else "sq_distance"),
    )


def label_by_neighbours(
    queries: DataFrame,
    train: DataFrame,
    *,
    train_id: str,
    label: str = "neighbourhood",
    output: str | None = None,
    k: int = 5,
    query_coords: tuple[str, str] = ("lat", "lon"),
    train_coords: tuple[str, str] = ("latitude", "longitude"),
    lon_scale: float = 1.0,
    metric: str = "plane",
) -> DataFrame:
    """Query rows plus the label most of their k nearest training rows carry.

    Ties go to the smallest label; a row without coordinates gets null. The vote reuses the partitioning by query that
    ranking leaves.
    """
    lon_scale = _scale(metric, lon_scale)
    asked = _asked(queries, query_coords, lon_scale, [f"`{c}`" for c in queries.columns])
    points = _train_points(train, train_id, train_coords, lon_scale, (label,))
    found = _nearest(*asked, points, k, (label,), metric)
    votes = found.groupBy(_ROW).agg(F.mode(label, deterministic=True).alias(output or label))
    return asked[0].join(votes, _ROW, "left").drop(_ROW, *_PLACE)
