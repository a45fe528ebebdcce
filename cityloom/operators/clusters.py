"""Clusters of points: fit, label, merge, and the row nearest to each centre."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.geo import haversine_m
from ..session import materialise, materialise_counted
from .knn import knn_join, pairs_in_reach

# Up to so many centres the nearest rows are found in one pass over rows and centres, beyond that by a
# grid. It is the plan that differs, never the result.
FEW_CENTRES = 64
# Up to so many centres a row's label is a generated expression over all of them, beyond that one over boxes of centres.
INLINE_CENTRES = 32
# Points are dealt to more tasks if each gets so many.
FILE_POINTS = 20_000


@dataclass(frozen=True)
class Clusters:
    """The (label, lat, lon) centres; the only thing clustering keeps on the driver."""

    centres: tuple[tuple[int, float, float], ...]

    def __post_init__(self) -> None:
        if not self.centres:
            raise ValueError("need at least one centre")

    @classmethod
    def from_frame(cls, df: DataFrame, label: str, lat: str, lon: str) -> Clusters:
        rows = df.select(label, lat, lon).orderBy(label).collect()
        return cls(tuple((int(r[0]), float(r[1]), float(r[2])) for r in rows))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.centres), "cluster int, clat double, clon double")

    def _literal(self) -> Column:
        """The centres as one constant array, however many they are."""
        rows = [{"label": i, "y": y, "x": x} for i, y, x in self.centres]
        return F.from_json(F.lit(json.dumps(rows)), "array<struct<label:int,y:double,x:double>>")

    def _boxes(self) -> Column:
        """The centres as a constant array of boxes, halved along their longer side until each holds about as many
        centres as there are boxes. ``by`` and ``bx`` are those of one centre in the middle of the box."""
        size = max(4, math.isqrt(len(self.centres)))
        todo, boxes = [[(y, x, place, label) for place, (label, y, x) in enumerate(self.centres)]], []
        while todo:
            held = todo.pop()
            ys, xs = [c[0] for c in held], [c[1] for c in held]
            held.sort(key=lambda c: c if max(ys) - min(ys) >= max(xs) - min(xs) else (c[1], c[0], *c[2:]))
            half = len(held) // 2
            if len(held) > size:
                todo += [held[:half], held[half:]]
                continue
            centres = [{"y": y, "x": x, "place": place, "label": label} for y, x, place, label in held]
            middle = held[half]
            boxes.append(
                {"y0": min(ys), "y1": max(ys), "x0": min(xs), "x1": max(xs), "by": middle[0], "bx": middle[1], "centres": centres}
            )
        return F.from_json(
            F.lit(json.dumps(boxes)),
            "array<struct<y0:double,y1:double,x0:double,x1:double,by:double,bx:double,"
            "centres:array<struct<y:double,x:double,place:int,label:int>>>>",
        )

    def nearest(self, lat: str, lon: str) -> Column:
        """Struct of ``gap`` (least squared coordinate distance to a centre), ``place`` and ``label`` of that
        centre; ties to the first. Null for a row without coordinates.

        A few centres are met one by one in generated code. Of more, one centre of each box gives a distance that the
        nearest can't exceed, and only boxes that come within it are opened. Rounding keeps the order of these bounds, so
        the result is that of meeting all centres.
        """
        y, x = F.col(lat), F.col(lon)

        def squared(dy: Column, dx: Column) -> Column:
            return dy * dy + dx * dx

        def met(cy: Column, cx: Column, place: Column, label: Column) -> Column:
            return F.struct(squared(y - cy, x - cx).alias("gap"), place.alias("place"), label.alias("label"))

        if len(self.centres) <= INLINE_CENTRES:
            each = [met(F.lit(cy), F.lit(cx), F.lit(place), F.lit(label)) for place, (label, cy, cx) in enumerate(self.centres)]
            best = F.least(*each) if len(each) > 1 else each[0]
        else:
            boxes = self._boxes()
            reach = F.array_min(F.transform(boxes, lambda b: squared(y - b["by"], x - b["bx"])))

            def within(b: Column, limit: Column) -> Column:
                zero = F.lit(0.0)
                return squared(F.greatest(b["y0"] - y, y - b["y1"], zero), F.greatest(b["x0"] - x, x - b["x1"], zero)) <= limit

            def opened(limit: Column) -> Column:
                inside = F.transform(
                    F.filter(boxes, lambda b: within(b, limit)),
                    lambda b: F.array_min(F.transform(b["centres"], lambda c: met(c["y"], c["x"], c["place"], c["label"]))),
                )
                return F.array_min(inside)

            # As the argument of a lambda the bound is found once per row, not once per box.
            best = F.transform(F.array(reach), opened)[0]
        return F.when(y.isNotNull() & x.isNotNull(), best)

    def label(self, lat: str, lon: str) -> Column:
        """Label of the centre with the least squared coordinate distance; ties to the first."""
        return self.nearest(lat, lon)["label"]

    def assign(self, df: DataFrame, lat: str = "lat", lon: str = "lon", name: str = "cluster") -> DataFrame:
        """Label rows in place: no index column, no join. Rows without coordinates get null."""
        return df.withColumn(name, self.label(lat, lon))


def _dealt(points: DataFrame) -> DataFrame:
    """Points written in as many files as there are cores, or the fewer that hold ``FILE_POINTS`` each: a compact input
    of few files would be iterated over in as few tasks."""
    points, n = materialise_counted(points, "points")
    parts = min(points.sparkSession.sparkContext.defaultParallelism, n // FILE_POINTS)
    return materialise(points.repartition(parts), "dealt-points") if parts > 1 else points


def _means(labelled: DataFrame, lat: str, lon: str) -> dict[int, tuple[float, float]]:
    """Mean of each cluster: one row per centre."""
    # A filter on the label would be pushed below it, and each row labelled twice.
    rows = labelled.groupBy("__label").agg(F.avg(lat).alias("y"), F.avg(lon).alias("x")).collect()
    return {r["__label"]: (r["y"], r["x"]) for r in rows if r["__label"] is not None}


def lloyd(
    df: DataFrame,
    init: Sequence[tuple[float, float]],
    n_iter: int,
    *,
    lat: str = "lat",
    lon: str = "lon",
    tolerance: float | None = None,
    persist: bool = True,
) -> Clusters:
    """Lloyd's iterations from given centres: ``n_iter`` of them, or fewer if in one of them no centre moves
    by more than ``tolerance`` in either coordinate.

    Each iteration is one partial aggregation of the points into k rows. The points are persisted,
    on disk where memory is short, so the input is read once; a lost executor costs a re-read of its
    partitions. A cluster that loses all its points keeps its centre.
    """
    points = df.select(lat, lon).filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if persist:
        points = points.persist(StorageLevel.MEMORY_AND_DISK)
    clusters = Clusters(tuple((i, float(y), float(x)) for i, (y, x) in enumerate(init)))
    try:
        for _ in range(n_iter):
            means = _means(clusters.assign(points, lat, lon, "__label"), lat, lon)
            before = clusters
            clusters = Clusters(tuple((i, *means.get(i, (y, x))) for i, y, x in clusters.centres))
            moved = max(max(abs(a[1] - b[1]), abs(a[2] - b[2])) for a, b in zip(before.centres, clusters.centres))
            if tolerance is not None and moved <= tolerance:
                break
    finally:
        if persist:
            points.unpersist()
    return clusters


def kmeans(
    df: DataFrame,
    k: int = 5,
    *,
    seed: int = 353,
    max_iter: int = 300,
    tolerance: float = 1e-6,
    starts: int = 3,
    lat: str = "lat",
    lon: str = "lon",
) -> Clusters:
    """k-means by Spark ML (parallel k-means++ start), run until the centres settle, the cheapest of several
    starts. Labels follow the centres' order by latitude and longitude, so that a refit of the same data
    gives the same labels."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    # Points are written once, dealt to all cores. A fit keeps its own vectors, ready for its iterations; a table persisted
    # here would be decoded again in each of them.
    points = _dealt(df.select(lat, lon).filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()))
    vectors = VectorAssembler(inputCols=[lat, lon], outputCol="features").transform(points).select("features")
    fits = [KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=tolerance).fit(vectors) for i in range(starts)]
    model = min(fits, key=lambda m: m.summary.trainingCost)
    centres = sorted((float(c[0]), float(c[1])) for c in model.clusterCenters())
    return Clusters(tuple((i, y, x) for i, (y, x) in enumerate(centres)))


def within_cost(df: DataFrame, clusters: Clusters, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Per cluster: points and the sum of squared distances to the centre."""
    near = df.select(clusters.nearest(lat, lon).alias("near")).filter("near IS NOT NULL")
    return near.groupBy(F.col("near.label").alias("cluster")).agg(
        F.count("*").alias("n"), F.sum("near.gap").alias("cost")
    )


def label_map(groups: Iterable[Iterable[int]], labels: Iterable[int]) -> dict[int, int]:
    """Every label to the smallest label of its group, or to itself."""
    to = {int(i): int(i) for i in labels}
    for group in groups:
        members = sorted(int(i) for i in group)
        for i in members:
            if i not in to:
                raise ValueError(f"no cluster {i}")
            to[i] = members[0]
    return to


def small_cluster_groups(df: DataFrame, clusters: Clusters, min_size: int, lat: str = "lat", lon: str = "lon"):
    """Groups that join every cluster below ``min_size`` points to its nearest large one."""
    sizes = {
        r["cluster"]: r["count"]
        for r in clusters.assign(df, lat, lon).filter("cluster IS NOT NULL").groupBy("cluster").count().collect()
    }
    large = [c for c in clusters.centres if sizes.get(c[0], 0) >= min_size]
    if not large:
        raise ValueError(f"no cluster has {min_size} points")
    groups: dict[int, set[int]] = {c[0]: {c[0]} for c in large}
    for i, y, x in clusters.centres:
        if i not in groups:
            near = min(large, key=lambda c: (c[1] - y) ** 2 + (c[2] - x) ** 2)
            groups[near[0]].add(i)
    return [g for g in groups.values() if len(g) > 1]


def _relabel(label: Column, to: Mapping[int, int]) -> Column:
    """A label by a constant table; labels it does not have stay."""
    rows = json.dumps([{"k": i, "v": j} for i, j in to.items()])
    table = F.map_from_entries(F.from_json(F.lit(rows), "array<struct<k:int,v:int>>"))
    return F.coalesce(F.element_at(table, label.cast("int")), label)


def merge_clusters(
    labelled: DataFrame,
    clusters: Clusters,
    groups: Iterable[Iterable[int]],
    *,
    label: str = "cluster",
    lat: str = "lat",
    lon: str = "lon",
) -> tuple[DataFrame, Clusters]:
    """Relabel the rows of joined clusters and give each joined cluster the mean of its rows as its
    centre. Clusters left alone keep the centre of the fit."""
    to = label_map(groups, (i for i, _, _ in clusters.centres))
    pairs = {i: j for i, j in to.items() if i != j}
    merged = labelled.withColumn(label, _relabel(F.col(label), pairs)) if pairs else labelled
    joined = set(pairs.values())
    means: dict[int, tuple[float, float]] = {}
    if joined:
        means = _means(
            merged.filter(F.col(label).isin(*joined)).withColumn("__label", F.col(label)), lat, lon
        )
    kept = tuple((i, *means.get(i, (y, x))) for i, y, x in clusters.centres if to[i] == i)
    return merged, Clusters(kept)


def nearest_per_centre(
    df: DataFrame,
    clusters: Clusters | DataFrame,
    *,
    id_col: str = "id",
    lat: str = "latitude",
    lon: str = "longitude",
    name: str = "cluster",
    distance: str | None = None,
) -> DataFrame:
    """For every centre the row at the least haversine distance; ties to the smallest id.

    With a few centres each task hands over one candidate per centre, and no row is shuffled. With many, a
    planar search gives each centre a row that is near, and what lies within that distance decides: cells
    as high as the next power of two of it are compared, one grid per power. Centres may also be a table of label,
    latitude and longitude, in this order, labels unique; it is never brought to the driver and takes the second way.
    Centres without coordinates have no row.
    """
    located = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    row = F.struct(*df.columns)
    if isinstance(clusters, Clusters) and len(clusters.centres) <= FEW_CENTRES:
        centre = F.explode(clusters._literal()).alias("__centre")
        pairs = located.select(row.alias("__of"), F.col(id_col).alias("__id"), F.col(lat).alias("__y"), F.col(lon).alias("__x"), centre)
        pairs = pairs.select("*", F.col("__centre.y").alias("__cy"), F.col("__centre.x").alias("__cx"))
        pairs = pairs.select("__of", "__id", F.col("__centre.label").alias("cluster"), haversine_m("__y", "__x", "__cy", "__cx").alias("__gap"))
    else:
        pairs = _pairs_by_grid(located, clusters, row, id_col, lat, lon)
    best = pairs.groupBy("cluster").agg(
        F.min_by("__of", F.struct("__gap", "__id")).alias("__of"), F.min("__gap").alias("__gap")
    )
    result = best.select("__of.*", F.col("cluster").alias(name), *([F.col("__gap").alias(distance)] if distance else []))
    return result


def _pairs_by_grid(
    located: DataFrame, clusters: Clusters | DataFrame, row: Column, id_col: str, lat: str, lon: str
) -> DataFrame:
    """Centres with the rows no farther than one that is near: (cluster, __of, __id, __gap)."""
    spark = located.sparkSession
    points = materialise(
        located.select(row.alias("__of"), F.col(id_col).alias("__id"), F.col(lat).alias("__plat"), F.col(lon).alias("__plon")),
        "centre-points",
    )
    if isinstance(clusters, Clusters):
        centres = clusters.to_frame(spark)
    else:
        named = clusters.toDF("cluster", "clat", "clon").filter("clat IS NOT NULL AND clon IS NOT NULL")
        centres = materialise(named, "centres")
    middle = centres.agg(F.avg("clat")).first()[0] or 0.0
    first = knn_join(
        centres, points.drop("__of").withColumnRenamed("__id", "row_id"), key="cluster", train_id="row_id", k=1, query_coords=("clat", "clon"),
        train_coords=("__plat", "__plon"), carry=("__plat", "__plon"), lon_scale=max(0.01, math.cos(math.radians(middle))),
    )
    asked = centres.join(first.select("cluster", "__plat", "__plon"), "cluster").select(
        "cluster", "clat", "clon", haversine_m("__plat", "__plon", "clat", "clon").alias("__reach")
    )
    found = pairs_in_reach(asked, points, ("clat", "clon"), ("__plat", "__plon"))
    return found.select("cluster", "__of", "__id", "__gap")
