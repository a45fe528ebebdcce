"""Approximate nearest neighbours by multiprobe p-stable hashing.

Every vector lies in one bucket of each table: the whole numbers of ``projections`` random projections, moved
and scaled. A query visits its own bucket and buckets next to it, in the order of how likely they are to hold
its neighbours: the squared distances of its projections to the bounds that are crossed, added up. Each table
gives its nearest candidates by exact distance; the best of all tables are the result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialise, ship
from .vectors import dimension, plain, valid

# Vectors that one task holds.
TASK_VECTORS = 100_000


@dataclass(frozen=True)
class Hashing:
    """Projections (tables, dimension, projections per table), shifts and the width of a bucket; how many
    buckets a query visits per table."""

    lines: np.ndarray
    shifts: np.ndarray
    width: float
    probes: int

    def places(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket numbers and where between their bounds the projections lie."""
        at = (vectors @ self.lines[table] + self.shifts[table]) / self.width
        return np.floor(at).astype(np.int64), at - np.floor(at)


def _keys(places: np.ndarray) -> np.ndarray:
    """One number per row of bucket numbers; buckets that share it by chance only add candidates."""
    key = np.zeros(places.shape[:-1], np.uint64)
    for i in range(places.shape[-1]):
        key = (key ^ places[..., i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _steps(projections: int) -> np.ndarray:
    """All ways to stay or to move by one in each projection."""
    return np.array(list(itertools.product((0, -1, 1), repeat=projections)), np.int64)


def _order(between: np.ndarray, steps: np.ndarray, n: int) -> np.ndarray:
    """For each query the ``n`` most promising steps, best first."""
    down, up = (steps == -1).astype(float), (steps == 1).astype(float)
    cost = (between**2) @ down.T + ((1 - between) ** 2) @ up.T
    if n < cost.shape[1]:
        near = np.argpartition(cost, n - 1, axis=1)[:, :n]
    else:
        near = np.tile(np.arange(cost.shape[1]), (len(cost), 1))
    return np.take_along_axis(near, np.argsort(np.take_along_axis(cost, near, 1), axis=1, kind="stable"), 1)


def fit(
    sample: np.ndarray, k: int, *, tables: int = 8, projections: int = 8, target: float = 0.97, seed: int = 7
) -> Hashing:
    """Widths and probes from a bounded sample (at most ``max_sample`` rows of :func:`nearest`).

    The width is 1.8 times the median distance to the ``k``-th neighbour within the sample. The probes are as
    many as let the sample's own queries find ``target`` of their ``k`` neighbours. Neighbours in the whole table
    are nearer than in the sample and so easier to find.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    lines, shifts = rng.normal(size=(tables, dim, projections)), rng.uniform(size=(tables, projections))
    steps = _steps(projections)
    if len(sample) < 2:
        return Hashing(lines, shifts, 1.0, len(steps))
    queries = sample[: min(len(sample), 300)]
    squares = (queries**2).sum(1)[:, None] + (sample**2).sum(1)[None] - 2 * queries @ sample.T
    squares[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    k = min(k, len(sample) - 1)
    near = np.argpartition(squares, k - 1, axis=1)[:, :k]
    far = math.sqrt(max(0.0, float(np.median(np.take_along_axis(squares, near, 1).max(1)))))
    width = 1.8 * far or 1.0
    hashing = Hashing(lines, shifts * width, width, len(steps))
    # The place of the step to each neighbour's bucket in its query's order, in the best table.
    best = np.full(near.shape, len(steps))
    number = {tuple(s): i for i, s in enumerate(steps.tolist())}
    for t in range(tables):
        at, between = hashing.places(sample, t)
        order = _order(between[: len(queries)], steps, len(steps))
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(len(steps))[None], 1)
        apart = at[near] - at[: len(queries), None]
        for q in range(len(queries)):
            for j in range(k):
                step = number.get(tuple(apart[q, j].tolist()))
                if step is not None:
                    best[q, j] = min(best[q, j], rank[q, step])
    probes = int(np.quantile(best, target, method="higher")) + 1
    return Hashing(lines, shifts * width, width, min(len(steps), probes))


def nearest(
    vectors: DataFrame,
    is_query: str,
    k: int = 10,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    max_sample: int = 4_000,
    tables: int = 8,
    projections: int = 8,
) -> DataFrame:
    """``query_id, rank, id_col, score``: for each row that the condition ``is_query`` holds for, its ``k`` nearest
    other rows by Euclidean distance in double precision, nearest first, ties to the smaller id; all others, if
    there are fewer.

    Rows whose vector is null, empty, zero, of another length than most, or holds null or non-finite components
    take no part, nor do rows without an id. Equal vectors are one class, indexed once, with its ``k + 1``
    smallest ids, as no other of them can be among the ``k`` nearest of any query. A row is no candidate of its
    own id. A query that finds too few by hashing is compared with all classes, in blocks. ``is_query`` is SQL
    over ``id_col``; other columns are dropped.
    """
    ship(vectors.sparkSession)
    vec, of = plain(F.col(f"`{vec_col}`"), vectors.schema[vec_col].dataType)
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), vec.alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & valid(F.col("vec")))
    dim = dimension(rows)
    rows = rows.filter(F.size("vec") == dim)
    order = Window.partitionBy("vec").orderBy("id")
    few = rows.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = materialise(classes.select(F.col("ids")[0].alias("c"), "vec", "ids"), "ann-classes")
    named = rows.select(F.col("id").alias("query_id"), "vec", F.col("id").alias(id_col))
    asked = named.filter(is_query).select("query_id", "vec").distinct()
    asked = materialise(asked.join(classes.select("c", "vec"), "vec").select("query_id", "c"), "ann-queries")
    query_classes = asked.select("c").distinct().join(classes.select("c", "vec"), "c")

    # The sample: rows with the smallest hashes, a bounded number.
    taken = classes.orderBy(F.xxhash64("c"), "c").limit(max_sample).select("vec").toArrow()["vec"].combine_chunks()
    sample = taken.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, max(1, dim))
    n_classes = classes.count()
    hashing = vectors.sparkSession.sparkContext.broadcast(fit(sample, k, tables=tables, projections=projections))
    shards = max(1, math.ceil(n_classes / TASK_VECTORS))
    steps = _steps(projections)

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vec"))
            for t in range(tables):
                keys = _keys(hashing.value.places(x, t)[0])
                yield pa.RecordBatch.from_pydict(
                    {"t": pa.array(np.full(len(x), t, np.int32)), "shard": pa.array((keys % shards).astype(np.int32)),
                     "key": keys, "c": batch.column("c"), "vec": batch.column("vec")}
                )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                x = matrix(part.column("vec"))
                for t in range(tables):
                    at, between = hashing.value.places(x, t)
                    keys = _keys(at[:, None, :] + steps[_order(between, steps, hashing.value.probes)])
                    shard = keys % shards
                    for s in np.unique(shard):
                        held = [k[m] for k, m in zip(keys, shard == s, strict=True)]
                        some = np.array([len(h) > 0 for h in held])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(some.sum(), t, np.int32)), pa.array(np.full(some.sum(), s, np.int32)),
                             pa.array([h for h in held if len(h)], pa.list_(pa.int64())),
                             part.column("c").filter(pa.array(some)), part.column("vec").filter(pa.array(some))],
                            ["t", "shard", "keys", "c", "vec"],
                        )

    indexed = classes.select("c", "vec").mapInArrow(index, f"t int, shard int, key long, c long, vec array<{of}>")
    # A shard with many vectors is parted again; its queries visit every part. The buckets are worked out once
    # more for that, as the vectors by table are many times the input.
    size = indexed.groupBy("t", "shard").agg(F.ceil(F.count("*") / F.lit(TASK_VECTORS)).cast("int").alias("parts"))
    size = materialise(size, "ann-shards")
    indexed = indexed.join(size, ["t", "shard"]).select(
        "t", "shard", F.pmod(F.xxhash64("c"), "parts").cast("int").alias("part"), "key", F.lit(None).cast("array<long>").alias("keys"), "c", "vec"
    )

    def search(table: pa.Table) -> pa.Table:
        is_item = pc.is_valid(table["key"])
        items, queries = table.filter(is_item), table.filter(pc.invert(is_item))
        key = items["key"].to_numpy()
        by_key = np.argsort(key, kind="stable")
        key, c = key[by_key], items["c"].to_numpy()[by_key]
        x = matrix(items["vec"].combine_chunks())[by_key] if len(key) else np.zeros((0, dim))
        got_q, got_c, got_d = [], [], []
        for row in range(len(queries)):
            q, cq = np.array(queries["vec"][row].as_py(), np.float64), queries["c"][row].as_py()
            keys = queries["keys"][row].as_py()
            if keys:
                keys = np.unique(np.array(keys, np.int64))
                lo, hi = np.searchsorted(key, keys, "left"), np.searchsorted(key, keys, "right")
                n = hi - lo
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            else:
                at = np.arange(len(key))
            if not len(at):
                continue
            best_d, best_c = np.zeros(0), np.zeros(0, np.int64)
            for i in range(0, len(at), 20_000):
                d = np.sqrt(((x[at[i : i + 20_000]] - q) ** 2).sum(1))
                best_d, best_c = np.append(best_d, d), np.append(best_c, c[at[i : i + 20_000]])
                if len(best_d) > k + 1:
                    first = np.lexsort((best_c, best_d))[: k + 1]
                    best_d, best_c = best_d[first], best_c[first]
            got_q.append(np.full(len(best_c), cq))
            got_c.append(best_c)
            got_d.append(best_d)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"q": join(got_q, np.int64), "c": join(got_c, np.int64), "d": join(got_d, np.float64)})

    def run(probes: DataFrame) -> DataFrame:
        spread = probes.join(size, ["t", "shard"]).select(
            "t", "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("key"), "keys", "c", "vec"
        )
        there = indexed.join(spread.select("t", "shard", "part").distinct(), ["t", "shard", "part"], "left_semi")
        found = there.unionByName(spread).groupBy("t", "shard", "part").applyInArrow(search, "q long, c long, d double")
        return found.groupBy("q", "c").agg(F.min("d").alias("d"))

    probes = query_classes.mapInArrow(probe, f"t int, shard int, keys array<long>, c long, vec array<{of}>")
    found = materialise(run(probes), "ann-found")
    # Every id of a class is a candidate; a class of its own that holds more ids counts those too.
    reached = found.join(classes.select("c", F.size("ids").alias("n")), "c").groupBy("q").agg(F.sum("n").alias("n"))
    lacking = query_classes.join(reached, query_classes["c"] == reached["q"], "left").filter(F.coalesce("n", F.lit(0)) < k + 1)
    # The shards of one table hold every class once.
    lacking = lacking.select(
        F.lit(0).alias("t"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.lit(None).cast("array<long>").alias("keys"),
        "c",
        "vec",
    )
    lacking = materialise(lacking, "ann-lacking")
    if not lacking.isEmpty():
        found = found.unionByName(run(lacking)).groupBy("q", "c").agg(F.min("d").alias("d"))
    # The nearest classes of a query class first: no more than k + 1 of them can matter.
    near = Window.partitionBy("q").orderBy("d", "c")
    found = found.withColumn("r", F.row_number().over(near)).filter(F.col("r") <= k + 1).drop("r")
    candidates = found.join(classes.select("c", "ids"), "c").select("q", "d", F.explode("ids").alias(id_col))
    pairs = asked.join(candidates, asked["c"] == candidates["q"]).filter(F.col("query_id") != F.col(id_col))
    order = Window.partitionBy("query_id").orderBy("score", id_col)
    ranked = pairs.select("query_id", id_col, F.col("d").alias("score")).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
