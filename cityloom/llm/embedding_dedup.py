"""Near-duplicates of embeddings: binary codes by iterative quantisation, multi-index Hamming tables to
find pairs, cosine of the original vectors to confirm them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise, ship
from .components import Forest, components
from .vectors import dimension, plain, valid

# Vectors of one label that one task looks through at a time.
TASK_VECTORS = 20_000
_PAIRS = 500_000
# Share of the linked pairs of the sample, per vector, that the tables must find.
RECALL = 0.95


def fit_rotation(sample: np.ndarray, bits: int, rounds: int = 50, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection for codes of ``bits`` bits: the principal directions of the sample, turned so that
    the projections lie as near as possible to the corners of the cube (rounds of: nearest corners, best
    rotation to them)."""
    mean = sample.mean(0)
    centred = sample - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    main = vectors[:, ::-1][:, :bits]
    flat = centred @ main
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        corners = np.where(flat @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(corners.T @ flat)
        turn = (u @ v).T
    return mean, main @ turn


def codes_of(unit: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes of unit vectors as unsigned 64-bit numbers, bit i for direction i."""
    bits = (unit - mean) @ projection >= 0
    out = np.zeros(len(unit), np.uint64)
    for i in range(bits.shape[1]):
        out |= bits[:, i].astype(np.uint64) << np.uint64(i)
    return out


def substrings(bits: int, tables: int) -> list[tuple[int, int]]:
    """First bit and length of the disjoint parts of a code, one per table."""
    cuts = [round(i * bits / tables) for i in range(tables + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def linked_pairs(unit: np.ndarray, labels: np.ndarray, threshold: float, most: int = 200_000, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors (two arrays, row by row) of pairs of a sample that are to be linked, and the position of the first.
    If the sample has few of them, pairs with a cosine of just ``threshold``, the hardest, are made from vectors of
    the sample, moved towards or away from others of it."""
    left, right, n = [], [], 0
    for at in range(0, len(unit), 100):
        block = slice(at, at + 100)
        near = (unit[block] @ unit.T >= threshold) & (labels[block, None] == labels[None])
        a, b = np.nonzero(near)
        apart = a + at != b
        left.append(a[apart] + at)
        right.append(b[apart])
        n += len(left[-1])
        if n >= most:
            break
    a, b = np.concatenate(left), np.concatenate(right)
    if len(np.unique(a)) >= 200 or len(unit) < 3:
        return unit[a], unit[b], a
    rng = np.random.default_rng(seed)
    at = rng.integers(0, len(unit), 2_000)
    x, step = unit[at], unit[rng.integers(0, len(unit), 2_000)] - unit[rng.integers(0, len(unit), 2_000)]
    step -= (step * x).sum(1, keepdims=True) * x
    size = np.sqrt((step**2).sum(1, keepdims=True))
    some = size[:, 0] > 1e-9
    made = threshold * x[some] + np.sqrt(max(0.0, 1 - threshold**2)) * step[some] / size[some]
    return np.concatenate((unit[a], x[some])), np.concatenate((unit[b], made)), np.concatenate((a, len(unit) + np.arange(some.sum())))


def choose_parts(apart: np.ndarray, of: np.ndarray, bits: int, tables: int) -> list[tuple[int, int]]:
    """The parts of the fewest tables, ``tables`` at least, that find ``RECALL`` of the pairs whose codes differ by
    ``apart`` (averaged over the vectors ``of`` they belong to). Where that takes as many comparisons as there are
    pairs, one part of one bit, in which all vectors of a label are compared."""
    weight = 1 / np.maximum(1, np.bincount(of))[of] if len(of) else np.zeros(0)
    for k in range(min(tables, bits), bits + 1):
        parts = substrings(bits, k)
        if sum((1 + size) / 2**size for _, size in parts) >= 1:
            break
        found = np.zeros(len(apart), bool)
        for first, size in parts:
            found |= np.bitwise_count(_part(apart, first, size)) <= 1
        if (found * weight).sum() >= RECALL * weight.sum():
            return parts
    return [(0, 1)]


def _part(codes: np.ndarray, first: int, size: int) -> np.ndarray:
    return (codes >> np.uint64(first)) & np.uint64((1 << size) - 1)


def _matches(value: np.ndarray, home: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions whose ``value`` differs in at most one of ``size`` bits, each pair once, in
    batches. Pairs of two guests (``home`` false) are left out."""
    order = np.argsort(value, kind="stable")
    ranked = value[order]
    for bit in (-1, *range(size)):
        other = ranked if bit < 0 else ranked ^ np.uint64(1 << bit)
        lo = np.arange(1, len(ranked) + 1) if bit < 0 else np.searchsorted(ranked, other, "left")
        hi = np.searchsorted(ranked, other, "right")
        if bit >= 0:  # from the value without the bit to the one with it
            hi = np.where(ranked < other, hi, lo)
        n = np.maximum(hi - lo, 0)
        ends = np.cumsum(n)
        at = 0
        while at < len(n):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
            m = n[at:upto]
            # One value with very many partners is cut as well.
            total = int(m.sum())
            base = np.repeat(lo[at:upto] - (np.cumsum(m) - m), m)
            left = np.repeat(np.arange(at, upto), m)
            for i in range(0, total, _PAIRS):
                span = np.arange(i, min(total, i + _PAIRS))
                a, b = order[left[span]], order[base[span] + span]
                kept = home[a] | home[b]
                yield a[kept], b[kept]
            at = upto


def in_blocks(indexed: DataFrame, counted: DataFrame) -> DataFrame:
    """``indexed`` with ``own``, ``i`` and ``j``: groups (``label, t, part``) of more than ``TASK_VECTORS`` rows, which
    ``counted`` tells (``rows``), are cut into blocks by hash of ``c``, and each row goes to all pairs ``i <= j`` of
    blocks that hold its own. A pair of blocks is about ``TASK_VECTORS`` rows."""
    large = counted.filter(F.col("rows") > TASK_VECTORS).select(
        "label", "t", "part", F.ceil(2 * F.col("rows") / F.lit(TASK_VECTORS)).cast("int").alias("blocks")
    )
    cut = indexed.join(materialise(large, "itq-large"), ["label", "t", "part"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("blocks", "other")


def near_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    bits: int = 64,
    tables: int = 6,
    max_sample: int = 10_000,
) -> DataFrame:
    """``id_col, n_links, component_id, kept``: one row per row of ``vectors``. Rows of one label, not null,
    are linked if they are found and the cosine of their vectors, in double precision, is at least ``threshold``.

    Vectors that are null, empty, zero, of another length than most, or hold null or non-finite components link
    with nothing; neither do rows without a label. ``n_links`` counts rows, so copies count each other.
    ``component_id`` is the smallest id reachable, the row's own included; ``kept`` says it is the row's own.
    Repeated rows are rows like others. Rows without an id take part; alone they have a null component and are
    kept. Other columns are dropped.

    Equal vectors of a label are one class; pairs are counted between classes and within one by its size. The
    rotation is fitted on at most ``max_sample`` vectors; every vector is indexed. A pair is found if one of the
    parts of the codes differs in at most one bit, and counted in the first such table only, so
    no pair leaves its task: a task sends on the number of links of each class, and a star per group of
    linked classes. There are ``tables`` parts, or as many more, and so shorter, as the linked pairs of the
    sample need to be found (``RECALL``); where tables would not spare comparisons all vectors of a label are compared.
    Large labels are parted further by the leading bits of the table's part, each vector being
    sent to its own part and to those that differ in one bit. Groups that are still large, as near copies share
    their bits, are cut into blocks, and pairs of blocks are compared (:func:`in_blocks`).
    """
    spark = vectors.sparkSession
    ship(spark)
    vec, of = plain(F.col(f"`{vec_col}`"), vectors.schema[vec_col].dataType)
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), vec.alias("vec")
    ).withColumn("ok", F.col("label").isNotNull() & valid(F.col("vec")))
    dim = dimension(rows.filter("ok"))
    rows = rows.withColumn("ok", F.col("ok") & (F.coalesce(F.size("vec"), F.lit(-1)) == dim))
    rows = rows.withColumn("vec", F.when(F.col("ok"), F.col("vec")))
    classes = rows.filter("ok").groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = materialise(classes.withColumn("c", F.monotonically_increasing_id()), "itq-classes")
    taken = classes.orderBy(F.xxhash64("vec"), "vec").limit(max_sample).select("vec", "label").toArrow()
    labels = np.unique(np.array([str(v) for v in taken["label"].to_pylist()]), return_inverse=True)[1]
    taken = taken["vec"].combine_chunks()
    if not len(taken):
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    sample = taken.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
    bits = min(bits, dim, 64)
    unit = _unit(sample)
    fitted = fit_rotation(unit, bits)
    p, q, of_row = linked_pairs(unit, labels, threshold)
    parts = choose_parts(codes_of(p, *fitted) ^ codes_of(q, *fitted), of_row, bits, tables)
    model = spark.sparkContext.broadcast(fitted)

    # How many leading bits part a label: by its own number of classes.
    sizes = classes.groupBy("label").agg(F.count("*").alias("size"))
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.col("size") / F.lit(float(TASK_VECTORS))))).cast("int")
    placed = classes.join(sizes.select("label", depth.alias("depth")), "label")
    label_type = classes.schema["label"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch], light: bool = False) -> Iterator[pa.RecordBatch]:
        mean, projection = model.value
        for batch in batches:
            x = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            code = codes_of(_unit(x), mean, projection)
            depth = batch.column("depth").to_numpy()
            for t, (first, size) in enumerate(parts):
                deep = np.minimum(depth, size)
                value = _part(code, first, size)
                shift = (size - deep).astype(np.uint64)
                own = value >> shift
                # As a guest in the parts with one more leading bit set.
                for bit in range(-1, int(deep.max(initial=0))):
                    goes = np.ones(len(own), bool) if bit < 0 else (bit < deep) & ((own >> np.uint64(bit)) & np.uint64(1) == 0)
                    to = own if bit < 0 else own | np.uint64(1 << bit)
                    m = pa.array(goes)
                    if light:
                        at = pa.table({"label": batch.column("label").filter(m), "part": to[goes].astype(np.int64)})
                        at = at.group_by(["label", "part"]).aggregate([([], "count_all")])
                        yield from at.select(["label", "part", "count_all"]).add_column(
                            1, "t", pa.array(np.full(len(at), t, np.int32))
                        ).rename_columns(["label", "t", "part", "rows"]).combine_chunks().to_batches()
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("label").filter(m), pa.array(np.full(goes.sum(), t, np.int32)),
                         pa.array(to[goes].astype(np.int64)), pa.array(np.full(goes.sum(), bit < 0)),
                         batch.column("c").filter(m), batch.column("n").filter(m),
                         pa.array(code[goes].view(np.int64)), batch.column("vec").filter(m)],
                        ["label", "t", "part", "home", "c", "n", "code", "vec"],
                    )

    indexed = placed.select("label", "vec", "c", "n", "depth").mapInArrow(
        place, f"label {label_type}, t int, part long, home boolean, c long, n long, code long, vec array<{of}>"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return place(batches, light=True)

    counted = placed.select("label", "vec", "depth").mapInArrow(count, f"label {label_type}, t int, part long, rows long")
    counted = counted.groupBy("label", "t", "part").agg(F.sum("rows").alias("rows"))
    indexed = in_blocks(indexed, counted)

    def search(table: pa.Table) -> pa.Table:
        own, across = table["own"].to_numpy(), table["i"][0].as_py() != table["j"][0].as_py()
        t = table["t"][0].as_py()
        c, n = table["c"].to_numpy(), table["n"].to_numpy()
        home = table["home"].to_numpy()
        code = table["code"].to_numpy().view(np.uint64)
        x = _unit(table["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
        links, forest = np.zeros(len(c), np.int64), Forest(len(c))
        first, size = parts[t]
        for a, b in _matches(_part(code, first, size), home, size):
            if across:  # pairs within a block are found in the group of the block with itself
                new = own[a] != own[b]
                a, b = a[new], b[new]
            apart = code[a] ^ code[b]
            new = np.ones(len(a), bool)
            for f, s in parts[:t]:
                new &= np.bitwise_count(_part(apart, f, s)) > 1
            a, b = a[new], b[new]
            for i in range(0, len(a), 50_000):
                p, q = a[i : i + 50_000], b[i : i + 50_000]
                near = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
                p, q = p[near], q[near]
                np.add.at(links, p, n[q])
                np.add.at(links, q, n[p])
                forest.link(p, q)
        member, root = forest.links()
        some = np.flatnonzero(links)
        return pa.table(
            {
                "c": np.concatenate((c[some], c[member])),
                "links": pa.array(np.concatenate((links[some], np.zeros(len(member), np.int64)))),
                "root": pa.array(np.concatenate((np.zeros(len(some), np.int64), c[root])),
                                 mask=np.concatenate((np.ones(len(some), bool), np.zeros(len(member), bool)))),
            }
        )

    found = indexed.groupBy("label", "t", "part", "i", "j").applyInArrow(search, "c long, links long, root long")
    found = materialise(found, "itq-found")
    counts = found.filter("root IS NULL").groupBy("c").agg(F.sum("links").alias("links"))
    stars = found.filter("root IS NOT NULL").select(F.col("c").alias("a"), F.col("root").alias("b"))
    roots = components(stars, "itq-links").withColumnRenamed("node", "c")
    ends = classes.select("c", "label", "vec", "least", "n").join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    ends = materialise(ends.join(counts, "c", "left"), "itq-ends")
    smallest = ends.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = ends.join(smallest, "root").select(
        "label", "vec", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    alone = rows.filter(~F.col("ok")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = rows.filter("ok").join(of_class, ["label", "vec"]).select("id", "n_links", "component_id")
    out = linked.unionByName(alone)
    return out.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # Scaled first, so that very large and very small components do not leave the range of doubles.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))
