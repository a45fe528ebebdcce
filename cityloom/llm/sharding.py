"""Sharding along a Hilbert curve: several dimensions of a document's metadata are cut into levels, documents sorted by
their place on the curve through the grid of levels, and the sorted row cut into shards. A shard so covers a small
part of every dimension, and files can be left out by the least and largest values they hold."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import materialise, parts_for, ship

# Rows in one range of the sorted row.
RANGE_ROWS = 500_000


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve through a grid of ``2**bits`` cells a side; ``levels`` has a row per dimension.

    From the highest bit down, the lower bits of the first dimension are turned over or exchanged with those of each
    other one, as the curve's next smaller square lies; the Gray code of the result, bit by bit across the dimensions,
    counts the cells along the curve.
    """
    x = np.array(levels, np.uint64)
    dims = len(x)
    if dims * bits > 63:
        raise ValueError("dimensions times bits must not be above 63")
    for b in range(bits - 1, 0, -1):
        low = np.uint64((1 << b) - 1)
        for i in range(dims):
            turned = (x[i] >> np.uint64(b)) & np.uint64(1) == 1
            differ = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ differ)
            x[i] ^= differ if i else np.uint64(0)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & np.uint64(1) == 1, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            place = (place << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return place.astype(np.int64)


def _numbered(rows: DataFrame, order: Sequence[str], parts: int, label: str) -> DataFrame:
    """``rows`` written in ranges of ``order``, sorted, with ``range`` and ``place`` (from 0 in each range)."""
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialise(ranged.select(*rows.columns, F.spark_partition_id().alias("range"), within.alias("place")), label)


def _before(ranged: DataFrame, amounts: Mapping[str, Column]) -> DataFrame:
    """What all earlier ranges hold of each amount; one row per range, so it can be broadcast and one task sums it."""
    sums = ranged.groupBy("range").agg(*(F.sum(c).alias(name) for name, c in amounts.items()))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("range", *(F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_before") for name in amounts))


def cut_points(rows: DataFrame, column: str, levels: int) -> list[tuple[object, int]]:
    """The least value of each level that has any, with the level: values in order, null first, go to ``levels`` levels
    with about as many rows each. All rows are counted; a value with more rows than a level takes has the level at
    its middle. At most ``levels`` pairs are returned."""
    counts = materialise(rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows")), "shard-values")
    total, distinct = counts.agg(F.sum("rows"), F.count("*")).first()
    if not total:
        return []
    ranged = _numbered(counts, ["value"], parts_for(distinct, RANGE_ROWS), "shard-value-ranges")
    upto = Window.partitionBy("range").orderBy("place")
    so_far = ranged.join(F.broadcast(_before(ranged, {"rows": F.col("rows")})), "range").withColumn(
        "twice", 2 * (F.col("rows_before") + F.sum("rows").over(upto)) - F.col("rows")
    )
    level = F.least(F.floor(F.col("twice") / F.lit(2 * total) * levels), F.lit(levels - 1)).cast("int")
    least = so_far.groupBy(level.alias("level")).agg(F.min("value").alias("least"), F.max(F.col("value").isNull()).alias("null"))
    found = []
    for r in least.orderBy("level").collect():  # one row per level
        found += [(None, r["level"])] * r["null"] + [(r["least"], r["level"])] * (r["least"] is not None)
    return found


def _levels(values: pa.Array, cuts: list[tuple[object, int]]) -> np.ndarray:
    """The level of each value."""
    of_null = next((level for value, level in cuts if value is None), 0)
    some = [(value, level) for value, level in cuts if value is not None]
    least = [value for value, _ in some]
    coded = values.dictionary_encode()
    table = [some[max(bisect_right(least, v) - 1, 0)][1] if some else 0 for v in coded.dictionary.to_pylist()] + [of_null]
    return np.array(table)[pc.fill_null(coded.indices, len(table) - 1).to_numpy(zero_copy_only=False)]


def shard(
    docs: DataFrame, dims: Mapping[str, Column], shards: int, *, law: str = "rows", bits: int = 10,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id_col, size, text_crc32``, the dimensions, ``curve`` (place on the curve), ``shard`` (from 0) and ``slot``
    (from 0 in its shard): one row per row of ``docs``, in no order.

    ``dims`` names the dimensions and says how a row gets its value (text, number, date or time; null is below all
    others, NaN counts as null). Each is cut into ``2**bits`` levels of about as many rows. Rows are sorted by their
    place on the curve, then equal texts side by side, then by id; rows equal in all of that are told apart by where
    they lie in the input. By the law ``rows`` shards differ by one row at most; by ``bytes`` a row goes to the shard in
    which the middle of its bytes falls, so that sizes differ by no more than two documents. ``size`` is the text's
    bytes in UTF-8 and eight; null texts have none, and checksum 0. Null ids come first among equal texts; an empty table
    gives an empty one. Other columns are dropped, and names of dimensions are free but for those named here.

    Only metadata moves: texts are read once, where they are. The row is sorted in ranges; what comes before a range
    is summed over one row per range.
    """
    if law not in ("rows", "bytes"):
        raise ValueError("the law is rows or bytes")
    ship(docs.sparkSession)
    taken = {"size", "text_crc32", "curve", "shard", "slot", id_col}
    if clash := taken & set(dims):
        raise ValueError(f"names of dimensions that are taken: {sorted(clash)}")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("string")
    names = [f"dim{i}" for i in range(len(dims))]

    def value(column: Column, kind: T.DataType) -> Column:
        return F.when(~F.isnan(column), column) if isinstance(kind, (T.FloatType, T.DoubleType)) else column

    kinds = [f.dataType for f in docs.select(*dims.values()).schema.fields]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("same"),
        F.monotonically_increasing_id().alias("row"),
        *(value(c, kind).alias(n) for n, c, kind in zip(names, dims.values(), kinds, strict=True)),
    )
    rows = materialise(rows, "shard-rows")
    cuts = [cut_points(rows, n, 1 << bits) for n in names]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = np.array([_levels(batch.column(n), c) for n, c in zip(names, cuts, strict=True)])
            at = hilbert_index(levels, bits) if len(names) else np.zeros(len(batch), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "curve"])

    placed = materialise(rows.mapInArrow(place, T.StructType([*rows.schema.fields]).add("curve", "long")), "shard-places")
    total, bytes_all = placed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranged = _numbered(placed, ["curve", "same", "id", "row"], parts_for(total, RANGE_ROWS), "shard-ranges")
    before = _before(ranged, {"rows": F.lit(1), "bytes": F.col("size")})
    at = ranged.join(F.broadcast(before), "range").withColumn("at", F.col("rows_before") + F.col("place"))
    if law == "rows":
        # Whole-number arithmetic: shard s begins at the least row r with r * shards >= s * total.
        number = F.expr(f"(at * {shards}L) div {max(total, 1)}L")
        begin = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
        cut = at.withColumn("shard", number).withColumn("slot", F.col("at") - begin)
    else:
        upto = Window.partitionBy("range").orderBy("place")
        middle = F.col("bytes_before") + F.sum("size").over(upto) - F.col("size") / 2
        cut = at.withColumn("shard", F.least(F.floor(middle * shards / F.lit(max(bytes_all, 1))), F.lit(shards - 1)))
        cut = materialise(cut, "shard-bytes")
        first = cut.groupBy("shard").agg(F.min("at").alias("begin"))  # one row per shard
        cut = cut.join(F.broadcast(first), "shard").withColumn("slot", F.col("at") - F.col("begin"))
    return cut.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        *(F.col(n).alias(d) for n, d in zip(names, dims, strict=True)), "curve", F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> DataFrame:
    """Write rows with ``shard`` and ``slot`` below ``path``, a folder per shard, rows by slot; and return what each
    file holds: ``shard, file, rows`` and ``least_*`` and ``most_*`` of every other column that can be ordered. A shard
    may have several files, each with a stretch of the curve. ``sharded`` may be the output of :func:`shard` joined to any
    further columns."""
    spark = sharded.sparkSession
    rows = sharded.count()
    ordered = sharded.repartitionByRange(parts_for(rows, RANGE_ROWS), "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
    schema = T.StructType([f for f in sharded.schema.fields if f.name != "shard"]).add("shard", T.IntegerType())
    back = spark.read.schema(schema).parquet(path).withColumn("file", F.input_file_name())
    plain = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.BooleanType)
    held = [f.name for f in schema.fields if isinstance(f.dataType, plain) and f.name not in ("shard", "slot")]
    bounds = [x for c in held for x in (F.min(f"`{c}`").alias(f"least_{c}"), F.max(f"`{c}`").alias(f"most_{c}"))]
    return back.groupBy("shard", "file").agg(F.count("*").alias("rows"), *bounds)


def files_for(stats: DataFrame, **wanted: tuple[object, object]) -> DataFrame:
    """The rows of :func:`write_shards`'s answer whose files may hold a row between the given ends (both included, None
    for open) in all the given columns."""
    for column, (low, high) in wanted.items():
        if low is not None:
            stats = stats.filter(F.col(f"most_{column}") >= F.lit(low))
        if high is not None:
            stats = stats.filter(F.col(f"least_{column}") <= F.lit(high))
    return stats
