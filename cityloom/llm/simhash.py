"""SimHash near-duplicates over a hierarchical index in Gray order.

Fingerprints are sorted by their rank in the reflected Gray code, so neighbours differ in few bits and a run
of them shares many. A run's shared bits are kept once, in the node above it; a search counts the differences
at a node, hands the count on to the nodes below, and leaves a whole run as soon as the count exceeds the limit.

The upper nodes are the range partitions of the sorted fingerprints. Each fingerprint is sent to those of them
that it cannot be told apart from, and searches the levels below there, in tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import give_back, giving_back, materialise, ship
from .components import Forest, components

FANOUT = 16
# Fingerprints per upper node; there are at most MAX_NODES of these, beyond that each holds more.
NODE_CODES, MAX_NODES = 65_536, 16_384
# Fingerprints that one task looks up in one upper node.
TASK_QUERIES = 100_000
_PAIRS = 4_000_000


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """Fingerprint of UTF-8 text, as a signed 64-bit number: A-Z lower-cased, words parted by ASCII white
    space, shingles of ``shingle`` words with repeats (fewer words: all of them as one; none: 0). A bit is set
    if more than half of the shingles' XXH64 values have it set."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    last = ends[shingle - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a : b - 1], seed) for a, b in zip(starts, last, strict=False)], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 65_536):
        part = h[i : i + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp`` for each row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            fps = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps, pa.int64())], ["id", "fp"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(giving_back(run), T.StructType([rows.schema["id"]]).add("fp", "long"))


def gray_rank(code: Column) -> Column:
    """Rank of a 64-bit code in the reflected Gray order, moved so that signed order is rank order."""
    rank = reduce(lambda r, s: r.bitwiseXOR(F.shiftrightunsigned(r, s)), (1, 2, 4, 8, 16, 32), code)
    return rank.bitwiseXOR(F.lit(-(2**63)))


class GrayIndex:
    """Levels of runs of ``FANOUT`` over items in Gray order. An item is a value with a mask of the bits it
    stands for (all, for a fingerprint). Every node keeps the bits its run shares and its parent lacks."""

    def __init__(self, value: np.ndarray, mask: np.ndarray | None = None) -> None:
        value = value.view(np.uint64)
        mask = np.full(len(value), 2**64 - 1, np.uint64) if mask is None else mask.view(np.uint64)
        levels = [(value & mask, mask)]
        while len(levels[-1][0]) > FANOUT:
            v, m = levels[-1]
            at = np.arange(0, len(v), FANOUT)
            shared = np.bitwise_and.reduceat(m, at)
            shared &= ~(np.bitwise_and.reduceat(v, at) ^ np.bitwise_or.reduceat(v, at))
            levels.append((np.bitwise_and.reduceat(v, at) & shared, shared))
        self.levels = levels[::-1]
        self.rest = [self.levels[0][1]]
        for (_, above), (_, mask_here) in zip(self.levels[:-1], self.levels[1:], strict=True):
            self.rest.append(mask_here & ~np.repeat(above, FANOUT)[: len(mask_here)])

    def search(self, queries: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions (query, item) that differ in at most ``limit`` of the item's bits, in
        batches."""
        queries = queries.view(np.uint64)
        if not len(self.levels[0][0]):
            return
        step = max(1, _PAIRS // (FANOUT * 64))
        for i in range(0, len(queries), step):
            part = queries[i : i + step]
            top = len(self.levels[0][0])
            todo = [(0, np.repeat(np.arange(len(part)), top), np.tile(np.arange(top), len(part)), None)]
            while todo:
                depth, q, node, count = todo.pop()
                value = self.levels[depth][0]
                apart = np.bitwise_count((part[q] ^ value[node]) & self.rest[depth][node])
                count = apart if count is None else count + apart
                kept = np.flatnonzero(count <= limit)
                q, node, count = q[kept], node[kept], count[kept]
                if depth + 1 == len(self.levels):
                    if len(q):
                        yield q + i, node
                    continue
                size = len(self.levels[depth + 1][0])
                # Portions, so that a search in a dense region needs no more memory than any other.
                for j in range(0, len(q), _PAIRS // FANOUT):
                    child = (node[j : j + _PAIRS // FANOUT, None] * FANOUT + np.arange(FANOUT)).ravel()
                    inside = child < size
                    todo.append(
                        (
                            depth + 1,
                            np.repeat(q[j : j + _PAIRS // FANOUT], FANOUT)[inside],
                            child[inside],
                            np.repeat(count[j : j + _PAIRS // FANOUT], FANOUT)[inside],
                        )
                    )


def _links(codes: DataFrame, limit: int) -> DataFrame:
    """Links ``a, b`` that connect all codes (``fp``, distinct) at ``limit`` or fewer differing bits: per
    task a star for each group found there, never all pairs."""
    spark = codes.sparkSession
    ship(spark)
    n = codes.count()
    n_nodes = min(MAX_NODES, max(1, math.ceil(n / NODE_CODES)))
    ranked = codes.select("fp", gray_rank(F.col("fp")).alias("rank"))
    ranked = ranked.repartitionByRange(n_nodes, "rank").sortWithinPartitions("rank")
    ranges = materialise(ranked.select(F.spark_partition_id().alias("range"), "fp"), "gray-ranges")
    # Ranges next to each other make up a node until it has its share of codes: however many ranges the
    # codes were dealt to, there are as few nodes as their number allows.
    share, before, node_of = max(NODE_CODES, math.ceil(n / MAX_NODES)), 0, []
    for r in ranges.groupBy("range").count().orderBy("range").collect():
        node_of.append((r["range"], before // share))
        before += r["count"]
    nodes = spark.createDataFrame(node_of, "range int, node int")  # one row per range
    placed = materialise(ranges.join(F.broadcast(nodes), "range").select("node", "fp"), "gray-nodes")
    node_rows = (
        placed.groupBy("node")
        .agg(F.expr("bit_and(fp)").alias("all_of"), F.expr("bit_or(fp)").alias("any_of"))
        .orderBy("node")
        .collect()  # about MAX_NODES rows at most
    )
    node_id = np.array([r["node"] for r in node_rows], np.int64)
    shared = ~np.array([r["all_of"] ^ r["any_of"] for r in node_rows], np.int64)
    upper = spark.sparkContext.broadcast((node_id, np.array([r["all_of"] for r in node_rows], np.int64), shared))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, value, mask = upper.value
        index = GrayIndex(value, mask)
        for batch in batches:
            fp, own = batch.column("fp").to_numpy(), batch.column("node").to_numpy()
            for q, at in index.search(fp, limit):
                later = ids[at] > own[q]  # each pair of nodes is searched from one side
                yield pa.RecordBatch.from_pydict({"node": ids[at][later].astype(np.int32), "fp": fp[q][later]})

    guests = placed.mapInArrow(giving_back(route), "node int, fp long")
    guests = materialise(guests, "gray-guests")
    # The codes of a node are also its own queries; many queries are spread over parts of their own.
    lookups = guests.unionByName(placed)
    load = lookups.groupBy("node").agg(F.ceil(F.count("*") / F.lit(TASK_QUERIES)).cast("int").alias("parts"))
    spread = lookups.join(F.broadcast(load), "node")  # at most MAX_NODES rows
    asked = spread.select("node", F.pmod(F.xxhash64("fp"), "parts").cast("int").alias("part"), "fp", F.lit(False).alias("code"))
    held = placed.join(F.broadcast(load), "node").select(
        "node", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "fp", F.lit(True).alias("code")
    )

    def search(table: pa.Table) -> pa.Table:
        is_code = table["code"]
        code = table.filter(is_code)["fp"].to_numpy()
        query = table.filter(pc.invert(is_code))["fp"].to_numpy()
        rank = code.view(np.uint64).copy()
        for s in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(s)
        code = code[np.argsort(rank, kind="stable")]
        every, place = np.unique(np.concatenate((code, query)), return_inverse=True)
        of_code, of_query = place[: len(code)], place[len(code) :]
        forest = Forest(len(every))
        for q, c in GrayIndex(code).search(query, limit):
            forest.link(of_query[q], of_code[c])
        a, b = forest.links()
        give_back()
        return pa.table({"a": every[a], "b": every[b]})

    return asked.unionByName(held).groupBy("node", "part").applyInArrow(search, "a long, b long")


def near_duplicates(
    docs: DataFrame, *, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, fp, component_id``: one row per row of ``docs``; documents whose fingerprints differ in at
    most ``max_bits`` bits are linked, and ``component_id`` is the smallest id that can be reached.

    Equal fingerprints are one code of the index, so any number of copies costs one search. Null and empty
    texts have fingerprint 0 and are linked like any other. Rows with a null id take part; they get the
    smallest id that is not null of their component, null if there is none. Repeated rows are repeated;
    other columns are dropped.
    """
    made = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    codes = materialise(made.groupBy("fp").agg(F.min("id").alias("least")), "codes")
    roots = components(_links(codes.select("fp"), max_bits), "simhash-links")
    rooted = codes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialise(rooted, "roots")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_code = rooted.join(smallest, "root").select("fp", "component_id")
    return made.join(of_code, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
