"""P-values of the chi-square test by drawing tables, where expected counts are too small for its distribution."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .contingency import chi_square

# Lines of either side; the totals of all lines are sent to every task.
MAX_LINES = 2_000_000
# Largest total that a table can be drawn for exactly.
MAX_TOTAL = 999_999_999
# Counts that are shuffled at a time.
BLOCK_ROWS = 1_000_000


def chi_square_monte_carlo(
    table: DataFrame, row: str, col: str, *, n: str = "n", replicates: int = 999, seed: int = 0, alpha: float = 0.05
) -> DataFrame:
    """Chi-square test of independence on a long table of counts, by tables drawn at random with the same totals per
    row and column: one row (statistic, n, n_rows, n_cols, replicates, n_as_large, p_value, standard_error,
    closed_p_value, significant); ``closed_p_value`` is that of the distribution.

    The p-value is (tables drawn with a statistic as large + 1) / (tables + 1). Each table is drawn whole by one task
    from ``seed`` and its number, so that results repeat, and in blocks of columns: its memory follows the lines and
    ``BLOCK_ROWS``, not the counts. There is no Yates correction. Null values are lines of their own, lines of zeros
    count as absent, a table with a single line has p 1, an empty one gives no row. More than ``MAX_LINES`` lines or
    a total above ``MAX_TOTAL`` are errors, raised before anything is drawn.
    """
    spark = table.sparkSession
    grouped = table.groupBy(F.col(row).alias("__r"), F.col(col).alias("__c"))
    cells = materialise(grouped.agg(F.sum(n).cast("bigint").alias("__o")).filter("__o <> 0"), "drawn-cells")
    found = chi_square(cells, "__r", "__c", n="__o", yates=False).first()
    taken = {"statistic": "double", "n": "bigint", "n_rows": "bigint", "n_cols": "bigint", "closed_p_value": "double"}
    shape = (
        "statistic double, n bigint, n_rows bigint, n_cols bigint, replicates int, n_as_large bigint, p_value double, "
        "standard_error double, closed_p_value double, significant boolean"
    )
    if found is None:
        return spark.createDataFrame([], shape)
    if max(found["n_rows"], found["n_cols"]) > MAX_LINES or found["n"] > MAX_TOTAL:
        raise ValueError(f"a table of {found['n_rows']} by {found['n_cols']} lines and {found['n']} counts is too large to draw")

    def totals(line: str) -> np.ndarray:  # at most MAX_LINES numbers
        sums = cells.groupBy(line).agg(F.sum("__o").alias("t")).select("t").toArrow()
        return np.sort(sums["t"].to_numpy())[::-1].astype(np.int64)

    # Which side is dealt to which makes no difference; the shorter one is dealt.
    rows, cols = sorted((totals("__r"), totals("__c")), key=len)
    shared = spark.sparkContext.broadcast((rows, cols, _blocks(cols, len(rows))))
    total = found["n"]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, cols, blocks = shared.value
        for batch in batches:
            statistics = []
            for number in batch.column("id").to_pylist():
                rng, left, weighed = np.random.default_rng([seed, number]), rows, 0.0
                for start, stop in blocks:
                    size = int(cols[start:stop].sum())
                    dealt = left if stop == len(cols) else rng.multivariate_hypergeometric(left, size, method="marginals")
                    left = left - dealt
                    if stop - start == 1:
                        weighed += float((dealt.astype(float) ** 2 / rows).sum() / cols[start])
                        continue
                    # The counts of a block meet its columns in random order.
                    width = stop - start
                    lines = np.repeat(np.arange(len(rows)), dealt)
                    rng.shuffle(lines)
                    at, count = np.unique(lines * width + np.repeat(np.arange(width), cols[start:stop]), return_counts=True)
                    weighed += float((count.astype(float) ** 2 / rows[at // width] / cols[start + at % width]).sum())
                statistics.append(total * (weighed - 1))
            yield pa.RecordBatch.from_arrays([pa.array(statistics, pa.float64())], ["drawn"])

    tasks = min(replicates, 4 * spark.sparkContext.defaultParallelism)
    drawn = spark.range(0, replicates, 1, tasks).mapInArrow(draw, "drawn double")
    # Tables with the same statistic but for rounding count as equal.
    least = found["statistic"] - 1e-9 * max(1.0, found["statistic"])
    p = (F.col("n_as_large") + 1) / (replicates + 1)
    return (
        drawn.agg(F.count_if(F.col("drawn") >= least).alias("n_as_large"))
        .withColumns({c: F.lit(found[c.removeprefix("closed_")]).cast(kind) for c, kind in taken.items()})
        .withColumns({"replicates": F.lit(replicates), "p_value": p})
        .withColumn("standard_error", F.sqrt(F.col("p_value") * (1 - F.col("p_value")) / replicates))
        .withColumn("significant", F.col("p_value") < alpha)
        .select(
            "statistic", "n", "n_rows", "n_cols", "replicates", "n_as_large", "p_value", "standard_error",
            "closed_p_value", "significant",
        )
    )


def _blocks(cols: np.ndarray, n_rows: int) -> list[tuple[int, int]]:
    """Columns, largest first, as ranges that are drawn together: a column with at least a count per row by itself, as
    its cells are drawn without shuffling counts, smaller ones up to ``BLOCK_ROWS`` counts."""
    out, start, held = [], 0, 0
    for at, size in enumerate(cols.tolist()):
        alone = size >= n_rows
        if at > start and (alone or held + size > BLOCK_ROWS):
            out.append((start, at))
            start, held = at, 0
        held += size
        if alone:
            out.append((start, at + 1))
            start, held = at + 1, 0
    if start < len(cols):
        out.append((start, len(cols)))
    return out
