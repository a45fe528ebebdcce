"""Contingency tables and the chi-square test of independence, in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.chi_square import chi_square_tail
from ..session import materialise
from .skew import join_small


def contingency(
    df: DataFrame, row: str, col: str, values: Sequence[str], *, weight: str | None = None, n: str = "n"
) -> DataFrame:
    """Counts per (row, col), with a zero for every listed value a row lacks.

    ``weight`` sums a column of counts instead of counting rows. Values outside the list keep their
    cells. The zeros are added to the aggregated cells, so their cost does not grow with the data.
    """
    cells = df.groupBy(row, col).agg((F.sum(weight) if weight else F.count("*")).cast("bigint").alias(n))
    listed = F.array(*(F.struct(F.lit(v).alias("c"), F.lit(0).cast("bigint").alias("n")) for v in values))
    own = F.array(F.struct(F.col(col).alias("c"), F.col(n).alias("n")))
    return (
        cells.select(row, F.explode(F.concat(own, listed)).alias("__cell"))
        .groupBy(row, F.col("__cell.c").alias(col))
        .agg(F.sum("__cell.n").alias(n))
    )


def pivot_contingency(table: DataFrame, row: str, col: str, values: Sequence[str], n: str = "n") -> DataFrame:
    """The wide form for display: one column per listed value, no job to find the values."""
    return table.groupBy(row).pivot(col, list(values)).agg(F.sum(n)).na.fill(0)


def supported_rows(
    table: DataFrame, row: str, col: str, values: Sequence[str], min_support: int = 5, n: str = "n"
) -> DataFrame:
    """Rows of the table in which every listed value has more than ``min_support`` counts."""
    least = F.min(F.when(F.col(col).isin(*values), F.col(n))).over(Window.partitionBy(row))
    return table.withColumn("__least", least).filter(F.col("__least") > min_support).drop("__least")


def chi_square(
    table: DataFrame, row: str, col: str, *, n: str = "n", alpha: float = 0.05, yates: bool = True
) -> DataFrame:
    """Chi-square test of independence on a long table: one row (statistic, dof, p_value, n,
    n_rows, n_cols, significant).

    The cells are written once and summed by row and by column; neither is gathered in one task.
    Absent cells count as zero. As in common statistics packages the Yates correction applies at one
    degree of freedom, and a table with a single row or column gives statistic 0 and p 1. An empty
    table and a line of zeros are errors there; here the first gives no row, the second is left out.
    """
    grouped = table.groupBy(F.col(row).alias("__r"), F.col(col).alias("__c"))
    cells = materialise(grouped.agg(F.sum(n).cast("double").alias("__o")), "chi-square-cells")
    by_row = cells.groupBy("__r").agg(F.sum("__o").alias("__sr")).filter("__sr > 0")
    by_col = cells.groupBy("__c").agg(F.sum("__o").alias("__sc")).filter("__sc > 0")
    total = by_row.agg(F.struct(F.sum("__sr").alias("n"), F.count("*").alias("r"), F.lit(0).cast("bigint").alias("c")).alias("t")).scalar()
    n_cols = by_col.agg(F.count("*")).scalar()
    lines = (
        join_small(join_small(cells, by_row, ["__r"]), by_col, ["__c"])
        .withColumn("__t", total)
        .withColumn("__t", F.col("__t").withField("c", n_cols))
        .withColumn("__dof", (F.col("__t.r") - 1) * (F.col("__t.c") - 1))
        .withColumn("__e", F.col("__sr") * F.col("__sc") / F.col("__t.n"))
    )
    off = F.abs(F.col("__o") - F.col("__e"))
    corrected = (F.col("__dof") == 1) & F.lit(yates)
    off = off - F.when(corrected, F.least(F.lit(0.5), off)).otherwise(0.0)
    # Cells missing from the table: observed 0, so each adds its expected count. Under the correction
    # the table is 2x2: all its offsets are equal, and so are the expected counts of missing cells.
    present = F.sum("__e")
    summed = lines.agg(
        F.first("__t").alias("t"),
        F.first("__dof").alias("dof"),
        F.sum(off * off / F.col("__e")).alias("s"),
        (F.first("__t.n") - present).alias("rest"),
        F.max(off).alias("off"),
        F.count("*").alias("cells"),
    )
    missing = F.greatest(F.lit(0.0), F.col("rest"))
    gone = F.col("t.r") * F.col("t.c") - F.col("cells")
    extra = (
        F.when(gone == 0, 0.0)
        .when((F.col("dof") == 1) & F.lit(yates), F.pow(gone * F.col("off"), 2) / missing)
        .otherwise(missing)
    )
    statistic: Column = F.when(F.col("dof") == 0, 0.0).otherwise(F.col("s") + extra)
    return (
        summed.filter("cells > 0")
        .withColumn("statistic", statistic)
        .withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("dof")))
        .select(
            "statistic",
            "dof",
            "p_value",
            F.col("t.n").cast("bigint").alias("n"),
            F.col("t.r").cast("bigint").alias("n_rows"),
            F.col("t.c").cast("bigint").alias("n_cols"),
            (F.col("p_value") < alpha).alias("significant"),
        )
    )
