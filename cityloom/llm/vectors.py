"""Vectors that take part in searches, and classes of equal ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, FloatType


def valid(vec: Column) -> Column:
    """Not null, not empty, not zero, no component null, NaN or infinite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def plain(vec: Column, kind: DataType) -> tuple[Column, str]:
    """Vectors of a column of type ``kind``, and the type of their components: 32-bit ones stay as they are, as
    they are moved about more cheaply and lose nothing; all others become doubles. Zero has two signs; as part of
    a key it must have one."""
    of = "float" if isinstance(getattr(kind, "elementType", None), FloatType) else "double"
    return F.transform(vec.cast(f"array<{of}>"), lambda x: x + F.lit(0.0).cast(of)), of


def dimension(vectors: DataFrame, vec_col: str = "vec") -> int:
    """The commonest length, the smaller one of a tie; 0 for an empty table."""
    row = vectors.groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return row["d"] if row else 0
