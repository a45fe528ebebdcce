"""Upper tail of the chi-square distribution for whole degrees of freedom, as a column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def _sum(items: Column, start: Column, step) -> Column:
    return F.aggregate(items, start, step)


def _log_weight(a: Column, x: Column) -> Column:
    """log of x^a exp(-x) / Gamma(a). Stirling's series from 20 on, written in x/a - 1 so that large terms
    do not cancel; below 20 Gamma is carried up by its recurrence first."""

    def rest(z: Column) -> Column:
        return 1 / (z * 12) - 1 / (F.pow(z, 3) * 360) + 1 / (F.pow(z, 5) * 1260)

    off = (x - a) / a
    large = -a * (off - F.log1p(off)) + F.log(a / (2 * math.pi)) / 2 - rest(a)
    z = a + 20
    carried = _sum(F.sequence(F.lit(0), F.lit(19)), F.lit(0.0), lambda s, i: s + F.log(a + i))
    small = a * F.log(x) - x + carried - ((z - 0.5) * F.log(z) - z + math.log(2 * math.pi) / 2 + rest(z))
    return F.when(a < 20, small).otherwise(large)


def chi_square_tail(x: Column, dof: Column) -> Column:
    """P(X >= x): the regularised incomplete gamma function of half the degrees and half of x.

    Its power series below the mean, its continued fraction above; both need a number of terms that grows
    with the square root of the degrees only.
    """
    a, h = dof / 2, x / 2
    steps = F.floor(F.sqrt(a) * 12).cast("int")
    series = _sum(
        F.sequence(F.lit(1), steps + 120),
        F.struct((1 / a).alias("term"), (1 / a).alias("sum")),
        lambda s, n: F.struct(
            (s["term"] * h / (a + n)).alias("term"), (s["sum"] + s["term"] * h / (a + n)).alias("sum")
        ),
    )["sum"]
    fraction = _sum(
        F.sequence(steps + 300, F.lit(1), F.lit(-1)),
        F.lit(0.0),
        lambda f, n: n * (n - a) / (h + n * 2 + 1 - a - f),
    )
    weight = F.exp(_log_weight(a, h))
    tail = F.when(h < a + 1, 1 - weight * series).otherwise(weight / (h + 1 - a - fraction))
    return F.when(x.isNull() | dof.isNull(), F.lit(None).cast("double")).when(
        (dof == 0) | (x <= 0), 1.0
    ).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))
