"""Mixing to target weights: token weights are raked to the marginals of several dimensions, then documents
are sampled with the calibrated probabilities. Native expressions only."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..session import materialise_counted
from .common import materialise

_NO_VALUE = "(none)"
# Sweeps and tolerance of the rounds in which cells are still being held, and of the last.
_COARSE, _FINE = (6, 1e-2), (20, 1e-9)
# Up to so many cells, as counted, are fitted in one task, a round of sweeps per job; more are in rounds of joins.
CELLS_IN_ONE_TASK = 20_000
_LOG = logging.getLogger(__name__)


def n_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0))


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares of one dimension (``dim, target``): its shares of the tokens raised to ``power`` and
    scaled to add up to 1; a power of 1 keeps them, 0 makes them equal."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).filter("t > 0").withColumn("t", F.pow("t", F.lit(power)))
    return sums.select(dim, (F.col("t") / sums.agg(F.sum("t")).scalar()).alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], sweeps: int = 40, tolerance: float = 1e-9) -> DataFrame:
    """Iterative proportional fitting: ``cells`` (the dimensions and ``tokens``) with ``weight``, shares of
    the whole whose sums by each dimension are its ``target`` (``targets``: dimension to table of the dimension
    and ``target``).

    Values without a target, or with tokens in no cell, get weight 0; targets of the rest are scaled to add up
    to 1. One sweep scales to every dimension once; it ends when no factor differs from 1 by more than
    ``tolerance``, or after ``sweeps``, as targets that no table with these empty cells can have never settle.
    The cells are summed by dimension before they meet, so a value with most of the cells is no burden.
    """
    dims = list(targets)
    held = cells.filter("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for d in dims:
        held = held.join(targets[d].filter("target > 0").withColumnRenamed("target", f"t_{d}"), d)
    held = materialise(held.withColumn("off", F.lit(0.0)), "rake")
    # The values that are there stay the same, so their targets are scaled once.
    totals = [held.groupBy(d).agg(F.first(f"t_{d}").alias("t")).agg(F.sum("t")).first()[0] for d in dims]
    for _ in range(sweeps):
        now = held.withColumn("off", F.lit(0.0))
        for d, total in zip(dims, totals, strict=True):
            sums = now.groupBy(d).agg(F.sum("weight").alias("s"), F.first(f"t_{d}").alias("t"))
            factors = sums.select(d, (F.col("t") / F.lit(total) / F.col("s")).alias("f"))
            now = now.join(factors, d)
            now = now.withColumn("off", F.greatest("off", F.abs(F.col("f") - 1))).withColumn("weight", F.col("weight") * F.col("f")).drop("f")
        held = materialise(now, "rake")
        worst = held.agg(F.max("off")).first()[0]
        if worst is None or worst <= tolerance:
            break
    fitted = held.select(*dims, "weight")
    return cells.join(fitted, dims, "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))


def fill(cells: DataFrame, targets: Mapping[str, DataFrame], budget: float) -> DataFrame:
    """``cells`` with ``weight``, the tokens each is to give: ``budget`` (a share) of the tokens of all cells
    that have targets, by dimension as near to the targets as no cell giving more than it holds allows.

    Cells are raked to the targets of the whole budget. Those that would have to give all they hold or more are
    held at that, and the others are raked to what is left of the targets, until no more are held; what a value
    that is held as a whole lacks goes to the other values by their targets. So a cell with few tokens is kept
    whole and takes nothing from the others. Rounds are raked roughly while cells are being held, and to the end
    afterwards; a round that is not one of these last ones holds a cell. The budget is met exactly, whether or not the
    targets are.
    """
    if not 0 < budget <= 1:
        raise ValueError("the budget is a share of the tokens, above 0 and at most 1")
    dims = list(targets)
    # A target is a share of the budget; those of values without tokens do not count.
    start = rake(cells, targets, *_COARSE)
    total = start.filter("weight > 0").agg(F.sum("tokens")).first()[0]
    if total is None:
        return start
    wanted = {}
    for d in dims:
        present = start.filter("weight > 0").groupBy(d).agg(F.sum("tokens").alias("__n")).join(targets[d], d)
        wanted[d] = materialise(
            present.select(d, (F.col("target") / present.agg(F.sum("target")).scalar() * budget * total).alias("aim")), "mix-aims"
        )
    state = start.withColumns({"weight": F.col("weight") * (budget * total), "held": F.lit(False)})
    effort = _COARSE
    while True:
        full = ~F.col("held") & (F.col("weight") > 0) & (F.col("weight") >= F.col("tokens") * (1 - 1e-9))
        state = materialise(state.withColumns({"new": full, "held": F.col("held") | full}).withColumn(
            "weight", F.when(F.col("held"), F.col("tokens").cast("double")).otherwise(F.col("weight"))
        ), "mix-held")
        free = state.filter("NOT held AND weight > 0")
        n_new, n_free, kept = state.agg(
            F.count_if("new"), F.count_if(~F.col("held") & (F.col("weight") > 0)), F.sum(F.when(F.col("held"), F.col("tokens")))
        ).first()
        if not n_free or (not n_new and effort == _FINE):
            return state.drop("held", "new")
        effort = _COARSE if n_new else _FINE
        left = budget * total - (kept or 0)
        rest = {}
        for d in dims:
            sums = state.groupBy(d).agg(
                F.sum(F.when(F.col("held"), F.col("weight")).otherwise(0.0)).alias("h"),
                F.sum(F.when(F.col("held"), 0.0).otherwise(F.col("weight"))).alias("f"),
            ).filter("f > 0")
            # Below what they weigh now the free cells of a value never go.
            rest[d] = sums.join(wanted[d], d).select(d, F.greatest(F.col("aim") - F.col("h"), "f").alias("target"))
        again = rake(free.select(*dims, F.col("weight").alias("tokens")), rest, *effort)
        again = again.select(*dims, (F.col("weight") * left).alias("__weight"))
        state = state.join(again, dims, "left").withColumn("weight", F.coalesce("__weight", "weight")).drop("__weight", "new")


def _sweep(cells: DataFrame, dims: list[str], weight: str, aims: Mapping[str, Column], sweeps: int) -> DataFrame:
    """Sweeps over cells that are in one partition: windows need no exchange there. Cells of weight 0 stay so."""
    for _ in range(sweeps):
        for d in dims:
            whole = F.sum(weight).over(Window.partitionBy(d))
            cells = cells.withColumn(weight, F.when(whole > 0, F.col(weight) * aims[d] / whole).otherwise(F.lit(0.0)))
    return cells


def _fill_few(cells: DataFrame, targets: Mapping[str, DataFrame], budget: float) -> DataFrame:
    """:func:`fill` for at most ``CELLS_IN_ONE_TASK`` cells: the same rounds, each one job over one partition. What the
    driver learns of a round is counted as it is written."""
    dims = list(targets)
    state = cells
    for d in dims:
        state = state.join(F.broadcast(targets[d].withColumnRenamed("target", f"t_{d}")), d, "left")
    state = materialise(state.coalesce(1), "mix-few")  # CELLS_IN_ONE_TASK rows at most
    everywhere = Window.partitionBy()
    there = reduce(and_, (F.coalesce(F.col(f"t_{d}") > 0, F.lit(False)) for d in dims), F.col("tokens") > 0)
    state = state.coalesce(1).withColumns({"there": there, "held": F.lit(False)})
    state = state.withColumns({
        "weight": F.when(F.col("there"), F.col("tokens").cast("double")).otherwise(0.0),
        "goal": F.sum(F.when(F.col("there"), F.col("tokens"))).over(everywhere) * F.lit(float(budget)),
    })
    for d in dims:  # what each value is to give; a value's target counts once
        of_value = F.sum(F.col("there").cast("int")).over(Window.partitionBy(d))
        state = state.withColumn("part", F.when(F.col("there"), F.col(f"t_{d}") / of_value))
        state = state.withColumn(f"aim_{d}", F.col(f"t_{d}") / F.sum("part").over(everywhere) * F.col("goal"))
    state = _sweep(state, dims, "weight", {d: F.col(f"aim_{d}") for d in dims}, _COARSE[0])
    effort = _COARSE
    while True:
        full = ~F.col("held") & (F.col("weight") > 0) & (F.col("weight") >= F.col("tokens") * (1 - 1e-9))
        state = state.withColumn("new", full).withColumn("held", F.col("held") | F.col("new"))
        state = state.withColumn("weight", F.when(F.col("held"), F.col("tokens").cast("double")).otherwise(F.col("weight")))
        seen = Observation()
        state = materialise(state.observe(
            seen, F.count_if("new").alias("new"), F.count_if(~F.col("held") & (F.col("weight") > 0)).alias("free")
        ), "mix-round")
        n_new, n_free = (seen.get[c] for c in ("new", "free"))
        if not n_free or (not n_new and effort == _FINE):
            return state.select(*cells.columns, "weight")
        effort = _COARSE if n_new else _FINE
        free = F.when(F.col("held"), 0.0).otherwise(F.col("weight"))
        state = state.coalesce(1).withColumns({
            "free": free, "kept": F.when(F.col("held"), F.col("weight")).otherwise(0.0)
        })
        state = state.withColumn("left", F.col("goal") - F.sum("kept").over(everywhere))
        aims = {}
        for d in dims:
            of_value = Window.partitionBy(d)
            state = state.withColumns({
                f"f_{d}": F.sum("free").over(of_value), f"k_{d}": F.sum("kept").over(of_value),
                f"n_{d}": F.count_if(F.col("free") > 0).over(of_value),
            })
            # Below what they weigh now the free cells of a value never go.
            rest = F.when(F.col(f"f_{d}") > 0, F.greatest(F.col(f"aim_{d}") - F.col(f"k_{d}"), f"f_{d}"))
            state = state.withColumn(f"rest_{d}", rest)
            each = F.when(F.col("free") > 0, F.col(f"rest_{d}") / F.col(f"n_{d}"))
            state = state.withColumn(f"rest_{d}", F.col(f"rest_{d}") / F.sum(each).over(everywhere) * F.col("left"))
            aims[d] = F.col(f"rest_{d}")
        state = _sweep(state, dims, "free", aims, effort[0])
        state = state.withColumn("weight", F.when(F.col("held"), F.col("weight")).otherwise(F.col("free"))).drop(
            "free", "kept", "left", "new", *(f"{x}_{d}" for d in dims for x in ("f", "k", "n", "rest"))
        )


def report(mixed: DataFrame, dims: Mapping[str, Column], *, powers: Mapping[str, float] | None = None,
           targets: Mapping[str, DataFrame] | None = None, tokens: Column | None = None) -> DataFrame:
    """What the output of :func:`mix` comes to, with the same arguments: a row per dimension and value with
    ``tokens``, ``kept`` (expected), its ``share`` of all that is kept, its ``target``, and whether that is ``met`` (to
    a thousandth of the target)."""
    counted = (n_words(F.col("text")) if tokens is None else tokens).cast("long")
    rows = mixed.select(
        *(F.coalesce(c.cast("string"), F.lit(_NO_VALUE)).alias(f"__dim_{d}") for d, c in dims.items()),
        counted.alias("tokens"), (counted * F.col("mix_probability")).alias("kept"),
    )
    cells = materialise(rows.groupBy(*(f"__dim_{d}" for d in dims)).agg(F.sum("tokens").alias("tokens"), F.sum("kept").alias("kept")), "mix-report")
    out = None
    for d, goal in _aims(cells, dims, powers, targets).items():
        sums = cells.groupBy(d).agg(F.sum("tokens").alias("tokens"), F.sum("kept").alias("kept"))
        all_kept = cells.agg(F.sum("kept")).scalar()
        part = sums.join(goal, d, "left").select(
            F.lit(d.removeprefix("__dim_")).alias("dimension"), F.col(d).alias("value"), "tokens", "kept",
            (F.col("kept") / all_kept).alias("share"), F.coalesce("target", F.lit(0.0)).alias("target"),
        )
        out = part if out is None else out.unionByName(part)
    return out.withColumn("met", F.abs(F.col("share") - F.col("target")) <= F.col("target") / 1000)


def _aims(cells: DataFrame, dims: Mapping[str, Column], powers: Mapping[str, float] | None, targets: Mapping[str, DataFrame] | None) -> dict[str, DataFrame]:
    names = {d: f"__dim_{d}" for d in dims}
    return {
        names[d]: (targets[d].withColumnRenamed(d, names[d]) if targets and d in targets else tempered(cells, names[d], (powers or {}).get(d, 0.7)))
        for d in dims
    }


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix(
    docs: DataFrame,
    dims: Mapping[str, Column],
    *,
    powers: Mapping[str, float] | None = None,
    targets: Mapping[str, DataFrame] | None = None,
    tokens: Column | None = None,
    budget: float | None = None,
    id_col: str = "doc_id",
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``mix_probability`` and ``mix_kept``, every row and column kept.

    ``dims`` names the dimensions and says how a row gets its value (null is a value of its own). Targets
    are ``targets``, or else the corpus' own shares to the power in ``powers`` (0.7 unless given).

    With ``budget``, a share of the tokens, so many tokens are kept in expectation (:func:`fill`): cells too small
    for their part are kept whole, the others make up for them, and what is kept does not depend on the smallest
    cell. Targets that so can't be met are told by :func:`report`. Without it a document's probability is its cell's
    fitted weight per token, divided by the largest such ratio: then the tokens that are kept have the target
    shares in expectation, but one cell with few tokens and a large weight decides how much of all is kept,
    which may be next to nothing. The share that is kept is logged. Whether a document is kept depends on its id and
    ``seed`` alone, so rows that repeat an id are kept or left together.

    Documents of cells without tokens (empty texts) have probability 1, as they weigh nothing; a value
    without a target has probability 0. An empty table gives an empty one. Columns of ``docs`` may have any
    names but ``mix_probability`` and ``mix_kept``, which are replaced.
    """
    docs = docs.drop("mix_probability", "mix_kept")
    names = {d: f"__dim_{d}" for d in dims}
    keyed = docs.withColumns({names[d]: F.coalesce(c.cast("string"), F.lit(_NO_VALUE)) for d, c in dims.items()})
    counted = n_words(F.col("text")) if tokens is None else tokens
    cells = keyed.select(*names.values(), counted.cast("long").alias("tokens"))
    cells, n_cells = materialise_counted(cells.groupBy(*names.values()).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    aims = _aims(cells, dims, powers, targets)
    if budget is None:
        fitted = materialise(rake(cells, aims).withColumn("ratio", F.col("weight") / F.nullif("tokens", F.lit(0))), "mix-fit")
        chance = F.col("ratio") / fitted.agg(F.max("ratio")).scalar()
    else:
        fit = _fill_few if n_cells <= CELLS_IN_ONE_TASK else fill
        fitted = materialise(fit(cells, aims, budget), "mix-fit")
        chance = F.least(F.lit(1.0), F.col("weight") / F.nullif("tokens", F.lit(0)))
    rates = fitted.select(*names.values(), "tokens", F.coalesce(chance, F.lit(1.0)).alias("mix_probability"))
    rates = materialise(rates, "mix-rates")
    whole, kept = rates.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("mix_probability"))).first()
    if whole:
        _LOG.warning("mixing keeps %.4f of the tokens, in expectation", kept / whole)
    rates = rates.drop("tokens")
    joined = keyed.join(rates, list(names.values()), "left").drop(*names.values())
    return joined.withColumn("mix_kept", uniform(F.col(f"`{id_col}`"), seed) < F.col("mix_probability")).select(
        *(F.col(f"`{c}`") for c in docs.columns), "mix_probability", "mix_kept"
    )
