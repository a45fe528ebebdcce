import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cityloom.operators import monte_carlo
from cityloom.operators.indexing import dense_id
from cityloom.operators.monte_carlo import chi_square_monte_carlo
from cityloom.operators.sketches import estimated, roll_up, sketch_distinct


def table(spark, matrix):
    rows = [(f"r{i}", f"c{j}", v) for i, row in enumerate(matrix) for j, v in enumerate(row)]
    return spark.createDataFrame(rows, "r string, c string, n bigint")


def statistic(matrix):
    m = np.array(matrix, float)
    e = m.sum(1, keepdims=True) * m.sum(0) / m.sum()
    return float(((m - e) ** 2 / e).sum())


def exact(matrix):
    """The share of all ways to deal the counts, with these totals, that give a statistic as large."""
    rows, cols = [sum(r) for r in matrix], [sum(c) for c in zip(*matrix)]
    lines = [i for i, r in enumerate(rows) for _ in range(r)]
    columns = [j for j, c in enumerate(cols) for _ in range(c)]
    tables = Counter()
    n = len(lines)
    for spots in set(itertools.permutations(lines)) if n <= 8 else ():
        cells = [[0] * len(cols) for _ in rows]
        for i, j in zip(spots, columns):
            cells[i][j] += 1
        tables[tuple(map(tuple, cells))] += 1
    least = statistic(matrix) - 1e-9
    return sum(w for t, w in tables.items() if statistic(t) >= least) / sum(tables.values())


@pytest.mark.parametrize("matrix", [[[3, 0], [1, 4]], [[2, 0, 1], [0, 3, 0], [0, 0, 2]], [[1, 1, 2, 0], [1, 0, 1, 2]]])
@pytest.mark.parametrize("block", [1_000_000, 2])
def test_share_of_drawn_tables_is_that_of_all(spark, monkeypatch, matrix, block):
    monkeypatch.setattr(monte_carlo, "BLOCK_ROWS", block)
    got = chi_square_monte_carlo(table(spark, matrix), "r", "c", replicates=8_000, seed=3).first()
    want = exact(matrix)
    assert got["statistic"] == pytest.approx(statistic(matrix))
    assert abs(got["p_value"] - want) < 4 * math.sqrt(want * (1 - want) / 8_000) + 1 / 8_000
    assert got["p_value"] == (got["n_as_large"] + 1) / 8_001


@pytest.mark.parametrize("block", [100, 7])
def test_small_columns_are_shuffled_in_blocks(spark, monkeypatch, block):
    """More lines than any column has counts; with and without blocks the p-value is near that of the distribution."""
    monkeypatch.setattr(monte_carlo, "BLOCK_ROWS", block)
    rng = np.random.default_rng(1)
    matrix = np.zeros((40, 40), int)
    np.add.at(matrix, (rng.integers(0, 40, 900), rng.integers(0, 40, 900)), 1)
    cols, n_rows = np.sort(matrix.sum(0))[::-1], 40
    blocks = monte_carlo._blocks(cols, n_rows)
    assert [a for a, _ in blocks[1:]] == [b for _, b in blocks[:-1]] and blocks[0][0] == 0 and blocks[-1][1] == 40
    assert all(b - a == 1 or cols[a:b].sum() <= block for a, b in blocks)
    got = chi_square_monte_carlo(table(spark, matrix.tolist()), "r", "c", replicates=400).first()
    z = (statistic(matrix) - 39 * 39) / math.sqrt(2 * 39 * 39)
    assert abs(got["p_value"] - math.erfc(z / math.sqrt(2)) / 2) < 0.12


def test_results_do_not_depend_on_the_layout(spark):
    cells = table(spark, [[5, 1, 0], [2, 7, 3]])
    got = [chi_square_monte_carlo(x, "r", "c", replicates=200, seed=9).first() for x in (cells, cells.repartition(5), cells)]
    assert got[0] == got[1] == got[2]
    turned = chi_square_monte_carlo(cells, "c", "r", replicates=200, seed=9).first()
    assert (turned["n_rows"], turned["n_cols"], turned["n_as_large"]) == (3, 2, got[0]["n_as_large"])


def test_a_hundred_thousand_lines_a_side(spark):
    n = 100_000
    alike = spark.range(n).selectExpr("id AS r", f"(id * 7 + 3) % {n} AS c", "3L AS n")
    got = chi_square_monte_carlo(alike, "r", "c", replicates=99).first()
    assert (got["n_rows"], got["n_cols"], got["n"], got["n_as_large"], got["p_value"]) == (n, n, 3 * n, 0, 0.01)
    assert got["statistic"] == pytest.approx(3 * n * (n - 1))
    dealt = spark.range(3 * n).selectExpr(f"id % {n} AS r", f"pmod(xxhash64(id, 5), {n}) AS c", "1L AS n")
    got = chi_square_monte_carlo(dealt, "r", "c", replicates=99).first()
    assert 0.01 < got["p_value"] < 1


def test_tables_without_a_choice_and_too_large_ones(spark, monkeypatch):
    one = chi_square_monte_carlo(table(spark, [[3, 4]]), "r", "c", replicates=20).first()
    assert (one["p_value"], one["n_as_large"], one["significant"], one["n"]) == (1.0, 20, False, 7)
    assert chi_square_monte_carlo(table(spark, [[0, 0]]), "r", "c").count() == 0
    nulls = table(spark, [[30, 1], [2, 40]]).withColumn("r", F.nullif("r", F.lit("r0")))
    assert chi_square_monte_carlo(nulls, "r", "c", replicates=99).first()["p_value"] == 0.01
    monkeypatch.setattr(monte_carlo, "MAX_TOTAL", 9)
    with pytest.raises(ValueError, match="too large"):
        chi_square_monte_carlo(table(spark, [[5, 5]]), "r", "c")


def test_sketches_roll_up_to_what_one_pass_gives(spark):
    df = spark.range(60_000).selectExpr(
        "CAST(id % 3 AS STRING) AS a", "nullif(id % 4, 0) AS b", "id % 20011 AS v", "CAST(nullif(id % 7, 0) AS DOUBLE) AS w", "2L AS n"
    )
    sketches = sketch_distinct(df, ["a", "b"], ["v", "w"], weight="n")
    assert sketches.count() == 12
    got = estimated(roll_up(sketches, ["a", "b"], ["v", "w"]), ["v", "w"]).collect()
    want = df.cube("a", "b").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("n").alias("num_rows"), F.count_distinct("v").alias("v"), F.count_distinct("w").alias("w")
    )
    exact = {(r["level"], r["a"], r["b"]): r for r in want.collect()}
    assert {(r["level"], r["a"], r["b"]) for r in got} == set(exact) and len(got) == 20
    for r in got:
        e = exact[r["level"], r["a"], r["b"]]
        assert r["num_rows"] == e["num_rows"] and r["w"] == e["w"] == 6
        assert r["v"] == pytest.approx(e["v"], rel=0.04)


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", 1)], "k string, v int")
    got = estimated(sketch_distinct(df, ["k"], ["v"]), ["v"])
    assert sorted(map(tuple, got.collect())) == [("a", 1, 0), ("b", 1, 1)]
    assert estimated(roll_up(sketch_distinct(df.limit(0), ["k"], ["v"]), ["k"], ["v"]), ["v"]).filter("v > 0").count() == 0


@pytest.mark.parametrize("parts", [None, 6])
def test_dense_ids_read_their_input_once(spark, parts):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.range(3_000, numPartitions=4).mapInArrow(seen, "id long")
    got = dense_id(df, "id", "i", start=5, parts=parts)
    assert got.filter("i = id + 5").count() == 3_000
    assert read.value == 3_000
