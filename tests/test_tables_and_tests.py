import math

import pytest
from pyspark.sql import functions as F

from cityloom.functions.chi_square import chi_square_tail
from cityloom.operators.contingency import chi_square, contingency, pivot_contingency, supported_rows


def table(spark, cells):
    return spark.createDataFrame([(r, c, n) for (r, c), n in cells.items()], "r string, c string, n bigint")


def dense(matrix):
    return {(f"r{i}", f"c{j}"): v for i, row in enumerate(matrix) for j, v in enumerate(row)}


def plain(matrix, yates=False):
    total = sum(map(sum, matrix))
    rows, cols = [sum(r) for r in matrix], [sum(c) for c in zip(*matrix)]
    s = 0.0
    for i, row in enumerate(matrix):
        for j, o in enumerate(row):
            e = rows[i] * cols[j] / total
            d = abs(o - e)
            s += (d - (min(0.5, d) if yates else 0)) ** 2 / e
    return s


def test_zeros_for_listed_values_and_unlisted_values_stay(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("b", "other")], "r string, c string")
    got = {(x["r"], x["c"]): x["n"] for x in contingency(df, "r", "c", ["x", "y"]).collect()}
    assert got == {("a", "x"): 2, ("a", "y"): 0, ("b", "x"): 0, ("b", "y"): 1, ("b", "other"): 1}
    wide = pivot_contingency(contingency(df, "r", "c", ["x", "y"]), "r", "c", ["x", "y"])
    assert sorted(map(tuple, wide.collect())) == [("a", 2, 0), ("b", 0, 1)]


def test_weighted_counts(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "x", 4)], "r string, c string, n bigint")
    assert contingency(df, "r", "c", ["x"], weight="n").collect() == [("a", "x", 7)]


def test_support_is_strictly_more_and_needs_every_listed_value(spark):
    df = table(spark, {("a", "x"): 6, ("a", "y"): 6, ("b", "x"): 5, ("b", "y"): 60, ("c", "x"): 9, ("c", "y"): 0})
    kept = supported_rows(df, "r", "c", ["x", "y"], 5)
    assert {r["r"] for r in kept.collect()} == {"a"}


@pytest.mark.parametrize("matrix", [[[10, 20, 30], [6, 9, 17]], [[12, 7], [5, 9], [30, 8]], [[7] * 7 for _ in range(6)],
                                    [[30, 10, 12, 9], [11, 28, 13, 8], [9, 10, 40, 17], [25, 25, 25, 26]]])
def test_statistic_and_p(spark, matrix):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import ChiSquareTest

    got = chi_square(table(spark, dense(matrix)), "r", "c").first()
    assert got["statistic"] == pytest.approx(plain(matrix), abs=1e-9)
    assert got["dof"] == (len(matrix) - 1) * (len(matrix[0]) - 1)
    rows = [(float(i), Vectors.dense(float(j))) for i, r in enumerate(matrix) for j, v in enumerate(r) for _ in range(v)]
    want = ChiSquareTest.test(spark.createDataFrame(rows, ["label", "features"]), "features", "label").first()
    assert got["statistic"] == pytest.approx(want["statistics"][0], abs=1e-9)
    assert got["p_value"] == pytest.approx(want["pValues"][0], abs=1e-12)


@pytest.mark.parametrize("matrix", [[[10, 20], [30, 25]], [[5, 0], [3, 9]], [[5, 0], [0, 5]], [[5, 0], [0, 9]], [[8, 9], [8, 8]]])
def test_correction_at_one_degree_of_freedom(spark, matrix):
    sparse = {k: v for k, v in dense(matrix).items() if v}
    for cells in (dense(matrix), sparse):
        got = chi_square(table(spark, cells), "r", "c").first()
        assert got["statistic"] == pytest.approx(plain(matrix, yates=True), abs=1e-9)
        assert got["p_value"] == pytest.approx(math.erfc(math.sqrt(got["statistic"] / 2)), rel=1e-12)
        raw = chi_square(table(spark, cells), "r", "c", yates=False).first()
        assert raw["statistic"] == pytest.approx(plain(matrix), abs=1e-9)


def test_absent_cells_count_as_zero(spark):
    matrix = [[10, 0, 7], [0, 12, 9], [5, 6, 0]]
    sparse = {k: v for k, v in dense(matrix).items() if v}
    assert chi_square(table(spark, sparse), "r", "c").first()["statistic"] == pytest.approx(plain(matrix), abs=1e-9)


def test_a_table_with_many_cells(spark):
    df = spark.range(200_000).selectExpr("id % 400 AS r", "id % 499 + 1000 AS c", "1 + id % 7 AS n")
    got = chi_square(df, "r", "c").first()
    cells = {}
    for i in range(200_000):
        cells[i % 400, i % 499] = cells.get((i % 400, i % 499), 0) + 1 + i % 7
    matrix = [[cells.get((i, j), 0) for j in range(499)] for i in range(400)]
    assert (got["dof"], got["n"]) == (399 * 498, sum(cells.values()))
    assert got["statistic"] == pytest.approx(plain(matrix), rel=1e-9)
    normal = (got["statistic"] - got["dof"]) / math.sqrt(2 * got["dof"])
    assert got["p_value"] == pytest.approx(math.erfc(normal / math.sqrt(2)) / 2, abs=2e-3)


def test_degrees_of_freedom_beyond_an_int(spark):
    """A sparse table of 60,000 by 60,000 lines, one count in each line: every cell is expected to hold 1/60,000."""
    n = 60_000
    cells = spark.range(n).selectExpr("id AS r", f"(id * 7 + 3) % {n} AS c", "1L AS n")
    got = chi_square(cells, "r", "c").first()
    assert (got["dof"], got["n"], got["n_rows"], got["n_cols"]) == ((n - 1) ** 2, n, n, n)
    assert got["statistic"] == pytest.approx(n * (n - 1)) and got["dof"] > 2**31
    # (x - dof) / sqrt(2 dof) is 1 / sqrt 2 here, and the distribution nearly normal.
    assert got["p_value"] == pytest.approx(0.5 * math.erfc(0.5), abs=1e-4)


def test_null_lines_are_lines(spark):
    cells = {("a", "x"): 10, ("a", None): 20, (None, "x"): 30, (None, None): 25}
    assert chi_square(table(spark, cells), "r", "c").first()["statistic"] == pytest.approx(plain([[10, 20], [30, 25]], yates=True))


def test_degenerate_tables(spark):
    one = chi_square(table(spark, {("a", "x"): 3, ("a", "y"): 4}), "r", "c").first()
    assert (one["statistic"], one["dof"], one["p_value"], one["significant"]) == (0.0, 0, 1.0, False)
    assert chi_square(spark.createDataFrame([], "r string, c string, n bigint"), "r", "c").count() == 0
    product = chi_square(table(spark, dense([[2, 4, 6], [3, 6, 9]])), "r", "c").first()
    assert product["statistic"] == pytest.approx(0, abs=1e-9) and product["p_value"] == pytest.approx(1)


def test_tail_against_closed_forms_and_extremes(spark):
    def one(x, d):
        return spark.range(1).select(chi_square_tail(F.lit(float(x)), F.lit(d)).alias("p")).first()["p"]

    for x in (0.01, 0.5, 1.9, 2.1, 7.0, 40.0):
        assert one(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-12)
        assert one(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-12)
        assert one(x, 3) == pytest.approx(
            math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2), rel=1e-12
        )
        assert one(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-12)
    assert one(0, 5) == 1.0
    assert one(1500, 10) < 1e-300
    assert one(2000, 2000) == pytest.approx(0.4958, abs=1e-3)
    assert one(2001, 2001) == pytest.approx(0.4958, abs=1e-3)
    assert one(5, 40) == pytest.approx(1.0, abs=1e-9)
    # Wilson and Hilferty's cube root is normal to six digits here.
    for d in (10_000_000, 10_000_001):
        for x in (d - 9000, d, d + 4000, d + 15000):
            z = ((x / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))
            assert one(x, d) == pytest.approx(math.erfc(z / math.sqrt(2)) / 2, rel=1e-5)
