import numpy as np
import pytest

from cityloom.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def factor(a):
    r = np.linalg.qr(a, mode="r")
    return np.vstack((r, np.zeros((max(0, a.shape[1] - len(r)), a.shape[1]))))


def matrices():
    r = np.random.default_rng(3)
    base = np.linalg.qr(r.standard_normal((200, 40)))[0]
    turn = np.linalg.qr(r.standard_normal((40, 40)))[0]
    steps = np.repeat([3.0, 2.0, 1.0], [10, 20, 10])
    wide = r.standard_normal((200, 40))
    flat = wide.copy()
    flat[:, 5], flat[:, 7] = 0, flat[:, 8]
    return {
        "one": r.standard_normal((9, 1)), "plain": wide, "graded": wide * np.logspace(0, -8, 40), "equal": base,
        "clusters": (base * steps) @ turn, "close": (base * (1 + 1e-9 * np.arange(40))) @ turn, "flat": flat,
        "few": r.standard_normal((7, 40)), "zero": np.zeros((5, 6)), "line": np.ones((5, 6)), "diagonal": np.diag(np.arange(8.0)),
        "wilkinson": np.diag(np.abs(np.arange(-10, 11.0))) + np.diag(np.ones(20), 1),
        "blocks": np.kron(np.eye(4), r.standard_normal((5, 4))),
    }


@pytest.mark.parametrize("name", matrices())
def test_solver(name):
    a = matrices()[name]
    r = factor(a)
    diagonal, upper, right = whitening.bidiagonalise(r)
    values, want = whitening.dqds(diagonal, upper), np.linalg.svd(r, compute_uv=False)
    m = int((want > 1e-12 * max(want[0], 1e-300)).sum())
    assert int((values > 1e-12 * max(values[0], 1e-300)).sum()) == m
    assert np.allclose(values[:m], want[:m], rtol=1e-12, atol=0)
    v = right @ whitening.twisted_vectors(diagonal, upper, values[:m])
    assert np.abs(v.T @ v - np.eye(m)).max(initial=0) < 1e-11
    assert np.abs(a.T @ (a @ v) - v * values[:m] ** 2).max(initial=0) <= 1e-13 * max(want[0], 1) ** 2


def check(spark, folder, kept, components=32):
    """The query's rows against numpy's eigenvectors and whole numbers of any size."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    apart = np.array([[n * c - s for c, s in zip(row, sums, strict=True)] for row in x], float) / n
    values, vectors = np.linalg.eigh(apart.T @ apart / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    m = min(components, int((values > 1e-18 * values[0]).sum()))
    df = queries.op11_whitening(spark, folder)
    assert df.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    got = df.collect()
    assert len(got) == m * n and {r["n"] for r in got} == {n}
    assert sorted((r["vec_id"] is None, r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == sorted(
        (i is None, i, sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True))) for (i, _), row in zip(kept, x, strict=True)
    )
    (error,) = {r["identity_error"] for r in got}
    assert error < 1e-9
    for j in range(1, m + 1):
        mine = {r["vec_id"]: r for r in got if r["component"] == j}
        assert all(abs(r["explained"] - values[j - 1] / values.sum()) < 1e-9 for r in mine.values())
        want = apart @ vectors[:, j - 1] / np.sqrt(values[j - 1])
        ids = [i for i, _ in kept]
        have = np.array([mine[i]["whitened"] for i in ids])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(spark, SF, [(r["vec_id"], r["embedding"]) for r in rows if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"])])


def test_odd_rows(spark, tmp_path):
    r = np.random.default_rng(0)
    good = [(i, [float(np.float32(c)) for c in r.standard_normal(3)]) for i in range(40)]
    good += [(50, [0.0, 0.0, 0.0]), (51, good[0][1]), (51, good[0][1])] + [(60 + i, [1.5, -2.0, 0.25]) for i in range(30)]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 0.0]), (94, [float("inf"), 0.0, 0.0]), (95, [1.0])]
    rows = [(i, v, 1, "x") for i, v in good + bad]
    kind = "vec_id long, embedding array<float>, n int, id string"
    spark.createDataFrame(rows, kind).repartition(40).write.parquet(f"{tmp_path}/embeddings.parquet")
    check(spark, str(tmp_path), good)


def test_no_spread_and_no_rows(spark, tmp_path):
    for i, rows in enumerate(([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)])):
        folder = f"{tmp_path}/{i}"
        spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
        assert queries.op11_whitening(spark, folder).collect() == []


def test_spread_along_one_line_has_one_component(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)] + [(None, [3.0, 6.0, 5.0])]
    df = spark.createDataFrame(rows, "key long, v array<double>")
    model = whitening.fit(df, id_col="key", vector_col="v")
    assert model.n == 10 and len(model.values) == 1
    out = whitening.whiten(df, model, id_col="key", vector_col="v").collect()
    assert len(out) == 10 and None in {r["key"] for r in out} and all(len(r["whitened"]) == 1 for r in out)
    assert abs(np.mean([r["whitened"][0] ** 2 for r in out]) - 1) < 1e-12


def test_deviation_beyond_64_bits_is_an_error(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [3e7])], "vec_id long, embedding array<double>")
    assert whitening.whiten(df, whitening.fit(df)).select("deviation").distinct().count() == 1  # (2 * x - S) ** 2
    far = spark.createDataFrame([(1, [0.0]), (2, [6e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large|too big|convert|Overflow|long"):
        whitening.whiten(far, whitening.fit(far)).collect()
