import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cityloom.llm import periodic_runs, queries

SF = "/root/testdata/sf0.01"


def runs_plainly(words, least):
    """Every stretch with a period, by comparing word by word for each period."""
    found = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            begin = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - begin if i > begin else 0
            if length >= max(least, 2 * q):
                part = words[begin : begin + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.add((begin, length, q))
            i += i == begin
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_together(rows, least):
    words = np.array([w for row in rows for w in row], np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    before = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    found = [[] for _ in rows]
    for start, length, period in zip(*(x.tolist() for x in periodic_runs.runs_of(words, doc, least)), strict=True):
        at = int(np.searchsorted(before, start, side="right")) - 1
        found[at].append((start - int(before[at]), length, period))
    return found


def test_all_short_rows():
    rows = [list(x) for n in range(1, 11) for x in itertools.product((0, 1), repeat=n)]
    rows += [list(x) for x in itertools.product((0, 1, 2), repeat=8)]
    assert runs_together(rows, 2) == [runs_plainly(r, 2) for r in rows]


def test_long_rows_with_repeats():
    r, rows = random.Random(5), []
    for _ in range(300):
        letters, row, n = r.choice((2, 2, 3, 6)), [], r.randint(1, 120)
        while len(row) < n:
            way = r.random()
            if row and way < 0.4:
                p = r.randint(1, min(len(row), 25))
                base = row[-p:]
                row += [base[i % p] for i in range(r.randint(1, 3 * p))]
            elif row and way < 0.6:
                i = r.randrange(len(row))
                row += row[i : i + r.randint(1, 30)]
            else:
                row.append(r.randrange(letters))
        rows.append(row)
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    rows += [b, [0] * 150, []]
    assert runs_together(rows, 2) == [runs_plainly(x, 2) for x in rows]
    assert runs_together(rows, 12) == [runs_plainly(x, 12) for x in rows]


def plain_answer(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_plainly(words, 12)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    return (
        doc_id, len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


@pytest.fixture
def tables(spark, tmp_path):
    def make(rows):
        spark.createDataFrame(rows, "doc_id long, text string, id string, runs int").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return make


def test_odd_rows(spark, tables):
    r = random.Random(1)
    texts = [
        None, "", " \t\n\x0b\f\r ", "a", "a " * 40, "x y " * 3, " ".join(["é"] * 11), " ".join(["é"] * 12), "a b " * 20,
        "one  two\n" * 30 + "end", " ".join(r.choice("ab") for _ in range(700)), "z" * 100_000 + " z" * 30,
        " ".join(str(r.randrange(50)) for _ in range(600)),
    ]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts * 3)] + [(None, "b " * 20, None, None), (3, "a", "x", 1), (3, "a", "x", 1)]
    got = queries.op12_periodic_runs(spark, tables(rows))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((plain_answer(i, t) for i, t, _, _ in rows), key=key)
    assert queries.op12_periodic_runs(spark, tables([])).count() == 0


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").filter(F.length("text") < 1500).select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()}
    for doc_id, text in rows:
        assert got[doc_id] == plain_answer(doc_id, text)


def test_real_outputs(spark):
    df = spark.createDataFrame([(1, "s " + "a b " * 7 + "t", 0)], "key int, words string, n_words int")
    (row,) = periodic_runs.find_runs(df, id_col="key", text_col="words").collect()
    assert row["key"] == 1 and row["n_words"] == 16 and row["collapsed"] == "s a b t"
    assert [tuple(r) for r in row["runs"]] == [(1, 14, 2)]
