import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cityloom.llm import queries, sharding

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 1), (2, 5), (3, 1), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_single_steps(dims, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims))).T
    at = sharding.hilbert_index(grid, bits)
    assert sorted(at.tolist()) == list(range(1 << bits * dims))
    steps = np.abs(np.diff(grid[:, np.argsort(at)], axis=1)).sum(axis=0)
    assert (steps == 1).all()


def plain_levels(values, levels):
    """The level of each value, by counting all smaller ones; null is the least."""
    key = lambda v: (v is not None, v if v is not None else 0)
    counts, level, before = Counter(values), {}, 0
    for v in sorted(counts, key=key):
        level[v] = min(levels - 1, (2 * before + counts[v]) * levels // (2 * len(values)))
        before += counts[v]
    return [level[v] for v in values]


def check_shards(rows, got, shards):
    """Every document once, counts at most one apart, slots gapless, shards in the order of the curve."""
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source", "lang").collect()
    df = queries.op13_sharding(spark, SF)
    assert df.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    got = df.collect()
    check_shards([(r["doc_id"], r["text"]) for r in docs], got, 24)
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
    # The order against a curve over levels found by sorting everything.
    levels = np.array([
        plain_levels([r["source"] for r in docs], 1024), plain_levels([r["lang"] for r in docs], 1024),
        plain_levels([len(r["text"].encode()) for r in docs], 1024),
    ])
    place = dict(zip((r["doc_id"] for r in docs), sharding.hilbert_index(levels, 10).tolist(), strict=True))
    row = [place[r["doc_id"]] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert row == sorted(row)


def test_odd_rows(spark, tmp_path):
    texts = [None, "", "é", "same", "same", "same", "x" * 200_000, "a b"]
    rows = [(i % 50, texts[i % len(texts)], ["s", None, "t"][i % 3], ["en", "de"][i % 2], i, "y") for i in range(300)]
    rows += [(None, "same", "s", "en", 0, None)] * 5 + [(7, "same", "s", "en", 1, "y")] * 200
    kind = "doc_id long, text string, source string, lang string, shard int, curve string"
    spark.createDataFrame(rows, kind).repartition(7).write.parquet(f"{tmp_path}/a/documents.parquet")
    check_shards([r[:2] for r in rows], queries.op13_sharding(spark, f"{tmp_path}/a").collect(), 24)
    for name, few in (("b", []), ("c", rows[:5])):
        spark.createDataFrame(few, kind).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        check_shards([r[:2] for r in few], queries.op13_sharding(spark, f"{tmp_path}/{name}").collect(), 24)


def test_equal_texts_lie_side_by_side(spark):
    rows = [(i, f"text {i % 10}", "a") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sharding.shard(df, {"source": F.col("source")}, 4).orderBy("shard", "slot").collect()
    texts = [r["text_crc32"] for r in got]
    assert sum(a != b for a, b in zip(texts, texts[1:], strict=False)) == 9


def test_ranges_and_the_order_of_the_input_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dims = {"source": F.col("source"), "n": F.col("n_chars").cast("double")}
    want = {tuple(r) for r in sharding.shard(docs, dims, 5).collect()}
    monkeypatch.setattr(sharding, "RANGE_ROWS", 100)
    assert {tuple(r) for r in sharding.shard(docs.orderBy(F.desc("text")).repartition(9), dims, 5).collect()} == want


def test_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 100)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sharding.shard(docs, {"lang": F.col("lang")}, 8, law="bytes").collect()
    sums, slots = Counter(), defaultdict(list)
    for r in got:
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sums) == set(range(8)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(sums.values()) - min(sums.values()) <= 2 * max(r["size"] for r in got)


def test_number_and_null_levels(spark):
    rows = [(i, "t", float("nan") if i % 5 == 0 else None if i % 5 == 1 else float(i % 7), None) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, v double, w date")
    got = sharding.shard(df, {"v": F.col("v"), "w": F.col("w")}, 3, bits=4).collect()
    values = [None if r[2] is None or r[2] != r[2] else r[2] for r in rows]
    levels = np.array([plain_levels(values, 16), plain_levels([None] * 200, 16)])
    assert {r["doc_id"]: r["curve"] for r in got} == dict(enumerate(sharding.hilbert_index(levels, 4).tolist()))
    with pytest.raises(ValueError, match="taken"):
        sharding.shard(df, {"size": F.col("v")}, 3)


def test_files_can_be_left_out(spark, tmp_path):
    df = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("y"), F.lit("t").alias("text"),
    )
    made = sharding.shard(df, {"x": F.col("x"), "y": F.col("y")}, 64)
    stats = sharding.write_shards(made, f"{tmp_path}/shards")
    assert stats.agg(F.sum("rows")).first()[0] == 20_000
    chosen = sharding.files_for(stats, x=(100, 160), y=(700, None))
    assert chosen.select("shard").distinct().count() <= 16
    back = spark.read.parquet(f"{tmp_path}/shards").withColumn("file", F.input_file_name())
    wanted = back.filter("x BETWEEN 100 AND 160 AND y >= 700")
    assert wanted.count() and wanted.join(chosen, "file", "left_anti").count() == 0
