import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cityloom.llm import components, simhash
from cityloom.llm.queries import op10_simhash_dedup


def plain_fingerprint(text, k=3):
    text = text.translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(codes, ids, limit):
    """Component id per position, by comparing all."""
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= limit:
                parent[find(i)] = find(j)
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [least.get(find(i)) for i in range(len(codes))]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("abAÉé \t\n\x0b\x1c\x85 日")), max_size=60), st.integers(1, 4))
def test_fingerprint(text, k):
    assert simhash.fingerprint(text.encode(), k) % 2**64 == plain_fingerprint(text, k)


def test_fingerprint_of_a_long_text():
    text = " ".join(random.Random(1).choices(["a", "b", "c", "the", "Of"], k=150_000))
    assert simhash.fingerprint(text.encode(), 3) % 2**64 == plain_fingerprint(text)


def near_codes(rng, n):
    codes = {0}
    while len(codes) < n:
        base = rng.getrandbits(64) if rng.random() < 0.3 else rng.choice(sorted(codes))
        for _ in range(rng.randint(0, 3)):
            base ^= 1 << rng.randrange(64)
        codes.add(base)
    return sorted(codes)


def test_index_finds_what_comparing_all_finds():
    rng = random.Random(5)
    for n in (1, 5, 17, 300, 700):
        codes = np.array(near_codes(rng, n), np.uint64)
        rank = codes.copy()
        for s in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(s)
        codes = codes[np.argsort(rank)]
        for limit in (0, 2, 5):
            got = sorted((int(q), int(c)) for a, b in simhash.GrayIndex(codes).search(codes, limit) for q, c in zip(a, b))
            want = [(i, j) for i in range(n) for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= limit)]
            assert got == want
    assert list(simhash.GrayIndex(np.zeros(0, np.uint64)).search(np.zeros(3, np.uint64), 2)) == []


def test_neighbours_in_gray_order_differ_in_one_bit(spark):
    df = spark.range(256).select(F.col("id").bitwiseXOR(F.shiftright("id", 1)).alias("g"))
    assert [r[0] for r in df.orderBy(simhash.gray_rank(F.col("g"))).collect()] == [i ^ i >> 1 for i in range(256)]


def test_links_across_nodes_and_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "NODE_CODES", 25)
    monkeypatch.setattr(simhash, "TASK_QUERIES", 20)
    codes = near_codes(random.Random(9), 400)
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    for limit in (2, 4):
        roots = {r["node"]: r["root"] for r in components.components(simhash._links(df, limit)).collect()}
        got = [roots.get(c, c) for c in signed]
        assert got == classes(codes, signed, limit)


def test_rows_of_all_kinds(spark):
    base = "one two three four five six seven eight nine ten " * 40
    data = [(9, base), (4, base.upper()), (7, base + "x"), (3, None), (8, ""), (None, " \n"), (5, "a b"), (5, "a b"), (None, "lonely text here")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("id", F.lit(1))
    got = sorted((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(df).collect() if r["doc_id"] is not None)
    codes = [plain_fingerprint(t or "") for _, t in data]
    want = classes(codes, [d for d, _ in data], 2)
    assert got == sorted((d, f, c) for (d, _), f, c in zip(data, codes, want) if d is not None)
    assert [c for d, _, c in got if d in (3, 8)] == [3, 3] and [c for d, _, c in got if d in (4, 9)] == [4, 4]
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(500, 500), (None, 3), (900, 800), (800, 900)]
    random.Random(2).shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    want = {i: 100 for i in range(100, 161)} | {k: 1 for k in range(1, 40)} | {500: 500, 800: 800, 900: 800}
    assert got == want
    assert components.components(df.limit(0)).collect() == []


def test_query_against_comparing_all(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    codes = [plain_fingerprint(d["text"] or "") for d in docs]
    want = classes(codes, [d["doc_id"] for d in docs], 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op10_simhash_dedup(spark, sf).collect()}
    assert got == {d["doc_id"]: (f"{c:016x}", w) for d, c, w in zip(docs, codes, want)}
