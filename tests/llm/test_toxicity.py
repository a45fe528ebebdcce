import numpy as np
import pytest
from pyspark.sql import functions as F

from cityloom.llm import toxicity
from cityloom.llm.queries import held_out, op2_toxicity

CLEAN = ["The river runs to the sea.", "A garden has paths", "Stones lie in the field!", "Paper and ink on the desk\n"]


def corpus(spark, n=120):
    docs, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = " ".join(CLEAN[(i * k) % 4] for k in range(1, 4)) + (f" You are a{i % 5} moron{'ic' if i % 2 else ''}. The sea" if bad else "")
        docs.append((i, text))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_from_document_labels_and_finds_the_sentence(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels)
    new = spark.createDataFrame(
        [(1, "The river runs.\nWhat a MORONIC### idea. The sea"), (2, "The river runs to the sea."), (3, None), (4, ""),
         (None, "unknown words"), (1, "moron"), (1, "moron"), (5, "The sea. " * 5000)],
        "doc_id long, text string",
    ).withColumn("score", F.lit("clash")).withColumn("id", F.lit(0)).withColumn("spans", F.lit(0))
    got = toxicity.score(new, model).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] != 1}
    assert [by_id[k]["score"] for k in (3, 4, None)] == [0, 0, 0]
    assert by_id[2]["score"] < 0.3 and by_id[5]["score"] < 0.7
    first = next(r for r in got if r["doc_id"] == 1 and len(r["spans"]) and r["spans"][0]["start"] > 0)
    assert first["score"] >= 0.7 and [(s["start"], s["stop"]) for s in first["spans"]] == [(16, 39)]
    alike = [r["score"] for r in got if r["doc_id"] == 1 and r is not first]
    assert alike[0] == alike[1] >= 0.7


def test_score_is_the_noisy_or_of_sentences(spark):
    f = toxicity.word_features
    model = toxicity.Model({f("moron")[0]: 1.5, f("clown")[0]: 0.5}, -1.0)
    df = spark.createDataFrame([(1, "moron clown. Clown! the moron? nothing")], "doc_id long, text string")
    p = 1 / (1 + np.exp(-np.array([1.0, -0.5, 0.5])))
    assert toxicity.score(df, model).first()["score"] == pytest.approx(1 - np.prod(1 - p))


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1), (2, 1)], [(None, 1), (1, None)]])
def test_without_two_kinds_of_labels_all_scores_are_zero(spark, labels):
    docs, _ = corpus(spark, 5)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_the_sample_is_bounded(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs.unionByName(docs), labels, max_docs=60, max_features=4)
    assert len(model.weights) <= 4


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = op2_toxicity(spark, sf)
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r["toxic"]]
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) / len(toxic) > 0.8
    assert sum(r["predicted"] for r in clean) / len(clean) < 0.02
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got.limit(300).collect())
    assert labels.filter(held_out(F.col("doc_id"))).count() > 0
