import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from cityloom.llm import mixing, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_stages_one_after_the_other(spark):
    """Each stage against a plain computation over what the one before has kept."""
    from tests.llm.test_mixing import plain_kept, plain_probabilities
    from tests.llm.test_simhash import classes, plain_fingerprint

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    clean = pipeline.drop_toxic(spark, docs, SF)
    assert clean.columns == columns
    labels = queries.table(spark, SF, "labels").filter(~queries.held_out(F.col("doc_id")))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    rows = {r["doc_id"]: r for r in docs.collect()}
    want = {d for d in rows if scores[d] < toxicity.THRESHOLD}
    assert {r["doc_id"]: r for r in clean.collect()} == {d: rows[d] for d in want} and len(want) < len(rows)

    one_each = pipeline.drop_near_duplicates(spark, clean, SF)
    assert one_each.columns == columns
    ids = sorted(want)
    least = classes([plain_fingerprint(rows[d]["text"] or "") for d in ids], ids, 2)
    want = {d for d, c in zip(ids, least) if d == c}
    assert {r["doc_id"]: r for r in one_each.collect()} == {d: rows[d] for d in want} and len(want) < len(ids)

    mixed = pipeline.sample_to_weights(spark, one_each, SF)
    assert mixed.columns == columns
    cells = one_each.select("doc_id", "source", "lang", queries.topic(F.col("text")), mixing.n_words(F.col("text"))).collect()
    wanted = plain_probabilities([tuple(r)[1:] for r in cells], queries.MIX_BUDGET)
    kept = {r["doc_id"] for r in cells if plain_kept(r["doc_id"], wanted[tuple(r)[1:4]])}
    assert {r["doc_id"] for r in mixed.collect()} == kept and 0 < len(kept) < len(want)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    got = {r["doc_id"]: r["n_tokens"] for r in pipeline.encode(spark, mixed, SF).collect()}
    assert got == {d: len(tokenizer.encode(rows[d]["text"] or "", add_special_tokens=False).ids) for d in kept}
    assert {r["doc_id"]: r["n_tokens"] for r in pipeline.run(spark, SF).collect()} == got


def test_near_duplicates_with_repeated_and_null_ids(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta " * 30
    data = [(2, text, "s"), (1, text.upper(), "s"), (1, text.upper(), "s"), (None, "quite another text " * 9, "s"), (5, None, "s"), (4, "", "s")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = sorted(((r["doc_id"], r["text"]) for r in pipeline.drop_near_duplicates(spark, df, SF).collect()), key=str)
    assert got == sorted([(1, text.upper()), (None, "quite another text " * 9), (4, "")], key=str)
    assert pipeline.drop_near_duplicates(spark, df.limit(0), SF).collect() == []


def test_rows_of_all_kinds_in_every_stage(spark):
    long = "alpha beta gamma delta epsilon zeta eta theta " * 20
    data = [(1, long, "s", "en"), (1, long, "s", "en"), (2, None, None, None), (3, "", "s", None), (None, "some words here", "t", "de")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string").withColumns({
        "a map": F.create_map(F.lit("x"), F.array("doc_id")), "key": F.lit(1), "place": F.lit("p"), "score": F.lit(2.0),
        "__key": F.lit(5), "rest": F.lit(None).cast("string"), "tokens": F.lit(3),
    })
    for docs in (df, df.limit(0)):
        for (name, stage), n in zip(pipeline.STAGES[:-1], (5, 3, None), strict=True):
            out = stage(spark, docs, SF)
            assert out.dtypes == docs.dtypes, name
            rows = out.collect()
            assert n is None or len(rows) == (n if docs is df else 0), name
            assert all(r["a map"] == {"x": [r["doc_id"]]} and r["key"] == 1 and r["score"] == 2.0 for r in rows), name
        assert pipeline.encode(spark, docs, SF).count() == docs.count()
