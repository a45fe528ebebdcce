"""The corpus pipeline: toxic documents go, one of each group of near-duplicates stays, the rest is sampled to
target weights and encoded. Each stage works on what the one before has kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cityloom.llm import queries, simhash, toxicity
from cityloom.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below the threshold; labels of held-out documents are not learnt from. Null and empty
    texts score 0 and stay; each row is judged by itself, repeated ones and rows without an id too. Columns of any
    type and name are kept."""
    labels = queries.table(spark, sf_dir, "labels")
    labels = labels.filter(~queries.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.select(F.struct(*_columns(docs)).alias("row"), "text"), model, id_col="row")
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select("row.*")


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; among rows of one id that with the smallest hash of its
    text, and of rows with one id and text one, by a hash of what else they hold. Rows without an id come before all
    others; null and empty texts are one group. Columns of any type and name are kept."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.md5(F.to_json(F.struct(*others), {"ignoreNullFields": "false"})) if others else F.lit("")
    rows = docs.select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("key"), rest.alias("rest"), F.struct(*others, F.lit(0)).alias("others")
    )
    found = simhash.near_duplicates(
        rows.select(F.struct("doc_id", "key").alias("id"), "text"), shingle=3, max_bits=2, id_col="id"
    )
    kept = found.filter(F.col("id") == F.col("component_id")).select(
        F.col("id.key").alias("kept_key"), F.col("id.doc_id").alias("kept_id")
    )
    same = (F.col("key") == F.col("kept_key")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    joined = rows.join(kept.distinct(), same, "left_semi")
    # Copies of a row share its key.
    order = Window.partitionBy("key", "doc_id").orderBy("rest")
    first = joined.withColumn("place", F.row_number().over(order)).filter("place = 1")
    return first.select(*(c if c in ("doc_id", "text") else F.col("others")[c].alias(c) for c in docs.columns))


def sample_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that source, language and topic have their target shares of the tokens, as far as the token
    budget allows. Documents without words always stay; rows that repeat an id stay or go together; null source and
    language are values of their own. Columns of any type and name are kept, but for ``mix_probability`` and
    ``mix_kept``, which are dropped."""
    return queries.mix_documents(docs).filter("mix_kept").select(
        *(F.col(f"`{c}`") for c in docs.columns if c not in ("mix_probability", "mix_kept"))
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document and the digests of ids and decoded text: a row per row, no tokens for null and empty
    texts. Other columns are dropped."""
    return queries.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("mixing", sample_to_weights),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written and read again by the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The first stage is a trained model, which SQL can't express.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
