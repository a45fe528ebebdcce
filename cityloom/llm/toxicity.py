"""Toxicity by multiple-instance learning: sentences are scored, a document's score is the noisy-or of its
sentences, only documents have labels. The fitted model locates the sentences that offend."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import giving_back, materialise, ship

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
_BUCKETS = 1 << 22
_MEMORY = 300_000
# Threshold from which a sentence is reported and a document is predicted toxic.
THRESHOLD = 0.7


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-cased word: itself and its beginnings of 3 to 6 letters, which stand for
    its inflected forms."""
    names = {f"={word}"} | {f"^{word[:k]}" for k in range(3, 7) if len(word) >= k}
    return [zlib.crc32(n.encode()) % _BUCKETS for n in names]


@dataclass(frozen=True)
class Model:
    """Weights of the features kept (at most ``max_features`` of :func:`fit`) and the sentence bias."""

    weights: dict[int, float]
    bias: float


def _bag(text: str, known: dict[str, list[int]]) -> list[set[int]]:
    """The distinct features of each sentence; ``known`` remembers words."""
    bag = []
    for s in _SENTENCE.findall(text.lower()):
        found: set[int] = set()
        for w in _WORD.findall(s):
            got = known.get(w)
            if got is None:
                got = known[w] = word_features(w)
            found.update(got)
        if found:
            bag.append(found)
    if len(known) > _MEMORY:
        known.clear()
    return bag


def _document_counts(df: DataFrame) -> DataFrame:
    """``feature, n_docs, n_toxic`` over all documents of ``df``; added up within each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, toxic, known = Counter(), Counter(), {}
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                found = set().union(*_bag(text.as_py() or "", known))
                n.update(found)
                if label:
                    toxic.update(found)
        keys = list(n)
        for i in range(0, len(keys), 100_000):
            part = keys[i : i + 100_000]
            yield pa.RecordBatch.from_pydict(
                {"feature": pa.array(part, pa.int32()), "n": [n[k] for k in part], "toxic": [toxic[k] for k in part]}
            )

    counted = df.mapInArrow(giving_back(count), "feature int, n long, toxic long")
    return counted.groupBy("feature").agg(F.sum("n").alias("n_docs"), F.sum("toxic").alias("n_toxic"))


def _feature_sets(df: DataFrame, kept: np.ndarray) -> DataFrame:
    """Per document its sentences as arrays of places in ``kept`` (sorted features); sentences without any
    are left out."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known = {f: i for i, f in enumerate(kept.tolist())}, {}
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                bag = [sorted(place[f] for f in s if f in place) for s in _bag(text.as_py() or "", known)]
                rows.append([s for s in bag if s])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(rows, pa.list_(pa.list_(pa.int32())))], ["toxic", "bag"]
            )

    return df.select("toxic", "text").mapInArrow(giving_back(sets), "toxic int, bag array<array<int>>")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    max_docs: int = 12_000,
    max_features: int = 4_096,
    min_docs: int = 3,
    rounds: int = 300,
    rate: float = 0.1,
    l2: float = 2e-5,
) -> Model:
    """Fit on at most ``max_docs`` labelled documents: those whose ids have the smallest hashes, whole
    texts. ``labels`` has ``doc_id, toxic``; of several labels of a document the largest counts, null ones
    do not. With no labelled document, or labels of one kind only, every score is 0.

    Of the features found in ``min_docs`` documents up to ``max_features`` are kept that tell the two labels
    apart best (likelihood ratio). The loss is that of the documents' noisy-or; its gradient reaches each
    sentence in proportion to its share in the document's score.
    """
    spark = docs.sparkSession
    ship(spark)
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Bounded by max_docs, so it may be sent to all.
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    sample = spark.createDataFrame(sample.collect(), "doc_id long, toxic int")
    # One row per document, as repeated rows would break the bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"), F.max("text").alias("text"))
    rows = materialise(rows, "toxicity-sample")
    size, pos = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < pos < size:
        return Model({}, -50.0)

    # Likelihood ratio of a feature's presence; the best are few, so they may come to the driver.
    def entropy(k: Column, m: Column) -> Column:
        p = F.when(m > 0, k / m).otherwise(0.0)
        return -m * (p * F.log(F.greatest(p, F.lit(1e-12))) + (1 - p) * F.log(F.greatest(1 - p, F.lit(1e-12))))

    n, k = F.col("n_docs"), F.col("n_toxic")
    gain = entropy(F.lit(pos), F.lit(size)) - entropy(k, n) - entropy(F.lit(pos) - k, F.lit(size) - n)
    best = _document_counts(rows).filter(n >= min_docs).select("feature", gain.alias("gain")).filter("gain > 8.0")
    best = best.orderBy(F.desc("gain"), "feature").limit(max_features).collect()
    kept = np.array(sorted(r["feature"] for r in best), np.int64)
    if not len(kept):
        return Model({}, -50.0)
    got = _feature_sets(rows.orderBy("doc_id"), kept).toArrow()
    y = got["toxic"].to_numpy().astype(bool)
    bags = got["bag"].combine_chunks()
    sentences = bags.flatten()
    of_doc = np.repeat(np.arange(len(y)), np.diff(bags.offsets.to_numpy()))
    n_feat = np.diff(sentences.offsets.to_numpy())
    column, row = sentences.flatten().to_numpy(), np.repeat(np.arange(len(n_feat)), n_feat)
    if not len(column):
        return Model({}, -50.0)

    w, b = np.zeros(len(kept)), -2.0
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=w[column], minlength=len(n_feat)) + b
        total = np.bincount(of_doc, weights=np.logaddexp(0, z), minlength=len(y))
        p_doc = -np.expm1(-total)
        push = np.where(y, -np.exp(-total) / np.maximum(p_doc, 1e-3), 1.0)[of_doc] / (1 + np.exp(-z))
        g = np.append(np.bincount(column, weights=push[row], minlength=len(kept)), push.sum()) / len(y)
        g[:-1] += l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model({int(k): float(x) for k, x in zip(kept, w, strict=True)}, float(b))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, spans``: the noisy-or of the sentences of each whole text, and the offending
    sentences (``start, stop`` in code points of the text lower-cased, ``score`` from ``THRESHOLD`` on; if
    the document as a whole reaches it, at least its worst sentence).

    A sentence none of whose words has a weight counts 0, so null and empty texts have score 0. Repeated
    rows are scored one by one; other columns are dropped. No row leaves its partition.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most max_features numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, known = sent.value.weights, sent.value.bias, {}

        def of(word: str) -> tuple[int, ...]:
            got = known[word] = tuple(f for f in word_features(word) if f in weights)
            return got

        for batch in batches:
            scores, spans = [], []
            for text in batch.column("text"):
                text = (text.as_py() or "").lower()
                words = _WORD.findall(text)
                if not any([known[w] if w in known else of(w) for w in words]):
                    scores.append(0.0)
                    spans.append([])
                    continue
                clean, found = 0.0, []
                for s in _SENTENCE.finditer(text):
                    features = {f for w in _WORD.findall(s[0]) for f in (known[w] if w in known else of(w))}
                    if features:
                        z = bias + sum(weights[f] for f in features)
                        clean += float(np.logaddexp(0, z))
                        found.append((float(1 / (1 + np.exp(-z))), s.start(), s.end()))
                p = float(-np.expm1(-clean))
                worst = max((x[0] for x in found), default=0.0)
                limit = min(THRESHOLD, worst) if p >= THRESHOLD else THRESHOLD
                scores.append(p)
                spans.append([{"start": i, "stop": j, "score": x} for x, i, j in found if x >= limit])
                if len(known) > _MEMORY:
                    known.clear()
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["id", "score", "spans"]
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    spans = T.ArrayType(T.StructType().add("start", "integer").add("stop", "integer").add("score", "double"))
    schema = T.StructType([rows.schema["id"]]).add("score", "double").add("spans", spans)
    return rows.mapInArrow(giving_back(run), schema).withColumnRenamed("id", id_col)
