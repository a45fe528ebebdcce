"""URL filters: rules by host and path, and a naive Bayes verdict over words cut out of host and path."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import attach
from .common import materialise, ship

# Words that are likely to mark an address as unwanted, before any example is seen.
BLOCK_WORDS = (
    "ads", "adult", "bet", "bets", "casino", "escort", "gambling", "lottery", "pills", "poker", "porn", "sex",
    "slots", "spam", "viagra", "warez", "xxx",
)
# Parts of a host that say nothing about its owner.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (from
    there up to ``?``, ``#`` or the end). Both are empty for null and where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (struct of ``rule`` and ``action``), null if none does. A rule fits its
    host and the hosts below it, if the path starts with the rule's. The list is written by hand, so it is
    part of the expression; of equally long ones the first in the list wins."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    # What comes later in the fold wins: longer rules, and of equally long ones the earlier in the list.
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"))).otherwise(found)
    return found


def viterbi(label: str, words: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """Most likely cut of ``label``: ``words`` has the log probability of each known span; any other span
    costs ``unknown`` and a tenth for each letter. Ties go to fewer, then to longer first words."""
    n = len(label)
    starts: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for (i, j), p in words.items():
        starts[j].append((i, p))
    best = [(0.0, 0, 0)] + [(-math.inf, 0, 0)] * n  # log probability, -words, where the last word starts
    # An unknown span may start anywhere: the best start is carried along, so the time is linear.
    open_score, open_count, open_at = 0.0, 0, 0
    tenth = math.log(10)
    for j in range(1, n + 1):
        open_score -= tenth
        choice = (open_score + unknown, open_count - 1, open_at)
        for i, p in starts[j]:
            choice = max(choice, (best[i][0] + p, best[i][1] - 1, i), key=lambda x: (x[0], x[1], -x[2]))
        best[j] = choice
        if (choice[0], choice[1]) > (open_score, open_count):
            open_score, open_count, open_at = choice[0], choice[1], j
    out = []
    while n:
        out.append(label[best[n][2] : n])
        n = best[n][2]
    return out[::-1]


def _letters(text: Column) -> Column:
    """The runs of letters of an address, lower-cased; digits and punctuation part them."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}]+"), lambda x: x != "")


def segment_labels(labels: DataFrame, unigrams: DataFrame) -> DataFrame:
    """``label`` and ``words`` (array): each distinct label cut by unigram Viterbi.

    Every span of a label that has as many letters as some word of ``unigrams`` (``word``, ``n``) is looked up there by
    a join, so the list may be of any size and its words of any length.
    """
    ship(labels.sparkSession)
    # One number for each length that a word has.
    sizes = sorted(r[0] for r in unigrams.select(F.length("word")).filter("word <> ''").distinct().collect())
    total = float(unigrams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] or 0) + 1.0
    spans = labels.withColumn("i", F.explode(F.sequence(F.lit(0), F.length("label") - 1))).withColumn(
        "size", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>"))
    )
    spans = spans.filter(F.col("i") + F.col("size") <= F.length("label")).withColumn(
        "word", F.substring("label", F.col("i") + 1, F.col("size"))
    )
    hits = (
        spans.join(unigrams, "word")
        .groupBy("label")
        .agg(F.collect_list(F.struct("i", "size", (F.log(F.col("n") / F.lit(total))).alias("p"))).alias("hits"))
    )
    unknown = -math.log(total)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [
                viterbi(label, {(h["i"], h["i"] + h["size"]): h["p"] for h in (() if hits is None else hits)}, unknown)
                for label, hits in zip(batch["label"], batch["hits"], strict=True)
            ]
            yield pd.DataFrame({"label": batch["label"], "words": words})

    return labels.join(hits, "label", "left").mapInPandas(cut, "label string, words array<string>")


def rule_words(rules: Sequence[Rule]) -> list[str]:
    """The runs of letters in hosts and paths of the rules."""
    texts = (f"{r.host}{r.path}".lower() for r in rules)
    return sorted({"".join(run) for t in texts for letter, run in groupby(t, str.isalpha) if letter})


def word_weights(counts: DataFrame, *, smoothing: float, pooled: float) -> DataFrame:
    """``word, w``: log of how much likelier a word is in ``block`` than in ``allow``, from ``word, n_block, n_allow``.

    Each class is smoothed towards the shares of both together: by ``pooled`` words in all, and by ``smoothing`` per
    word times the class' part of all words. A word that neither class has seen weighs nothing, and without examples of
    one class no word weighs anything.
    """
    t = counts.agg(F.sum("n_block").alias("b"), F.sum("n_allow").alias("a"), F.count("*").alias("v")).first()
    block, allow, v = float(t["b"] or 0), float(t["a"] or 0), t["v"]
    total = max(1.0, block + allow)
    share = (F.col("n_block") + F.col("n_allow") + F.lit(smoothing)) / F.lit(total + smoothing * v)

    def likelihood(n: str, size: float) -> Column:
        part = size / total
        return (F.col(n) + F.lit(smoothing * part) + share * F.lit(pooled)) / F.lit(size + smoothing * v * part + pooled)

    return counts.select("word", (F.log(likelihood("n_block", block)) - F.log(likelihood("n_allow", allow))).alias("w"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    learn: str = "true",
    block_words: Sequence[str] = BLOCK_WORDS,
    word_odds: float = 100.0,
    base_rate: float = 0.1,
    smoothing: float = 1.0,
    pooled: float = 10.0,
) -> DataFrame:
    """``id_col, host, path, rule, verdict, log_odds, words``: one row per row of ``pages``.

    The rule that fits decides; elsewhere naive Bayes does. ``log_odds`` is its score for all rows, those with a rule
    too. Host and path are cut at everything but letters, and the pieces of the host once more by unigram Viterbi.
    Word counts for that come from the pieces of hosts with a hyphen and of paths, over all pages, and from
    ``block_words``.

    Examples are labelled by the rules. ``block``: addresses that a rule blocks. ``allow``: those that a rule allows,
    and as a background those that no rule speaks of, unless they have one of ``block_words``. Words of the rules
    themselves are neither counted nor scored, as they would only repeat the rules. ``block_words`` are no labels: each
    starts at odds of ``word_odds``, from which the examples may move it. As rules are no sample of the other pages,
    the part of unwanted ones among these is a parameter, ``base_rate``. ``block`` needs log odds above 0.

    Rows for which ``learn`` (a condition on the columns of ``pages``) is not true are judged, but no examples.

    An address shape (host and letters of the path) is one example and is scored once, so a host with a third of all
    pages is neither a heavy row nor a heavy vote. Null and empty urls have empty host and path, no words, and the
    verdict of the base rate. Repeated rows are judged one by one; other columns are dropped whatever their names.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").alias("__id"), F.col(f"`{url_col}`").alias("__url"), F.expr(learn).alias("__learn")
    )
    host, path = host_and_path(F.col("__url"))
    rows = rows.withColumns({"host": host, "path": path})
    rows = rows.withColumn("shape", F.concat_ws("/", "host", F.array_join(_letters(F.col("path")), "/")))
    rows = rows.withColumn("fit", match_rule(F.col("host"), F.col("path"), rules))

    spark = pages.sparkSession
    action, learnt = F.col("fit.action"), F.coalesce(F.col("__learn"), F.lit(False))
    # Partial sums per task come first, so a frequent shape is a few rows in the shuffle.
    shapes = materialise(
        rows.groupBy("shape").agg(
            F.count("*").alias("pages"),
            F.coalesce(F.max(learnt & (action == "block")), F.lit(False)).alias("blocked"),
            F.coalesce(F.max(learnt & (action == "allow")), F.lit(False)).alias("allowed"),
            F.max(learnt & action.isNull()).alias("background"),
        ),
        "url-shapes",
    )
    host_part = F.substring_index("shape", "/", 1)
    path_part = F.substring(F.col("shape"), F.length(host_part) + 1, F.length("shape"))
    pieces = shapes.select("shape", "pages", F.explode(F.split(host_part, "\\.")).alias("part"), F.lit(True).alias("of_host"))
    pieces = pieces.unionByName(
        shapes.select("shape", "pages", F.explode(_letters(path_part)).alias("part"), F.lit(False).alias("of_host"))
    )
    pieces = pieces.withColumn("labels", _letters(F.col("part"))).filter(F.size("labels") > 0)
    # A piece that nothing parts may be words run together, so it is no evidence for a word.
    parted = F.col("part").contains("-") | ~F.col("of_host")
    seeds = spark.createDataFrame([(w, 1) for w in block_words], "word string, n long")
    unigrams = (
        pieces.filter(parted)
        .select(F.explode("labels").alias("word"), "pages")
        .groupBy("word")
        .agg(F.sum("pages").alias("n"))
        .unionByName(seeds)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    named = pieces.select("shape", F.explode("labels").alias("label"))
    cuts = segment_labels(named.select("label").distinct(), materialise(unigrams, "url-unigrams"))
    # Every address has a label like "www", so the joins by label and by word salt such keys.
    words = attach(named, cuts, ["label"]).select("shape", F.explode("words").alias("word"))
    words = words.groupBy("shape").agg(F.sort_array(F.collect_list("word")).alias("words"))
    told = materialise(
        shapes.join(words, "shape", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>"))),
        "url-shape-words",
    )

    listed = F.array(*map(F.lit, block_words)).cast("array<string>")
    own = F.array(*map(F.lit, rule_words(rules))).cast("array<string>")
    told = told.withColumns(
        {
            "allowed": F.col("allowed") | (F.col("background") & ~F.arrays_overlap("words", listed)),
            "scored": F.filter("words", lambda w: ~F.array_contains(own, w)),
        }
    )
    counts = (
        told.select(F.explode("scored").alias("word"), "blocked", "allowed")
        .groupBy("word")
        .agg(F.sum(F.col("blocked").cast("long")).alias("n_block"), F.sum(F.col("allowed").cast("long")).alias("n_allow"))
    )
    weights = word_weights(materialise(counts, "url-word-counts"), smoothing=smoothing, pooled=pooled)
    prior = F.when(F.col("word").isin(list(block_words)), F.lit(math.log(word_odds))).otherwise(F.lit(0.0))
    sums = (
        attach(told.select("shape", F.explode("scored").alias("word")), weights, ["word"])
        .groupBy("shape")
        .agg(F.sum(F.col("w") + prior).alias("w"))
    )
    scored = told.select("shape", "words").join(sums, "shape", "left").withColumn(
        "log_odds", F.coalesce("w", F.lit(0.0)) + F.lit(math.log(base_rate / (1 - base_rate)))
    )
    return attach(rows, scored.select("shape", "words", "log_odds"), ["shape"]).select(
        F.col("__id").alias(id_col),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.action", F.when(F.col("log_odds") > 0, "block").otherwise("allow")).alias("verdict"),
        "log_odds",
        "words",
    )
