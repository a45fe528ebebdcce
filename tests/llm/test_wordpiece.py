import random

import public_tokenizers
from hypothesis import given, settings, strategies as st

from cityloom.llm import wordpiece
from cityloom.llm.queries import op7_token_counts


def greedy(word, first, later):
    at, n = 0, 0
    while at < len(word):
        pieces = later if at else first
        end = next((j for j in range(len(word), at, -1) if word[at:j] in pieces), None)
        if end is None:
            return 0
        at, n = end, n + 1
    return n


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=5)), st.sets(st.text("abc", min_size=1, max_size=5)), st.text("abcd", max_size=25))
def test_length_is_that_of_greedy_matching(first, later, word):
    assert wordpiece.LongestMatch(first, later).length(word) == greedy(word, first, later)


def test_real_vocabulary():
    first, later = wordpiece.pieces_of_byte_level(public_tokenizers.path("byte_bpe_50k.json"))
    machine, f, l = wordpiece.LongestMatch(first, later), set(first), set(later)
    rng = random.Random(1)
    words = ["unbelievable", "Straße", "a" * 3000, "日本語", "\U0010ffff"]
    words += ["".join(rng.choice("abcdeéßtñ") for _ in range(rng.randint(1, 14))) for _ in range(500)]
    assert [machine.length(w) for w in words] == [greedy(w, f, l) for w in words]


def test_rows(spark):
    df = spark.createDataFrame(
        [(1, "ab ab, x"), (2, None), (3, ""), (None, " \n"), (1, "ab ab, x")], "doc_id long, text string"
    ).selectExpr("*", "'n' AS n_words", "1 AS id")
    vocabulary = (["a", "ab", ","], ["b"])
    got = sorted(map(tuple, wordpiece.count_pieces(df, vocabulary).collect()), key=str)
    assert got == sorted([(1, 4, 1, 4), (1, 4, 1, 4), (2, 0, 0, 0), (3, 0, 0, 0), (None, 0, 0, 0)], key=str)
    assert wordpiece.count_pieces(df.limit(0), vocabulary).collect() == []


def test_query_against_greedy_matching(spark):
    sf = "/root/testdata/sf0.001"
    pieces = wordpiece.pieces_of_byte_level(public_tokenizers.path("byte_bpe_50k.json"))
    first, later = map(set, pieces)
    got = {r["doc_id"]: (r["n_words"], r["n_unknown"], r["n_tokens"]) for r in op7_token_counts(spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n = [greedy(w, first, later) for w in wordpiece.WORD.findall(row["text"] or "")]
        assert got.pop(row["doc_id"]) == (len(n), n.count(0), sum(k or 1 for k in n))
    assert not got
