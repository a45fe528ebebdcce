"""Token counts: greedy longest-match word pieces counted in linear time, without building the pieces."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import ship

# A word: a run of letters, marks and digits, or one other character that is no white space.
WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]")
_FAIL = -1
# Words remembered by a worker before it starts afresh: bounds its memory, changes no count.
_MEMORY = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: each byte that prints stands for itself, the
    others follow from U+0100 on in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def pieces_of_byte_level(path: str) -> tuple[list[str], list[str]]:
    """Word-piece vocabulary of a byte-level tokenizer file: pieces that follow a blank begin words, the
    others continue them. Pieces that are no whole characters or hold white space are left out."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    of, first, later = byte_alphabet(), [], []
    for token in vocab:
        try:
            text = bytes(of[c] for c in token).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        into, text = (first, text[1:]) if text.startswith(" ") else (later, text)
        if text and not any(c.isspace() for c in text):
            into.append(text)
    # Single characters may also begin a word.
    first.extend(t for t in later if len(t) == 1)
    return sorted(set(first)), sorted(set(later))


class LongestMatch:
    """Trie over the pieces with two roots (start of a word, and what continues one). Every node knows
    where matching goes on when no edge fits, and how many pieces are complete by then."""

    def __init__(self, first: Iterable[str], later: Iterable[str]) -> None:
        self.edges: list[dict[str, int]] = [{}, {}]
        is_piece = [False, False]
        for root, pieces in ((0, first), (1, later)):
            for piece in pieces:
                at = root
                for c in piece:
                    to = self.edges[at].get(c)
                    if to is None:
                        to = self.edges[at][c] = len(self.edges)
                        self.edges.append({})
                        is_piece.append(False)
                    at = to
                is_piece[at] = True
        self.link = [_FAIL] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for c, node in self.edges[parent].items():
                if is_piece[node]:
                    self.link[node], self.popped[node] = 1, 1
                else:
                    at, n = self.link[parent], self.popped[parent]
                    while at != _FAIL and c not in self.edges[at]:
                        n += self.popped[at]
                        at = self.link[at]
                    if at != _FAIL:
                        self.link[node], self.popped[node] = self.edges[at][c], n
                queue.append(node)

    def length(self, word: str) -> int:
        """Number of pieces of a word, 0 if it can't be cut into pieces."""
        edges, link, popped = self.edges, self.link, self.popped
        at, n = 0, 0
        for c in word:
            while c not in edges[at]:
                n += popped[at]
                at = link[at]
                if at == _FAIL:
                    return 0
            at = edges[at][c]
        while at != 1:
            n += popped[at]
            at = link[at]
            if at == _FAIL:
                return 0
        return n


def count_pieces(docs: DataFrame, vocabulary: tuple[list[str], list[str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_unknown, n_tokens`` for each row: words, words that no pieces make up, and word
    pieces by greedy longest match, an unknown word counting as one.

    The automaton is built once per worker from the vocabulary, which is fixed; texts are read whole and no
    row leaves its partition. Null and empty texts have zeros; repeated rows are counted one by one, other
    columns are dropped.
    """
    ship(docs.sparkSession)
    held: list[LongestMatch] = []
    pieces = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(LongestMatch(*pieces.value))
        length, known = held[0].length, {}
        for batch in batches:
            n_words, n_unknown, n_tokens = [], [], []
            for text in batch.column("text"):
                words = WORD.findall(text.as_py() or "")
                n = unknown = 0
                for word in words:
                    k = known.get(word)
                    if k is None:
                        k = known[word] = length(word)
                    n += k or 1
                    unknown += not k
                n_words.append(len(words))
                n_unknown.append(unknown)
                n_tokens.append(n)
                if len(known) > _MEMORY:
                    known = {}
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "n_words": n_words, "n_unknown": n_unknown, "n_tokens": n_tokens}
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_words long, n_unknown long, n_tokens long")
    return counted.withColumnRenamed("id", id_col)
