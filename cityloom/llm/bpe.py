"""BPE encoding and decoding: words are split and counted apart in Spark, each distinct word is encoded
once, ids go back by position; decoding looks ids up among the pieces.

The way of an encoding, as tables:

1. Blocks of documents: the distinct words of each block, commonest first, and its documents as sequences
   of places in that list. A word that fills the corpus is so one entry per block, not one row per use.
2. The words of all blocks meet by hash; there each distinct word is encoded once.
3. Their ids go back to the blocks, where the sequences turn into ids.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import give_back, giving_back, materialise_by, parts_for, ship
from .subwords import word_encoder
from .wordpiece import byte_alphabet

# A word with the white space in front of it. Between a character that is no white space and white space
# the byte-level pattern always cuts; the class holds whatever any engine takes for white space.
_SPACE = " \t\n\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　"
UNIT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")

# Characters of text per block: what one task holds at a time.
BLOCK_CHARS = 16_000_000
# Parts that the distinct words of all blocks are dealt to: at least LEAST_BUCKETS, more for more text.
LEAST_BUCKETS, BUCKET_BYTES = 256, 128_000_000
_WORDS_SCHEMA = "block string, bucket int, payload binary"


def _pack(*arrays: np.ndarray) -> bytes:
    """Small non-negative integers: byte planes apart, compressed."""
    out = [np.array([len(arrays), *(len(a) for a in arrays)], "<u4").tobytes()]
    for a in arrays:
        planes = a.astype("<u4").view(np.uint8).reshape(-1, 4).T
        out.extend(np.ascontiguousarray(p).tobytes() for p in planes)
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = int(raw[:4].view("<u4")[0])
    sizes = raw[4 : 4 + 4 * n].view("<u4").astype(np.int64)
    out, at = [], 4 + 4 * n
    for size in sizes:
        planes = raw[at : at + 4 * size].reshape(4, size)
        out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1))
        at += 4 * size
    return out


def _blocks(batches: Iterator[pa.RecordBatch], limit: int, buckets: int) -> Iterator[pa.RecordBatch]:
    columns = ["block", "ids", "seq", "bucket", "payload"]
    ids: list = []
    texts: list[array] = []
    words: dict[str, int] = {}
    chars, done = 0, 0
    part = TaskContext.get().partitionId()

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal ids, texts, words, chars, done
        if not ids:
            return
        name = f"{part}-{done}"
        flat = np.concatenate([np.frombuffer(t, np.uint32) for t in texts])
        lens = np.fromiter(map(len, texts), np.uint32, len(texts))
        texts = []  # as long as the block; not needed beside its sequence
        # Bucket by bucket, commonest first within each: a word's place says in which bucket it is.
        names = list(words)
        bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in names), np.int64, len(names))
        order = np.argsort(bucket, kind="stable")
        by_use = np.argsort(-np.bincount(flat, minlength=len(names)), kind="stable")
        rank = np.empty(len(names), np.uint32)
        rank[by_use] = np.arange(len(names), dtype=np.uint32)
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        places = rank[order]  # of the words in bucket order
        sequence = _pack(lens, rank[flat], places)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([ids], pa.list_(id_type)), pa.array([sequence], pa.binary()),
             pa.array([None], pa.int32()), pa.array([None], pa.binary())], columns,
        )
        squeeze = zstandard.ZstdCompressor(level=3)
        for lo in range(0, buckets, 64):
            held = [b for b in range(lo, min(lo + 64, buckets)) if cuts[b] < cuts[b + 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(held), pa.string()),
                    pa.array([None] * len(held), pa.list_(id_type)),
                    pa.array([None] * len(held), pa.binary()),
                    pa.array(held, pa.int32()),
                    pa.array(
                        [squeeze.compress(json.dumps([names[i] for i in order[cuts[b] : cuts[b + 1]]], ensure_ascii=False).encode())
                         for b in held], pa.binary(),
                    ),
                ],
                columns,
            )
        ids, texts, words, chars, done = [], [], {}, 0, done + 1
        give_back()

    id_type = None
    for batch in batches:
        id_type = batch.column("id").type
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
            text = text.as_py() or ""
            ids.append(key)
            texts.append(array("I", [words.setdefault(w, len(words)) for w in UNIT.findall(text)]))
            chars += len(text)
            if chars >= limit:
                yield from flush()
    yield from flush()


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    buckets: int | None = None,
) -> DataFrame:
    """``id_col, ids`` (array of int): one row per row of ``docs``, ids as the tokenizers library gives
    them for the whole text with ``add_special_tokens=False``, without truncation or padding.

    Null and empty texts have no ids; ids of documents may be null or repeated, each row has its own result;
    other columns are dropped. A text is never cut, so one longer than ``block_chars`` is a block by itself.
    The distinct words of the corpus are dealt to ``buckets`` parts, by default one for ``BUCKET_BYTES`` of text. The
    tokenizer file must be found at the same path on all executors.
    """
    ship(docs.sparkSession)
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
        buckets = parts_for(size, BUCKET_BYTES, LEAST_BUCKETS)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks(batches, block_chars, buckets)

    made = materialise_by(
        rows.mapInArrow(giving_back(blocks), f"block string, ids array<{kind}>, seq binary, bucket int, payload binary"), "block", "bpe-blocks"
    )

    def distinct_words(table: pa.Table) -> pa.Table:
        unzip, squeeze = zstandard.ZstdDecompressor(), {}
        lists = [json.loads(unzip.decompress(p.as_py())) for p in table["payload"]]
        for words in lists:
            for w in words:
                squeeze.setdefault(w, len(squeeze))
        encoder = word_encoder(tokenizer_path, 4)
        encoded = encoder.encode(list(squeeze))
        encoder.forget()  # no other bucket has these words
        lens = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        flat = np.frombuffer(b"".join(encoded), "<u4")
        offsets = np.concatenate(([0], np.cumsum(lens)))
        out = []
        for words in lists:
            at = np.fromiter((squeeze[w] for w in words), np.int64, len(words))
            n = lens[at]
            starts = np.repeat(offsets[at] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
            out.append(_pack(n, flat[starts + np.arange(n.sum())]))
        give_back()
        return pa.table({"block": table["block"], "bucket": table["bucket"], "payload": pa.array(out, pa.binary())})

    words = made.filter("bucket IS NOT NULL").select("block", "bucket", "payload")
    words = words.groupBy("bucket").applyInArrow(distinct_words, _WORDS_SCHEMA)

    def join_back(left: pa.Table, right: pa.Table) -> pa.Table:
        n_list, ids_list = [], []
        for p in right.sort_by("bucket")["payload"]:
            n, ids = _unpack(p.as_py())
            n_list.append(n)
            ids_list.append(ids)
        lens, seq, places = _unpack(left["seq"][0].as_py())
        n = np.concatenate(n_list).astype(np.int64) if n_list else np.zeros(0, np.int64)
        flat = np.concatenate(ids_list) if ids_list else np.zeros(0, np.uint32)
        starts = np.concatenate(([0], np.cumsum(n)))[:-1]
        start_of, n_of = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        start_of[places], n_of[places] = starts, n
        # Documents in portions, so that no array is much larger than the block.
        ends = np.cumsum(lens.astype(np.int64))
        keys, tables = left["ids"].combine_chunks().flatten(), []
        portion = np.searchsorted(ends, np.arange(0, max(1, len(seq)), 200_000), side="left")
        portion = np.unique(np.append(portion, len(lens)))
        if portion[0] != 0:
            portion = np.insert(portion, 0, 0)
        for i, j in zip(portion[:-1], portion[1:], strict=True):
            lo, hi = (ends[i - 1] if i else 0), (ends[j - 1] if j else 0)
            s = seq[lo:hi]
            m = n_of[s]
            upto = np.concatenate(([0], np.cumsum(m)))
            ids = flat[np.repeat(start_of[s] - upto[:-1], m) + np.arange(upto[-1])]
            cut = np.concatenate(([0], ends[i:j] - lo))
            tables.append(
                pa.table(
                    {
                        "id": keys.slice(i, j - i),
                        "ids": pa.ListArray.from_arrays(pa.array(upto[cut], pa.int32()), pa.array(ids.astype(np.int32))),
                    }
                )
            )
        give_back()
        return pa.concat_tables(tables)

    sequences = made.filter("bucket IS NULL").select("block", "ids", "seq")
    joined = sequences.groupBy("block").cogroup(words.groupBy("block"))
    out = joined.applyInArrow(join_back, f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def pieces(tokenizer_path: str) -> list[bytes]:
    """The bytes of every id of a byte-level file, special tokens as their names; b"" for ids not used."""
    with open(tokenizer_path, encoding="utf-8") as f:
        data = json.load(f)
    vocab = dict(data["model"]["vocab"]) | {t["content"]: t["id"] for t in data.get("added_tokens", [])}
    of, out = byte_alphabet(), [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return out


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and ``out_col``: the text of its ids, special tokens included, bytes that
    are no UTF-8 as the replacement character; a column of the name ``out_col`` is replaced.

    The ids of a batch are joined with the pieces of the vocabulary by position, the fixed side (one entry per
    id of the file) being sent to all tasks. Ids outside the vocabulary give nothing; a null array and an empty
    one give the empty text.
    """
    ship(encoded.sparkSession)
    encoded = encoded.drop(out_col)
    sent = encoded.sparkSession.sparkContext.broadcast(pieces(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array([*sent.value, b""], pa.large_binary())
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                lists = batch.column(ids_col)
                n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                at = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                at = np.where((at < 0) | (at >= len(known) - 1), len(known) - 1, at)
                got = known.take(pa.array(at))
                offsets = np.frombuffer(got.buffers()[1], np.int64)[: len(got) + 1]
                data = got.buffers()[2].to_pybytes() if got.buffers()[2] else b""
                ends = offsets[np.concatenate(([0], np.cumsum(n)))]
                texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out_col]
                )

    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())])
    return encoded.mapInArrow(giving_back(run), schema)
