import hashlib
import io
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cityloom.llm import bpe, subwords, token_files
from cityloom.llm.queries import op4_token_files, op8_bpe

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TEXTS = [
    "", None, "Hello, world! It's 3.14 o'clock...", "  two  blanks \n\n lines\t\ttabs ", "<|endoftext|> a<|endoftext|>,b",
    "don't DON'T ’s élan Élan, naïve? é ́x", "日本語 テキスト。 emoji 😀👍🏽!", "a  b c\x85 d\x1c e\x0b f", "ΣΑΣ Σ İstanbul ǅ ﬁ",
    "x" * 5000, "the " * 3000, "word," * 50, " lead", "trail ", "a" + "\n" * 9 + "b", "!? ;: .", "A.b,C", "1,000.5%%%!!", "퟿￿\U0010ffff",
]
ALPHABET = st.text(st.sampled_from(list("aAbÉß'st.,!?%#&<|> \n\t \x85\x1ćΣİ1½日😀")), max_size=40)


@lru_cache
def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def frame(spark, texts=TEXTS):
    data = [(i, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again"), (None, "no id")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    return df.withColumn("id", F.lit("x")).withColumn("ids", F.lit(1)).withColumn("block", F.lit(2)).repartition(3)


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_words_apart_give_the_ids_of_the_whole_text(text):
    for path, cut in ((BYTE, bpe.UNIT.findall), (WORD, lambda t: t.split(" "))):
        encoder = subwords.word_encoder(path, 4)
        ids = np.frombuffer(b"".join(encoder.encode(cut(text))), "<u4").tolist()
        assert ids == library(path).encode(text, add_special_tokens=False).ids
        whole = encoder.encode_array(pa.array(cut(text), pa.large_string())).to_pylist()
        assert whole == encoder.encode(cut(text))


@pytest.mark.parametrize("block", [10, bpe.BLOCK_CHARS])
def test_encode_and_decode(spark, block):
    tokenizer = library(BYTE)
    df = frame(spark)
    out = bpe.decode(bpe.encode(df, BYTE, block_chars=block, buckets=3).withColumn("decoded", F.lit(0)), BYTE)
    assert out.columns == ["doc_id", "ids", "decoded"]
    got = sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in out.collect()), key=str)
    want = []
    for r in df.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)
    assert bpe.encode(df.limit(0), BYTE).collect() == []


def test_decode_of_any_ids(spark):
    tokenizer = library(BYTE)
    lists = [[], None, [50256, 0, 1], [220, 188, 5], list(range(0, 50257, 97))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "k int, ids array<int>")
    got = {r["k"]: r["decoded"] for r in bpe.decode(df, BYTE).collect()}
    assert [got[i] for i in range(5)] == [tokenizer.decode(x or [], skip_special_tokens=False) for x in lists]
    odd = spark.createDataFrame([(0, [60000, -5, 72])], "k int, ids array<int>")
    assert bpe.decode(odd, BYTE).first()["decoded"] == tokenizer.decode([72])


def test_query_op8_against_the_library(spark):
    sf, tokenizer = "/root/testdata/sf0.001", library(BYTE)
    got = {r["doc_id"]: r for r in op8_bpe(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        x = got.pop(r["doc_id"])
        assert x["n_tokens"] == len(ids)
        assert x["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert x["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert not got


def test_token_files_round_trip(spark):
    df, tokenizer = frame(spark), library(WORD)
    manifest = token_files.write_tokens(df, WORD, end_id=2, frame_bytes=200)
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], np.frombuffer(r["ids_le32"], "<u4").tolist())
                  for r in token_files.read_tokens(manifest, frames_per_task=2).collect()))
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: r[:2])
    want = [(r[2], tokenizer.encode(r[3], add_special_tokens=False).ids + [2]) for r in rows]
    assert [x[1] for x in got] == [w[0] for w in want]
    assert sorted(str((x[1], x[3])) for x in got) == sorted(map(str, want))
    start = 0
    for s, _, n, ids in got:
        assert s == start and n == len(ids)
        start += n
    some = token_files.read_tokens(manifest, wanted=[5, 3, 999]).collect()
    assert sorted(r["doc_id"] for r in some) == [3, 3, 3, 5]
    assert token_files.read_tokens(token_files.write_tokens(df.limit(0), WORD, end_id=2)).collect() == []


def test_reader_decompresses_only_what_is_asked_for_and_checks_it():
    sink = io.BytesIO()
    writer = token_files.FrameWriter(sink, False, 400)
    docs = {i: np.arange(i, i + 90, dtype="<u2").tobytes() for i in range(40)}
    for k, ids in docs.items():
        writer.add(k, ids)
    writer.close()
    data = sink.getvalue()
    # Any reader of zstandard can read the frames.
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(docs.values())
    reader = token_files.FrameReader(io.BytesIO(data), len(data))
    read = []
    content = reader.content
    reader.content = lambda f: read.append(f) or content(f)
    got = list(reader.documents(0, len(reader.entries), np.array([17])))
    assert [(k, at) for k, at, _ in got] == [(17, 17 * 90)] and len(read) == 1
    broken = bytearray(data)
    broken[int(reader.entries[0, 0]) // 2] ^= 1
    bad = token_files.FrameReader(io.BytesIO(bytes(broken)), len(broken))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        bad.content(0)
    with pytest.raises(ValueError):
        token_files.FrameReader(io.BytesIO(data[:-3]), len(data) - 3)


def test_query_op4_against_the_library(spark):
    sf, tokenizer = "/root/testdata/sf0.001", library(WORD)
    got, start = {r["doc_id"]: r for r in op4_token_files(spark, sf).collect()}, 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        x = got.pop(r["doc_id"])
        assert (x["start"], x["n_tokens"], x["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_token_folders_are_where_spark_has_them(spark, tmp_path):
    from cityloom.llm.token_files import shared_folder

    assert shared_folder(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert shared_folder(spark, f"file:{tmp_path}") == shared_folder(spark, f"file://{tmp_path}") == f"file://{tmp_path}"
    assert shared_folder(spark, "s3a://bucket/a b") == "s3://bucket/a b"
    assert shared_folder(spark, "hdfs://host/a") == "hdfs://host/a"
    with pytest.raises(ValueError, match="wasb"):
        shared_folder(spark, "wasb://x/y")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    made = token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "t"), end_id=2)
    assert [r["n_tokens"] for r in token_files.read_tokens(made).collect()] == [3] and any((tmp_path / "t").iterdir())


def test_workers_give_memory_back_after_each_task():
    """What a task has freed does not stay with the worker, which lives on."""
    from cityloom.llm import common

    def held():
        with open("/proc/self/status") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("VmRSS")) // 1024

    def run(batches):
        for _ in batches:
            words = [bytes(64) + str(i).encode() for i in range(2_000_000)]
            last = words[-1]  # keeps the top of the heap, so that freed pages stay in it
            del words
            kept.append(last)
            yield None

    kept = []
    before = held()
    assert list(common.giving_back(run)(iter([1]))) == [None]
    assert held() - before < 60
