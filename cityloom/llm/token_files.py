"""Token files: ids of documents in independent zstandard frames, each with a checksum, behind them an
index of the documents and a seek table, so that a reader decompresses only what it is asked for.

A file, front to back:

- frames: little-endian ids of whole documents, one after the other, 2 bytes each if the vocabulary has no more
  than 65,536 ids, else 4; about ``frame_bytes`` before compression, more if a single document is longer
- a skippable frame (magic 0x184D2A5D): zstandard-compressed index: bytes per id, number of documents, then as
  64-bit numbers their ids, flags of null ids, token counts and the frame of each
- the seek table of the public seekable format (skippable frame 0x184D2A5E): compressed size, size and checksum
  (low half of XXH64 of the content) of each frame, number of frames, descriptor, magic 0x8F92EAB1

Any zstandard reader can read the frames, skipping the rest.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import materialise, scratch_path, ship
from .subwords import WordEncoder, word_encoder

_INDEX_MAGIC, _SEEK_MAGIC, _FOOTER_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 64 * 1024
# Characters whose lower case one engine may see otherwise than another.
_BEYOND_LATIN = "[^\\x00-\\x{12F}\\x{131}-\\x{17F}]"
# Bytes of text encoded at a time.
_PORTION = 8_000_000


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``_PORTION`` bytes of text, more only where one row has more."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PORTION, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _encode(texts: pa.Array, encoder: WordEncoder) -> Iterator[bytes]:
    """Ids of each text: every distinct word of the portion is encoded once."""
    texts = texts.cast(pa.large_string())
    if encoder.lowers and not pc.any(pc.match_substring_regex(texts, _BEYOND_LATIN)).as_py():
        texts = pc.utf8_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten().dictionary_encode()
    ids = encoder.encode_array(words.dictionary).take(words.indices)
    ends = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1]
    raw = memoryview(ids.buffers()[2]) if ids.buffers()[2] else b""
    cuts = ends[np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))].tolist()
    return (bytes(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


class FrameWriter:
    """Writes one file; documents are added whole."""

    def __init__(self, sink, wide: bool, frame_bytes: int = FRAME_BYTES) -> None:
        self.sink, self.wide, self.frame_bytes = sink, wide, frame_bytes
        self.zip = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int, int]] = []
        self.held: list[bytes] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """A document; ``ids`` as little-endian numbers of the file's width."""
        self.docs.append((doc_id or 0, doc_id is None, len(ids) // (4 if self.wide else 2), len(self.entries)))
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.frame_bytes:
            self._frame()

    def _frame(self) -> None:
        raw = b"".join(self.held)
        packed = self.zip.compress(raw)
        self.sink.write(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._frame()
        index = struct.pack("<BQ", 4 if self.wide else 2, len(self.docs))
        index += np.array(self.docs, "<i8").reshape(-1, 4).T.tobytes()
        packed = self.zip.compress(index)
        self.sink.write(struct.pack("<II", _INDEX_MAGIC, len(packed)) + packed)
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), 0x80, _FOOTER_MAGIC)
        self.sink.write(struct.pack("<II", _SEEK_MAGIC, len(table)) + table)


class FrameReader:
    """Reads one file: the tail first, then the frames that are asked for."""

    def __init__(self, source, size: int) -> None:
        self.source = source
        self.unzip = zstandard.ZstdDecompressor()
        n, _, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != _FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the file")
        at = size - 9 - 12 * n
        self.entries = np.frombuffer(self._read(at, 12 * n), "<u4").reshape(n, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.entries[:, 0].astype(np.int64))))
        magic, length = struct.unpack("<II", self._read(int(self.starts[-1]), 8))
        if magic != _INDEX_MAGIC:
            raise ValueError("no index behind the frames")
        index = self.unzip.decompress(self._read(int(self.starts[-1]) + 8, length))
        self.width, count = struct.unpack("<BQ", index[:9])
        self.doc_id, self.null_id, self.n_tokens, self.frame = np.frombuffer(index[9:], "<i8").reshape(4, count)
        self.first_token = np.cumsum(self.n_tokens) - self.n_tokens

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def content(self, frame: int) -> bytes:
        raw = self.unzip.decompress(self._read(int(self.starts[frame]), int(self.entries[frame, 0])))
        if len(raw) != self.entries[frame, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.entries[frame, 2]:
            raise ValueError(f"frame {frame} does not have its checksum")
        return raw

    def documents(self, first: int, last: int, wanted: np.ndarray | None = None):
        """``(doc_id, first token in the file, ids as little-endian 32-bit numbers)`` of the documents in
        the frames ``first`` to ``last`` (exclusive); with ``wanted``, only those, and only frames that
        hold any are decompressed."""
        at, upto = np.searchsorted(self.frame, [first, last])
        here, raw, offset = -1, b"", 0
        keep = None if wanted is None else np.isin(self.doc_id[at:upto], wanted) & (self.null_id[at:upto] == 0)
        for d in range(at, upto):
            f = int(self.frame[d])
            if f != here:
                here, raw, offset = f, None, 0
            size = int(self.n_tokens[d]) * self.width
            if keep is None or keep[d - at]:
                raw = self.content(f) if raw is None else raw
                ids = raw[offset : offset + size]
                if self.width == 2:
                    ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                yield (None if self.null_id[d] else int(self.doc_id[d])), int(self.first_token[d]), ids
            offset += size


def shared_folder(spark: SparkSession, folder: str) -> str:
    """``folder`` as an address that pyarrow takes for the same place as Spark does: without a scheme it lies in Spark's
    default file system (pyarrow would take the executor's own disk), and Hadoop's names of S3 become ``s3``. Raises
    ``ValueError`` for a scheme that pyarrow does not know, before any work."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    scheme = path.toUri().getScheme()
    if scheme is None:
        path = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
        folder, scheme = path.toString(), path.toUri().getScheme()
    if scheme == "file":
        return f"file://{path.toUri().getPath()}"
    if scheme in ("s3a", "s3n"):
        return f"s3{folder.removeprefix(scheme)}"
    if scheme not in ("hdfs", "s3", "gs", "abfs", "abfss", "viewfs"):
        raise ValueError(f"token files can't be written to {scheme}: folders; give hdfs, s3, gs, abfs or file")
    return folder


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    *,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Encode whole texts and write them in ascending order of ``id_col`` (an integer). Returns the
    manifest: ``shard, path, n_docs, n_tokens, n_frames, start`` (tokens in all shards before).

    The file must be one with word ends, that drops white space, as ``word_bpe_49k.json``.
    Null ids come first; rows with equal ids are ordered by a hash of their text, then by text. Null and empty texts hold ``end_id`` alone.
    Other columns are dropped. Documents are parted by ranges of id and text hash, so rows that repeat one id
    are spread too. Every attempt of a task writes a file of its own, and only files of attempts that Spark
    committed are in the manifest, which is what a reader goes by: files of lost attempts are never read.
    ``folder`` is any place that both Spark and pyarrow know (:func:`shared_folder`; default: below the shared scratch
    folder). An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    ship(spark)
    target = shared_folder(spark, folder or scratch_path(spark, "tokens"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path, 4 if end_id >= 65_536 else None)
        if not encoder.word_ends:
            raise ValueError("this file's words hold white space; it needs a splitter of its own")
        wide = encoder.width == 4
        end = np.array([end_id], encoder.kind).tobytes()
        shard, out, n_docs, n_tokens = TaskContext.get().partitionId(), None, 0, 0
        system, base = fs.FileSystem.from_uri(target)
        name = f"part-{shard:06d}-{uuid.uuid4().hex}.tokens.zst"
        for whole in batches:
            for batch in _portions(whole):
                if out is None:
                    system.create_dir(base, recursive=True)
                    sink = system.open_output_stream(f"{base}/{name}", compression=None)
                    out = FrameWriter(sink, wide, frame_bytes)
                for key, ids in zip(batch.column("id").to_pylist(), _encode(batch.column("text"), encoder), strict=True):
                    out.add(key, ids + end)
                    n_docs += 1
                    n_tokens += len(ids) // len(end) + 1
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [f"{target}/{name}"], "n_docs": [n_docs], "n_tokens": [n_tokens],
                 "n_frames": [len(out.entries)]},
                schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                                  ("n_tokens", pa.int64()), ("n_frames", pa.int32())]),
            )

    manifest = materialise(
        rows.mapInArrow(write, "shard int, path string, n_docs long, n_tokens long, n_frames int"), "token-manifest"
    )
    # One row per file, however many documents there are.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read_tokens(
    manifest: DataFrame, id_col: str = "doc_id", wanted: list[int] | None = None, frames_per_task: int = 64
) -> DataFrame:
    """Read files back: ``id_col, start`` (tokens of all documents before), ``n_tokens, ids_le32`` (the ids as
    little-endian unsigned 32-bit numbers). With ``wanted`` only those documents, and only the frames that
    hold them are decompressed. A frame that does not match its checksum raises ``ValueError``."""
    ship(manifest.sparkSession)
    spans = manifest.select(
        "path", "start", F.explode(F.sequence(F.lit(0), F.col("n_frames") - 1, F.lit(frames_per_task))).alias("first")
    )
    # Said outright, as the rows are too small to tell how much there is to read.
    spans = spans.repartition(max(1, spans.count()), "path", "first")
    asked = None if wanted is None else np.array(sorted(wanted), np.int64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_le32", pa.binary())])
        path, reader = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    path = row["path"]
                    system, where = fs.FileSystem.from_uri(path)
                    reader = FrameReader(system.open_input_file(where), system.get_file_info(where).size)
                found = []
                for key, first, ids in reader.documents(row["first"], row["first"] + frames_per_task, asked):
                    found.append({"id": key, "start": row["start"] + first, "n_tokens": len(ids) // 4, "ids_le32": ids})
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    out = spans.mapInArrow(read, "id long, start long, n_tokens long, ids_le32 binary")
    return out.withColumnRenamed("id", id_col)
