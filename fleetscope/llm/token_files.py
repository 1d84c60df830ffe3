"""Operator 2 - token-id files: independent zstandard frames with a trailing seek table.

One file for each range of document ids, little-endian throughout:

* frames: each an independent zstandard frame with ids (unsigned, 2 bytes if every id of the
  writer's vocabulary fits, else 4) of ONE document; a long document has several frames of at
  most ``FRAME_IDS`` ids, an empty one none;
* a skippable frame ``0x184D2A5D`` with the documents: count, id width, then per document
  doc_id (8), null flag (1), first frame (4), number of frames (4), ids (8);
* a skippable frame ``0x184D2A5E``, the seek table: per frame compressed size (4), raw size (4),
  low half of the raw bytes' XXH64 (4); then number of frames (4), ``0x80``, ``0x8F92EAB1``.

A reader takes the last 9 bytes, the two tables, and then decompresses only the frames of the
documents asked for, each checked against its checksum.  A file counts only when its row is in
the manifest, which Spark commits after all tasks: files of lost or repeated attempts are never
read.  Cases: null text = empty document; equal or null doc_ids keep a place each (null first,
ties by text hash and text); an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import byte_slices, ship
from fleetscope.llm.encoding import encoder

FRAME_IDS = 1 << 18
ZSTD_LEVEL = 3
#: Words a worker keeps in a cache generation; no other operator shares the executor's memory here.
CACHE_ENTRIES = 400_000
DOCS_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("frame", "<u4"), ("frames", "<u4"), ("ids", "<u8")])
_SEEK = np.dtype([("size", "<u4"), ("raw", "<u4"), ("check", "<u4")])

MANIFEST = "first_id long, first_hash long, file string, n_docs long, n_ids long, width int"


class TokenFileWriter:
    """Writes documents' ids one after another to an open binary sink."""

    def __init__(self, sink, width: int = 4):
        self.sink, self.width, self.docs, self.seek, self.n_ids = sink, width, [], [], 0
        self._zstd = zstandard.ZstdCompressor(level=ZSTD_LEVEL, write_content_size=True)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        first = len(self.seek)
        for at in range(0, len(ids), FRAME_IDS):
            raw = ids[at:at + FRAME_IDS].astype(f"<u{self.width}").tobytes()
            frame = self._zstd.compress(raw)
            self.sink.write(frame)
            self.seek.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.docs.append((doc_id or 0, doc_id is None, first, len(self.seek) - first, len(ids)))
        self.n_ids += len(ids)

    def finish(self) -> None:
        docs = struct.pack("<QB", len(self.docs), self.width) + np.array(self.docs, dtype=_DOC).tobytes()
        self.sink.write(struct.pack("<II", DOCS_MAGIC, len(docs)) + docs)
        seek = np.array(self.seek, dtype=_SEEK).tobytes() + struct.pack("<IBI", len(self.seek), 0x80, FOOTER_MAGIC)
        self.sink.write(struct.pack("<II", SEEK_MAGIC, len(seek)) + seek)


class TokenFileReader:
    """Random access to a finished file; ``source`` has size(), seek() and read()."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, kind, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or kind != 0x80:
            raise ValueError("not a token file, or cut short")
        seek_at = size - 9 - n * _SEEK.itemsize - 8
        if struct.unpack("<I", self._at(seek_at, 4))[0] != SEEK_MAGIC:
            raise ValueError("seek table not found")
        self.seek = np.frombuffer(self._at(seek_at + 8, n * _SEEK.itemsize), dtype=_SEEK)
        self.starts = np.concatenate([[0], np.cumsum(self.seek["size"], dtype=np.int64)])
        magic, length = struct.unpack("<II", self._at(int(self.starts[-1]), 8))
        if magic != DOCS_MAGIC:
            raise ValueError("document table not found")
        docs = self._at(int(self.starts[-1]) + 8, length)
        count, self.width = struct.unpack("<QB", docs[:9])
        self.docs = np.frombuffer(docs, dtype=_DOC, offset=9, count=count)
        self._zstd = zstandard.ZstdDecompressor()

    def _at(self, start: int, n: int) -> bytes:
        self.source.seek(start)
        return self.source.read(n)

    def frame(self, i: int) -> bytes:
        size, raw_size, check = (int(x) for x in self.seek[i])
        raw = self._zstd.decompress(self._at(int(self.starts[i]), size), max_output_size=raw_size)
        if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i}: checksum differs")
        return raw

    def frames_of(self, k: int):
        """The k-th document's ids, a frame at a time, as unsigned 32-bit integers."""
        d = self.docs[k]
        for i in range(int(d["frame"]), int(d["frame"]) + int(d["frames"])):
            yield np.frombuffer(self.frame(i), dtype=f"<u{self.width}").astype("<u4")


def open_store(uri: str):
    """(file system, path) for a URI or a plain path."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Encode ``docs`` and write them in ascending id order below ``folder`` (shared storage).
    Returns the committed manifest, one row for each file."""
    spark = docs.sparkSession
    ship(spark)

    def write(batches):
        enc = encoder(tokenizer, CACHE_ENTRIES)
        width = 2 if max(enc.pre.largest_id, end_id) < 1 << 16 else 4
        fs, path = open_store(folder)
        name, sink, out, first = f"tokens-{uuid.uuid4().hex}.zst", None, None, None
        end = np.array([end_id], dtype="<u4")
        try:
            for batch in batches:
                for part in byte_slices(batch, "text"):
                    ids, hashes, texts = (part.column(i).to_pylist() for i in range(3))
                    for doc_id, h, text in zip(ids, hashes, texts):
                        if out is None:
                            fs.create_dir(path, recursive=True)
                            sink = fs.open_output_stream(f"{path}/{name}", compression=None)
                            out, first = TokenFileWriter(sink, width), (doc_id, h)
                        out.add(doc_id, np.concatenate([np.frombuffer(enc.encode(text), dtype="<u4"), end]))
            if out is not None:
                out.finish()
        finally:
            if sink is not None:
                sink.close()
        if out is not None:
            row = (*first, f"{folder}/{name}", len(out.docs), out.n_ids, width)
            yield pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, (
                pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()))],
                names=["first_id", "first_hash", "file", "n_docs", "n_ids", "width"])

    ranged = (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("h"),
                          F.col(text_col).alias("text"))
              .repartitionByRange(F.col("id"), F.col("h")).sortWithinPartitions("id", "h", "text"))
    ranged.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place and digest from the files: doc_id, start, n_tokens, ids_crc32.

    Files are read by tasks of their own; the running total over files is a window over the
    manifest (one small row for each file, not for each document)."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    before = F.coalesce(F.sum("n_ids").over(
        Window.orderBy(F.col("first_id").asc_nulls_first(), "first_hash", "file").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).cast("long")

    def read(batches):
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = open_store(file)
                with fs.open_input_file(path) as source:
                    reader = TokenFileReader(source)
                    crc = np.zeros(len(reader.docs), dtype=np.int64)
                    for k in range(len(reader.docs)):
                        value = 0
                        for ids in reader.frames_of(k):
                            value = zlib.crc32(ids.tobytes(), value)
                        crc[k] = value
                    d = reader.docs
                    n = d["ids"].astype(np.int64)
                    start = base + np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(d["doc_id"].copy(), mask=d["null"].astype(bool)), pa.array(start, type=pa.int64()),
                         pa.array(n), pa.array(crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    return (manifest.select("file", before.alias("base")).repartition(files)
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_documents(folder_file: str, positions) -> list[np.ndarray]:
    """Ids of the documents at ``positions`` of one file; nothing else is decompressed."""
    fs, path = open_store(folder_file)
    with fs.open_input_file(path) as source:
        reader = TokenFileReader(source)
        return [np.concatenate([np.empty(0, "<u4"), *reader.frames_of(k)]) for k in positions]
