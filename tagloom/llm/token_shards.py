"""Token ids in binary files: concatenated ids with Elias-Fano document boundaries.

Documents are range-partitioned and sorted by id; each task writes its documents to shard
files of bounded size. A file has a header, the boundaries, the document ids and the ids of
all its documents, 16 bits each where the vocabulary allows. A table lists the files of
the tasks that succeeded, with the number of ids before each; a file that a lost attempt has
left is not listed, as every attempt takes names of its own.

Null and empty texts hold the end id alone. Rows that share an id lie side by side, ordered
by a hash of their text; null ids come first. No rows give no files. Files go to any place
that ``pyarrow.fs`` reaches (shared folder, HDFS, object store). Other columns are not looked at.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.byte_bpe import byte_bpe
from tagloom.llm.elias_fano import EliasFano
from tagloom.llm.frames import open_store, row_key, staged, text_of

MAGIC = b"TLSHARD1"
#: Magic, bytes per id, low bits, documents, ids, bytes of high bits.
HEADER = struct.Struct("<8sHHQQQ")
#: Ids after which a task closes a file, and bytes that a reader holds of one.
SHARD_IDS = 16 << 20
#: Units that a writer remembers; it keeps little else, so more than other operators.
REMEMBERED = 400_000
READ_BYTES = 8 << 20

MANIFEST = "part int, seq int, path string, docs long, ids long"
CONTENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


class ShardWriter:
    """Collects the documents of one file."""

    def __init__(self, dtype: np.dtype):
        self.dtype, self.doc_ids, self.parts, self.ends = dtype, [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> int:
        self.doc_ids.append(doc_id)
        self.parts.append(ids)
        self.ends.append((self.ends[-1] if self.ends else 0) + len(ids) // self.dtype.itemsize)
        return self.ends[-1]

    def write(self, uri: str) -> None:
        bounds = EliasFano.of(np.array(self.ends, np.uint64))
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        store, path = open_store(uri)
        with store.open_output_stream(path) as out:
            out.write(HEADER.pack(MAGIC, self.dtype.itemsize, bounds.width, len(bounds), self.ends[-1], len(bounds.high)))
            for part in (bounds.samples, bounds.high, bounds.low, np.packbits(known, bitorder="little")):
                out.write(part.tobytes())
            out.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
            for ids in self.parts:
                out.write(ids)


class ShardReader:
    """One file: its boundaries in memory, its ids read as they are asked for."""

    def __init__(self, uri: str):
        store, path = open_store(uri)
        self.file = store.open_input_file(path)
        magic, size, width, n, self.n_ids, n_high = HEADER.unpack(self.file.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a shard file")
        self.dtype = np.dtype(f"<u{size}")
        samples = self._array("<u4", -(-n // 256))
        high, low = self._array("u1", n_high), self._array("u1", -(-n * width // 8))
        self.known = np.unpackbits(self._array("u1", -(-n // 8)), count=n, bitorder="little").astype(bool)
        self.doc_ids = self._array("<i8", n)
        self.bounds = EliasFano(n, width, low, high, samples)
        self.base = self.file.tell()

    def _array(self, dtype: str, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read(n * np.dtype(dtype).itemsize), dtype)

    def close(self) -> None:
        self.file.close()

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, found by two selects."""
        start, end = self.bounds[i - 1] if i else 0, self.bounds[i]
        size = self.dtype.itemsize
        self.file.seek(self.base + start * size)
        return np.frombuffer(self.file.read((end - start) * size), self.dtype)

    def summaries(self) -> Iterator[tuple[int, int, int]]:
        """``start, n, crc32`` of each document in order, reading bounded pieces."""
        self.file.seek(self.base)
        start = 0
        for end in self.bounds.values().tolist():
            crc, left = 0, (end - start) * self.dtype.itemsize
            while left:
                piece = self.file.read(min(left, READ_BYTES))
                crc = zlib.crc32(np.frombuffer(piece, self.dtype).astype("<u4").tobytes(), crc)
                left -= len(piece)
            yield start, end - start, crc
            start = end


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, shard_ids: int = SHARD_IDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the documents in the order of their ids; returns ``path, docs, ids, before`` of each file."""

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = byte_bpe(vocabulary, REMEMBERED), TaskContext.get().partitionId()
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        end, done = np.array([end_id], bpe.dtype).tobytes(), []

        def close(shard: ShardWriter) -> None:
            name = f"{folder}/part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.ids"
            shard.write(name)
            done.append((part, len(done), name, len(shard.ends), shard.ends[-1]))

        shard = ShardWriter(bpe.dtype)
        for batch in rows:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256).to_pydict()
                for i, t in zip(piece["doc_id"], piece["text"]):
                    if shard.add(i, bpe.encode(t) + end) >= shard_ids:
                        close(shard)
                        shard = ShardWriter(bpe.dtype)
        if shard.ends:
            close(shard)
        names = ("part", "seq", "path", "docs", "ids")
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        columns = list(zip(*done)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"), row_key(text).alias("key"))
        .repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key").select("doc_id", "text")
    )
    files = staged(ordered.mapInArrow(write, MANIFEST), "shards")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", "docs", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))


def read_shards(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, read from the files."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for file in batch.to_pylist():
                shard = ShardReader(file["path"])
                table = np.array(list(shard.summaries()), np.int64).reshape(-1, 3)
                shard.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64(), mask=~shard.known), *(pa.array(c, pa.int64()) for c in (table[:, 0] + file["before"], table[:, 1], table[:, 2]))],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    listed = staged(files, "manifest")
    n = max(1, min(listed.count(), 100_000))
    return listed.repartition(n).select("path", "before").mapInArrow(read, CONTENT)
