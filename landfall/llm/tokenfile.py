"""Binary token files: ids in bit or byte planes, each compressed by zstandard, with an index of chunks.

A file is the magic, then chunks, then the footer (JSON, compressed), its size as 8 bytes, and the magic again. A chunk
holds up to ``CHUNK`` ids: plane by plane, the bits (or bytes) of equal weight of all its ids, compressed. The footer
lists each chunk's offset, number of ids and plane sizes, so any chunk is read by itself; and likewise the blocks that
hold the documents' ids and lengths.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.arrow import slices, values
from landfall.llm.tokens import BYTE_BPE, encoder, tokenizer_path

MAGIC = b"idplane1"
CHUNK = 1 << 16
END_ID = 2


def to_planes(ids: np.ndarray, planes: str = "bit") -> list[bytes]:
    """The planes of unsigned 32-bit ids, lowest weight first, without the empty ones at the top."""
    ids = np.ascontiguousarray(ids, "<u4")
    top = int(ids.max()).bit_length() if len(ids) else 0
    if planes == "byte":
        return [np.ascontiguousarray(ids.view(np.uint8)[k::4]).tobytes() for k in range((top + 7) // 8)]
    return [np.packbits((ids >> np.uint32(b)).astype(np.uint8) & 1, bitorder="little").tobytes() for b in range(top)]


def from_planes(planes: list[bytes], n: int, kind: str = "bit") -> np.ndarray:
    ids = np.zeros(n, "<u4")
    for k, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        if kind == "bit":
            raw = np.unpackbits(raw, count=n, bitorder="little")
        ids |= raw.astype("<u4") << np.uint32(k if kind == "bit" else 8 * k)
    return ids


class Writer:
    """One file, written front to back; holds one chunk of ids and the index in memory."""

    def __init__(self, sink, planes: str, level: int = 3):
        self.sink, self.planes, self.zip = sink, planes, zstandard.ZstdCompressor(level=level)
        self.at, self.chunks, self.blocks = 0, [], []
        self.ids, self.held, self.doc_ids, self.lengths = [], 0, [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.ids.append(ids)
        self.held += len(ids) // 4
        if self.held >= CHUNK:
            self._chunks(False)
        if len(self.doc_ids) >= CHUNK:
            self._block()

    def _chunks(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.ids), "<u4")
        end = len(ids) if last else len(ids) // CHUNK * CHUNK
        for start in range(0, end, CHUNK):
            own = ids[start:min(end, start + CHUNK)]
            parts = [self.zip.compress(p) for p in to_planes(own, self.planes)]
            self.chunks.append([self.at, len(own), [len(p) for p in parts]])
            self._put(b"".join(parts))
        self.ids, self.held = [ids[end:].tobytes()], len(ids) - end

    def _block(self) -> None:
        data = self.zip.compress(json.dumps([self.doc_ids, self.lengths]).encode())
        self.blocks.append([self.at, len(data)])
        self._put(data)
        self.doc_ids, self.lengths = [], []

    def close(self) -> None:
        self._chunks(True)
        self._block()
        footer = self.zip.compress(json.dumps(
            {"planes": self.planes, "chunks": self.chunks, "documents": self.blocks}).encode())
        self._put(footer + len(footer).to_bytes(8, "little") + MAGIC)


class Reader:
    """Random access to the chunks of a file."""

    def __init__(self, source):
        self.source, self.zip = source, zstandard.ZstdDecompressor()
        size = source.size()
        tail = source.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token file, or cut short")
        n = int.from_bytes(tail[:8], "little")
        self.index = json.loads(self.zip.decompress(source.read_at(n, size - 16 - n)))

    def chunk(self, k: int) -> np.ndarray:
        at, n, sizes = self.index["chunks"][k]
        data, planes, start = self.source.read_at(sum(sizes), at), [], 0
        for size in sizes:
            planes.append(self.zip.decompress(data[start:start + size]))
            start += size
        return from_planes(planes, n, self.index["planes"])

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Documents in file order. Holds a chunk, or a document where that is longer."""
        left, k = np.zeros(0, "<u4"), 0
        for at, size in self.index["documents"]:
            for doc_id, n in zip(*json.loads(self.zip.decompress(self.source.read_at(size, at)))):
                parts = [left]
                have = len(left)
                while have < n:
                    parts.append(self.chunk(k))
                    have += len(parts[-1])
                    k += 1
                own = np.concatenate(parts) if len(parts) > 1 else left
                left = own[n:]
                yield doc_id, own[:n]


def write(df: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, planes: str = "bit") -> None:
    """Write the ids of ``df`` (doc_id bigint, text), each document's ended by ``end_id``, ascending by doc_id.

    Null doc_ids come first; rows of one doc_id are ordered by the hash of their text, so that a repeated id can spread
    over files. A null or empty text is the end id alone. Other columns are ignored; an empty table writes no file.

    Rows are range-partitioned by doc_id; each task streams its range into ``part-<n>.ids`` under ``path``. A file is
    written under a name of its own and then renamed, and its content depends on its range only, so a repeated task
    puts the same file in the same place. ``path`` must be reachable by ``pyarrow.fs`` from every executor, such as a
    folder below ``spark.checkpoint.dir``. A Parquet manifest, ``manifest``, lists the files and makes them count.
    """
    tokenizer = tokenizer or tokenizer_path(BYTE_BPE)
    ranged = (df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
              .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, n, docs, writer = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0, 0, None
        files, folder = pyarrow.fs.FileSystem.from_uri(path)
        name, unfinished = f"{folder}/part-{part:06d}.ids", f"{folder}/_{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            for some in slices(batch, "text"):
                if writer is None:
                    files.create_dir(folder, recursive=True)
                    sink = files.open_output_stream(unfinished)
                    writer = Writer(sink, planes)
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encode(values(some, "text", ""))):
                    writer.add(doc_id, ids + end)
                    n, docs = n + len(ids) // 4 + 1, docs + 1
        if writer:
            writer.close()
            sink.close()
            files.move(unfinished, name)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_ids": [n], "n_docs": [docs]})

    ranged.select("doc_id", "text").mapInArrow(run, "part int, n_ids bigint, n_docs bigint").write.parquet(
        f"{path}/manifest")


def read(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """The documents of a written table: doc_id, start (ids before it in the table), n_tokens, ids_crc32 (and ids).

    One task per file. Starts come from the manifest, which has a row per file.
    """
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.parquet(f"{path}/manifest")
    parts = manifest.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("base"))
    ddl = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = pyarrow.fs.FileSystem.from_uri(path)
        for batch in batches:
            for part, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist()):
                with files.open_input_file(f"{folder}/part-{part:06d}.ids") as source:
                    rows, size = [], 0
                    for doc_id, ids in Reader(source).documents():
                        rows.append((doc_id, base, len(ids), zlib.crc32(ids.tobytes()), *([ids] if keep_ids else [])))
                        base += len(ids)
                        size += len(ids)
                        if len(rows) == 4096 or size > 1 << 22:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
        arrays += [pa.array(c, pa.list_(pa.int32())) for c in columns[4:]]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(arrays)])

    return parts.repartitionByRange(max(1, manifest.count()), "part").mapInArrow(run, ddl)
