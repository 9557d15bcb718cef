"""Token ids in plane-shuffled binary files.

File layout (little-endian): MAGIC; the zstandard frames of all planes, chunk after chunk; the frame of the document
table (doc_id int64, id count int64, null flag uint8, each as one array); the frame of a JSON footer with the chunk
index; the footer frame's length as uint64; MAGIC. A chunk holds up to `block` ids: plane k of mode "byte" has byte k
of each id, plane k of mode "bit" has bit k of each id, packed. Planes above a chunk's largest id are not stored.

Each task writes its own file under a name with its attempt number and reports it in a manifest; only reported files
are read, so a repeated or lost attempt leaves no trace in the result.

Nulls and odd input: a null text counts as empty and has the end id alone; a null doc_id sorts first; rows that
repeat a doc_id stay separate rows, in order of their text; an empty table gives no file and no row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import crc, encoder
from .shared import Scratch, slices

MAGIC = b"RFPLANE1"
MANIFEST = "part int, file string, n_docs long, n_ids long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def split_planes(ids: np.ndarray, mode: str) -> list[bytes]:
    """The planes of up to a block of ids, lowest first."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    if mode == "byte":
        return [b.tobytes() for b in ids.astype("<u4").view(np.uint8).reshape(-1, 4).T[: -(-top // 8)]]
    return [np.packbits((ids >> np.uint32(k) & np.uint32(1)).astype(np.uint8)).tobytes() for k in range(top)]


def join_planes(planes: list[bytes], n: int, mode: str) -> np.ndarray:
    if mode == "byte":
        out = np.zeros((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            out[:, k] = np.frombuffer(plane, np.uint8)
        return out.reshape(-1).view("<u4")
    out = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        out |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n).astype(np.uint32) << np.uint32(k)
    return out


class PlaneWriter:
    """Writes one file; holds one block of ids and the document table."""

    def __init__(self, out, block: int = 1 << 16, mode: str = "byte", level: int = 3):
        self.out, self.block, self.mode, self.zstd = out, block, mode, zstandard.ZstdCompressor(level)
        self.rest, self.chunks, self.docs, self.counts, self.n_ids = np.zeros(0, np.uint32), [], [], [], 0
        out.write(MAGIC)
        self.at = len(MAGIC)

    def _frame(self, data: bytes) -> int:
        frame = self.zstd.compress(data)
        self.out.write(frame)
        self.at += len(frame)
        return len(frame)

    def _chunk(self, ids: np.ndarray) -> None:
        at = self.at
        self.chunks.append({"at": at, "n": len(ids), "planes": [self._frame(p) for p in split_planes(ids, self.mode)]})

    def add(self, doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs += doc_ids
        self.counts += counts.tolist()
        self.n_ids += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // self.block * self.block
        for at in range(0, whole, self.block):
            self._chunk(ids[at : at + self.block])
        self.rest = ids[whole:]

    def close(self) -> None:
        if len(self.rest):
            self._chunk(self.rest)
        null = np.array([d is None for d in self.docs], np.uint8)
        table = np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array(self.counts, "<i8").tobytes() + null.tobytes()
        footer = {"block": self.block, "mode": self.mode, "n_ids": self.n_ids, "n_docs": len(self.docs), "docs_at": self.at, "chunks": self.chunks}
        footer["docs_len"] = self._frame(table)
        self.out.write((self._frame(json.dumps(footer).encode())).to_bytes(8, "little") + MAGIC)


class PlaneReader:
    """Reads one file by its chunk index; ids(a, b) opens only the chunks that it needs."""

    def __init__(self, file):
        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        size = file.seek(0, 2)
        tail = self._bytes(size - 16, 16)
        if tail[8:] != MAGIC or self._bytes(0, 8) != MAGIC:
            raise ValueError("not a plane file, or an incomplete one")
        length = int.from_bytes(tail[:8], "little")
        self.footer = json.loads(self.zstd.decompress(self._bytes(size - 16 - length, length)))
        n, table = self.footer["n_docs"], self.zstd.decompress(self._bytes(self.footer["docs_at"], self.footer["docs_len"]))
        self.doc_ids, self.counts = np.frombuffer(table, "<i8", n), np.frombuffer(table, "<i8", n, 8 * n)
        self.null = np.frombuffer(table, np.uint8, n, 16 * n).astype(bool)
        self.last = (-1, np.zeros(0, np.uint32))

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _chunk(self, k: int) -> np.ndarray:
        if self.last[0] != k:
            c, planes = self.footer["chunks"][k], []
            data, at = self._bytes(c["at"], sum(c["planes"])), 0
            for n in c["planes"]:
                planes.append(self.zstd.decompress(data[at : at + n]))
                at += n
            self.last = (k, join_planes(planes, c["n"], self.footer["mode"]))
        return self.last[1]

    def ids(self, a: int, b: int) -> np.ndarray:
        size = self.footer["block"]
        parts = [self._chunk(k)[max(0, a - k * size) : b - k * size] for k in range(a // size, -(-b // size))]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _file_system(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, path: str, end: int, block: int = 1 << 16, mode: str = "byte") -> DataFrame:
    """Encodes docs (doc_id, text) into files of `folder`, in ascending doc_id order over files and inside each; returns the plan of the manifest.

    The one shuffle deals texts by ranges of doc_id; ids themselves are never shuffled.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, task = None, TaskContext.get()
        for batch in slices(batches):
            if writer is None:
                fs, root = _file_system(folder)
                fs.create_dir(root, recursive=True)
                name = f"{task.partitionId():06d}-{task.taskAttemptId()}.planes"
                sink = fs.open_output_stream(f"{root}/{name}")
                writer = PlaneWriter(sink, block, mode)
            ids, counts = encoder(path).encode(batch.column("text").to_pylist(), end)
            writer.add(batch.column("doc_id").to_pylist(), ids, counts)
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "file": [name], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(write, MANIFEST)


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """One row for each document: doc_id, start, n_tokens, ids_crc32, and ids if asked for. The manifest has a row for each file."""
    files, base = [], 0
    for row in sorted(manifest.collect(), key=lambda r: r.part):
        files.append((row.file, base))
        base += row.n_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with fs.open_input_file(f"{root}/{name}") as file:
                    reader = PlaneReader(file)
                    ends = np.cumsum(reader.counts)
                    for at in range(0, len(ends), 2048):
                        n, e = reader.counts[at : at + 2048], ends[at : at + 2048]
                        own = [reader.ids(b - k, b) for k, b in zip(n.tolist(), e.tolist(), strict=True)]
                        columns = [pa.array(reader.doc_ids[at : at + 2048], mask=reader.null[at : at + 2048]), pa.array(start + e - n), pa.array(n), pa.array([crc(x) for x in own], pa.int64())]
                        if with_ids:
                            columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    spark = manifest.sparkSession
    rows = spark.createDataFrame(files, "file string, base long").repartition(max(1, len(files)))
    return rows.mapInArrow(read, RESULT + (", ids array<long>" if with_ids else ""))


def store_tokens(docs: DataFrame, path: str, end: int, mode: str = "byte") -> DataFrame:
    """Writes docs to plane files in the shared folder and reads them back."""
    scratch = Scratch(docs.sparkSession, "planes")
    folder = f"{scratch.path}/files"
    manifest = scratch.keep(write_token_files(docs, folder, path, end, mode=mode), "manifest")
    return read_token_files(manifest, folder)
