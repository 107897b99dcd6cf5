"""Token ids in binary files of bit or byte planes.

File layout, all integers little-endian:

    magic | planes of block 0 | planes of block 1 | ... | documents | chunk index | footer length (8 bytes) | magic

A block holds BLOCK_IDS ids, the last one fewer. Its ids are transposed: plane k holds byte k
(or bit k) of every id. Each plane is one zstandard frame. ``documents`` is a frame of doc ids,
null flags and id counts. The chunk index (a frame of JSON) names each block's place, plane
sizes and id count, so a reader opens the blocks it needs and no others.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecloom.llm.batches import bounded
from vecloom.llm.encoding import SLICE_BYTES, crc, encoder, with_end
from vecloom.llm.shared_files import new_file, open_file
from vecloom.session import cut_lineage

MAGIC = b"VLPLANE1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 26
LEVEL = 1
END_ID = 0


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Planes of one block of unsigned 32-bit ids, lowest first: 4 of bytes or 32 of bits."""
    if kind == "byte":
        return [p.tobytes() for p in np.ascontiguousarray(ids.astype("<u4", copy=False)).view(np.uint8).reshape(-1, 4).T]
    return [np.packbits((ids >> np.uint32(k)).astype(np.uint8) & 1, bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).copy().view("<u4").ravel()
    out = np.zeros(n, np.uint32)
    for k, p in enumerate(planes):
        out |= np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little").astype(np.uint32) << np.uint32(k)
    return out


class PlaneWriter:
    """Appends documents to an output stream; holds one block of ids and the documents' counts."""

    def __init__(self, stream: Any, kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = LEVEL):
        self.stream, self.kind, self.block_ids = stream, kind, block_ids
        self.frames = zstandard.ZstdCompressor(level=level)
        self.blocks: list[list[Any]] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting, self.n_ids, self.place = 0, 0, len(MAGIC)
        self.doc_ids: list[int | None] = []
        self.sizes: list[np.ndarray] = []
        stream.write(MAGIC)

    def add(self, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.sizes.append(sizes)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block_ids:
            held = np.concatenate(self.waiting)
            whole = len(held) // self.block_ids * self.block_ids
            for k in range(0, whole, self.block_ids):
                self._block(held[k : k + self.block_ids])
            self.waiting, self.n_waiting = [held[whole:]], len(held) - whole

    def _block(self, ids: np.ndarray) -> None:
        frames = [self.frames.compress(p) for p in to_planes(ids, self.kind)]
        self.blocks.append([self.place, [len(f) for f in frames], len(ids)])
        self._write(b"".join(frames))

    def _write(self, part: bytes) -> None:
        self.stream.write(part)
        self.place += len(part)

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        sizes = np.concatenate(self.sizes) if self.sizes else np.empty(0, np.int64)
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        nulls = np.array([d is None for d in self.doc_ids], np.uint8)
        documents = self.frames.compress(ids.tobytes() + nulls.tobytes() + sizes.astype("<i8").tobytes())
        at = self.place
        self._write(documents)
        index = {"kind": self.kind, "block_ids": self.block_ids, "blocks": self.blocks, "documents": [at, len(documents), len(ids)], "n_ids": self.n_ids}
        footer = self.frames.compress(json.dumps(index).encode())
        self._write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.stream.close()


class PlaneReader:
    """Random access to the ids of one file."""

    def __init__(self, stream: Any):
        self.stream, self.frames = stream, zstandard.ZstdDecompressor()
        end = stream.seek(0, io.SEEK_END) or stream.tell()
        tail = self._at(end - 16, 16)
        if tail[8:] != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError("not a whole plane file")
        length = int.from_bytes(tail[:8], "little")
        self.index = json.loads(self.frames.decompress(self._at(end - 16 - length, length)))
        place, length, n = self.index["documents"]
        raw = self.frames.decompress(self._at(place, length))
        self.doc_ids, self.nulls = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n)
        self.bounds = np.concatenate(([0], np.cumsum(np.frombuffer(raw[9 * n :], "<i8", n))))

    def _at(self, place: int, length: int) -> bytes:
        self.stream.seek(place)
        return self.stream.read(length)

    def block(self, k: int) -> np.ndarray:
        place, sizes, n = self.index["blocks"][k]
        raw, at, planes = self._at(place, sum(sizes)), 0, []
        for size in sizes:
            planes.append(self.frames.decompress(raw[at : at + size]))
            at += size
        return from_planes(planes, n, self.index["kind"])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from place ``start`` to ``stop``; only the blocks that hold them are read."""
        size = self.index["block_ids"]
        if stop <= start:
            return np.empty(0, np.uint32)
        first = start // size
        held = np.concatenate([self.block(k) for k in range(first, -(-stop // size))])
        return held[start - first * size : stop - first * size]

    def documents(self, ids_at_once: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first document, number of documents, their ids), in order, some blocks at a time."""
        d = 0
        while d < len(self.doc_ids):
            stop = max(d + 1, int(np.searchsorted(self.bounds, self.bounds[d] + ids_at_once, side="right")) - 1)
            yield d, stop - d, self.ids(int(self.bounds[d]), int(self.bounds[stop]))
            d = stop


MANIFEST = "partition int, nth int, uri string, n_docs bigint, n_ids bigint"


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, kind: str = "byte", file_ids: int = FILE_IDS, special_as_text: bool = False) -> DataFrame:
    """Writes the ids of all documents in ascending doc_id order; returns the manifest, one row per file.

    A null text is empty, so every document has its end id at least. Null ids come first; rows
    that repeat an id stand side by side. Range partitions are cut on id and text hash, so
    that no id is too large for a task. An empty table makes no files.
    """

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, writer, uri, nth = encoder(tokenizer_path, special_as_text), None, "", 0
        partition = TaskContext.get().partitionId()

        def closed() -> pa.RecordBatch:
            writer.close()
            row = {"partition": partition, "nth": nth, "uri": uri, "n_docs": len(writer.doc_ids), "n_ids": writer.n_ids}
            return pa.RecordBatch.from_pylist([row], pa.schema([("partition", pa.int32()), ("nth", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

        for batch in bounded(batches, "text", SLICE_BYTES):
            if writer is None:
                uri, stream = new_file(folder, ".planes")
                writer = PlaneWriter(stream, kind)
            ids, bounds = with_end(*coder.encode(batch.column("text")), end_id)
            writer.add(batch.column("doc_id").to_pylist(), np.diff(bounds), ids)
            if writer.n_ids >= file_ids:
                yield closed()
                writer, nth = None, nth + 1
        if writer is not None:
            yield closed()

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    ordered = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash").select("doc_id", "text")
    return cut_lineage(ordered.mapInArrow(files, MANIFEST))


def read(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, and ids if asked for.

    ``start`` counts the ids of all documents before it. The manifest's running sum is over
    one small row per file.
    """
    before = Window.orderBy("partition", "nth").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("uri", "base")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                with open_file(file["uri"]) as stream:
                    reader = PlaneReader(stream)
                    for d, n, ids in reader.documents():
                        bounds = reader.bounds[d : d + n + 1]
                        own = bounds - bounds[0]
                        parts = [ids[a:b] for a, b in zip(own.tolist(), own[1:].tolist(), strict=False)]
                        columns = [
                            pa.array(reader.doc_ids[d : d + n], pa.int64(), mask=reader.nulls[d : d + n].astype(bool)),
                            pa.array(file["base"] + bounds[:-1], pa.int64()),
                            pa.array(np.diff(bounds), pa.int64()),
                            pa.array([crc(p) for p in parts], pa.int64()),
                        ]
                        if with_ids:
                            columns.append(pa.array([p.astype("<u4", copy=False).tobytes() for p in parts], pa.binary()))
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    spread = files.repartition(max(1, manifest.count()), "uri")
    return spread.mapInArrow(documents, schema)
