"""Token ids in wavelet-matrix shards: one compressed file each, with access, rank, select and decoding.

The shard's ids are replaced by their places in its sorted alphabet. Plane ``l`` holds bit ``l`` (from the top) of
all places, after the ids were stably sorted by the bits above it; so following one id through the planes takes
one rank for each. A plane is packed into bits and compressed by itself; its rank directory (a count for each 512 bits) is
rebuilt in one pass when the plane is opened.

File: magic, length of the header, JSON header, then zstd frames: alphabet, ids of the documents, their null flags, their
lengths, planes. Documents stand in ascending order of doc_id across the files of a set.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, map_partitions, materialize, text_slices
from .tokens import encoder

MAGIC = b"WVMX0001"
#: A shard is closed with the document that brings it to so many ids.
SHARD_TOKENS = 1 << 20
BLOCK = 64  # bytes of a plane to an entry of the rank directory


def build(tokens: np.ndarray) -> tuple[np.ndarray, list[bytes], list[int]]:
    """Alphabet, packed planes and the number of zeros in each."""
    alphabet = np.flatnonzero(np.bincount(tokens)) if len(tokens) else np.zeros(0, np.int64)
    place = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.uint32)
    place[alphabet] = np.arange(len(alphabet))
    v = place[tokens].astype(np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    planes, zeros = [], []
    for shift in reversed(range(levels(len(alphabet)))):
        bit = (v >> shift) & 1 != 0
        zero = np.flatnonzero(~bit)
        planes.append(np.packbits(bit).tobytes())
        zeros.append(len(zero))
        v = np.concatenate([v.take(zero), v.take(np.flatnonzero(bit))])
    return alphabet, planes, zeros


def levels(alphabet: int) -> int:
    return max(1, (alphabet - 1).bit_length()) if alphabet else 0


class Plane:
    """A packed bit vector with rank and select."""

    def __init__(self, packed: bytes, n: int):
        self.n, self.data = n, np.frombuffer(packed, np.uint8)
        ones = np.bitwise_count(np.pad(self.data, (0, -len(self.data) % BLOCK))).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
        self.before = np.r_[0, np.cumsum(ones)]

    def bit(self, i: int) -> int:
        return int(self.data[i >> 3]) >> (7 - (i & 7)) & 1

    def rank(self, bit: int, i: int) -> int:
        """How many of the first ``i`` bits are ``bit``."""
        block = (i >> 3) // BLOCK
        ones = int(self.before[block]) + int(np.bitwise_count(self.data[block * BLOCK:i >> 3]).sum())
        if i & 7:
            ones += (int(self.data[i >> 3]) >> (8 - (i & 7))).bit_count()
        return ones if bit else i - ones

    def select(self, bit: int, k: int) -> int:
        """Place of the ``k``-th ``bit`` (from 0)."""
        before = self.before if bit else np.minimum(np.arange(len(self.before)) * BLOCK * 8, self.n) - self.before
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.data[block * BLOCK:(block + 1) * BLOCK])
        return block * BLOCK * 8 + int(np.flatnonzero(bits == bit)[k - int(before[block])])


class Shard:
    """An opened file. Planes are decompressed when they are first used."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        size, = struct.unpack("<I", data[8:12])
        self.header = json.loads(data[12:12 + size])
        self.n, self.zeros = self.header["tokens"], self.header["zeros"]
        self._frames, at = [], 12 + size
        for length in self.header["frames"]:
            self._frames.append(data[at:at + length])
            at += length
        self.alphabet = self._array(0, "<u4")
        ids, null = self._array(1, "<i8").tolist(), self._array(2, "u1").tolist()
        self.doc_ids = [None if x else d for d, x in zip(ids, null)]
        self.lengths = self._array(3, "<u4").astype(np.int64)
        self._planes: dict[int, Plane] = {}

    def _open(self, frame: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self._frames[frame])

    def _array(self, frame: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._open(frame), kind)

    def plane(self, level: int) -> Plane:
        if level not in self._planes:
            self._planes[level] = Plane(self._open(4 + level), self.n)
        return self._planes[level]

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        place = 0
        for level, zeros in enumerate(self.zeros):
            p = self.plane(level)
            bit = p.bit(i)
            place = place << 1 | bit
            i = zeros * bit + p.rank(bit, i)
        return int(self.alphabet[place])

    def _path(self, token: int) -> list[int] | None:
        place = int(np.searchsorted(self.alphabet, token))
        if place == len(self.alphabet) or self.alphabet[place] != token:
            return None
        return [place >> s & 1 for s in reversed(range(len(self.zeros)))]

    def rank(self, token: int, end: int) -> int:
        """Occurrences of an id before place ``end``."""
        bits, start = self._path(token), 0
        for level, bit in enumerate(bits or ()):
            p = self.plane(level)
            start, end = (self.zeros[level] * bit + p.rank(bit, i) for i in (start, end))
        return end - start if bits is not None else 0

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th occurrence (from 0) of an id."""
        bits, start = self._path(token), 0
        if bits is None or not 0 <= k < self.count(token):
            raise IndexError(f"no occurrence {k} of {token}")
        for level, bit in enumerate(bits):
            start = self.zeros[level] * bit + self.plane(level).rank(bit, start)
        i = start + k
        for level in reversed(range(len(bits))):
            i = self.plane(level).select(bits[level], i - self.zeros[level] * bits[level])
        return i

    def decode(self) -> np.ndarray:
        """All ids in order: the planes' sorts undone from the last to the first."""
        kind = np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32
        v = np.zeros(self.n, kind)
        for level in reversed(range(len(self.zeros))):
            bit = np.unpackbits(np.frombuffer(self._open(4 + level), np.uint8), count=self.n).view(bool)
            zeros, out = self.zeros[level], np.empty_like(v)
            out[np.flatnonzero(~bit)] = v[:zeros]
            out[np.flatnonzero(bit)] = v[zeros:] | kind(1 << (len(self.zeros) - 1 - level))
            v = out
        return self.alphabet[v]


def pack(tokens: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """A shard's file."""
    alphabet, planes, zeros = build(tokens)
    parts = [alphabet.astype("<u4").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
             np.array([d is None for d in doc_ids], "u1").tobytes(), np.array(lengths, "<u4").tobytes(), *planes]
    frames = [zstandard.ZstdCompressor(level=1).compress(p) for p in parts]
    header = json.dumps({"tokens": len(tokens), "docs": len(doc_ids), "zeros": zeros, "frames": [len(f) for f in frames]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *frames])


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    """A folder on any store that pyarrow opens; ``file:/x`` as Hadoop writes it, too."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[6:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


_MANIFEST = "partition int, seq int, file string, n_docs long, n_tokens long"


def _write(folder: str, tokenizer: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        store, path = _folder(folder)
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        partition, seq = TaskContext.get().partitionId(), 0
        ids, data, held = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, data, held, seq
            # a name of its own for each attempt: only the files of attempts that end well get into the manifest
            name = f"shard-{partition:06d}-{seq:05d}-{uuid.uuid4().hex[:12]}.wvm"
            tokens = np.frombuffer(b"".join(data), enc.dtype)
            with store.open_output_stream(f"{path}/{name}") as f:
                f.write(pack(tokens, ids, [len(d) // enc.dtype.itemsize for d in data]))
            row = [partition, seq, name, len(ids), len(tokens)]
            ids, data, held, seq = [], [], 0, seq + 1
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds)],
                                   names=["partition", "seq", "file", "n_docs", "n_tokens"])

        for batch in batches:
            for part in text_slices(batch, "text") if batch.num_rows else ():
                for doc, tokens in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text").to_pylist())):
                    ids.append(doc)
                    data.append(tokens + end)
                    held += len(data[-1]) // enc.dtype.itemsize
                    if held >= shard_tokens:
                        yield close()
        if ids:
            yield close()
    return run


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode every text of ``docs(doc_id, text)`` and write it to shards; returns their manifest.

    ``(partition, seq, file, n_docs, n_tokens, start)``: files in the order of (partition, seq) hold the documents in
    ascending order of doc_id (nulls first, equal ids by text); ``start`` counts the ids in all files before.
    A null text is an empty one: its ``end_id`` alone. Plan: one range shuffle by doc_id; counts by file are
    added up in two steps (partitions, then files of a partition). Tasks write directly to the
    folder, which all executors must reach; files of failed or repeated
    attempts are in no manifest.
    """
    store, path = _folder(folder)
    store.create_dir(path, recursive=True)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    files = materialize(map_partitions(ordered, _write(folder, tokenizer, end_id, shard_tokens), _MANIFEST), "manifest")
    sums = files.groupBy("partition").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("partition", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("partition").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (files.join(sums, "partition")
            .withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("base"))


def _read(folder: str, with_ids: bool):
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        store, path = _folder(folder)
        for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
            with store.open_input_stream(f"{path}/{file}") as f:
                shard = Shard(f.read())
            tokens, ends = shard.decode().astype("<u4"), np.cumsum(shard.lengths)
            begins = ends - shard.lengths
            raw = memoryview(tokens.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
            out = {"doc_id": pa.array(shard.doc_ids, pa.int64()), "start": pa.array(begins + start),
                   "n_tokens": pa.array(shard.lengths), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(tokens.astype(np.int32)))
            yield pa.record_batch(list(out.values()), names=list(out))
    return rows


def read_shards(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` of every document in the files of a manifest."""
    files = materialize(manifest.select("file", "start"), "files")
    spread = files.repartition(max(1, min(files.count(), 20_000)), "file")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return map_arrow(spread, _read(folder, with_ids), schema)

