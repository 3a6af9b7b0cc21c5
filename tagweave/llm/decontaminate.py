"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents may be a thousand times longer, and a signature
of fixed length would see nothing of an item in a long document. So
documents are partitioned by size class (their number of distinct shingles, in
powers of two), and each class has its own number of one-permutation MinHash
bins, twice its upper size bound: a shingle of a document is the
smallest of its bin with a probability of at least 0.78, whatever the size. An item
is signed once for each class with the class's bins. One common bin makes a
candidate; its containment is then computed on the exact shingles.

An item of fewer than ``LEAST_SHARED`` shingles that must be shared is too small for a
reliable signature and is probed with all its shingles (bins without limit).

Items go to the tasks in blocks of bounded size, one pass over the documents for
each block; documents never shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, materialize, text_slices
from .words import Shingles

SHINGLE = 5
THRESHOLD = 0.8
#: An item that needs at least so many common shingles is missed with probability 0.22^8 = 5e-6 at most.
LEAST_SHARED = 8
#: Characters of items in a block: what a task holds of the benchmark at once is about 40 times that, at most.
BLOCK_CHARS = 1 << 22
#: Size classes: 2^0 to 2^CLASSES distinct shingles.
CLASSES = 40


def _bins(size: int) -> int:
    """log2 of the number of bins for a document of ``size`` distinct shingles: twice its class's upper bound."""
    return max(1, math.ceil(math.log2(max(size, 1)))) + 1


def signature(sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    """Smallest hash of each of 2^bits bins. A hash's top bits are its bin, so it is the first of its bin in order."""
    bins = sorted_hashes >> np.uint64(64 - bits)
    return sorted_hashes[np.r_[True, bins[1:] != bins[:-1]]] if len(bins) else sorted_hashes


class ItemBlock:
    """Signatures by size class and shingles of a block of items."""

    def __init__(self, items: list[tuple[int, str]], threshold: float, k: int = SHINGLE):
        self.k, self.threshold = k, threshold
        self.ids = [i for i, _ in items]
        s = Shingles([t for _, t in items], k)
        words = np.diff(s.word_offsets)
        self.sets = [np.unique(s.hashes[a:b]) for a, b in zip(s.offsets[:-1], s.offsets[1:])]
        self.need = [max(1, math.ceil(threshold * len(x) - 1e-9)) for x in self.sets]
        #: items shorter than a shingle are one short shingle, looked up among the documents' shingles of that length
        self.lengths = sorted({k, *(int(n) for n in words if 0 < n < k)})
        self.length = [k if n >= k else int(n) for n in words]
        self.tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def table(self, length: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes that the signatures of this class may share with an item, sorted, and the items' places."""
        if (length, bits) not in self.tables:
            hashes, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, x in enumerate(self.sets):
                if self.length[i] == length and len(x) and (self.need[i] >= LEAST_SHARED) == (bits > 0):
                    hashes.append(signature(x, bits) if bits else x)
                    owner.append(np.full(len(hashes[-1]), i))
            h, o = np.concatenate(hashes), np.concatenate(owner)
            order = np.argsort(h, kind="stable")
            self.tables[length, bits] = h[order], o[order]
        return self.tables[length, bits]

    def matches(self, shingles: dict[int, np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(place of the item, its shingles, shared shingles) for the items that a document contains."""
        found: set[int] = set()
        for length, h in shingles.items():
            classes = (0, _bins(len(h))) if length == self.k else (0,)
            for bits in classes:
                hashes, owner = self.table(length, bits)
                if len(hashes):
                    probe = signature(h, bits) if bits else h
                    first = np.searchsorted(hashes, probe)
                    hit = probe[hashes[np.minimum(first, len(hashes) - 1)] == probe]
                    for a, b in zip(np.searchsorted(hashes, hit), np.searchsorted(hashes, hit, "right")):
                        found.update(owner[a:b].tolist())
        for i in sorted(found):
            x, h = self.sets[i], shingles[self.length[i]]
            at = np.minimum(np.searchsorted(h, x), len(h) - 1)
            shared = int((h[at] == x).sum())
            if shared >= self.need[i]:
                yield i, len(x), shared


def _found(block: ItemBlock, part: pa.RecordBatch) -> Iterator[list[tuple[int, int, int]]]:
    """The matches of each text of a batch."""
    by_length = [(n, Shingles(part.column("text").to_pylist(), n)) for n in block.lengths]
    for d in range(part.num_rows):
        sets = {n: np.unique(s.hashes[s.offsets[d]:s.offsets[d + 1]]) for n, s in by_length}
        yield list(block.matches({n: h for n, h in sets.items() if len(h)}))


def _search(block: ItemBlock):
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batch, "text"):
            out = [(doc, block.ids[i], n, shared)
                   for doc, found in zip(part.column("doc_id").to_pylist(), _found(block, part)) for i, n, shared in found]
            if out:
                kinds = {"doc_id": pa.int64(), "item_id": pa.int64(), "n_shingles": pa.int64(), "n_shared": pa.int64()}
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds.values())], names=list(kinds))
    return rows


def item_blocks(items: DataFrame, most_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``most_chars`` characters (an item that is longer comes alone)."""
    block, chars = [], 0
    rows = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    for r in rows.toLocalIterator():
        if block and chars + len(r.text) > most_chars:
            yield block
            block, chars = [], 0
        block.append((r.item_id, r.text))
        chars += len(r.text)
    if block:
        yield block


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_shared, containment)``: items of which a document holds ``threshold`` or more.

    Containment is the share of the item's distinct five-word shingles that the
    document has anywhere. An item of 1 to 4 words is one shingle of all its words, found as those
    words in a row. Null or wordless items and texts match nothing; null ids: such items are
    left out, such documents give rows with a null doc_id; repeated rows
    give repeated pairs. Other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, n_shingles long, n_shared long"
    found = None
    for block in item_blocks(items.select(F.col("item_id").cast("long").alias("item_id"), "text")):
        part = map_arrow(docs, _search(ItemBlock(block, threshold)), schema)
        if found is not None:  # a pass for each block: keep what it found, not its plan
            found = materialize(found, "contained")
        found = part if found is None else found.unionByName(part)
    found = spark.createDataFrame([], schema) if found is None else found
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def _clean(block: ItemBlock):
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batch, "text"):
            yield part.filter(pa.array([not found for found in _found(block, part)], pa.bool_()))
    return rows


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark item.

    Map only: one filter for each block of items, no shuffle.
    """
    for block in item_blocks(items.select(F.col("item_id").cast("long").alias("item_id"), "text")):
        docs = map_arrow(docs, _clean(ItemBlock(block, threshold)), docs.schema)
    return docs
