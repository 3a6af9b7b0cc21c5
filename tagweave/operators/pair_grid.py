"""Pairs of tags summed on a grid: posts meet in cells, and no pair is shuffled.

The tags are dealt to ``g`` groups by hash. A cell of the grid is a pair of groups; it holds every pair of a tag
of the one with a tag of the other, so its sums are complete and nothing is added up behind it. What is shuffled are the posts'
distinct tags, each once, to the partition of its group; the task of a cell reads the partitions of its two groups (Spark's Cartesian product of the
partitions, whose rows meet by chunk). So the disk holds the tags twice (the table of the first step and its shuffle), whatever the number of cells, and
each tag is read ``2 g`` times.

Two steps run on Arrow batches with numpy. The first cuts a batch of posts into one row for each group: the group's words and, for each tag of a
post, the place of its word, its post and its multiplicity in as few bytes as hold them. The second gets one cell and makes and sums its pairs left tag by left tag, a
bounded number of pairs at once; its memory is that of its tags (about ``CELL_TAGS``, which is what the number of groups follows from).
"""

from __future__ import annotations

import math
import sys
import zlib
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Tags of posts in one cell (both groups), about; pairs that are made at once; sums that are held as a dense block; rows of an Arrow batch of edges.
CELL_TAGS = 1 << 24
PAIRS_AT_ONCE = 1 << 21
DENSE_SUMS = 1 << 22
ROWS_AT_ONCE = 1 << 17
MAX_GROUPS = 400
#: Bytes of an Arrow batch of posts.
BATCH_BYTES = "4m"

_CHUNK = "grp int, chunk long, words array<string>, n long, code binary, post binary, mult binary, copies binary"

# the functions travel by value: Python workers need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _packed(a: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max()))).tobytes()


def _unpacked(buffer: bytes, n: int) -> np.ndarray:
    return np.frombuffer(buffer, dtype=f"u{len(buffer) // n}")


def _group_rows(batch: pa.RecordBatch, groups: int, chunk: int):
    """A batch of ``(tags, copies)`` as one row for each group that has a tag in it."""
    lists = batch.column(0)
    flat = lists.flatten()
    post = np.repeat(np.arange(len(lists), dtype=np.int64), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    if flat.null_count:
        post, flat = post[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
    if not len(flat):
        return
    coded = flat.dictionary_encode()
    words, size = coded.dictionary, len(coded.dictionary)
    # a post's distinct tags with their multiplicities, by post
    held, mult = np.unique(post * size + coded.indices.to_numpy(), return_counts=True)
    post, code = held // size, held % size
    copies = batch.column(1).to_numpy()[post]
    of_word = np.fromiter((zlib.crc32(w) % groups for w in words.cast(pa.binary()).to_pylist()), dtype=np.int64, count=size)
    by_group = np.argsort(of_word, kind="stable")
    ends = np.cumsum(np.bincount(of_word, minlength=groups))
    place = np.empty(size, dtype=np.int64)
    place[by_group] = np.arange(size) - np.repeat(ends - np.bincount(of_word, minlength=groups), np.bincount(of_word, minlength=groups))
    rows = np.argsort(of_word[code], kind="stable")
    cuts = np.searchsorted(of_word[code][rows], np.arange(groups + 1))
    out = [[] for _ in range(8)]
    for g in range(groups):
        at = rows[cuts[g]:cuts[g + 1]]
        if not len(at):
            continue
        mine = words.take(pa.array(by_group[(ends[g - 1] if g else 0):ends[g]]))
        values = (g, chunk, mine.to_pylist(), len(at), _packed(place[code[at]]), _packed(np.diff(post[at], prepend=0)), _packed(mult[at]), _packed(copies[at]))
        for column, value in zip(out, values):
            column.append(value)
    types = (pa.int32(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    names = ["grp", "chunk", "words", "n", "code", "post", "mult", "copies"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)


class _Side:
    """The tags of one group of a cell, by post: ``tag`` (place in ``words``), ``post``, ``mult``, ``copies``."""

    def __init__(self, rows: list[tuple]):
        rows.sort(key=lambda r: r[0])  # by chunk
        coded = pa.concat_arrays([r[1] for r in rows]).dictionary_encode()
        self.words, places = coded.dictionary, coded.indices.to_numpy()
        starts = np.cumsum([0] + [len(r[1]) for r in rows])
        self.tag = np.concatenate([places[starts[i] + _unpacked(r[3], r[2]).astype(np.int64)] for i, r in enumerate(rows)])
        # a post's number: those of a chunk follow each other, and both sides of a cell know the same chunks
        self.post = np.concatenate([(np.int64(r[0]) << 22) + np.cumsum(_unpacked(r[4], r[2]), dtype=np.int64) for r in rows])
        self.mult = np.concatenate([_unpacked(r[5], r[2]) for r in rows])
        self.copies = np.concatenate([_unpacked(r[6], r[2]) for r in rows])


def _runs(sizes: np.ndarray, most: int):
    """Ranges of consecutive items whose sizes add up to at most ``most`` (a larger item comes alone)."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield at, to
        at = to


def _summed(key: np.ndarray, weight: np.ndarray):
    """Distinct keys and the sums of their weights."""
    if not len(key):
        return key, weight
    bits = int(weight.max()).bit_length()
    if int(key.max()).bit_length() + bits <= 63:  # key and weight are sorted as one number
        both = np.sort((key << bits) | weight)
        key, weight = both >> bits, both & ((1 << bits) - 1)
    else:
        order = np.argsort(key)
        key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(weight, first)


def _cell_sums(left: _Side, right: _Side):
    """``(left tag, right tag, weight)`` of a cell, every pair of tags once; ``left is right`` on the diagonal."""
    start = np.searchsorted(right.post, left.post, side="left")
    count = np.searchsorted(right.post, left.post, side="right") - start
    width = len(right.words)
    pairs = np.bincount(left.tag, weights=count, minlength=len(left.words))
    # a tag with many pairs is summed in a dense row, others by sorting
    dense = pairs * 4 >= width
    turn = np.empty(len(dense), dtype=np.int64)
    turn[np.argsort(~dense, kind="stable")] = np.arange(len(dense))
    order = np.argsort(turn[left.tag], kind="stable")
    order = order[count[order] > 0]
    tags, firsts = np.unique(turn[left.tag[order]], return_index=True)
    back = np.argsort(turn)
    bounds = np.append(firsts, len(order))
    n_dense = int(np.searchsorted(tags, dense.sum()))

    def made(a: int, b: int, base: int):
        """Pairs of the left tags at ``order[a:b]``: key ``(turn - base) * width + right tag``, weight."""
        at = order[a:b]
        n = count[at]
        own = np.repeat(np.arange(len(at)), n)
        other = np.arange(len(own)) + np.repeat(start[at] - (np.cumsum(n) - n), n)
        l_tag, r_tag = left.tag[at][own], right.tag[other]
        m = left.mult[at].astype(np.int64)[own]
        weight = m * right.mult[other]
        if left is right:
            weight = np.where(l_tag == r_tag, m * (m - 1) // 2, weight)
        weight *= left.copies[at].astype(np.int64)[own]
        key = (turn[left.tag[at]][own] - base) * width + r_tag
        if left is right:
            once = l_tag <= r_tag
            key, weight = key[once], weight[once]
        return key, weight

    def decoded(key, weight, base):
        some = weight > 0
        key = key[some]
        return back[key // width + base], key % width, weight[some]

    for a, b in _runs(np.ones(n_dense, dtype=np.int64), max(1, DENSE_SUMS // width)):
        base = tags[a]
        sums = np.zeros((tags[b - 1] - base + 1) * width, dtype=np.int64)
        for c, d in _runs(count[order[bounds[a]:bounds[b]]], PAIRS_AT_ONCE):
            np.add.at(sums, *made(bounds[a] + c, bounds[a] + d, base))
        key = np.flatnonzero(sums)
        yield decoded(key, sums[key], base)
    if n_dense < len(tags):
        rest = np.add.reduceat(count[order], firsts)[n_dense:]
        for a, b in _runs(rest, PAIRS_AT_ONCE):
            base = tags[n_dense + a]
            yield decoded(*_summed(*made(bounds[n_dense + a], bounds[n_dense + b], base)), base)


def _cell_edges(left: _Side, right: _Side):
    """The edges of a cell as Arrow batches ``(src, dst, weight)``, ``src <= dst`` by the bytes of UTF-8."""
    same = left is right
    words = left.words if same else pa.concat_arrays([left.words, right.words])
    shift = 0 if same else len(left.words)
    rank = np.empty(len(words), dtype=np.int64)
    rank[pc.sort_indices(words.cast(pa.binary())).to_numpy()] = np.arange(len(words))
    for a, b, weight in _cell_sums(left, right):
        b = b + shift
        swap = rank[a] > rank[b]
        src, dst = np.where(swap, b, a), np.where(swap, a, b)
        for i in range(0, len(src), ROWS_AT_ONCE):
            cut = slice(i, i + ROWS_AT_ONCE)
            yield pa.RecordBatch.from_arrays([words.take(pa.array(src[cut])), words.take(pa.array(dst[cut])), pa.array(weight[cut])],
                                             names=["src", "dst", "weight"])


def _to_groups(groups: int):
    def run(batches):
        part, numbers = TaskContext.get().partitionId(), count()
        for batch in batches:
            for i in range(0, batch.num_rows, 1 << 21):  # a post's number within its chunk has 22 bits
                yield from _group_rows(batch.slice(i, 1 << 21), groups, (part << 20) + next(numbers))
    return run


def _sum_cells(batches):
    """Cells of rows ``_CHUNK`` beside those of the other group (``r_``) with the same chunk."""
    cells: dict[tuple[int, int], tuple[list, list]] = {}
    for batch in batches:
        cols = {name: batch.column(name) for name in batch.schema.names}

        def row(side: str, i: int) -> tuple:
            chunk, words, n, *codes = (cols[side + c][i] for c in ("chunk", "words", "n", "code", "post", "mult", "copies"))
            return chunk.as_py(), words.values, n.as_py(), *(c.as_py() for c in codes)

        for i in range(batch.num_rows):
            lo, hi = cols["grp"][i].as_py(), cols["r_grp"][i].as_py()
            sides = cells.setdefault((lo, hi), ([], []))
            sides[0].append(row("", i))
            if lo != hi:
                sides[1].append(row("r_", i))
    for cell in sorted(cells):
        lo, hi = cells.pop(cell)
        left = _Side(lo)
        yield from _cell_edges(left, _Side(hi) if hi else left)
        pa.default_memory_pool().release_unused()


def groups_for(n_tags: int, cores: int) -> int:
    """Groups so that a cell holds about ``CELL_TAGS`` tags at most, and that there are three cells a core."""
    spread = math.ceil((math.sqrt(1 + 24 * max(1, cores)) - 1) / 2)
    return min(MAX_GROUPS, max(2, spread, math.ceil(2 * n_tags / CELL_TAGS)))


def grid_edges(posts: DataFrame, groups: int) -> DataFrame:
    """``(src, dst, weight)`` of posts ``(tags array<string>, copies long)``, by a grid of ``groups`` groups."""
    posts.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    # written once: both sides of a cell must know the same chunks, however often a job recomputes its input
    written = materialize(posts.select("tags", "copies").mapInArrow(_to_groups(groups), _CHUNK), "tag-groups")
    chunks = written.repartitionById(groups, F.col("grp"))
    other = chunks.select(*[F.col(c).alias(f"r_{c}") for c in chunks.columns])
    # every partition beside every other one, read where the one shuffle has put them; a row meets the one of its own chunk only
    cells = chunks.join(other.hint("shuffle_replicate_nl"), (F.col("chunk") == F.col("r_chunk")) & (F.col("grp") <= F.col("r_grp")))
    return cells.mapInArrow(_sum_cells, "src string, dst string, weight long")
