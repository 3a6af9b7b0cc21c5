"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are cut into two halves, each with its own codebook; a vector's two codes are its cell in the product
grid. A query visits cells in the order of their distance (the sum of its distances to both codewords: the multi-sequence
order of Babenko and Lempitsky) and stops after as many as the target recall needs: the most that is needed by neighbours
planted at exactly the threshold around sampled vectors, in all directions and along the data's own, and by the true links
of sampled vectors, found by comparing them with all vectors. What it finds is verified by its cosine in double precision.

Work is dealt out in units of one first code: the index vectors with that code and the queries that visit some of its
cells, each in blocks of bounded size, so a query's vector travels once for all cells of a row of the grid.
A unit returns one row for each vector with a link (links found, smallest linked vector of its part), never pairs.
A link counts at both ends: a query that meets a vector which does not visit the query's own cell counts for that vector, too.
Whether it does is told by its reach, the distance of the last cell that it visits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import discard, map_arrow, materialize
from .components import connected_components

THRESHOLD = 0.95
TARGET_RECALL = 0.995
#: Vectors on which the codebooks and the number of visited cells are fitted.
SAMPLE = 20_000
MOST_CODES = 1024
#: Vectors around which neighbours are planted, and those that are compared with all vectors.
PLANTED, COMPARED = 1000, 512
#: Vectors of a unit's two sides.
BLOCK_INDEX, BLOCK_QUERIES = 16_384, 2048


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def _codebook(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Lloyd's algorithm from ``k`` distinct sampled points."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centers = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        code = _distances(x, centers).argmin(axis=1)
        for j in range(len(centers)):
            if (mine := code == j).any():
                centers[j] = x[mine].mean(axis=0)
    return centers


def cell_order(d1: np.ndarray, d2: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Multi-sequence traversal: cells (i, j) by rising ``d1[i] + d2[j]``, ``most`` of them and those as far as the last."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}
    last = np.inf
    for n in range(len(o1) * len(o2)):
        distance, a, b = heapq.heappop(heap)
        if distance > last:
            return
        if n == most - 1:
            last = distance
        yield int(o1[a]), int(o2[b])
        for x, y in ((a + 1, b), (a, b + 1)):
            if x < len(o1) and y < len(o2) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (d1[o1[x]] + d2[o2[y]], x, y))


def nearest_cells(d1: np.ndarray, d2: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``cell_order`` for many queries at once: (row, i, j) of all visited cells by row, and each row's reach.

    The traversal can only meet a cell after all that precede it in both orders: the cell at places (a, b) is among the first ``most``
    only if (a + 1) * (b + 1) of them fit. Those places are ranked together; a row with ties beyond them is walked cell by cell.
    """
    most = min(most, d1.shape[1] * d2.shape[1])
    o1, o2 = np.argsort(d1, axis=1, kind="stable"), np.argsort(d2, axis=1, kind="stable")
    s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
    width = np.minimum(most // np.arange(1, min(d1.shape[1], most) + 1), d2.shape[1])
    a = np.repeat(np.arange(len(width)), width)
    b = np.arange(len(a)) - np.repeat(np.cumsum(width) - width, width)
    sums = s1[:, a] + s2[:, b]
    reach = np.partition(sums, most - 1, axis=1)[:, most - 1]
    beside = np.flatnonzero(width < d2.shape[1])
    tied = (s1[:, beside] + s2[:, width[beside]] <= reach[:, None]).any(axis=1)
    if len(width) < d1.shape[1]:
        tied |= s1[:, len(width)] + s2[:, 0] <= reach
    row, at = np.nonzero((sums <= reach[:, None]) & ~tied[:, None])
    i, j = o1[row, a[at]], o2[row, b[at]]
    for r in np.flatnonzero(tied):
        cells = np.array(list(cell_order(d1[r], d2[r], most)))
        row, i, j = np.r_[row, np.full(len(cells), r)], np.r_[i, cells[:, 0]], np.r_[j, cells[:, 1]]
    order = np.lexsort((j, i, row))
    return row[order], i[order], j[order], reach


@dataclass
class Grid:
    first: np.ndarray
    second: np.ndarray
    visited: int = 1

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return x[:, :half], x[:, half:]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.split(x)
        return _distances(a, self.first), _distances(b, self.second)

    def row_distances(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distances of one vector: the same bits whichever rows are beside it."""
        d1, d2 = self.distances(v[None].copy())
        return d1[0], d2[0]


def fit(sample: np.ndarray, n_vectors: int, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> Grid:
    """Codebooks for ``n_vectors`` unit vectors, and the cells a query has to visit."""
    k = int(min(MOST_CODES, max(4, np.ceil(np.sqrt(n_vectors) / 4)), len(sample)))
    half = sample.shape[1] // 2
    grid = Grid(_codebook(sample[:, :half], k), _codebook(sample[:, half:], k, seed=8))
    rng = np.random.default_rng(9)
    x = sample[rng.choice(len(sample), min(PLANTED, len(sample)), replace=False)]
    d1, d2 = grid.distances(x)
    for away in _directions(x, sample, rng):
        away -= (away * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(away, axis=1, keepdims=True)
        planted = threshold * x + np.sqrt(1 - threshold**2) * away / np.maximum(size, 1e-12)
        p1, p2 = (d.argmin(axis=1) for d in grid.distances(planted))
        ranks = [rank(d1[i], d2[i], p1[i], p2[i]) for i in np.flatnonzero(size[:, 0] > 1e-9)]
        if ranks:
            grid.visited = max(grid.visited, int(np.quantile(ranks, recall, method="higher")))
    return grid


def _directions(x: np.ndarray, sample: np.ndarray, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Where neighbours of ``x`` may lie: anywhere; as the sample spreads; towards sampled vectors; towards the nearest ones."""
    yield rng.standard_normal(x.shape)
    yield rng.standard_normal((len(x), len(sample))) @ (sample - sample.mean(axis=0))
    yield sample[rng.integers(len(sample), size=len(x))] - sample[rng.integers(len(sample), size=len(x))]
    cosine = x @ sample.T
    cosine[cosine > 1 - 1e-9] = -2  # itself
    nearest = np.argpartition(-cosine, min(9, len(sample) - 1), axis=1)[:, :10]
    yield sample[nearest[np.arange(len(x)), rng.integers(nearest.shape[1], size=len(x))]] - x


def rank(d1: np.ndarray, d2: np.ndarray, i: int, j: int) -> int:
    """The number of cells that a query at distances ``d1`` and ``d2`` visits up to the cell (i, j)."""
    return int((d1[:, None] + d2[None] <= d1[i] + d2[j]).sum())


def _true_ranks(grid: Grid, queries: np.ndarray, query_nodes: np.ndarray, kind: str, dimension: int, threshold: float):
    """For each rank at which a query meets vectors that it is linked with: their number, and their share of the query's links."""
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        d1, d2 = grid.distances(queries)
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            x, node = _unit(part, kind, dimension), part.column("node").to_numpy()
            q, y = np.nonzero((queries @ x.T >= threshold) & (query_nodes[:, None] != node[None]))
            if not len(q):
                continue
            p1, p2 = (d.argmin(axis=1) for d in grid.distances(x[y]))
            cells, pairs = np.unique(np.c_[q, p1, p2], axis=0, return_counts=True)
            yield pa.record_batch([pa.array(cells[:, 0], pa.int64()), pa.array([rank(d1[i], d2[i], a, b) for i, a, b in cells], pa.int64()),
                                   pa.array(pairs, pa.int64())], names=["query", "rank", "pairs"])
    return rows


def fit_true(grid: Grid, nodes: DataFrame, sample: np.ndarray, sample_nodes: np.ndarray, kind: str, dimension: int,
             threshold: float, recall: float) -> None:
    """Raise the visited cells to what the links of sampled vectors with all of ``nodes`` need, as pairs and as an average of the vectors."""
    found = map_arrow(nodes.select("node", "vector"), _true_ranks(grid, sample[:COMPARED], sample_nodes[:COMPARED], kind, dimension, threshold),
                      "query long, rank long, pairs long")
    found = found.groupBy("query", "rank").agg(F.sum("pairs").alias("pairs"))
    found = found.withColumn("share", F.col("pairs") / F.sum("pairs").over(Window.partitionBy("query")))
    ranks = found.groupBy("rank").agg(F.sum("pairs").alias("pairs"), F.sum("share").alias("share")).orderBy("rank").toArrow()
    for weight in ("pairs", "share"):
        total = np.cumsum(ranks.column(weight).to_numpy())
        if len(total):
            at = min(np.searchsorted(total, recall * total[-1]), len(total) - 1)
            grid.visited = max(grid.visited, int(ranks.column("rank")[int(at)].as_py()))


def _unit(batch: pa.RecordBatch, kind: str, dimension: int) -> np.ndarray:
    raw = b"".join(batch.column("vector").to_pylist())
    x = np.frombuffer(raw, kind).reshape(-1, dimension).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large and very small entries stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _clean(kind: str):
    """Each vector as bytes, null if it can have no link. Of one dimension only the sign is kept: it is the vector's direction."""
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            column = part.column("embedding")
            values = pc.list_flatten(column)
            usable = ~pc.is_null(values).to_numpy(zero_copy_only=False)
            x = pc.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(kind)
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(size)), size)
            bad = np.bincount(row, ~(usable & np.isfinite(x)), len(size)) > 0
            zero = np.bincount(row, x != 0, len(size)) == 0
            x = np.where(size[row] == 1, np.sign(x), x).astype(kind)
            raw, end = x.tobytes(), np.cumsum(size) * x.itemsize
            vectors = [None if no else raw[a:b] for no, a, b in zip((bad | zero).tolist(), [0, *end.tolist()], end.tolist())]
            yield pa.record_batch([part.column("vec_id"), pa.array(vectors, pa.binary())], names=["vec_id", "vector"])
    return rows


def _route(grid: Grid, kind: str, dimension: int):
    """A row ``x`` for the index and rows ``q`` for the visits, one for each first code."""
    # rows whose candidates are ranked together: a query has about visited * log(visited) of them
    step = int(np.clip((1 << 20) // (grid.visited * (1 + np.log(grid.visited))), 1, 512))

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            d1, d2 = (np.stack(d) for d in zip(*(grid.row_distances(v) for v in _unit(part, kind, dimension))))
            own1, own2 = d1.argmin(axis=1), d2.argmin(axis=1)
            row, i, j, reach = nearest_cells(d1, d2, grid.visited)
            first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (i[1:] != i[:-1])])
            n = part.num_rows
            source = np.r_[np.arange(n), row[first]]
            code = np.r_[own1, i[first]]
            offsets = np.r_[np.arange(n), n + first, n + len(j)]
            cells = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.r_[own2, j], pa.int32()))
            take = pa.array(source, pa.int64())
            yield pa.record_batch([part.column("node").take(take), part.column("copies").take(take), part.column("vector").take(take),
                                   pa.array(code, pa.int32()), pa.array(np.arange(len(source)) >= n), cells,
                                   pa.array(own1[source], pa.int32()), pa.array(own2[source], pa.int32()), pa.array(reach[source])],
                                  names=["node", "copies", "vector", "code", "query", "cells", "own1", "own2", "reach"])
    return rows


def _by_cell(cell: np.ndarray, row: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(cell, kind="stable")
    cells, first = np.unique(cell[order], return_index=True)
    return dict(zip(cells.tolist(), np.split(row[order], first[1:])))


def _search(grid: Grid, kind: str, dimension: int, threshold: float):
    def unit(rows: pa.Table) -> pa.Table:
        part = rows.combine_chunks().to_batches()[0]
        query = part.column("query").to_numpy(zero_copy_only=False)
        node, copies = part.column("node").to_numpy(), part.column("copies").to_numpy()
        own1, own2, reach = (part.column(c).to_numpy() for c in ("own1", "own2", "reach"))
        vectors, cells = _unit(part, kind, dimension), part.column("cells")
        cell, row = cells.flatten().to_numpy(), np.repeat(np.arange(len(node)), pc.list_value_length(cells).to_numpy())
        in_cell, visits = (_by_cell(cell[side], row[side]) for side in (~query[row], query[row]))
        links: dict[int, int] = {}
        least: dict[int, int] = {}
        extra: list[tuple[int, int]] = []
        for j, x in in_cell.items():
            for start in range(0, len(visits.get(j, ())), 512):
                q = visits[j][start:start + 512]
                linked = (vectors[q] @ vectors[x].T >= threshold) & (node[q][:, None] != node[x][None])
                qs, ys = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
                if not len(qs):
                    continue
                linked = linked[np.ix_(qs, ys)]
                q, y = q[qs], x[ys]
                for i, n in zip(node[q].tolist(), (linked * copies[y]).sum(axis=1).tolist()):
                    links[i] = links.get(i, 0) + n
                for column, i in enumerate(y):  # links that the vector's own visits do not meet
                    mine = q[linked[:, column]]
                    d1, d2 = grid.row_distances(vectors[i])
                    n = int(copies[mine[d1[own1[mine]] + d2[own2[mine]] > reach[i]]].sum())
                    if n:
                        links[int(node[i])] = links.get(int(node[i]), 0) + n
                # smallest node of each connected part of this block
                a, b = node[q], node[y]
                while True:
                    new_b = np.minimum(b, np.where(linked, a[:, None], np.iinfo(np.int64).max).min(axis=0))
                    new_a = np.minimum(a, np.where(linked, new_b[None], np.iinfo(np.int64).max).min(axis=1))
                    if (new_a == a).all() and (new_b == b).all():
                        break
                    a, b = new_a, new_b
                for i, m in zip([*node[q].tolist(), *node[y].tolist()], [*a.tolist(), *b.tolist()]):
                    if m < i:
                        least.setdefault(i, m)
                        if least[i] != m:  # parts of two blocks meet in this vector
                            extra.append((i, m))
        out = [(i, links.get(i, 0), least.get(i)) for i in {*links, *least}] + [(i, 0, m) for i, m in extra]
        return pa.table({"node": pa.array([o[0] for o in out], pa.int64()), "links": pa.array([o[1] for o in out], pa.int64()),
                         "least": pa.array([o[2] for o in out], pa.int64())})
    return unit


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vectors(vec_id, embedding)``.

    Two vectors are linked if their cosine is ``threshold`` or more. Vectors that are null, empty, zero, of another dimension than
    most, or hold a null or non-finite component are linked with nothing. Equal vectors
    are one node with copies: they link with each other and have the same links. A row with a null vec_id is linked with nothing and
    has no component (kept); rows that repeat a vec_id count as vectors of their own. Other columns are ignored.
    Sizes do not matter: finite entries of any magnitude have a direction, and vectors of one dimension are linked if their signs are equal.
    """
    spark = vectors.sparkSession
    kind = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "<f8"
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    clean = materialize(map_arrow(vectors, _clean(kind), "vec_id long, vector binary"), "vectors")
    most = clean.where(F.col("vector").isNotNull()).groupBy(F.length("vector").alias("size")).count()
    most = most.orderBy(F.desc("count"), "size").first()
    size = most["size"] if most else 0
    usable = F.col("vector").isNotNull() & (F.length("vector") == size) & F.col("vec_id").isNotNull()
    keyed = clean.withColumn("key", F.when(usable, F.sha2("vector", 256)))
    copies = materialize(keyed.where(usable).groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")), "copies")
    nodes = copies.select("node", "copies", "vector")
    n = nodes.count()
    dimension = size // np.dtype(kind).itemsize
    if n > 1 and dimension > 1:
        sample = nodes.orderBy(F.xxhash64("vector"), "node").limit(SAMPLE).select("node", "vector").toArrow().combine_chunks().to_batches()[0]
        units = _unit(sample, kind, dimension)
        grid = fit(units, n, threshold, recall)
        fit_true(grid, nodes, units, sample.column("node").to_numpy(), kind, dimension, threshold, recall)
        found = _found(nodes, grid, kind, dimension, threshold)
    else:
        found = spark.createDataFrame([], "node long, links long, least long")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected_components(found.where(F.col("least").isNotNull()).select(F.col("node").alias("a"), F.col("least").alias("b")))
    classes = materialize(
        copies.select("key", "node", "copies").join(links, "node", "left").join(joined, "node", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("component_id")), "classes")
    discard(copies, joined, *([found] if hasattr(found, "_scratch") else []))
    out = keyed.select("vec_id", "key").join(classes, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _found(nodes: DataFrame, grid: Grid, kind: str, dimension: int, threshold: float) -> DataFrame:
    """``(node, links, least)`` rows of all units."""
    routes = materialize(map_arrow(nodes, _route(grid, kind, dimension),
                                   "node long, copies long, vector binary, code int, query boolean, cells array<int>, "
                                   "own1 int, own2 int, reach double"), "routes")
    sizes = {(r.code, r.query): r["count"] for r in routes.groupBy("code", "query").count().collect()}  # two for each code
    blocks = [[-(-max(1, sizes.get((i, q), 0)) // most) for i in range(len(grid.first))]
              for q, most in ((False, BLOCK_INDEX), (True, BLOCK_QUERIES))]
    n_index, n_queries = (F.element_at(F.array(*[F.lit(n) for n in b]), F.col("code") + 1) for b in blocks)
    place = F.xxhash64("node")
    own = F.when(F.col("query"), F.pmod(place, n_queries)).otherwise(F.pmod(place, n_index)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("query"), n_index).otherwise(n_queries) - 1))
    dealt = routes.withColumn("own", own).withColumn("other", other).select(
        "node", "copies", "vector", "query", "cells", "code", "own1", "own2", "reach",
        F.when(F.col("query"), F.col("other")).otherwise(F.col("own")).alias("index_block"),
        F.when(F.col("query"), F.col("own")).otherwise(F.col("other")).alias("query_block"))
    found = dealt.groupBy("code", "index_block", "query_block").applyInArrow(
        _search(grid, kind, dimension, threshold), "node long, links long, least long")
    found = materialize(found, "found")
    discard(routes)
    return found
