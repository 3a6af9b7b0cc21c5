"""Near-duplicate documents by DartMinHash over weighted word shingles.

Elements are a text's five-word shingles, weighted by how often they occur.
Element ``x`` of weight ``w`` owns the region [0, w) of a line; darts hit each unit of
that region at the times of a Poisson process that is seeded by (x, unit), so that
two texts see the same darts wherever their regions overlap. Every dart carries
a random coordinate; the earliest dart of each of the ``COORDINATES`` coordinates is the signature, and
two signatures agree in a coordinate with the probability of the weighted Jaccard
similarity (Christiani, 2020). Only darts earlier than a threshold that
falls with the text's weight are thrown, so that signing a text costs one hash
a shingle plus about ``k ln k`` darts, whatever its length.

Groups: identical word sequences collapse first (map-side combine); signatures of the
representatives are cut into bands; inside a bucket all members are compared to one
hub, not to each other. Members of buckets that no link has joined yet are paired by a prefix
filter on their rarest shingles. Pairs are verified on the exact shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_arrow, materialize, text_slices
from .components import connected_components
from .words import Shingles, Windows, mix

SHINGLE = 5
THRESHOLD = 0.8
#: 32 bands of 6 coordinates: a pair at 0.8 is missed with probability (1 - 0.8^6)^32 = 6e-5, at 0.9 with 1e-10.
BANDS, ROWS = 32, 6
COORDINATES = BANDS * ROWS
#: Shingles of more open texts than that are matched by size class too; a class spans 2 % of the size.
FEW_TEXTS, SIZE_CLASS = 64, 0.02
#: Pairs to compare for each joined row beyond which buckets get other hubs first: four times what texts of rare shingles need at most.
MOST_LISTED = 4 * FEW_TEXTS

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def _times(n: int, step: np.uint64) -> np.uint64:
    return np.uint64(n * int(step) % (1 << 64))


def strips(shingles: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit-weight strips: the n-th occurrence of a shingle in a text is strip (shingle, n). Sorted by text and shingle."""
    order = np.lexsort((shingles, owner))
    h, o = shingles[order], owner[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])] if len(h) else np.zeros(0, bool)
    i = np.arange(len(h))
    nth = (i - np.maximum.accumulate(np.where(new, i, 0))).astype(np.uint64)
    return mix(h + nth * _SALT), o


def signatures(seeds: np.ndarray, owner: np.ndarray, n_texts: int, k: int = COORDINATES) -> np.ndarray:
    """(n_texts, k) earliest dart of each coordinate; rows of texts without strips stay 0."""
    weight = np.bincount(owner, minlength=n_texts)
    out = np.zeros((n_texts, k), np.uint64)
    limit = (k * np.log(k) + 2 * k) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        pick = todo[owner]
        alive, text, time, n = seeds[pick], owner[pick], None, 0
        best, found = np.full(n_texts * k, np.inf), np.zeros(n_texts * k, np.uint64)
        hits = []
        while len(alive):
            n += 1
            u = ((mix(alive + _times(n, _STEP)) >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53
            early = u > np.exp(-limit)[text] if time is None else time - np.log(u) < limit[text]
            alive, text, u = alive[early], text[early], u[early]
            time = -np.log(u) if time is None else time[early] - np.log(u)
            dart = mix(alive ^ _times(n, _SALT))
            cell = text * k + (dart % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, cell, time)
            hits.append((cell, time, dart))
        for cell, time, dart in hits:
            first = time == best[cell]
            found[cell[first]] = dart[first]
        full = np.isfinite(best).reshape(n_texts, k).all(axis=1) & todo
        out[full] = found.reshape(n_texts, k)[full]
        todo &= ~full
        limit = limit * 2
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(n_texts, bands) hash of each band, the band's number included."""
    n, k = signature.shape
    parts = signature.reshape(n, k // rows, rows)
    h = np.broadcast_to(np.arange(1, k // rows + 1, dtype=np.uint64) * _STEP, parts.shape[:2])
    for j in range(rows):
        h = mix(h ^ parts[:, :, j]) * _SALT
    return mix(h)


def _sign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batch, "text"):
        texts = part.column("text").to_pylist()
        s = Shingles(texts, SHINGLE)
        owner = np.repeat(np.arange(len(texts)), np.diff(s.offsets))
        seeds, owner = strips(s.hashes, owner)
        keys = band_keys(signatures(seeds, owner, len(texts)))
        begin, end = s.word_offsets[:-1], s.word_offsets[1:]
        first = s.windows.spans(begin, end).view(np.int64)
        second = Windows(s.words, second=True).spans(begin, end).view(np.int64)
        wordless = begin == end
        raw = part.column("raw_hash").to_numpy(zero_copy_only=False)
        offsets = np.r_[0, np.cumsum(np.where(wordless, 0, keys.shape[1]))].astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[~wordless].reshape(-1).view(np.int64)))
        yield pa.record_batch([part.column("doc_id"), pa.array(np.where(wordless, raw, first)),
                               pa.array(np.where(wordless, 0, second)), bands],
                              names=["doc_id", "copy_1", "copy_2", "bands"])


def _strip_sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batch, "text"):
        s = Shingles(part.column("text").to_pylist(), SHINGLE)
        sets = [np.unique(strips(h, np.zeros(len(h), np.int64))[0]).tobytes()
                for h in (s.hashes[a:b] for a, b in zip(s.offsets[:-1], s.offsets[1:]))]
        yield pa.record_batch([part.column("doc_id"), pa.array([len(x) // 8 for x in sets], pa.int32()),
                               pa.array(sets, pa.binary())], names=["node", "size", "strips"])


def _single_strips(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(batch.num_rows):
        x = np.frombuffer(batch.column("strips")[i].as_buffer(), np.int64)
        yield pa.record_batch([pa.array(x), pa.array(np.full(len(x), batch.column("node")[i].as_py()))],
                              names=["strip", "node"])


def _verify(threshold: float):
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column("strips_a"), batch.column("strips_b"))):
            both = np.sort(np.concatenate([np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y)]))
            shared = int((both[1:] == both[:-1]).sum())
            keep[i] = shared >= threshold * (len(both) - shared)
        yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))
    return rows


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, copy_id, class_id, kept)`` for each row of ``docs(doc_id, text)``.

    Two texts are linked if the weighted Jaccard similarity of their word
    shingles is ``threshold`` or more; ``class_id`` is the smallest doc_id that links
    reach, ``copy_id`` the smallest with the same word sequence, and ``kept`` marks
    class_id itself. Texts without any word are copies only of equal texts;
    null and empty texts are linked with nothing. doc_id names the document: rows that
    repeat one count as one document, and rows with a null one are returned
    unlinked (class null, kept). Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = docs.where(F.col("doc_id").isNotNull())
    # null and empty texts get a class of their own each
    raw = F.when(F.length("text") > 0, F.xxhash64("text")).otherwise(F.xxhash64(F.lit("empty"), "doc_id"))
    signed = materialize(map_arrow(named.withColumn("raw_hash", raw), _sign,
                                   "doc_id long, copy_1 long, copy_2 long, bands array<long>"), "signed")
    copy = ["copy_1", "copy_2"]
    copies = materialize(signed.groupBy(*copy).agg(F.min("doc_id").alias("copy_id")), "copies")
    banded = (signed.join(copies, copy).where("doc_id = copy_id")
              .select(F.explode("bands").alias("band"), F.col("doc_id").alias("node")))
    shared = materialize(banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("x"), F.max("node").alias("y"))
                         .where("x < y").select("band", "n"), "shared-bands")
    members = materialize(banded.join(shared, "band"), "buckets")
    # the hub of a bucket is its member that shares the most bands with others: the source of edited copies, if it is there
    popular = materialize(members.groupBy("node").agg(F.sum("n").alias("popularity")), "popularity")
    hubs = materialize(members.join(popular, "node").groupBy("band").agg(
        F.min(F.struct(-F.col("popularity"), "node")).alias("h")).select("band", F.col("h.node").alias("hub")), "hubs")
    buckets = materialize(members.select("band", "node").join(hubs, "band"), "buckets")
    discard(shared, members, popular, hubs)
    involved = buckets.select("node").distinct()
    sets = materialize(map_arrow(named.join(involved, named["doc_id"] == involved["node"], "left_semi"),
                                 _strip_sets, "node long, size int, strips binary").dropDuplicates(["node"]), "strip-sets")

    links = _links(buckets.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")), sets, threshold)
    by_hubs = connected_components(links)
    discard(links)
    links = _later_links(buckets, by_hubs, sets, threshold)
    joined = connected_components(links.unionByName(
        by_hubs.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    classes = materialize(copies.join(joined.withColumnRenamed("node", "copy_id"), "copy_id", "left")
                          .select(*copy, "copy_id", F.coalesce("component", "copy_id").alias("class_id")), "classes")
    discard(copies, buckets, sets, links, by_hubs, joined)
    out = signed.select("doc_id", *copy).join(classes, copy).select(
        "doc_id", "copy_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
    unnamed = docs.where(F.col("doc_id").isNull()).select(
        "doc_id", F.lit(None).cast("long").alias("copy_id"), F.lit(None).cast("long").alias("class_id"),
        F.lit(True).alias("kept"))
    return out.unionByName(unnamed)


def _links(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` whose weighted Jaccard similarity reaches the threshold, written out."""
    pairs = materialize(pairs.distinct(), "pairs")
    side = [sets.select(*[F.col(c).alias(n if c == "node" else f"{c}_{n}") for c in sets.columns]) for n in "ab"]
    fits = F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b")
    both = pairs.join(side[0], "a").join(side[1], "b").where(fits).select("a", "b", "strips_a", "strips_b")
    links = materialize(map_arrow(both, _verify(threshold), "a long, b long"), "links")
    discard(pairs)
    return links


def _later_links(buckets: DataFrame, joined: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between components that share a bucket and that the popular hubs have left apart.

    Where a prefix join would list many pairs for each row, most of them lead from one large component to another, and one link would do:
    such buckets get other hubs first, for as long as a round takes a quarter of the pairs off the list.
    """
    later, owned, n_round, before = None, [], 0, math.inf
    while True:
        members, nodes = _open_members(buckets, joined)
        index, probe, used = _prefixes(nodes, sets, threshold)
        listed, rows = _listed(index, probe)
        if listed <= MOST_LISTED * rows or listed > 0.75 * before:
            break
        n_round, before = n_round + 1, listed
        hubs = members.groupBy("band").agg(F.min(F.struct(F.xxhash64("node", F.lit(n_round)), "node", "component")).alias("h"))
        pairs = members.join(hubs, "band").where("component <> h.component").select(F.col("h.node").alias("a"), F.col("node").alias("b"))
        links = _links(pairs, sets, threshold)
        discard(members, nodes, *used)
        later = links if later is None else later.unionByName(links)
        joined = connected_components(links.unionByName(joined.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        owned += [links, joined]
    links = _links(_prefix_pairs(index, probe, threshold), sets, threshold)
    discard(members, nodes, *used)
    if later is None:
        return links
    out = materialize(links.unionByName(later), "links")
    discard(links, *owned)
    return out


def _open_members(buckets: DataFrame, joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(band, node, component)`` of the buckets that still hold several components, and their distinct nodes, written out."""
    members = materialize(buckets.select("band", "node").join(joined, "node", "left")
                          .withColumn("component", F.coalesce("component", "node")), "members")
    mixed = materialize(members.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                        .where("x < y").select("band"), "open-bands")
    still_open = materialize(members.join(mixed, "band"), "open-members")
    nodes = materialize(still_open.select("node", "component").distinct(), "open-nodes")
    discard(members, mixed)
    return still_open, nodes


def _prefixes(nodes: DataFrame, sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """What the prefix join matches by ``(strip, class)``: indexed rows, probing rows, and the tables that they are read from.

    Prefix filtering on shingles in order of rarity:

    Two sets that share ``o`` elements also share one among the ``size - o + 1`` that come first in any common order, and
    their first common element leaves room for ``o - 1`` more behind it in both. Shingles that no other open text
    has come first and match nothing, shingles of a large group's source come last: an edited copy that went too far from
    its source has no room left, and the members of the group are not listed with every straggler.

    How much must be shared depends on both sizes. A shingle of many texts (a template's) therefore matches by size class too: a
    text is indexed in its own class, at the places that leave room for a partner no smaller than that, and probes each class
    from ``threshold`` times its size up to its own, at the places that leave room for a partner of that class.
    """
    known = sets.join(nodes, "node")
    single = materialize(map_arrow(known.select("node", "strips"), _single_strips, "strip long, node long"), "strips")
    shared = materialize(single.groupBy("strip").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-strips")
    common = single.join(shared, "strip")
    attributes = materialize(
        known.select("node", "component", "size")
        .join(common.groupBy("node").agg(F.count(F.lit(1)).alias("common")), "node")
        .withColumn("prefix", F.col("size") - F.ceil(threshold * F.col("size") - 1e-9) + 1 - (F.col("size") - F.col("common")))
        .where("prefix > 0"), "open-texts")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("n", "strip"))
    width = math.log1p(SIZE_CLASS)
    # the largest partner, by class, that the room is enough for; 1e-9 of a class is slack for rounding
    fits = F.floor(F.log(F.col("room") * (1 + threshold) / threshold - F.col("size")) / width + 1e-9)
    rows = materialize(
        common.join(attributes, "node").withColumn("place", rank).where("place <= prefix")
        .withColumn("room", F.col("common") - F.col("place") + 1)
        .withColumn("own", F.when(F.col("n") <= FEW_TEXTS, -1).otherwise(F.floor(F.log("size") / width + 1e-9)).cast("int"))
        .withColumn("last", F.least("own", fits).cast("int"))
        .select("strip", "node", "component", "size", "room", "own", "last"), "prefixes")
    index = rows.where("own = last").withColumn("class", F.col("own")).drop("last")
    first = F.when(F.col("own") < 0, -1).otherwise(F.floor(F.log(threshold * F.col("size")) / width - 1e-9)).cast("int")
    probe = rows.withColumn("class", F.explode(F.sequence(first, F.greatest(first, "last")))).drop("last")
    return index, probe, [single, shared, attributes, rows]


def _listed(index: DataFrame, probe: DataFrame) -> tuple[int, int]:
    """Pairs that the prefix join compares, and the rows that it joins."""
    key = ["strip", "class"]
    n, m = (df.groupBy(*key).agg(F.count(F.lit(1)).alias(c)) for df, c in ((index, "n"), (probe, "m")))
    found = n.join(m, key, "full").agg(F.sum(F.col("n") * F.col("m")).alias("pairs"),
                                       F.sum(F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("rows")).first()
    return found.pairs or 0, found.rows or 0


def _prefix_pairs(index: DataFrame, probe: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components that may reach the threshold."""
    y = index.select("strip", "class", *[F.col(c).alias(f"y_{c}") for c in ("node", "component", "size", "room", "own")])
    fits = F.least("room", "y_room") >= threshold / (1 + threshold) * (F.col("size") + F.col("y_size")) - 1e-9
    once = (F.col("own") > F.col("y_own")) | (F.col("node") < F.col("y_node"))
    pairs = probe.join(y, ["strip", "class"]).where((F.col("component") != F.col("y_component")) & once & fits)
    return pairs.select(F.least("node", "y_node").alias("a"), F.greatest("node", "y_node").alias("b"))
