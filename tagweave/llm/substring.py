"""Substring dedup by compaction of a minimizer-sampled token De Bruijn graph.

The job: remove every word covered by a window of ``WINDOW`` words whose exact
word sequence also starts in a document with a smaller id. Grouping all windows
of a corpus would shuffle many times the corpus, so the graph is sampled:

1. *Nodes and edges* (map). Each window selects the ``K``-word token k-mer with the
   smallest hash; two documents that share a window share its selected k-mer.
   The text between two selected neighbours, both included, is an edge.
2. *Branching* (one aggregate with map-side combine). A k-mer is repeated if it
   is selected in two documents; it does not branch to the right (left) if
   all its occurrences continue with the same next (previous) edge.
3. *Compaction* (join on the k-mer, then on the document). Along a document, nonbranching
   neighbours chain into one path. All occurrences of a k-mer share the
   path around it, so a window on that path occurs exactly where the k-mer
   does, and the k-mer's smallest document decides it.
4. *Coordinates*. Windows that reach over a branching point, where paths end,
   are few; they are grouped by 128 bits of their own content, and their
   (document, position) coordinates are joined back.

No step collects a group of occurrences: k-mers and windows are reduced by
min/max, and only one document's own coordinates are ever brought together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, map_arrow, materialize, text_slices
from .words import Windows, hash_words, mix

WINDOW = 50
K = 8

_ANCHORS = "k_hash long, doc_id long, text_hash long, pos int, prev_edge long, next_edge long"
_DECIDED = ("doc_id long, text_hash long, n_words long, n_removed long, kept binary, text string, mask binary, "
            "h1 array<long>, h2 array<long>, start array<int>")
_RESULT = "doc_id long, n_words long, n_removed long, kept binary"


def smallest_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value of each run of ``width`` values."""
    place, size = np.arange(len(values), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        right = values[step:] < values[:-step]
        values = np.where(right, values[step:], values[:-step])
        place = np.where(right, place[step:], place[:-step])
        size += step
    return place


class Selected:
    """Word hashes of some texts, their windows and the k-mer that each window selects."""

    def __init__(self, texts: list[bytes], window: int, k: int):
        self.words, self.offsets = hash_words(texts)
        self.hashes = Windows(self.words)
        self.k_hash = self.hashes.all(k)
        n = max(0, len(self.words) - window + 1)
        self.place = smallest_in_window(self.k_hash, window - k + 1) if n else np.zeros(0, np.int32)
        self.valid = np.zeros(n, bool)
        for a, b in zip(self.offsets[:-1], self.offsets[1:]):
            self.valid[a:max(a, b - window + 1)] = True


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _anchors(window: int, k: int):
    """Step 1: the selected k-mers of each text with the edges on both sides."""
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batch, "text"):
            s = Selected(_texts(part), window, k)
            at = np.unique(s.place[s.valid]).astype(np.int64)
            if not len(at):
                continue
            doc = np.searchsorted(s.offsets, at, "right") - 1
            first = np.r_[True, doc[1:] != doc[:-1]]
            last = np.r_[first[1:], True]
            begin = np.where(first, s.offsets[doc], np.r_[0, at[:-1]])
            end = np.where(last, s.offsets[doc + 1], np.r_[at[1:] + k, 0])
            # a text's start and end are part of its first and last edge
            prev_edge = mix(s.hashes.spans(begin, at + k) + first.astype(np.uint64))
            next_edge = mix(s.hashes.spans(at, end) + last.astype(np.uint64))
            ids = pa.array(doc)
            yield pa.record_batch([
                _long(s.k_hash[at]), part.column("doc_id").take(ids), part.column("text_hash").take(ids),
                pa.array((at - s.offsets[doc]).astype(np.int32)), _long(prev_edge), _long(next_edge)],
                names=["k_hash", "doc_id", "text_hash", "pos", "prev_edge", "next_edge"])
    return rows


def _reach(pos: np.ndarray, same_prev: np.ndarray, same_next: np.ndarray, n_words: int, k: int):
    """First and past-the-last word of the nonbranching path around each repeated k-mer of one text."""
    i = np.arange(len(pos))
    stop = np.minimum.accumulate(np.where(same_next, len(pos), i)[::-1])[::-1]
    begin = np.maximum.accumulate(np.where(same_prev, -1, i))
    return np.r_[pos, 0][begin], np.r_[pos + k, n_words][stop]


def _covered(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    d = np.zeros(n_words + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + window, -1)
    return np.cumsum(d[:-1]) > 0


def _kept(text: bytes, gone: np.ndarray | None) -> bytes:
    words = text.split()
    if gone is not None:
        words = [w for w, g in zip(words, gone.tolist()) if not g]
    return b" ".join(words)


def _decide(window: int, k: int):
    """Step 3: decide windows on nonbranching paths, emit the coordinates of the others."""
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batch, "text"):
            texts = _texts(part)
            s, second, out = Selected(texts, window, k), None, []
            ids, hashes = part.column("doc_id").to_pylist(), part.column("text_hash").to_pylist()
            known = part.column("anchors")
            for i, text in enumerate(texts):
                a, b = int(s.offsets[i]), int(s.offsets[i + 1])
                row = {"doc_id": ids[i], "text_hash": hashes[i], "n_words": b - a, "n_removed": 0}
                out.append(row)
                if not known[i].is_valid:
                    row["kept"] = _kept(text, None)
                    continue
                x = known[i].values
                pos, order = np.unique(x.field("pos").to_numpy(), return_index=True)
                least, same_prev, same_next = (
                    x.field(f).to_numpy(zero_copy_only=False)[order] for f in ("least_doc", "same_prev", "same_next"))
                begin, end = _reach(pos, same_prev, same_next, b - a, k)
                start = np.arange(b - a - window + 1)
                place = s.place[a:a + len(start)] - a
                j = np.minimum(np.searchsorted(pos, place), len(pos) - 1)
                repeated = pos[j] == place
                on_path = repeated & (start >= begin[j]) & (start + window <= end[j])
                gone = on_path & (least[j] < ids[i]) if ids[i] is not None else np.zeros(len(start), bool)
                mask = _covered(np.flatnonzero(gone), b - a, window)
                open_ = np.flatnonzero(repeated & ~on_path)
                if len(open_):
                    second = second or Windows(s.words, second=True)
                    row |= {"text": text.decode(), "mask": np.packbits(mask).tobytes(), "start": open_,
                            "h1": s.hashes.spans(a + open_, a + open_ + window).view(np.int64),
                            "h2": second.spans(a + open_, a + open_ + window).view(np.int64)}
                else:
                    row |= {"n_removed": int(mask.sum()), "kept": _kept(text, mask)}
            kinds = {"doc_id": pa.int64(), "text_hash": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(),
                     "kept": pa.binary(), "text": pa.string(), "mask": pa.binary(), "h1": pa.list_(pa.int64()),
                     "h2": pa.list_(pa.int64()), "start": pa.list_(pa.int32())}
            yield pa.record_batch([pa.array([r.get(c) for r in out], t) for c, t in kinds.items()], names=list(kinds))
    return rows


def _finish(window: int):
    """Step 4's end: add the windows found by their coordinates to the mask."""
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batch, "text"):
            n_words, removed, kept = part.column("n_words").to_pylist(), [], []
            for i, text in enumerate(_texts(part)):
                n = n_words[i]
                mask = np.unpackbits(np.frombuffer(part.column("mask")[i].as_py(), np.uint8), count=n).astype(bool)
                if part.column("starts")[i].is_valid:
                    mask |= _covered(part.column("starts")[i].values.to_numpy(), n, window)
                removed.append(int(mask.sum()))
                kept.append(_kept(text, mask))
            yield pa.record_batch([part.column("doc_id"), pa.array(n_words), pa.array(removed), pa.array(kept, pa.binary())],
                                  names=["doc_id", "n_words", "n_removed", "kept"])
    return rows


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` for each row of ``docs(doc_id, text)``.

    ``kept`` is the UTF-8 text of the words that stay, joined by one space (binary). Words are runs
    without ASCII white space, unchanged. Null text: no words. A text of
    fewer than ``window`` words keeps them all. Rows with the same doc_id
    never remove each other's words; a row with a null doc_id neither removes
    nor loses any. Other columns are ignored; no rows in, no rows out.
    """
    key = ("doc_id", "text_hash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    anchors = materialize(map_arrow(docs, _anchors(window, k), _ANCHORS), "kmers")
    repeated = materialize(
        anchors.groupBy("k_hash").agg(
            F.min("doc_id").alias("least_doc"), F.max("doc_id").alias("last_doc"),
            (F.min("prev_edge") == F.max("prev_edge")).alias("same_prev"),
            (F.min("next_edge") == F.max("next_edge")).alias("same_next"))
        .where("least_doc < last_doc").drop("last_doc"), "repeated-kmers")
    paths = (anchors.select("k_hash", *key, "pos").join(repeated, "k_hash").groupBy(*key)
             .agg(F.collect_list(F.struct("pos", "least_doc", "same_prev", "same_next")).alias("anchors")))
    decided = materialize(map_arrow(_on_document(docs, paths), _decide(window, k), _DECIDED), "decided")
    discard(anchors, repeated)
    pending = decided.where(F.col("start").isNotNull())
    windows = (pending.select(*key, F.explode(F.arrays_zip("h1", "h2", "start")).alias("w"))
               .select(*key, "w.h1", "w.h2", "w.start"))
    shared = materialize(
        windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least_doc"), F.max("doc_id").alias("last_doc"))
        .where("least_doc < last_doc").drop("last_doc"), "shared-windows")
    starts = (windows.join(shared, ["h1", "h2"]).where("least_doc < doc_id").groupBy(*key)
              .agg(F.collect_list("start").alias("starts")))
    finished = map_arrow(_on_document(pending.select(*key, "n_words", "text", "mask"), starts), _finish(window), _RESULT)
    done = decided.where(F.col("start").isNull()).select("doc_id", "n_words", "n_removed", "kept")
    return done.unionByName(finished)


def _on_document(docs: DataFrame, info: DataFrame) -> DataFrame:
    """Left join on (doc_id, text_hash), null ids included."""
    right = info.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    on = (docs["text_hash"] == right["_hash"]) & docs["doc_id"].eqNullSafe(right["_doc"])
    return docs.join(right, on, "left").drop("_doc", "_hash")


def digest(rows: DataFrame) -> DataFrame:
    """The result with the kept text's sha256 in its place."""
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: DuckDB twin of ``digest(remove_repeats(documents))``.
SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) AS h
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM w)),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, s + o AS p FROM (
           SELECT win.doc_id, win.s, unnest(range(0, 50)) AS o FROM win JOIN least USING (h) WHERE m < win.doc_id)),
word AS (SELECT doc_id, unnest(words) AS x, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
