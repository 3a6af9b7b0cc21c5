"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every other character counts as a blank, and n-grams of 1 to 3 characters with a letter
in them are hashed into ``BUCKETS``. Training counts n-grams by language over all rows that may be learnt
from: each task adds up a (languages x buckets) table and Spark sums the tables. The matrix of log
probabilities, at most ``MOST_LANGUAGES`` x ``BUCKETS``, goes to the tasks, where a batch of texts is scored as a sparse matrix
times that matrix: gathered rows, summed by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_arrow, map_partitions, text_slices

BITS = 15
BUCKETS = 1 << BITS
SMOOTHING = 0.5
#: More values of lang than that are no languages; it bounds the model at 260 MB.
MOST_LANGUAGES = 1000
#: Languages whose counts a task holds before it passes them on.
HELD_LANGUAGES = 64
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@cache
def _letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else a blank."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            table[c] = c
    return table


def ngrams(texts: list[str | None]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For n = 1, 2, 3: bucket of each n-gram with a letter, and its text; and the number of letters of each text."""
    # two blanks between texts keep n-grams from reaching over
    data = [("  " + (t or "").lower()).encode("utf-32-le", "replace") for t in texts]
    ends = np.cumsum([len(d) // 4 for d in data])
    c = _letters()[np.frombuffer(b"".join([*data, "  ".encode("utf-32-le")]), np.uint32)]
    text = np.repeat(np.arange(len(texts)), np.diff(np.r_[0, ends]))
    n_chars = len(text)
    letter = c != 32
    h, any_letter, out = np.zeros(n_chars, np.uint32), np.zeros(n_chars, bool), []
    for n in range(3):
        h = (h ^ c[n:n + n_chars]) * _FACTORS[n]
        h ^= h >> np.uint32(15)
        any_letter = any_letter | letter[n:n + n_chars]
        keep = np.flatnonzero(any_letter)
        out.append(((h[keep] >> np.uint32(32 - BITS)).astype(np.int64), text[keep]))
    return out, np.bincount(text[letter[:n_chars]], minlength=len(texts))


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_p: np.ndarray  # buckets x languages

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Most likely language and its posterior probability for each text."""
        n, n_languages = len(texts), len(self.languages)
        total = np.tile(self.log_prior, (n, 1))
        step = max(1, (1 << 21) // max(1, n_languages))  # rows gathered at once
        found, letters = ngrams(texts)
        for bucket, text in found if n_languages else ():
            for i in range(0, len(bucket), step):
                b, t = bucket[i:i + step], text[i:i + step]
                first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
                total[t[first]] += np.add.reduceat(self.log_p[b], first, axis=0)
        if not n_languages:
            return [UNKNOWN] * n, np.zeros(n)
        best = total.argmax(axis=1)
        posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        known = letters > 0
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, posterior, 0.0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for language, counts in held.items():
            places = np.flatnonzero(counts)
            yield pa.record_batch([pa.array([language] * len(places)), pa.array(places.astype(np.int32)), pa.array(counts[places])],
                                  names=["lang", "bucket", "n"])
        held.clear()

    for batch in batches:
        for part in text_slices(batch, "text") if batch.num_rows else ():
            languages = part.column("lang").to_pylist()
            names, code = np.unique(languages, return_inverse=True)
            table = np.zeros((len(names), BUCKETS + 1), np.int64)
            np.add.at(table[:, BUCKETS], code, 1)  # the last place counts texts
            for bucket, text in ngrams(part.column("text").to_pylist())[0]:
                table[:, :BUCKETS] += np.bincount(code[text] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
            for name, counts in zip(names.tolist(), table):
                held[name] = held[name] + counts if name in held else counts.copy()
            if len(held) > HELD_LANGUAGES:
                yield from out()
    yield from out()


def train(docs: DataFrame, learn: Column | None = None) -> Model:
    """Count the n-grams of all rows of ``docs(doc_id, text, lang)`` with a text and a language for which ``learn`` holds."""
    if learn is not None:
        docs = docs.where(learn)
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = map_partitions(rows, _count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counts.limit(MOST_LANGUAGES * (BUCKETS + 1) + 1).toArrow()
    languages = sorted(got.column("lang").unique().to_pylist())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of lang")
    table = np.zeros((BUCKETS + 1, len(languages)))
    if languages:
        place = {v: i for i, v in enumerate(languages)}
        column = np.array([place[v] for v in got.column("lang").to_pylist()])
        table[got.column("bucket").to_numpy(), column] = got.column("n").to_numpy()
    texts, table = table[BUCKETS], table[:BUCKETS] + SMOOTHING
    return Model(languages, np.log(texts / texts.sum()) if languages else texts, np.log(table / table.sum(axis=0)))


def _predict(model: Model):
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batch, "text"):
            languages, score = model.score(part.column("text").to_pylist())
            yield pa.record_batch([part.column("doc_id"), part.column("held_out"), pa.array(languages, pa.string()), pa.array(score)],
                                  names=["doc_id", "held_out", "lang_pred", "score"])
    return rows


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for each row of ``docs(doc_id, text)``.

    ``score`` is the posterior probability of the predicted language. A null text or one without a letter is ``und``
    with score 0, and so is every text if no row could be learnt from. Repeated rows and null ids
    are scored like others; other columns are ignored. Ties go to the language that sorts first.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_arrow(docs, _predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
