"""Hashes of words and of word windows, computed for many texts at once in numpy.

A word's hash is a polynomial in its bytes, read off one prefix sum over the
whole buffer; a window's hash is a polynomial in its word hashes, read off a
second prefix sum. Both are finished by a 64-bit mixer, depend on the content
alone (never on the place in the buffer), and cost a few nanoseconds a byte
for any window length.

Folding brings texts beyond ASCII to one form first, so that the byte tables can take every byte beyond ASCII for a letter.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

#: Bytes hashed at once; longer buffers are cut between two words.
CHUNK = 1 << 18

_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE_BASE_2 = np.uint64(0xE7037ED1A0B428DB)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_WORD_BASE_2 = np.uint64(0xA0761D6478BD642F)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


class _Powers:
    """Powers 0..n-1 of an odd base modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.values = base, np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            v = np.full(max(n, 1 << 16), self.base, np.uint64)
            v[0] = 1
            self.values = np.cumprod(v, dtype=np.uint64)
        return self.values[:n]


_POWERS: dict[int, _Powers] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    return _POWERS.setdefault(int(base), _Powers(base))(n)


def _byte_values(fold: bool) -> np.ndarray:
    v = mix(np.arange(1, 257, dtype=np.uint64) * _BYTE_BASE) | np.uint64(1)
    if fold:
        v[65:91] = v[97:123]
    return v


#: ASCII white space: the separators of ``[^\x20\x09-\x0D]+``.
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Everything but ASCII letters, digits and the bytes of other characters.
_NOT_ALNUM = np.ones(256, bool)
_NOT_ALNUM[48:58] = _NOT_ALNUM[65:91] = _NOT_ALNUM[97:123] = _NOT_ALNUM[128:] = False
_VALUES_2 = mix(np.arange(1, 257, dtype=np.uint64) * _BYTE_BASE_2) | np.uint64(1)
_VALUES = {False: _byte_values(False), True: _byte_values(True)}


def _hash_chunk(data: np.ndarray, separator: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a buffer."""
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~separator[data]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[fold][data] * powers(_BYTE_BASE, len(data)), out=total[1:])
    h = (total[ends] - total[starts]) * powers(_inverse(_BYTE_BASE), len(data) + 1)[starts]
    return starts, mix(h ^ (ends - starts).astype(np.uint64) * _WORD_BASE)


def word_hashes(data: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and two independent hashes of each word of a buffer."""
    edge = np.flatnonzero(np.diff(np.concatenate([[True], separator[data], [True]])))
    starts, ends = edge[::2], edge[1::2]
    hashes = []
    for base, values in ((_BYTE_BASE, _VALUES[False]), (_BYTE_BASE_2, _VALUES_2)):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers(base, len(data)), out=total[1:])
        h = (total[ends] - total[starts]) * powers(_inverse(base), len(data) + 1)[starts]
        hashes.append(mix(h ^ (ends - starts).astype(np.uint64) * _WORD_BASE))
    return starts, ends, *hashes


def hash_words(texts: list[bytes], plain: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, one after the other, and the texts' offsets into them.

    ``plain``: words are runs without ASCII white space, unchanged. Otherwise
    they are runs of letters and digits (ASCII; any other character counts as
    a letter, which ``folded`` makes true), with ASCII case folded.
    """
    separator = _SPACE if plain else _NOT_ALNUM
    data = np.frombuffer(b" ".join(texts), np.uint8)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data):  # cut before a separator
            cuts = np.flatnonzero(separator[data[end:end + 4096]])
            if len(cuts):
                end += int(cuts[0])
                break
            end = min(end + 4096, len(data))
        s, h = _hash_chunk(data[at:end], separator, not plain)
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds)


class Windows:
    """Hashes of word windows of any length over concatenated word hashes."""

    def __init__(self, words: np.ndarray, second: bool = False):
        base = _WORD_BASE_2 if second else _WORD_BASE
        if second:
            words = mix(words ^ _WORD_BASE_2)
        self.inverse = powers(_inverse(base), len(words) + 1)
        self.total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers(base, len(words)), out=self.total[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of words [start, end) for each pair."""
        h = (self.total[ends] - self.total[starts]) * self.inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _BYTE_BASE)

    def all(self, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each place on (places across texts included)."""
        n = len(self.total) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.total[k:] - self.total[:n]) * self.inverse[:n] + np.uint64(k * int(_BYTE_BASE) % (1 << 64)))


#: Letters of scripts written without blanks, as code points (fixed values): Thai and Lao, Myanmar, Khmer, kana, Han.
NO_BLANKS = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF),
             (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_KEEP, _BLANK, _DROP, _ALONE = range(4)


@functools.cache
def _kinds() -> np.ndarray:
    """What folding does with each code point: letters, marks and numbers stay, invisible format characters go, others are blanks."""
    def kind(c: str) -> int:
        category = unicodedata.category(c)
        return _DROP if category == "Cf" and c != "\u200b" else _KEEP if category[0] in "LMN" else _BLANK

    kinds = np.fromiter((kind(chr(c)) for c in range(0x110000)), np.uint8, 0x110000)
    kinds[:128] = _KEEP  # the byte tables split at these
    for first, last in NO_BLANKS:
        part = kinds[first:last + 1]
        part[part == _KEEP] = _ALONE
    return kinds


def _fold_wide(text: str) -> str:
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    kinds = _kinds()[points]
    if not kinds.any():
        return text
    points = np.where(kinds == _BLANK, 32, points).astype("<u4")[kinds != _DROP]
    kinds = kinds[kinds != _DROP]
    out = np.full(len(points) + 2 * int((kinds == _ALONE).sum()), 32, "<u4")
    width = np.where(kinds == _ALONE, 3, 1)
    out[np.cumsum(width) - width + (width == 3)] = points
    return out.tobytes().decode("utf-32-le")


def folded(texts: list[str | None]) -> list[bytes]:
    """Lower-cased UTF-8 of each text, null as empty; beyond ASCII in compatibility form (NFKC), with a blank for whatever is no
    letter, mark or number, without format characters, and with blanks round each letter of a script that is written without them."""
    return [(t.lower() if t.isascii() else _fold_wide(t)).encode("utf-8", "replace") if t else b"" for t in texts]


class Shingles:
    """Hashes of the ``k``-word shingles of each text, in order, with repeats.

    Words are runs of letters and digits, case folded (see ``folded``; a letter of a script without blanks is a word). A text of 1 to k-1 words has one
    shingle, all its words; a text without words has none.
    """

    def __init__(self, texts: list[str | None], k: int):
        self.words, self.word_offsets = hash_words(folded(texts), plain=False)
        self.windows = Windows(self.words)
        n = np.diff(self.word_offsets)
        count = np.where(n >= k, n - k + 1, n > 0)
        self.offsets = np.r_[0, np.cumsum(count)]
        start = np.repeat(self.word_offsets[:-1] - self.offsets[:-1], count) + np.arange(self.offsets[-1])
        self.hashes = self.windows.spans(start, start + np.repeat(np.minimum(n, k), count))
