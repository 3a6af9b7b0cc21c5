"""Whole-text encoding with a byte-level BPE tokenizer file, at the speed of a word table.

A byte-level BPE splits a text into pieces before it merges, and no piece crosses the start
of a run of white space. So a text whose words are parted by single blanks and line ends is encoded word by
word, and a worker encodes each distinct word once: words are found by 128 bits of hash in an open-addressing table
of numpy arrays, thousands at a time, and their ids are gathered from one array. All other texts,
and files of other kinds of tokenizers, are encoded whole.
"""

from __future__ import annotations

import array
import os
import re

import numpy as np

from .words import mix, powers, word_hashes

#: log2 of the table's places; it is emptied when two thirds are taken (22 bytes a place, and the ids).
TABLE_BITS = 22
#: Words encoded in one call.
CALL_WORDS = 1000
#: Bytes of text handled at once.
CHUNK = 1 << 19

_OTHER_SPACE = [chr(c) for c in (0, 9, 11, 12, 13, 28, 29, 30, 31)]
_WIDE_SPACE = [chr(c) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: A word whose last letter is followed by ASCII punctuation alone; no piece holds a letter and punctuation, but for apostrophes.
_TAIL = re.compile(r"([^']*[A-Za-zÀ-ÖØ-öø-ɏ])([!-&(-/:-@\[-`{-~]+)")
#: A word of letters alone is one piece, whatever stands around it.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+")
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0, 10, 32]] = True
_AFTER_BLANK = np.uint64(0x8CB92BA72F3D8DD7)


def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes of Latin-1 stand for themselves, the others for code points from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in own else next(others)) for b in range(256)}


class WordTable:
    """128-bit keys to small numbers, looked up and inserted in bulk."""

    def __init__(self, bits: int):
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.first, self.second = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.value = np.zeros(1 << bits, np.int32)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The keys' values, -1 for keys that are not there."""
        out = np.full(len(first), -1, np.int32)
        todo, place = np.arange(len(first)), (first >> self.shift).astype(np.int64)
        while len(todo):
            held = self.first[place]
            hit = (held == first[todo]) & (self.second[place] == second[todo])
            out[todo[hit]] = self.value[place[hit]]
            on = np.flatnonzero((held != 0) & ~hit)
            todo, place = todo[on], (place[on] + 1) & self.mask
        return out

    def insert(self, first: np.ndarray, second: np.ndarray, value: np.ndarray) -> None:
        """Distinct keys that are not there yet."""
        todo, place = np.arange(len(first)), (first >> self.shift).astype(np.int64)
        while len(todo):
            free = np.flatnonzero(self.first[place] == 0)
            at, which = np.unique(place[free], return_index=True)  # one key for each free place
            won = free[which]
            self.first[at], self.second[at], self.value[at] = first[todo[won]], second[todo[won]], value[todo[won]]
            lost = np.ones(len(todo), bool)
            lost[won] = False
            todo, place = todo[lost], (place[lost] + 1) & self.mask


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.by_word = (self.tokenizer.normalizer is None and repr(self.tokenizer.pre_tokenizer)
                        == "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)")
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids if self.by_word else []
        self.by_word &= len(line_end) == 1
        if self.by_word:
            self.line_end = line_end[0]
            self.byte_characters = byte_characters()
            self.tails: dict[str, bytes] = {}
            self._clear()

    def _clear(self) -> None:
        self.table = WordTable(TABLE_BITS)
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.ids, self.n_words, self.n_ids = np.zeros(1 << 18, self.dtype), 0, 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _regular(text: str) -> bool:
        """Words are parted by single blanks or line ends alone, and there is no other white space."""
        return not (text[0] in " \n" or text[-1] in " \n" or any(p in text for p in ("  ", " \n", "\n ", "\n\n"))
                    or any(c in text for c in _OTHER_SPACE) or not text.isascii() and any(c in text for c in _WIDE_SPACE))

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words; a blank at a word's start belongs to it."""
        out: list[bytes | None] = [None] * len(words)
        model, rest = self.tokenizer.model, []
        for i, w in enumerate(words):
            head, tail = w, b""
            if cut := _TAIL.fullmatch(w):
                head, marks = cut[1], cut[2]
                if marks not in self.tails:
                    if len(self.tails) > 100_000:
                        self.tails.clear()
                    self.tails[marks] = self._whole([marks])[0]
                tail = self.tails[marks]
            if _LETTERS.fullmatch(head, head[0] == " "):  # one piece: straight to the merges
                piece = head.encode().decode("latin-1").translate(self.byte_characters)
                out[i] = array.array(self.code, [t.id for t in model.tokenize(piece)]).tobytes() + tail
            else:
                rest.append((i, head, tail))
        for j in range(0, len(rest), CALL_WORDS):
            part = rest[j:j + CALL_WORDS]
            for (i, _, tail), ids in zip(part, self._whole([head for _, head, _ in part])):
                out[i] = ids + tail
        return out

    def _learn(self, first: np.ndarray, second: np.ndarray, words: list[str]) -> None:
        encoded = self._encode_words(words)
        ids = np.frombuffer(b"".join(encoded), self.dtype)
        lengths = np.array([len(e) // self.dtype.itemsize for e in encoded], np.int32)
        a, b = self.n_words, self.n_words + len(words)
        while len(self.start) < b:
            self.start, self.length = np.r_[self.start, np.zeros_like(self.start)], np.r_[self.length, np.zeros_like(self.length)]
        while len(self.ids) < self.n_ids + len(ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        self.length[a:b] = lengths
        self.start[a:b] = self.n_ids + np.cumsum(lengths) - lengths
        self.n_words, self.n_ids = b, self.n_ids + len(ids)
        self.table.insert(first, second, np.arange(a, b, dtype=np.int32))

    def _entries(self, first: np.ndarray, second: np.ndarray, buffer: bytes, starts: np.ndarray, ends: np.ndarray, blank: np.ndarray) -> np.ndarray:
        """The table's entries of words; new ones are learned, in a cleared table if they might not fit."""
        if self.n_words + len(starts) > (2 << TABLE_BITS) // 3:
            self._clear()
        entry = self.table.find(first, second)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            _, which = np.unique(first[missing], return_index=True)
            new = missing[which]
            self._learn(first[new], second[new], [buffer[s - 1 if b else s:e].decode() for s, e, b in zip(
                starts[new].tolist(), ends[new].tolist(), blank[new].tolist())])
            entry[missing] = self.table.find(first[missing], second[missing])
        return entry

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Ids of regular texts."""
        buffer = "\0".join(["", *texts, ""]).encode()
        data = np.frombuffer(buffer, np.uint8)
        starts, ends, first, second = word_hashes(data, _SEPARATOR)
        before = data[starts - 1]
        blank = before == 32
        first = np.maximum(mix(first ^ np.where(blank, _AFTER_BLANK, np.uint64(0))), np.uint64(1))
        most = (2 << TABLE_BITS) // 3  # words of a round: as many as the table holds, should all be distinct
        raw, places, total = [], [np.zeros(0, np.int64)], 0
        for i in range(0, len(starts), most):
            now = slice(i, i + most)
            entry = self._entries(first[now], second[now], buffer, starts[now], ends[now], blank[now])
            line = before[now] == 10
            length = self.length[entry] + line  # the line end's id, then the word's
            at = np.cumsum(length) - length
            n = int(at[-1] + length[-1])
            out = self.ids[np.repeat(self.start[entry] - line - at, length) + np.arange(n)]
            out[at[line]] = self.line_end
            raw.append(out.tobytes())
            places.append(at + total)
            total += n
        at, raw, size = np.concatenate(places), b"".join(raw), self.dtype.itemsize
        text_of = np.flatnonzero(before == 0)
        bounds = [*at[text_of].tolist(), total]
        return [raw[size * a:size * b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, without special tokens, as little-endian integers of ``dtype``; null is an empty text."""
        out: list[bytes] = [b""] * len(texts)
        regular = [i for i, t in enumerate(texts) if t and self.by_word and self._regular(t)]
        known = set(regular)
        whole = [i for i, t in enumerate(texts) if t and i not in known]
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids
        start = held = 0
        for end, i in enumerate(regular, 1):
            held += len(texts[i])
            if held >= CHUNK or end == len(regular):
                for j, ids in zip(regular[start:end], self._by_words([texts[j] for j in regular[start:end]])):
                    out[j] = ids
                start, held = end, 0
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; its table lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
