"""Word and window hashes against Python's own splitting."""

import re
import unicodedata

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tagweave.llm import words
from tagweave.llm.substring import smallest_in_window

texts = st.lists(st.text(st.sampled_from("ab \n\t.é"), max_size=30), max_size=6)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_are_split_and_hashed_by_content(ts):
    data = [t.encode() for t in ts]
    h, off = words.hash_words(data)
    split = [d.split() for d in data]
    assert np.diff(off).tolist() == [len(s) for s in split]
    flat = [w for s in split for w in s]
    seen = {}
    for w, x in zip(flat, h.tolist()):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(1, 4))
def test_window_hashes_depend_on_the_words_alone(ts, k):
    h, _ = words.hash_words([t.encode() for t in ts])
    flat = [w for t in ts for w in t.encode().split()]
    for second in (False, True):
        seen = {}
        for i, x in enumerate(words.Windows(h, second).all(k).tolist()):
            assert seen.setdefault(tuple(flat[i:i + k]), x) == x
        assert len(set(seen.values())) == len(seen)


def test_long_buffers_are_cut_between_words(monkeypatch):
    data = [b"alpha beta " * 50, b"x" * 9000, b"", b"beta gamma"]
    whole = words.hash_words(data)
    monkeypatch.setattr(words, "CHUNK", 64)
    cut = words.hash_words(data)
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_shingles_fold_case_and_punctuation():
    s = words.Shingles(["One, two THREE four five six!", "one two three four FIVE; six", "Éa b", "éa, B.", "", None, "..."], 5)
    n = np.diff(s.offsets).tolist()
    assert n == [2, 2, 1, 1, 0, 0, 0]
    assert s.hashes[:2].tolist() == s.hashes[2:4].tolist() and s.hashes[4] == s.hashes[5]
    assert re.findall(r"\w+", "Éa b") == ["Éa", "b"]


def test_other_typography_gives_the_same_shingles():
    plain = "the 'quick' brown fox - it jumps over café tables, 2 times"
    typed = ("the \u2018quick\u2019 brown\u00a0fox \u2014 it\u3000jumps o\u00adver cafe\u0301 ta\u200dbles\u2026 \uff12 times",
             "THE \u201cQUICK\u201d brown\u2009fox\u2013it jumps\u200bover CAF\u00c9 tables\u3001 2 times")
    s = words.Shingles([plain, *typed], 5)
    first, second, third = (s.hashes[s.offsets[i]:s.offsets[i + 1]].tolist() for i in range(3))
    assert len(first) == 7 and first == second == third


def test_scripts_without_blanks_have_a_word_a_letter():
    s = words.Shingles(["今日は天気がいい。", "今日は、天気が いい", "สวัสดีครับ", "Привет мир", "abc今日"], 2)
    n = np.diff(s.offsets).tolist()
    assert n == [7, 7, len("สวัสดีครับ") - 1, 1, 2]
    assert s.hashes[:7].tolist() == s.hashes[7:14].tolist()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_words_beyond_ascii_equal_a_plain_walk(t):
    form, flat = unicodedata.normalize("NFKC", t) if not t.isascii() else t, []
    for c in form.lower():
        category = unicodedata.category(c)
        if category == "Cf" and c != "\u200b":
            continue
        letter = c.isalnum() if c.isascii() else category[0] in "LMN"
        alone = letter and any(a <= ord(c) <= b for a, b in words.NO_BLANKS)
        flat.append(f" {c} " if alone else c if letter else " ")
    assert np.diff(words.Shingles([t], 1).offsets).tolist() == [len("".join(flat).split(" ")) - "".join(flat).split(" ").count("")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 9))
def test_smallest_in_window(values, width):
    v = np.array(values, np.uint64)
    got = smallest_in_window(v, width).tolist()
    want = [i + int(np.argmin(v[i:i + width])) for i in range(len(v) - width + 1)]
    assert got == want or (width > len(v) and not want)
