"""Near-duplicates, components, substring dedup, decontamination: brute force on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tagweave.llm import dartminhash, decontaminate, substring
from tagweave.llm.components import connected_components

DOCS = "doc_id long, text string"


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_components(spark, kind):
    rng = random.Random(4)
    links = {"random": [(rng.randrange(60), rng.randrange(60)) for _ in range(40)], "path": [(i, i + 1) for i in range(40)],
             "star": [(7, i) for i in range(30)], "none": []}[kind]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    u = Union()
    for a, b in links:
        u.join(a, b)
    assert got == {x: u.find(x) for a, b in links for x in (a, b) if any(a != b and x in (a, b) for a, b in links)}


def text(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def shingles(t):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def near_texts(rng):
    out = []
    for _ in range(12):
        base = text(rng, rng.choice([6, 30, 120]))
        out.append(base)
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(99)}"
            out.append(copy)
    return [" ".join(t) for t in out]


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(11)
    texts = near_texts(rng) + ["short one", "Short, one!", "...", "...", "!!", "", "", None, " ".join(["same"] * 50), " ".join(["same"] * 45)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: (r.class_id, r.kept) for r in dartminhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    u, sets = Union(), {i: shingles(t) for i, t in rows}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                u.join(i, j)
            if i < j and texts[i] and texts[i] == texts[j]:
                u.join(i, j)
    assert got == {i: (u.find(i), u.find(i) == i) for i, _ in rows}


def test_edited_copies_meet_through_prefixes(spark):
    """A chain of edits: the hub reaches some, the prefix filter has to find the rest."""
    rng = random.Random(5)
    base, rows = text(rng, 150, 10**6), []
    for i in range(40):
        copy = list(base)
        for _ in range(rng.randrange(7)):
            copy[rng.randrange(150)] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    u, sets = Union(), [shingles(t) for _, t in rows]
    for i in range(40):
        for j in range(i):
            if sum((sets[i] & sets[j]).values()) >= 0.8 * sum((sets[i] | sets[j]).values()):
                u.join(i, j)
    assert got == {i: u.find(i) for i in range(40)} and len(set(got.values())) > 1


def template_texts(rng, n, words, most_changed):
    """Texts of one template, three fields filled with words of their own (and as many or more words than the template's)."""
    out = []
    for _ in range(n):
        t = [f"t{j}" for j in range(words)]
        for field in (3, 2, 1):
            at, k = field * words // 4, rng.randint(1, most_changed)
            t[at:at + k] = [f"v{rng.randrange(10**6)}" for _ in range(k + rng.randrange(2))]
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("few,most", [(64, 256), (2, 256), (2, 0)])
def test_texts_of_a_template_against_all_pairs(spark, monkeypatch, few, most):
    """By rare shingles, by size classes, and with other hubs before the pairs are listed."""
    monkeypatch.setattr(dartminhash, "FEW_TEXTS", few)
    monkeypatch.setattr(dartminhash, "MOST_LISTED", most)
    texts = template_texts(random.Random(3), 70, 200, 7) + template_texts(random.Random(4), 30, 150, 4)
    rows = list(enumerate(texts))
    got = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    u, sets = Union(), [shingles(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if sum((sets[i] & sets[j]).values()) >= 0.8 * sum((sets[i] | sets[j]).values()):
                u.join(i, j)
    assert got == {i: u.find(i) for i in range(len(texts))} and 2 < len(set(got.values())) < len(texts)


def test_texts_of_a_template_are_not_compared_pair_by_pair(spark, monkeypatch):
    """600 texts whose common part is too short for a link share 196 - 24 shingles each: 179,700 pairs, hardly any of them compared."""
    seen, listed = [], dartminhash._listed
    monkeypatch.setattr(dartminhash, "_listed", lambda *a: seen.append(listed(*a)) or seen[-1])
    rng, rows = random.Random(6), []
    for i in range(600):
        t = [f"t{j}" for j in range(200)]
        for at in (30, 90, 150):
            t[at:at + 4] = [f"v{rng.randrange(10**9)}" for _ in range(4)]
        rows.append((i, " ".join(t)))
    got = dartminhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert all(r.kept for r in got) and seen[0][1] > 600 and seen[0][0] < 600


def test_signatures_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**62, 300).astype(np.uint64)
    b = np.concatenate([a[:200], rng.integers(0, 2**62, 100).astype(np.uint64), a[:40]])  # 40 twice
    h = np.concatenate([a, b])
    owner = np.r_[np.zeros(len(a), int), np.ones(len(b), int)]
    seeds, owner = dartminhash.strips(h, owner)
    sig = dartminhash.signatures(seeds, owner, 2, k=4096)
    assert abs((sig[0] == sig[1]).mean() - 200 / 440) < 0.04


def test_near_duplicates_edges(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")], DOCS)
    got = sorted((r.doc_id or -1, r.class_id, r.kept) for r in dartminhash.near_duplicates(docs).collect())
    assert got == [(-1, None, True), (3, 3, True), (3, 3, True)]


def repeats(rows, window):
    first, out = {}, {}
    for d, t in rows:
        w = (t or "").encode().split()
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if d is not None:
                first[k] = min(first.get(k, d), d)
    for i, (d, t) in enumerate(rows):
        w = (t or "").encode().split()
        gone = set()
        for s in range(len(w) - window + 1):
            if d is not None and first[tuple(w[s:s + window])] < d:
                gone.update(range(s, s + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (d, len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("seed,window,k,vocabulary", [(1, 6, 2, 3), (2, 8, 3, 30), (3, 50, 8, 400), (4, 5, 5, 2)])
def test_substring_against_all_windows(spark, seed, window, k, vocabulary):
    rng = random.Random(seed)
    passages = [text(rng, window + rng.randrange(window), vocabulary) for _ in range(4)]
    rows = []
    for d in rng.sample(range(1000), 40):
        t = []
        for _ in range(rng.randrange(5)):
            t += text(rng, rng.randrange(2 * window), vocabulary) if rng.random() < 0.5 else rng.choice(passages)
        rows.append((d, rng.choice([" ", "\n", "\t\x0b "]).join(t)))
    rows += [(1001, rows[0][1]), (rows[1][0], rows[1][1]), (1002, None), (1003, ""), (None, rows[2][1]), (1004, "é\u00a0x " * 60), (1005, "é\u00a0x " * 70)]
    rng.shuffle(rows)
    got = substring.digest(substring.remove_repeats(spark.createDataFrame(rows, DOCS), window, k)).collect()
    key = lambda t: tuple((x is not None, x) for x in t)
    assert sorted(map(tuple, got), key=key) == sorted(repeats(rows, window).values(), key=key)


def test_contained_items_against_all_pairs(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join(text(rng, rng.choice([1, 3, 5, 9, 14, 40])))) for i in range(60)] + [(60, None), (61, "..."), (None, "a b"), (62, "")]
    docs = []
    for d in range(80):
        t = text(rng, rng.choice([0, 3, 50, 800]))
        for _ in range(rng.randrange(3)):
            part = (rng.choice(items[:60])[1]).split()
            if rng.random() < 0.5 and part:
                part[rng.randrange(len(part))] = "edit"
            at = rng.randrange(len(t) + 1)
            t[at:at] = [w.upper() for w in part]
        docs.append((d, ", ".join(t)))
    docs.append((80, None))
    want = set()
    for d, t in docs:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        for i, x in items:
            v = re.findall(r"[^\W_]+", (x or "").lower())
            n = min(5, len(v))
            if n and i is not None:
                have = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)}
                q = {tuple(v[j:j + n]) for j in range(len(v) - n + 1)}
                if len(q & have) >= 0.8 * len(q):
                    want.add((d, i, len(q), len(q & have)))
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in decontaminate.contained_items(d, b).collect()}
    assert got == want
    blocks = list(decontaminate.item_blocks(b, 300))
    assert len(blocks) > 2 and sum(map(len, blocks)) == 62
    monkeypatch.setattr(decontaminate, "item_blocks", lambda items, most=300: iter(blocks))
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in decontaminate.contained_items(d, b).collect()}
    assert got == want
    clean = {r.doc_id for r in decontaminate.clean_documents(d, b).collect()}
    assert clean == set(range(81)) - {x[0] for x in want}
