"""Personal data: base spans against the plain patterns, labelers and EM, added spans, awkward texts."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tagweave.llm import personal
from tagweave.llm.personal import CARD, EMAIL, IP, KINDS, PHONE, base_spans, digests, luhn, pattern_id, pattern_votes, personal_data, posteriors, spans_of, votes

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def plain(text):
    """The base spans as their patterns say, with the regular expressions as they stand."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and sum((int(c) * (1 + i % 2) - 9 * (i % 2 and c > "4")) for i, c in enumerate(reversed(digits(s)))) % 10 == 0),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15))
    return [[m.span() for m in re.finditer(p, text) if ok(m[0])] for p, ok in rules]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    for alphabet, size in (("a1.@-", 14), ("12.", 20), ("0123456789 -.", 60), ("+12 ().-", 30), ("ab9@.%+ é", 25), ("0", 40)):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(size)))
            assert base_spans(text) == plain(text), text
    for text in ("x 4111 1111 1111 1111 y", "4111-1111-1111-1111", "a@b.c@d.e f@g h@i..j k.l@m.n-o.p", "+1 (302) 555-0147.", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.0255"):
        assert base_spans(text) == plain(text)


def test_whole_tables_digest_equals_the_plain_patterns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(10_001, "call +1 (302) 555-0147 or mail a.b@c.example, card 4111 1111 1111 1111, host 10.0.0.1"), (10_002, None), (10_003, ""), (None, "x@y.z"), (10_001, "x@y.z")]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, SCHEMA))
    want = []
    for r in docs.collect():
        found = plain(r.text or "")
        text = ",".join(f"{k}:{s}:{e}" for k, spans in zip(KINDS, found) for s, e in spans)
        want.append((r.doc_id, *map(len, found), hashlib.sha256(text.encode()).hexdigest(), text))
    got = digests(personal_data(docs)).collect()
    cols = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256"]
    assert sorted([tuple(r[c] for c in cols) for r in got], key=repr) == sorted([w[:-1] for w in want], key=repr)
    by_text = {w[5]: w[6] for w in want}
    for r in got:  # base spans stay, all spans are in order
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert {s for s in by_text[r.base_sha256].split(",") if s} <= set(r.spans.split(","))
        assert spans == sorted(spans, key=lambda s: (KINDS.index(s[0]), int(s[1])))


def test_added_spans_and_decoys(spark):
    rng = random.Random(2)

    def card(prefix="4"):
        body = prefix + "".join(rng.choice("0123456789") for _ in range(14))
        return next(body + c for c in "0123456789" if luhn(body + c))

    ip = lambda: ".".join(str(rng.randrange(1, 224)) for _ in range(4))
    phone = lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    mail = lambda: f"user.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com"
    token = lambda: 'token = "a' + "".join(rng.choice("0123456789") for _ in range(15)) + 'f"'
    rows, glued = [], {}
    for i in range(300):
        rows.append((i, f"some words {mail()} here, more {ip()} and {card()} then {phone()} end. {token()}"))
    for i in range(300, 340):
        a, b = card(), phone()
        rows.append((i, f"words {b} {a} more"))
        glued[i] = {("phone", 6, 6 + len(b)), ("card", 7 + len(b), 7 + len(b) + len(a))}
    for i in range(340, 360):
        a, b = card(), ip()
        rows.append((i, f"words {a} {b} more"))
        glued[i] = {("card", 6, 22)}
    rows += [(400 + i, t) for i, t in enumerate(["chapter 3, 4.0 and 17", "we meet at the dot of noon", "version 1.2.3 build 20240101123456", "é" * 50, token()])]
    out = digests(personal_data(spark.createDataFrame(rows, SCHEMA))).collect()
    spans = {r.doc_id: {(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)} for r in out}
    hits = sum(len(want & spans[i]) for i, want in glued.items())
    assert hits >= 0.95 * sum(map(len, glued.values()))
    base = {r.doc_id: sum(r[f"n_{k}"] for k in KINDS) for r in out}
    assert all(len(spans[i]) == base[i] for i in [*range(300), *range(400, 405)])  # a token of digits may pass as a card in the base
    assert not any(spans[i] for i in range(400, 404)), [(i, spans[i]) for i in range(400, 405)]


def test_spelled_out_addresses_and_other_separators_are_candidates():
    found = lambda text: {(KINDS[c["kind"]], text[c["start"]:c["end"]]) for c in spans_of(text)[1]}
    assert found("write to jo.doe [at] example [dot] com now") == {("email", "jo.doe [at] example [dot] com")}
    assert found("jo at example dot org") == {("email", "jo at example dot org")}
    assert found("host 10[.]0[.]0[.]1 down") == {("ip", "10[.]0[.]0[.]1")}
    assert ("card", "4111.1111.1111.1111") in found("pay 4111.1111.1111.1111")
    assert found("tel (302) 555-0147") == {("phone", "(302) 555-0147")}
    assert found("2001:0db8:0000:0000:0000:ff00:0042:8329") == {("ip", "2001:0db8:0000:0000:0000:ff00:0042:8329")}


def test_votes_and_patterns():
    text = "my visa card 4111111111111111 ok"
    assert votes(CARD, text, 13, 29, False) == [1, 1, 1, 1, 0, 1, 0]
    assert votes(CARD, "token x4111111111111112", 7, 23, True) == [-1, -1, 1, 0, -1, -1, -1]
    assert votes(EMAIL, "a@b.toolongendingxxxxxxxxxxxxxxx", 0, 32, False)[:3] == [1, -1, -1]
    assert votes(IP, "0.1.2.3", 0, 7, False)[1:3] == [1, -1] and votes(PHONE, "+999 123 456 789", 0, 16, False)[2] == -1
    for kind in range(4):
        for said in ([1, 0, -1, 1, 0, -1, 0], [-1] * 7, [1] * 7):
            assert pattern_votes(pattern_id(kind, said)) == (kind, said)


def test_em_finds_reliable_labelers():
    rng = random.Random(3)
    right = (0.97, 0.95, 0.9, 0.8, 0.75, 0.9, 0.5)  # the last one guesses
    counts, truth = {}, {}
    for _ in range(20_000):
        y = rng.random() < 0.4
        said = [(1 if y else -1) if rng.random() < q else (-1 if y else 1) for q in right]
        p = pattern_id(CARD, said)
        counts[p] = counts.get(p, 0) + 1
        truth[p] = truth.get(p, 0) + y
    post, reliability = posteriors(counts)
    assert sum(abs(post[p] * counts[p] - truth[p]) for p in counts) < 0.03 * sum(counts.values())
    yes = [reliability["card"][n][0][2] for n in personal.LABELERS]
    assert all(abs(a - b) < 0.04 for a, b in zip(yes, right))
    assert posteriors({}) == ({}, {})


@pytest.mark.parametrize("piece", ["a", "1", "1.", "a@", "@", "+1", "1 ", "4111111111111111 ", "[at]", " at ", "a.b@c.d ", "1:", "+1 (302) 555-0147 "])
def test_long_texts_take_linear_time(piece):
    took = []
    for n in (100_000, 400_000):
        text = piece * (n // len(piece))
        t = time.perf_counter()
        spans_of(text)
        took.append(time.perf_counter() - t)
    assert took[1] < 0.5 + 8 * took[0]


def test_empty_tables_nulls_and_clashing_names(spark):
    assert digests(personal_data(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(1, "no data"), (2, None), (None, ""), (None, None), (2, "x@y.zz")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("key", "base", "spans", "more", "a.b", "pattern")])
    got = digests(personal_data(df)).collect()
    assert len(got) == 5 and sum(r.n_email for r in got) == 1 and sum(r.spans == "" for r in got) == 4
