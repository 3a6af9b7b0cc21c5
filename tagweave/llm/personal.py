"""Personal data in texts by weak supervision: email addresses, IP addresses, card numbers, phone numbers.

One pass over the texts finds the *base* spans, which four fixed patterns define, and wider *candidates* that the patterns miss:
numbers glued to their neighbours, spelled-out addresses, other separators, national phone numbers. No span has a label; seven
labelers (pattern, check digits and ranges, gazetteers, words before it, words that speak against it, neighbours, other kinds' spans) vote yes, no
or nothing on each. Expectation-maximisation over the counts of vote patterns of *all* candidates estimates how reliable each labeler is for each
kind, and so the probability that a span is personal data. With these probabilities as soft labels a logistic span classifier is
trained, on votes, shape and neighbouring words, over all candidates. Base spans always stay; a candidate is added when the classifier gives it ``THRESHOLD`` or more.

Texts are read once and whole; afterwards Spark handles spans alone. The driver sees the counts of vote patterns (at most
4 * 3^7) and the classifier's ``FEATURES`` weights. Patterns are linear in the text: no run of characters is scanned again from each of its places.

Edge cases: a null or empty text has no spans; a table without candidates needs no classifier; repeated rows and ids, and null ids, have a row each;
extra columns pass by unread. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, map_arrow, materialize

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
THRESHOLD = 0.5
#: Hashed features of the span classifier.
FEATURES = 1 << 12
#: Characters before a span whose words count as its context.
CONTEXT = 40
ITERATIONS = 200

# The base patterns. Each one takes a whole run at a time and gives nothing back, so a failed run is not tried again from its middle;
# what follows a run does not depend on where in it a match would begin.
LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL_RUN = re.compile(LOCAL + r"++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
IP_RUN = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
CARD_RUN = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE_RUN = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Wider patterns; every repetition is bounded, and they are tried near digits or connecting words alone.
DOT = r"(?:\.| ?[\[({] ?(?:\.|dot|punto|point|punkt) ?[\])}] ?| (?:dot|punto|point|punkt) )"
AT = (re.compile(r"@"), re.compile(r"[\[({] ?(?:@|at|arroba|chez) ?[\])}]", re.I),
      re.compile(r" (?:at|arroba) (?=[\w-]{1,63} (?:dot|punto|point|punkt) )", re.I))
HOST = re.compile(r" ?([\w-]{1,63}(?:" + DOT + r"[\w-]{2,63}){1,4})", re.I)
NAME = re.compile(r"([\w.%+-]{1,64}) ?\Z")
#: Text from a digit on in which the next digit is never far.
DIGITS = re.compile(r"[0-9](?:[^0-9]{0,16}[0-9])*+")
IP_WIDE = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:" + DOT + r"[0-9]{1,3}){3}(?![0-9])", re.I)
IP6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
CARD_WIDE = re.compile(r"(?<![0-9])(?:[0-9]{4}([ ./ -]{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[0-9]{3}([ ./ -])[0-9]{6}\2[0-9]{5}|[0-9]{13,19})(?![0-9])")
PHONE_WIDE = re.compile(
    r"\+[0-9]{1,3}[ . -]?(?:\([0-9]{1,4}\)[ . -]?)?[0-9]{2,4}(?:[ ./ -][0-9]{2,4}){1,4}(?!\.?[0-9])"
    r"|(?<![0-9])00[1-9][0-9]{0,2}[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4}){1,4}(?!\.?[0-9])"
    r"|(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?!\.?[0-9])")
#: A text without these has no base span and no candidate.
MAY_HOLD = r"[@0-9]|(?i:[\[({] ?(at|arroba|chez) ?[\])}]| (at|arroba) [^ ]{1,63} (dot|punto|point|punkt) )"

# The gazetteers.
ENDINGS = frozenset("com org net edu gov mil int info biz io co uk de fr es it eu us ca at ch nl be pl pt se no dk fi ru cn jp br mx ar in au nz app dev".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98 212 213 "
                          "216 234 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 886 966 971 972".split())
SPEAKS_FOR = (
    frozenset("mail email emails e-mail mailto correo courriel contact contacto kontakt adresse address write".split()),
    frozenset("ip ipv4 ipv6 host server address addr adresse dirección client node login".split()),
    frozenset("card cards credit debit visa mastercard amex karte kreditkarte kartennummer tarjeta carte bancaire payment".split()),
    frozenset("phone tel telephone call mobile cell fax telefon handy rufnummer teléfono móvil téléphone portable appelez whatsapp".split()))
SPEAKS_AGAINST = frozenset("version versions release build isbn issn order invoice sku serial page chapter section token key hash secret password sha md5 id uuid "
                           "total price usd eur amount bestellung rechnung pedido factura commande facture".split())
WORDS = re.compile(r"[^\W_][\w-]*")
LABELERS = ("pattern", "check", "gazetteer", "words for", "words against", "neighbours", "other kinds")


def luhn(digits: str) -> bool:
    """The check digit of a card number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def _emails(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in EMAIL_RUN.finditer(text) if m[1]] if "@" in text else []


def _ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IP_RUN.finditer(text) if m[1] and _octets(m[0])]


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def _cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CARD_RUN.finditer(text) if 13 <= len(_digits(m[0])) <= 19 and luhn(_digits(m[0]))]


def _phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE_RUN.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else []


BASE = (_emails, _ips, _cards, _phones)


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Base spans of each kind, in order."""
    return [find(text) for find in BASE]


def _wide(text: str) -> list[list[tuple[int, int]]]:
    """Candidates of each kind, whether base or not."""
    mails, numbers = [], [[], [], []]
    for pattern in AT:
        for m in pattern.finditer(text):
            name, host = NAME.search(text, max(0, m.start() - 65), m.start()), HOST.match(text, m.end())
            if name and host:
                mails.append((name.start(1), host.end(1)))
    for zone in DIGITS.finditer(text):
        if zone.end() - zone.start() > 6:  # no candidate is shorter
            for pattern, to in zip((IP_WIDE, CARD_WIDE, PHONE_WIDE), numbers):
                to += [m.span() for m in pattern.finditer(text, max(0, zone.start() - 2), min(zone.end() + 2, len(text)))]
    if text.count(":") > 6:
        numbers[0] += [m.span() for m in IP6.finditer(text)]
    return [mails, *numbers]


def _apart(found: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of ``found`` (by start) that overlap none of ``taken`` (by start) and no earlier one."""
    out, last, i = [], 0, 0
    for s, e in sorted(found, key=lambda x: (x[0], -x[1])):
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if s >= last and (i == len(taken) or taken[i][0] >= e):
            out.append((s, e))
            last = e
    return out


def votes(kind: int, text: str, start: int, end: int, elsewhere: bool) -> list[int]:
    """What each labeler says of a span: 1 yes, -1 no, 0 nothing. ``elsewhere``: a base span of another kind overlaps it."""
    span, digits = text[start:end], _digits(text[start:end])
    before, after = text[start - 1:start], text[end:end + 1]
    words = [w.lower() for w in WORDS.findall(text, max(0, start - CONTEXT), start)]
    own = any(w in SPEAKS_FOR[kind] for w in words)
    other = any(w in SPEAKS_FOR[k] for k in range(len(KINDS)) if k != kind for w in words)
    joined = (before.isalnum() or before in ("_", "=", "#", "/", "-") and before != "") or (after.isalnum() or after in ("_", "=") and after != "")
    check, known = 0, 0
    if kind == EMAIL:
        ending = re.split(r"[^\w-]+", span)[-1].lower()
        check = 1 if ending.isalpha() and 2 <= len(ending) <= 24 else -1
        known = 1 if ending in ENDINGS else -1
    elif kind == IP:
        parts = [p for p in re.split(r"[^0-9]+", span) if p] if ":" not in span else []
        check = 1 if not parts or all(int(p[-9:]) <= 255 and (p == "0" or p[0] != "0") for p in parts) else -1
        known = (1 if 0 < int(parts[0][-9:]) < 224 else -1) if parts else 0
    elif kind == CARD:
        check = 1 if luhn(digits) else -1
        known = 1 if _issued(digits) else -1
    else:
        check = 1 if 9 <= len(digits) <= 15 else -1
        code = digits[2:] if span.startswith("00") else digits
        known = (1 if any(code[:k] in CALLING_CODES for k in (1, 2, 3)) else -1) if span[0] in "+0" else (1 if digits[0] in "23456789" else -1)
    exact = [s for s in BASE[kind](span) if s == (0, len(span))]
    return [1 if exact else -1, check, known, 1 if own else -1 if other else 0, -1 if any(w in SPEAKS_AGAINST for w in words) else 0,
            -1 if joined else 1, -1 if elsewhere else 0]


def _issued(digits: str) -> bool:
    """A number range and length that card networks use."""
    n, two, four = len(digits), int(digits[:2]), int(digits[:4])
    return (digits[0] == "4" and n in (13, 16, 19) or (51 <= two <= 55 or 2221 <= four <= 2720) and n == 16 or two in (34, 37) and n == 15
            or (four == 6011 or two == 65 or two == 35) and 16 <= n <= 19 or two in (30, 36, 38) and n == 14)


def _shape(span: str) -> str:
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]", "a", span)))[:24]


def features(kind: int, text: str, start: int, end: int, said: list[int]) -> list[int]:
    """Hashed features of a span: its kind, votes, shape, size and neighbours."""
    span = text[start:end]
    before, after = WORDS.findall(text, max(0, start - CONTEXT), start), WORDS.search(text, end, end + CONTEXT)
    named = [f"labeler {i} {v}" for i, v in enumerate(said)] + [
        "kind", f"shape {_shape(span)}", f"digits {len(_digits(span))}", f"before {before[-1].lower() if before else ''}",
        f"after {after[0].lower() if after else ''}", f"left {_shape(text[max(0, start - 1):start])}", f"right {_shape(text[end:end + 1])}"]
    return sorted({zlib.crc32(f"{kind} {n}".encode("utf-8", "replace")) % FEATURES for n in named})


SPAN = pa.struct([("kind", pa.int8()), ("start", pa.int32()), ("end", pa.int32())])
CANDIDATE = pa.struct([("kind", pa.int8()), ("start", pa.int32()), ("end", pa.int32()), ("pattern", pa.int32()), ("features", pa.list_(pa.int16()))])
FOUND = "base array<struct<kind:byte,start:int,end:int>>, more array<struct<kind:byte,start:int,end:int,pattern:int,features:array<short>>>, \
trained array<struct<kind:byte,start:int,end:int,pattern:int,features:array<short>>>"


def pattern_id(kind: int, said: list[int]) -> int:
    """A vote pattern as one number."""
    out = 0
    for v in said:
        out = 3 * out + v + 1
    return out * len(KINDS) + kind


def pattern_votes(pattern: int) -> tuple[int, list[int]]:
    kind, rest, said = pattern % len(KINDS), pattern // len(KINDS), []
    for _ in LABELERS:
        said.append(rest % 3 - 1)
        rest //= 3
    return kind, said[::-1]


def spans_of(text: str) -> tuple[list, list, list]:
    """Base spans, added candidates, and base spans as candidates (they train the classifier) of one text."""
    base = base_spans(text)
    out, more, known = [], [], []
    for kind, wide in enumerate(_wide(text)):
        others = sorted(s for k, spans in enumerate(base) if k != kind for s in spans)
        for spans, to in ((base[kind], known), (_apart(wide, base[kind]), more)):
            free = set(_apart(spans, others))
            for s, e in spans:
                said = votes(kind, text, s, e, (s, e) not in free)
                to.append({"kind": kind, "start": s, "end": e, "pattern": pattern_id(kind, said), "features": features(kind, text, s, e, said)})
        out += [{"kind": kind, "start": s, "end": e} for s, e in base[kind]]
    return out, more, known


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, base, more, trained`` of every row: base spans, candidates beyond them, and base spans with their votes."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(1)
        hold = pc.fill_null(pc.match_substring_regex(texts, MAY_HOLD), False).to_numpy(zero_copy_only=False)
        found = [([], [], [])] * batch.num_rows
        for i in np.flatnonzero(hold):
            found[i] = spans_of(texts[int(i)].as_py())
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([f[k] for f in found], pa.list_(t)) for k, t in enumerate((SPAN, CANDIDATE, CANDIDATE))]],
                                         ["key", "base", "more", "trained"])

    return map_arrow(rows, run, f"key {rows.schema['key'].dataType.simpleString()}, {FOUND}")


def posteriors(counts: dict[int, int]) -> tuple[dict[int, float], dict]:
    """Probability that a candidate with a vote pattern is personal data, and the labelers' reliabilities.

    For each kind: a share of true spans, and for true and for false ones how often each labeler votes no, nothing, yes;
    labelers vote independently given the truth. Pseudo-counts (a labeler is rather right than wrong) keep the two classes in
    their place and decide where there is no data.
    """
    out, reliability = {}, {}
    for kind in range(len(KINDS)):
        rows = sorted(p for p in counts if p % len(KINDS) == kind)
        if not rows:
            continue
        n = np.array([counts[p] for p in rows], float)
        seen = np.array([pattern_votes(p)[1] for p in rows]) + 1
        onehot = seen[:, :, None] == np.arange(3)  # pattern, labeler, vote
        p = 1 / (1 + np.exp(-(seen - 1.0).sum(1)))
        # a labeler that is silent on most spans tells nothing by its silence; where it speaks, it is rather right
        silent = np.clip((n[:, None] * (seen == 1)).sum(0) / n.sum(), 0.05, 0.95)[:, None]
        speaks = 9 * (1 - silent)
        prior = [np.hstack([speaks * wrong, 9 * silent, speaks * (1 - wrong)]) for wrong in (1 / 9, 8 / 9)]  # of true spans, of false ones
        for _ in range(ITERATIONS):
            share = ((n * p).sum() + 2) / (n.sum() + 4)
            tables = []
            for weight, start in ((n * p, prior[0]), (n * (1 - p), prior[1])):
                table = (weight[:, None, None] * onehot).sum(0) + start
                tables.append(table / table.sum(1, keepdims=True))
            logit = math.log(share / (1 - share)) + (np.log(tables[0]) - np.log(tables[1]))[np.arange(len(LABELERS)), seen].sum(1)
            new = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
            moved, p = np.abs(new - p).max(), new
            if moved < 1e-9:
                break
        out.update(zip(rows, p.tolist()))
        reliability[KINDS[kind]] = {name: (tables[0][i].tolist(), tables[1][i].tolist()) for i, name in enumerate(LABELERS)}
    return out, reliability


def train(found: DataFrame) -> tuple[np.ndarray, float] | None:
    """Weights and intercept of the span classifier, from all candidates of ``find_spans`` (None: there are none)."""
    candidates = found.select(F.explode(F.concat("more", "trained")).alias("c")).select("c.pattern", "c.features")
    counts = {r["pattern"]: r["n"] for r in candidates.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    spark = found.sparkSession
    probability = spark.createDataFrame(sorted(posteriors(counts)[0].items()), "pattern int, p double")
    # equal candidates are one row; each row stands for a true span with its probability and for a false one with the rest
    rows = candidates.groupBy("pattern", "features").agg(F.count(F.lit(1)).alias("n")).join(probability, "pattern")
    rows = rows.select(F.col("features").cast("array<string>").alias("words"), F.posexplode(F.array(F.lit(1) - F.col("p"), F.col("p"))).alias("label", "part"), "n")
    rows = rows.select("words", F.col("label").cast("double").alias("label"), (F.col("n") * F.greatest("part", F.lit(1e-6))).alias("weight"))
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(FEATURES)], "words", "x").setBinary(True)
    rows = materialize(vectors.transform(rows).select("x", "label", "weight"), "pii-training")
    fitted = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", maxIter=25, regParam=1e-4, standardization=False).fit(rows)
    discard(rows)
    return fitted.coefficients.toArray(), float(fitted.intercept)


def add_spans(found: DataFrame, model: tuple[np.ndarray, float] | None, key: str = "doc_id") -> DataFrame:
    """``key, base, spans``: the base spans, and all spans after the classifier has added its own, by kind and start."""
    weights, intercept = model if model is not None else (np.zeros(FEATURES), -1.0)
    least = math.log(THRESHOLD / (1 - THRESHOLD))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        base = batch.column(1).to_pylist()
        out = []
        for spans, more in zip(base, batch.column(2).to_pylist()):
            added = [{k: c[k] for k in ("kind", "start", "end")} for c in more if weights[c["features"]].sum() + intercept >= least]
            out.append(sorted(spans + added, key=lambda s: (s["kind"], s["start"])))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(SPAN))], ["key", "base", "spans"])

    schema = f"key {found.schema['key'].dataType.simpleString()}, base array<struct<kind:byte,start:int,end:int>>, spans array<struct<kind:byte,start:int,end:int>>"
    return map_arrow(found.select("key", "base", "more"), run, schema).withColumnRenamed("key", key)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans`` of every row of ``docs``."""
    found = materialize(find_spans(docs), "pii-spans")
    return add_spans(found, train(found))


def joined(spans: str) -> Column:
    """Spans as text, ``kind:start:end``, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"].cast("int")), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _equals(value: int):
    return lambda c: c == value


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
