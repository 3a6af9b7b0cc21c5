"""The whole pipeline against plain Python, from what its first stage keeps on."""

import hashlib
import math
import re
import zlib

import numpy as np
from test_groups import Union, shingles

import corpus_pipeline
from tagweave.llm import toxicity
from tagweave.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def copies(doc_id, rate):
    u = int(hashlib.md5(f"mix-1:{doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    k, term = 0, math.exp(-rate)
    total = term
    while total <= u:
        k += 1
        term *= rate / k
        total += term
    return k


def test_pipeline_equals_plain_python(spark):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scorer = model.scorer()
    kept = {r.doc_id: r for r in docs.collect() if scorer.score(r.text)[0] < 0.5}
    sets, u = {i: shingles(r.text) for i, r in kept.items()}, Union()
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                u.join(i, j)
    kept = {i: r for i, r in kept.items() if u.find(i) == i}
    items = [set(shingles(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert all(len(re.findall(r"[^\W_]+", " ".join(max(x)))) == 5 for x in items)
    kept = {i: r for i, r in kept.items() if not any(len(x & set(sets[i])) >= 0.8 * len(x) for x in items)}
    n = {}
    for r in kept.values():
        n[r.source] = n.get(r.source, 0) + 1
    total = sum(v**0.7 for v in n.values())
    rows = sorted(i for i, r in kept.items() for _ in range(copies(i, n[r.source] ** 0.7 * len(kept) / total / n[r.source])))
    tokenizer, start, want = Tokenizer.from_file(tokenizer_path()), 0, []
    tokenizer.encode_special_tokens = True
    for i in rows:
        ids = [*tokenizer.encode(kept[i].text, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=lambda r: r[1])
    assert len(rows) > 100 and got == want
