"""Token shards: whole-text encoding, the succinct structure, order across files."""

import random
import zlib

import numpy as np
import pytest

from tagweave.llm import tokens, wavelet
from tagweave.llm.queries import tokenizer_path
from tagweave.session import scratch_path

PIECES = ["a", "the", "Ünï", "'s", "can't", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "123", "!!", "日本", "<|endoftext|>", "\x1c", "\r\n",
          "\0", "\u00a0", "😀", "_", "word,", "l.", "é!", "it'.", "×!", "foo-bar);", " and", " of,"]


def test_encoder_equals_the_library_on_whole_texts(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(14))) for _ in range(4000)] + [None, ""]
    texts += [sep.join(rng.choices(["word,", "l.", "é!", "it'.", "the", "Ünï", "日本", "a1,"], k=20)) for sep in " \n" for _ in range(1000)]
    monkeypatch.setattr(tokens, "TABLE_BITS", 12)  # the table is emptied now and then
    e = tokens.Encoder(tokenizer_path())
    assert e.by_word
    want = [np.array(x.ids, e.dtype).tobytes() for x in e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = [x for i in range(0, len(texts), 100) for x in e.encode(texts[i:i + 100])]
    assert got == want


def test_a_text_with_more_distinct_words_than_the_table_holds(monkeypatch):
    rng = random.Random(4)
    words = [f"id{i}" for i in range(500)] + ["the", "é!", "日本"] * 100
    rng.shuffle(words)
    texts = [" ".join(words), "a b\nc", "\n".join(words[::-1])]
    monkeypatch.setattr(tokens, "TABLE_BITS", 6)
    e = tokens.Encoder(tokenizer_path())
    want = [np.array(x.ids, e.dtype).tobytes() for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert e.encode(texts) == want and e.encode(texts) == want


def test_other_kinds_of_tokenizers_encode_whole_texts():
    e = tokens.Encoder(tokenizer_path("word_bpe_49k.json"))
    assert not e.by_word
    assert np.frombuffer(e.encode(["A small  test"])[0], e.dtype).tolist() == e.tokenizer.encode("A small  test", add_special_tokens=False).ids


@pytest.mark.parametrize("n,alphabet", [(0, 1), (1, 1), (700, 1), (513, 2), (5000, 300), (4096, 70000)])
def test_shard_access_rank_select(n, alphabet):
    rng = np.random.default_rng(n)
    v = (rng.integers(0, alphabet, n) * 3).astype(np.uint32)
    shard = wavelet.Shard(wavelet.pack(v, [5, None], [n, 0]))
    assert shard.decode().tolist() == v.tolist() and shard.doc_ids == [5, None] and shard.lengths.tolist() == [n, 0]
    for i in rng.integers(0, n, 40).tolist() if n else []:
        t = int(v[i])
        before = int((v[:i] == t).sum())
        assert shard.access(i) == t and shard.rank(t, i) == before and shard.select(t, before) == i
        assert shard.count(t) == int((v == t).sum())
    assert shard.count(1) == 0
    with pytest.raises(IndexError):
        shard.select(1, 0)


def test_shards_round_trip_in_order(spark):
    rng = random.Random(1)
    rows = [(d, " ".join(rng.choices(["alpha", "beta,", "γάμμα"], k=rng.randrange(30)))) for d in rng.sample(range(-500, 500), 200)]
    rows += [(600, None), (601, ""), (rows[0][0], "again"), (None, "no id")]
    folder = scratch_path(spark, "test-shards")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    manifest = wavelet.write_shards(df, folder, tokenizer_path(), shard_tokens=500)
    assert manifest.count() > 8
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in wavelet.read_shards(manifest, folder, with_ids=True).collect()]
    e, start, want = tokens.Encoder(tokenizer_path()).tokenizer, 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*e.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
