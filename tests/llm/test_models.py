"""Toxicity, language, embeddings, mixing."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import language, mixing, multiindex, toxicity
from tagweave.llm.common import held_out

SYLLABLES = "er an th on in ed es ou re ing tion ly sh wh st".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randrange(1, 4))) for _ in range(n))


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for d in range(700):
        words, toxic = prose(rng, rng.randrange(20, 200)).split(), int(d % 4 == 0)
        for _ in range(max(2, len(words) // 25) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice("zompkul brixnaff gurdlebok wexmurtz".split())
        docs.append((d, " ".join(words)))
        labels.append((d, toxic))
    docs += [(700, None), (701, ""), (None, "who knows"), (700, None)]
    labels += [(3, 0), (None, 1), (5, None), (9999, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"), ~held_out(F.col("doc_id")))
    rows = toxicity.score_documents(d, model).collect()
    assert len(rows) == 704 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 700]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in test]) > 0.93
    kept = toxicity.clean_documents(d.withColumn("score", F.lit(1)), model)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == sum(r.predicted == 0 for r in rows)


def test_toxicity_learns_from_late_passages(spark):
    rng = random.Random(5)
    docs = []
    for d in range(160):
        words = prose(rng, 2200 if d % 2 else 60).split()
        if d % 4 == 1:  # toxic beyond the first 10,000 characters only
            assert len(" ".join(words[:2100])) > 10_000
            words[2100:2100] = rng.choices("zompkul brixnaff gurdlebok wexmurtz".split(), k=30)
        docs.append((d, " ".join(words)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 1)) for i, _ in docs], "doc_id long, toxic int")
    model = toxicity.train(d, labels, ~held_out(F.col("doc_id")))
    assert b"brixnaff" in model.toxic
    test = [r for r in toxicity.score_documents(d, model).collect() if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 1) for r in test]) > 0.93


def test_toxicity_without_labels_or_with_one_class(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for rows in ([], [(1, 0)], [(1, 1)]):
        model = toxicity.train(d, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert toxicity.score_documents(d, model).count() == 2


def test_language_on_held_out_rows(spark):
    rng, rows = random.Random(3), []
    sets = {"xx": "er an th on in".split(), "yy": "ló ñu ré ção in".split(), "zz": "жа ко ли ер".split()}
    for d in range(400):
        lang = rng.choice(list(sets))
        rows.append((d, " ".join("".join(rng.choices(sets[lang], k=3)) for _ in range(rng.randrange(2, 60))), lang))
    rows += [(400, None, "xx"), (401, "123 !? ", "yy"), (402, "", None), (403, "anthon", None), (None, "жако", "xx")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(d, ~held_out(F.col("doc_id")))
    got = {r.doc_id: r for r in language.predict(d, model).collect()}
    assert model.languages == ["xx", "yy", "zz"]
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (400, 401, 402))
    assert got[403].lang_pred == "xx" and got[None].lang_pred == "zz"
    test = [r for r in rows[:400] if got[r[0]].held_out]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in test]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_scores_equal_a_plain_sum():
    texts = ["Abc déf", "zz, a", "", "x" * 50 + " " + "y" * 9]
    rng = np.random.default_rng(1)
    m = language.Model(["p", "q"], np.log([0.5, 0.5]), np.log(rng.dirichlet(np.ones(language.BUCKETS), 2).T))
    got, score = m.score(texts)
    for t, g, s in zip(texts, got, score):
        total = m.log_prior.copy()
        for bucket, _ in language.ngrams([t])[0]:
            total = total + m.log_p[bucket].sum(axis=0)
        assert g == ("und" if not t else m.languages[int(total.argmax())])
        assert abs(s - (0 if not t else 1 / np.exp(total - total.max()).sum())) < 1e-9


def test_language_without_rows_to_learn_from(spark):
    d = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language.predict(d, language.train(d)).first().lang_pred == "und"


def embeddings():
    rng = np.random.default_rng(6)
    base = rng.standard_normal((300, 16))
    near = [base[i % 40] + 0.09 * rng.standard_normal(16) for i in range(200)]
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate([*base, *near, *([base[0]] * 30), *(2 * base[:5])])]
    n = len(rows)
    return rows + [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] * 16, 0), (n + 3, [None] + [1.0] * 15, 0),
                   (n + 4, [1.0, 2.0], 0), (n + 5, [], 0), (n + 6, [float("inf")] * 16, 0), (None, rows[0][1], 0)]


def test_embeddings_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "BLOCK_INDEX", 40)
    monkeypatch.setattr(multiindex, "BLOCK_QUERIES", 30)
    rows = embeddings()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multiindex.near_duplicates(df).collect()}
    ok = [r for r in rows if r[0] is not None and r[0] < 535]
    x = np.array([r[1] for r in ok])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    n = linked.sum(axis=1) - 1
    part = np.arange(len(x))
    while (new := np.where(linked, part[None], len(x)).min(axis=1)).tolist() != part.tolist():
        part = new
    found = np.array([got[i][0] for i in range(len(x))])
    assert (found <= n).all() and found.sum() >= 0.98 * n.sum()
    assert np.mean([got[i][1] == part[i] for i in range(len(x))]) > 0.98
    assert all(got[i] == (0, i, True) for i in range(535, 542)) and got[None] == (0, None, True)


def low_rank_pairs(n, rank, dimension, cosine):
    """Unit vectors of a subspace, each followed by a neighbour inside the subspace."""
    rng = np.random.default_rng(12)
    basis = np.linalg.qr(rng.standard_normal((dimension, rank)))[0].T
    x, away = rng.standard_normal((2, n, rank))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    near = cosine * x + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    return np.stack([x, near], axis=1).reshape(2 * n, rank) @ basis


def test_embeddings_of_low_rank_keep_their_links(spark):
    x = low_rank_pairs(3000, 6, 64, 0.9505)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in multiindex.near_duplicates(df).collect()}
    n = (x @ x.T >= 0.95).sum(axis=1) - 1
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= n).all() and found.sum() >= 0.99 * n.sum()


def test_embeddings_of_one_dimension_and_of_any_size(spark):
    one = spark.createDataFrame([(i, [v]) for i, v in enumerate([1.0, 2.0, -3.0, 0.0, 1e-300, -1e300, float("inf")])] + [(7, None), (8, [None])],
                                "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in multiindex.near_duplicates(one).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (1, 2), 3: (0, 3), 4: (2, 0), 5: (1, 2), 6: (0, 6), 7: (0, 7), 8: (0, 8)}
    sizes = [1.0, 1e200, 1e-200, 5e-324, 1e308]
    rows = [(i, [v, v, 0.0, v]) for i, v in enumerate(sizes)] + [(i + 5, [0.0, -v, v, 0.0]) for i, v in enumerate(sizes)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in multiindex.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {i: (4, i // 5 * 5) for i in range(10)}


def test_visits_are_fitted_to_true_links(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "_directions", lambda x, sample, rng: iter(()))
    x = low_rank_pairs(1000, 6, 64, 0.9505)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = sum(r.n_links for r in multiindex.near_duplicates(df).collect())
    assert found >= 0.98 * ((x @ x.T >= 0.95).sum() - len(x))


def test_links_count_at_both_ends(spark, monkeypatch):
    """With few visited cells many pairs are met from one end only."""
    monkeypatch.setattr(multiindex, "fit_true", lambda *a: None)
    monkeypatch.setattr(multiindex, "BLOCK_QUERIES", 300)
    x = low_rank_pairs(1000, 32, 32, 0.96)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in multiindex.near_duplicates(df, recall=0.7).collect()}
    found = np.array([got[i].n_links for i in range(2000)])
    joined = np.array([got[i].component_id for i in range(2000)]) == np.arange(2000) // 2 * 2
    assert 200 < joined[1::2].sum() < 1000
    assert (found[::2] == joined[1::2]).all() and (found[1::2] == joined[1::2]).all()


def test_cells_come_in_order_of_distance():
    rng = np.random.default_rng(1)
    a, b = rng.random(7), rng.random(9)
    cells = list(multiindex.cell_order(a, b, 1000))
    sums = [a[i] + b[j] for i, j in cells]
    assert len(set(cells)) == 63 and sums == sorted(sums) and len(list(multiindex.cell_order(a, b, 10))) == 10


@pytest.mark.parametrize("kind", ["distinct", "ties"])
def test_visits_of_many_queries_equal_the_walk(kind):
    rng = np.random.default_rng(3)
    for most in (1, 2, 7, 30, 62, 63, 500):
        a, b = rng.random((20, 7)), rng.random((20, 9))
        if kind == "ties":
            a, b = np.round(2 * a), np.round(2 * b)
        row, i, j, reach = multiindex.nearest_cells(a, b, most)
        for r in range(20):
            walk = list(multiindex.cell_order(a[r], b[r], most))
            assert sorted(zip(i[row == r].tolist(), j[row == r].tolist())) == sorted(walk)
            assert reach[r] == a[r, walk[-1][0]] + b[r, walk[-1][1]]


def test_mixing_reaches_weights_and_is_repeatable(spark):
    rows = [(i, f"t{i}", "en", ["hot", "mid", None][0 if i % 10 < 6 else 1 if i % 10 < 9 else 2], 2) for i in range(3000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("copy_no", F.lit("old"))
    w = spark.createDataFrame([("hot", 1.0), ("mid", 2.0), (None, 1.0), ("none", 5.0)], "source string, weight double")
    got = mixing.mix_sources(d, w, total_rows=8000)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy_no"]
    count = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    assert all(abs(count[s] - 2000 * x) < 4 * (2000 * x) ** 0.5 for s, x in (("hot", 1), ("mid", 2), (None, 1)))
    again = mixing.mix_sources(d.repartition(7), w, total_rows=8000)
    assert sorted((r.doc_id, r.copy_no) for r in got.collect()) == sorted((r.doc_id, r.copy_no) for r in again.collect())
    ids = [r.doc_id for r in got.collect()]
    assert abs(np.corrcoef(ids[:-1], ids[1:])[0, 1]) < 0.1  # shuffled


def test_poisson_draws_follow_the_distribution(spark):
    for rate in (0.3, 4.0, 60.0, 400.0, 40_000.0):
        first, cdf = spark.range(1).select(mixing.poisson_cdf(F.lit(rate)).alias("c")).first().c
        p = np.diff(np.r_[0, cdf])
        k = first + np.arange(len(p)) - rate
        assert len(p) <= 2 * mixing.DEVIATIONS * rate**0.5 + 50 and abs(p.sum() - 1) < 1e-9 and p[-1] < 1e-20
        assert abs((p * k).sum()) < 1e-8 * max(1, rate) and abs((p * k * k).sum() / rate - 1) < 1e-8


def test_a_source_repeated_very_often(spark):
    d = spark.createDataFrame([(i, "t", "en", "rare" if i < 3 else "s", 1) for i in range(500)], "doc_id long, text string, lang string, source string, n_chars long")
    w = spark.createDataFrame([("rare", 1.0), ("s", 0.0)], "source string, weight double")
    got = {r.doc_id: r["count"] for r in mixing.mix_sources(d, w, total_rows=60_000).groupBy("doc_id").count().collect()}
    assert set(got) == {0, 1, 2} and all(abs(n - 20_000) < 900 for n in got.values())


def test_mixing_beyond_the_broadcast_bound(spark, monkeypatch):
    d = spark.createDataFrame([(i, "t", "en", f"s{i % 7}", 1) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    a = sorted((r.doc_id, r.copy_no) for r in mixing.mix_sources(d).collect())
    monkeypatch.setattr(mixing, "BROADCAST_VALUES", 3)
    assert a == sorted((r.doc_id, r.copy_no) for r in mixing.mix_sources(d).collect())


def test_mixing_runs_no_python(spark):
    d = spark.createDataFrame([(1, "t", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert not any(x in mixing.mix_sources(d)._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Arrow", "Pandas"))


def test_mixing_takes_columns_of_any_name(spark):
    d = spark.createDataFrame([(i, "t", f"s{i % 2}", 1) for i in range(50)], "doc_id long, text string, source string, `a.b` int")
    out = mixing.mix_sources(d)
    assert out.columns == ["doc_id", "text", "source", "a.b", "copy_no"] and out.where("`a.b` = 1").count() == out.count() > 0


def test_toxic_segments_of_long_words_are_learnt():
    assert b"insul" in toxicity._grams(b"x" * 500 + b"insult") and len(toxicity._grams(b"a")) == 1
