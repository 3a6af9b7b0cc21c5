"""The classifier as a table of token weights."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tagweave.operators.model import train_sentiment_model
from tagweave.operators.sentiment import with_sentiment
from tagweave.operators.weights import calibration, export_weights, fit_token_weights, held_out, score_by_weights, text_tokens
from tagweave.sources.fixtures import read_table

TRAIN = [("1", "good good day", "positive"), ("2", "bad day", "negative"), ("3", "", "negative"), ("4", None, "positive"), ("5", "good", None)]


def frame(spark):
    return spark.createDataFrame(TRAIN, "id string, text string, sentiment string")


def test_weights_by_hand(spark):
    w = {(r["token"], r["class"]): r["weight"] for r in fit_token_weights(frame(spark), "id").collect()}
    n, v = {"positive": 3, "negative": 2}, 3
    seen = {("good", "positive"): 2, ("day", "positive"): 1, ("bad", "negative"): 1, ("day", "negative"): 1}
    assert len(w) == 2 * (v + 1) and all(abs(w[None, c] - math.log(0.5)) < 1e-12 for c in n)
    assert all(abs(w[t, c] - math.log((seen.get((t, c), 0) + 1) / (n[c] + v))) < 1e-12 for t in ("good", "bad", "day") for c in n)


def test_scores_by_hand_and_mode(spark):
    w = fit_token_weights(frame(spark), "id").cache()
    posts = spark.createDataFrame([("a", "Good!", 1), ("b", "bad bad day", 2), ("c", "unknown words", 3), ("d", None, 4), (None, "good", 5)], "id string, text string, n int")
    got = {r["id"]: (r["sentiment"], r["confidence"]) for r in score_by_weights(posts, w).collect()}
    assert got["a"][0] == "positive" and abs(got["a"][1] - (3 / 6) / (3 / 6 + 1 / 5)) < 1e-12
    assert got["b"][0] == "negative" and got["c"] == ("neutral", 0.5) and got["d"] == ("neutral", 0.5) and got[None][0] == "positive"
    assert {r["sentiment"] for r in score_by_weights(posts, w, threshold=1.01).collect()} == {"neutral"}
    out = with_sentiment(posts, "weights", w).collect()
    assert len(out) == 5 and {r["n"]: r["sentiment"] for r in out} == {1: "positive", 2: "negative", 3: "neutral", 4: "neutral", 5: "positive"}
    with pytest.raises(ValueError):
        with_sentiment(posts, "weights")
    none = fit_token_weights(frame(spark).where("false"), "id")
    assert {r["sentiment"] for r in score_by_weights(posts, none).collect()} == {"neutral"} and none.count() == 0


def test_exported_model_scores_like_the_model(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    labels = read_table(spark, SF_SMALL, "labels").select("doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment"))
    model = train_sentiment_model(docs.join(labels, "doc_id"), max_iter=10)
    vocabulary = text_tokens(docs, "doc_id").where("token IS NOT NULL").select("token")
    table = export_weights(model, vocabulary).cache()
    assert table.where("token IS NULL").count() == 2
    want = {r["doc_id"]: r["sentiment"] for r in model.transform(docs).collect()}
    got = {r["doc_id"]: (r["sentiment"], r["confidence"]) for r in score_by_weights(docs, table, "doc_id").collect()}
    off = [k for k in want if got[k][0] != want[k] and abs(got[k][1] - 0.6) > 1e-9]
    assert got.keys() == want.keys() and not off


def test_split_and_calibration(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("id"))
    share = ids.where(held_out("id")).count() / 20_000
    assert 0.18 < share < 0.22 and ids.repartition(7).where(held_out("id")).count() == ids.where(held_out("id")).count()
    scored = spark.createDataFrame([("positive", "positive", 1.0), ("positive", "negative", 0.95), ("neutral", "positive", 0.55)], "sentiment string, label string, confidence double")
    assert sorted(map(tuple, calibration(scored, "label").collect())) == [(5, 1, 0, 0.55), (9, 2, 1, 0.975)]


def test_words_meet_their_weights_without_a_shuffle_of_words(spark, monkeypatch):
    from tagweave.operators import weights as module
    from tagweave.operators.weights import row_tokens
    texts = [("1", "b a B é a b"), ("1", "a"), ("2", None), ("3", "!"), (None, "x")]
    posts = spark.createDataFrame(texts, "id string, text string")
    got = sorted(map(str, map(tuple, row_tokens(posts, "id").collect())))
    assert got == sorted(map(str, [("1", "a", 2), ("1", "b", 3), ("1", "é", 1), ("1", "a", 1), ("2", None, 1), ("3", None, 1), (None, "x", 1)]))
    assert "Exchange" not in row_tokens(posts, "id")._jdf.queryExecution().executedPlan().toString()
    w = fit_token_weights(frame(spark), "id").localCheckpoint()
    docs = read_table(spark, SF_SMALL, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    both = {}
    for size in (module.WEIGHTS_BROADCAST_BYTES, 0):
        monkeypatch.setattr(module, "WEIGHTS_BROADCAST_BYTES", size)
        out = score_by_weights(docs, w)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        by_key = [x for x in plan.splitlines() if "Aggregate [" in x and "token" in x and "tf" in x and "count(" in x]
        assert not by_key  # words were grouped by key and token before they met their weights
        assert ("rightHint=(strategy=broadcast)" in plan) == bool(size)
        both[size] = sorted((r["id"], r["sentiment"], round(r["confidence"], 9)) for r in out.collect())
    assert len(set(map(str, both.values()))) == 1
