"""Golden rows for the column functions (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from tagweave.functions import (distinct_hashtags, has_hash, hashtags, label_to_sentiment,
                                parse_post_date, sentiment_from_text, shrink, strip_zone,
                                tags_from_json, tags_to_json, tokens)
from tagweave.functions.labels import edge_width, node_size, sentiment_color


def one(spark, value, fn, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


def test_hashtags_unicode_and_odd_hashes(spark):
    text = "I #Café #a #A b#c ##d #日本 #x_1 # #"
    assert one(spark, text, hashtags) == ["café", "a", "a", "c", "d", "日本", "x_1"]


def test_hashtags_combining_marks_stop_the_tag(spark):
    assert one(spark, "#हिन्दी", hashtags) == ["ह"]


def test_hash_without_tag(spark):
    for t in ["#", "# x", "###"]:
        assert one(spark, t, has_hash) is True
        assert one(spark, t, hashtags) == []


def test_null_text(spark):
    assert one(spark, None, has_hash) is False
    assert one(spark, None, hashtags) == []


def test_distinct_hashtags_sorted(spark):
    assert one(spark, "#b #a #a #B", distinct_hashtags) == ["a", "b"]


def test_labels(spark):
    df = spark.createDataFrame([("0",), ("4",), ("2",), (None,), ("x",)], "v string")
    got = [r["s"] for r in df.select(label_to_sentiment("v").alias("s")).collect()]
    assert got == ["negative", "positive", "neutral", "neutral", "neutral"]


def test_date_parse(spark):
    got = one(spark, "Mon Apr 06 22:19:45 PDT 2009", parse_post_date)
    # session time zone is UTC
    assert got == dt.datetime(2009, 4, 7, 5, 19, 45)
    assert one(spark, "junk", parse_post_date) is None
    assert one(spark, None, parse_post_date) is None


def test_strip_zone(spark):
    assert one(spark, "Mon Apr 06 22:19:45 PDT 2009", strip_zone) == "Mon Apr 06 22:19:45 2009"
    assert one(spark, "junk", strip_zone) == " junk"
    assert one(spark, None, strip_zone) is None
    assert one(spark, "", strip_zone) is None


def test_json_tags(spark):
    assert one(spark, '["a","café"]', tags_from_json) == ["a", "café"]
    assert one(spark, "[]", tags_from_json) == []
    assert one(spark, "junk", tags_from_json) is None
    assert one(spark, None, tags_from_json) is None
    df = spark.createDataFrame([(["a", "b"],)], "v array<string>")
    assert df.select(tags_to_json("v").alias("r")).first()["r"] == '["a","b"]'


def test_model_text_positive_wins(spark):
    df = spark.createDataFrame([("positive and negative",), ("very negative",), ("meh",)], "v string")
    got = [r["s"] for r in df.select(sentiment_from_text("v").alias("s")).collect()]
    assert got == ["positive", "negative", "neutral"]


def test_shrink_and_tokens(spark):
    assert one(spark, "  a \t\n b  ", shrink) == "a b"
    assert one(spark, "I love this!", tokens) == ["I", "love", "this", "!"]
    assert one(spark, "don't stop", tokens) == ["don't", "stop"]


def test_display_values(spark):
    df = spark.createDataFrame([("positive", 5, 1), ("other", 50, 30)], "s string, d long, w long")
    rows = df.select(sentiment_color("s").alias("c"), node_size("d").alias("n"),
                     edge_width("w").alias("w")).collect()
    assert (rows[0]["c"], rows[0]["n"], rows[0]["w"]) == ("#4CAF50", 20, 1.0)
    assert (rows[1]["c"], rows[1]["n"], rows[1]["w"]) == ("#9E9E9E", 80, 10.0)


def test_labels_compare_by_value(spark):
    from tagweave.functions.labels import label_to_sentiment
    df = spark.createDataFrame([("0", "negative"), ("0.0", "negative"), ("4.0", "positive"), ("0.5", "neutral"), ("-0.3", "neutral"),
                                ("4.7", "neutral"), ("junk", "neutral"), (None, "neutral")], "label string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", label_to_sentiment("label")).collect())


def test_zone_abbreviations_are_offsets_whatever_the_season(spark):
    at = lambda z: one(spark, f"Mon Apr 06 22:19:45 {z} 2009", parse_post_date)
    assert at("PST") - at("PDT") == dt.timedelta(hours=1) and at("CET") - at("CEST") == dt.timedelta(hours=1)
    assert at("pdt") == at("PDT") == at("-0700") == at("-07:00") == dt.datetime(2009, 4, 7, 5, 19, 45)
    assert at("America/Los_Angeles") == at("PDT")  # a region goes by the date
    assert at("UTC") == at("GMT") == dt.datetime(2009, 4, 6, 22, 19, 45)
    assert at("+9999") is None and at("XXT") is None and one(spark, "  Mon Apr 06 22:19:45 PST 2009 ", parse_post_date) == at("PST")


def test_event_time_of_wire_dates(spark):
    from tagweave.streaming import event_time
    other = F.lit("2000-01-01 00:00:00").cast("timestamp")
    got = lambda v: one(spark, v, lambda c: event_time(c, other))
    assert got("Mon Apr 06 22:19:45 2009") == dt.datetime(2009, 4, 6, 22, 19, 45)
    assert got(None) == got("junk") == got("") == dt.datetime(2000, 1, 1)


def test_ascii_json(spark):
    import json
    from tagweave.functions.text import ascii_json, json_value
    for v in ("plain", 'q"\\ \n\t', "café 日本 \U0001f600 \x7f", "", None):
        text = one(spark, v, lambda c: ascii_json(json_value(c)))
        assert text.isascii() and json.loads(text) == v
    assert one(spark, "é\U0001f600", lambda c: ascii_json(json_value(c))) == json.dumps("é\U0001f600")
