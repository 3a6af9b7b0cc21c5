"""Loader: formats, quoting, encodings, required and optional columns, sampling."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tagweave.sources import hash_sample, load_posts, load_posts_and_rejects, normalize_posts


def write(path, data, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(data)
    return path


def test_csv_quotes_commas_newlines(spark, scratch):
    p = write(os.path.join(scratch, "a.csv"),
              '0,"1","Mon Apr 06 22:19:45 PDT 2009","NO_QUERY","u","say ""hi"", #Tag\nnext line"\n'
              '4,"2","Mon Apr 06 22:19:45 PDT 2009","NO_QUERY","v","plain #x"\n')
    rows = {r["id"]: r for r in load_posts(spark, p, "csv").collect()}
    assert rows["1"]["text"] == 'say "hi", #Tag\nnext line'
    assert rows["1"]["hashtags"] == ["tag"]
    assert rows["1"]["original_sentiment"] == "negative"
    assert rows["2"]["original_sentiment"] == "positive"


def test_csv_latin1(spark, scratch):
    p = write(os.path.join(scratch, "l.csv"), '4,"7","","NO_QUERY","u","café #café"\n',
              encoding="latin-1")
    good = load_posts(spark, p, "CSV", encoding="ISO-8859-1").first()
    assert good["hashtags"] == ["café"]
    bad = load_posts(spark, p, "csv").first()
    assert "�" in bad["text"]


def test_json_numbers_and_missing_optionals(spark, scratch):
    p = write(os.path.join(scratch, "a.json"),
              json.dumps({"id": 123, "text": "#a #b"}) + "\n")
    r = load_posts(spark, p, "json").first()
    assert r["id"] == "123" and r["hashtags"] == ["a", "b"]
    assert r["original_sentiment"] == "neutral" and r["created_at"] is None


def test_parquet_and_unsupported(spark, scratch):
    p = os.path.join(scratch, "p")
    spark.createDataFrame([(1, "#a", 0)], "id long, text string, sentiment_label int").write.parquet(p)
    assert load_posts(spark, p, "parquet").first()["original_sentiment"] == "negative"
    with pytest.raises(ValueError, match="Unsupported data format"):
        load_posts(spark, p, "xml")


def test_required_columns(spark):
    df = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(ValueError, match="'id'"):
        normalize_posts(df)


def test_constant_created_at(spark):
    df = spark.createDataFrame([("1", "t", "junk")], "id string, text string, date string")
    r = normalize_posts(df, created_at_mode="constant").first()
    assert str(r["created_at"]) == "2009-01-01 00:00:00"


def test_hash_sample_is_layout_independent(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("string").alias("id"))
    a = {r["id"] for r in hash_sample(df, 0.1).collect()}
    b = {r["id"] for r in hash_sample(df.repartition(7), 0.1).collect()}
    assert a == b and 350 < len(a) < 650


def test_max_rows_is_ordered(spark, scratch):
    p = os.path.join(scratch, "m")
    spark.createDataFrame([(str(i), "#a") for i in range(20)], "id string, text string") \
        .repartition(4).write.parquet(p)
    got = [r["id"] for r in load_posts(spark, p, "parquet", max_rows=3).collect()]
    assert got == sorted(str(i) for i in range(20))[:3]


def test_dropmalformed_skips_bad_lines(spark, scratch):
    p = write(os.path.join(scratch, "bad.csv"),
              '0,"1","d","q","u","#a"\n'
              '4,"2","d","q","u","#b","extra","fields"\n'
              '4,"3","d","q","u","#c"\n', encoding="latin-1")
    from tagweave.sources.posts import read_raw
    raw = read_raw(spark, p, "csv", encoding="ISO-8859-1", mode="DROPMALFORMED")
    assert {r["id"] for r in raw.collect()} == {"1", "3"}       # all columns read: checked
    assert read_raw(spark, p, "csv", encoding="ISO-8859-1", mode="DROPMALFORMED").count() == 2   # whatever is read
    assert read_raw(spark, p, "csv", mode="PERMISSIVE").count() == 3
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_raw(spark, p, "csv").count()


def test_split_lines_are_checked(spark, scratch):
    p = write(os.path.join(scratch, "nl.csv"), '0,"1","d","q","u","#a"\n4,"2","d","q","u","two\nlines #b"\n')
    assert load_posts(spark, p, "csv").count() == 2
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        load_posts(spark, p, "csv", multiline=False).collect()


def test_files_without_required_fields(spark, scratch):
    p = write(os.path.join(scratch, "five.csv"), '0,"1","d","u","#a"\n')
    with pytest.raises(ValueError, match="5 unnamed fields"):
        load_posts(spark, p, "csv")
    p = write(os.path.join(scratch, "no_text.json"), '{"id": 1, "body": "#a"}\n{"id": 2}\n')
    with pytest.raises(ValueError, match="'text'.*found: id"):
        load_posts(spark, p, "json")
    p = write(os.path.join(scratch, "empty.json"), "")
    assert load_posts(spark, p, "json").count() == 0


def test_hash_sample_near_one_keeps_all(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("id"))
    assert hash_sample(df, 1 - 1e-10).count() == 2000
    assert hash_sample(df, 0.999).count() > 1950


def test_posts_with_hashtags_filter(spark):
    from tagweave.sources.posts import posts_with_hashtags
    df = spark.createDataFrame([("1", "#a"), ("2", "# x"), ("3", "none"), ("4", None)],
                               "id string, text string")
    got = sorted(r["id"] for r in posts_with_hashtags(normalize_posts(df)).collect())
    assert got == ["1", "2"]


def test_typed_date_column_is_kept(spark):
    import datetime as dt
    df = spark.createDataFrame([("1", "#a", dt.datetime(2009, 4, 7, 5, 19, 45))],
                               "id string, text string, date timestamp")
    assert normalize_posts(df).first()["created_at"] == dt.datetime(2009, 4, 7, 5, 19, 45)


def test_checkpoint_dir_from_session(spark):
    from tagweave.session import ensure_checkpoint_dir, scratch_path
    root = ensure_checkpoint_dir(spark)
    assert root and scratch_path(spark, "x").startswith(root)


def test_checkpoint_dir_without_context(spark, monkeypatch):
    import tagweave.session as session
    monkeypatch.setattr(session, "_context", lambda s: None)
    assert session.ensure_checkpoint_dir(spark)


BAD_CSV = ('0,"1","d","q","u","one\ntwo #a"\n'
           '4,"2","d","q","#five"\n'
           '4,"3","d","q","u","#six","seven"\n'
           '0,"4","d","q","u","last ""q"" #b"\n')


@pytest.mark.parametrize("multiline", [None, False])
def test_a_record_of_another_size_is_never_shifted(spark, scratch, multiline):
    data = BAD_CSV if multiline is None else BAD_CSV.replace("one\ntwo", "one two")
    p = write(os.path.join(scratch, "bad.csv"), data)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        load_posts(spark, p, "csv", multiline=multiline).collect()
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):  # whatever columns are read
        load_posts(spark, p, "csv", multiline=multiline).select("id").collect()
    posts, rejects = load_posts_and_rejects(spark, p, "csv", multiline=multiline)
    assert {r["id"]: r["hashtags"] for r in posts.collect()} == {"1": ["a"], "4": ["b"]}
    assert sorted(r["record"] for r in rejects.select("record").collect()) == ['4,"2","d","q","#five"', '4,"3","d","q","u","#six","seven"']
    assert {(r["reason"], os.path.basename(r["file"])) for r in rejects.collect()} == {("not 6 fields", "bad.csv")} and rejects.count() == 2


def test_a_quote_that_never_closes_takes_its_record_with_it(spark, scratch):
    p = write(os.path.join(scratch, "open.csv"), '0,"1","d","q","u","never closed\n0,"2","d","q","u","x"\n4,"3","d","q","u","#y"\n')
    posts, rejects = load_posts_and_rejects(spark, p, "csv")
    kept, lost = {r["id"] for r in posts.collect()}, "".join(r["record"] for r in rejects.collect())
    assert "3" in kept and all(f'"{i}"' in lost or i in kept for i in "12")


def test_json_lines_are_checked(spark, scratch):
    p = write(os.path.join(scratch, "j.json"), '{"id": 1, "text": "#a"}\nnot json\n{"id": 2, "text": null}\n[1, 2]\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        load_posts(spark, p, "json").collect()
    posts, rejects = load_posts_and_rejects(spark, p, "json")
    assert {r["id"] for r in posts.collect()} == {"1", "2"}
    assert sorted(r["record"] for r in rejects.collect()) == ["[1, 2]", "not json"]


def test_json_with_a_text_that_is_always_null_has_a_text(spark, scratch):
    p = write(os.path.join(scratch, "n.json"), '{"id": 1, "text": null}\n{"id": 2, "text": null}\n')
    assert [r["has_hashtags"] for r in load_posts(spark, p, "json").collect()] == [False, False]
    many = write(os.path.join(scratch, "m.json"), '{"id": 1}\n{"text": "x"}\n')  # both columns, in different records
    assert load_posts(spark, many, "json").count() == 2


def test_parquet_has_no_rejects(spark, scratch):
    p = os.path.join(scratch, "p")
    spark.createDataFrame([("1", "#a")], "id string, text string").write.parquet(p)
    posts, rejects = load_posts_and_rejects(spark, p, "parquet")
    assert posts.count() == 1 and rejects.count() == 0 and rejects.columns == ["file", "reason", "record"]
