"""Known answers at sf0.01 (computed independently in plain Python, FIXTURES §2.4 / SURVEY §5),
and randomized parity of the tag pattern with Python's Unicode word class."""

import random
import re

from pyspark.sql import functions as F

from tagweave.functions import has_hash, hashtags
from tagweave.operators import graph, sentiment
from tagweave.sources.fixtures import read_table, scored_view

SF01 = "/root/testdata/sf0.01"


def test_posts_graph_known_answers(spark):
    posts = scored_view(spark, SF01, "posts")
    assert posts.count() == 15000
    assert posts.where(F.col("text").isNull()).count() == 257
    v, e = graph.build_graph(posts)
    s = graph.graph_summary(v, e).first().asDict()
    assert s == {"vertices": 25, "tag_occurrences": 60000, "edges": 325,
                 "total_pairs": 119498, "self_loops": 25}
    split = {r["sentiment"]: r["count"] for r in sentiment.sentiment_distribution(posts).collect()}
    assert split == {"negative": 4933, "neutral": 5088, "positive": 4979}


def test_documents_hash_without_tags(spark):
    d = read_table(spark, SF01, "documents")
    row = d.agg(F.count_if(has_hash("text")).alias("with_hash"),
                F.sum(F.size(hashtags("text"))).alias("tags")).first()
    assert (row["with_hash"], row["tags"]) == (43, 0)


def test_tag_pattern_matches_python_word_class(spark):
    rnd = random.Random(7)
    # letters of several scripts, digits, underscore, '#', blanks and punctuation;
    # no combining marks (the one documented difference)
    alphabet = list("abcxyzABCXYZ0129_#    .,!-'éÉüßçñøÅ日本語кирΣσςİı٣") + ["##", "# "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["h"] for r in df.select("i", hashtags("t").alias("h")).collect()}
    pattern = re.compile(r"#(\w+)")
    for i, t in enumerate(texts):
        assert got[i] == pattern.findall(t.lower()), repr(t)
