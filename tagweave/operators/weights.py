"""A text classifier as a table: a weight for each token and class, fitted by counting and applied by join and sum.

The table ``(token, class, weight)`` holds one row for each token and class, and with a null token the weight that every text has for the
class. A text's score for a class is the sum of the weights of its token occurrences; the scores' softmax are
probabilities, and a text whose best one is below the threshold is neutral. Any linear text model fits this form:
``fit_token_weights`` counts a multinomial naive Bayes, ``export_weights`` lays out a trained ``SentimentModel``. Fitting and scoring are
aggregates and one equi-join on the token, all in Spark; the driver sees the classes and one total for each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD_PATTERN, text_or_empty
from ..session import materialize
from .model import DEFAULT_THRESHOLD, SentimentModel

# Fixed value: folds of the held-out split.
FOLDS = 5

# Tunables (not semantics): a table of weights goes to every task while its proven size (token bytes and so much for each row) stays under this.
WEIGHTS_BROADCAST_BYTES = 64 << 20
WEIGHT_ROW_OVERHEAD = 64


def text_tokens(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``(key, token, tf)``: lower-cased words and how often a text holds them; a text without words has one row with a null token."""
    words = F.regexp_extract_all(F.lower(text_or_empty(text_col)), F.lit(WORD_PATTERN), F.lit(0))
    return (df.select(F.col(key).alias("key"), F.explode_outer(words).alias("token"))
            .groupBy("key", "token").agg(F.count(F.lit(1)).alias("tf")))


def row_tokens(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``(key, token, tf)`` of every row by itself, nothing shuffled: rows of one key are not put together as in :func:`text_tokens`."""
    words = F.array_sort(F.regexp_extract_all(F.lower(text_or_empty(text_col)), F.lit(WORD_PATTERN), F.lit(0)))
    # generated columns are evaluated once, not in every lambda call; a token begins where the sorted words change
    rows = df.select(F.col(key).alias("key"), F.explode_outer(F.array(words)).alias("_w"))
    starts = "explode_outer(array(filter(sequence(0, size(_w)), i -> i = 0 OR i = size(_w) OR get(_w, i) != get(_w, i - 1)))) AS _s"
    runs = rows.selectExpr("key", "_w", starts)
    counted = "explode_outer(transform(slice(_s, 1, size(_s) - 1), (p, j) -> struct(get(_w, p) AS token, CAST(get(_s, j + 1) - p AS LONG) AS tf))) AS _t"
    return runs.selectExpr("key", counted).selectExpr("key", "_t.token AS token", "coalesce(_t.tf, 1L) AS tf")


def held_out(key) -> Column:
    """True for the fifth of the keys that is kept for measuring: by the first 32 bits of ``md5``, so the same in every run and layout."""
    c = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long") % FOLDS == 0


def fit_token_weights(labelled: DataFrame, key: str, text_col: str = "text", label_col: str = "sentiment",
                      smoothing: float = 1.0) -> DataFrame:
    """Weights of a multinomial naive Bayes, counted over all of ``labelled`` (rows without a label are left out).

    ``weight(token, class) = ln((n + s) / (N + s V))`` for n occurrences of the token in the class, N of all tokens, V tokens;
    the class's own weight is the log of its share of the texts.
    """
    rows = labelled.where(F.col(label_col).isNotNull())
    texts = {r["label"]: r["n"] for r in rows.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(texts)
    if not classes:
        return labelled.sparkSession.createDataFrame([], "token string, class string, weight double")
    words = F.explode(F.regexp_extract_all(F.lower(text_or_empty(text_col)), F.lit(WORD_PATTERN), F.lit(0)))
    # one row for each token, a conditional count for each class: partial sums take in a frequent token before the shuffle
    counts = materialize(rows.select(F.col(label_col).alias("label"), words.alias("token")).groupBy("token").agg(
        *[F.count_if(F.col("label") == c).alias(f"n{i}") for i, c in enumerate(classes)]), "token-counts")
    totals = counts.agg(F.count(F.lit(1)).alias("v"), *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(classes))]).first()
    weight = [F.struct(F.lit(c).alias("class"), F.log((F.col(f"n{i}") + smoothing) / F.lit(totals[f"n{i}"] + smoothing * totals["v"])).alias("weight"))
              for i, c in enumerate(classes)]
    whole = float(sum(texts.values()))
    own = labelled.sparkSession.createDataFrame([(None, c) for c in classes], "token string, class string").withColumn(
        "weight", reduce(lambda e, c: e.when(F.col("class") == c, F.log(F.lit(texts[c] / whole))), classes, F))
    return counts.select("token", F.inline(F.array(*weight))).unionByName(own)


def export_weights(model: SentimentModel, vocabulary: DataFrame) -> DataFrame:
    """The weights of a trained model for the tokens of ``vocabulary(token)``, as such a table.

    A token's weight is its hashed feature's coefficient times its inverse document frequency, so scoring by the table gives
    what the model gives. The coefficients, a matrix of bounded size, come from the driver.
    """
    spark = vocabulary.sparkSession
    _, hashing, idf, classifier = model.pipeline_model.stages
    coefficients, scale = classifier.coefficientMatrix.toArray(), idf.idf.toArray()
    rows = [(int(i), *[float(w) for w in coefficients[:, i] * scale[i]]) for i in coefficients.any(axis=0).nonzero()[0]]
    by_index = spark.createDataFrame(rows, ", ".join(["_i int", *[f"w{c} double" for c in range(len(model.labels))]]))
    hashed = hashing.transform(vocabulary.select("token").distinct().withColumn("_tok", F.array("token")))
    index = F.regexp_extract(F.col("_tf").cast("string"), r"\[(\d+)\]", 1).cast("int")
    weights = F.array(*[F.struct(F.lit(c).alias("class"), F.coalesce(f"w{i}", F.lit(0.0)).alias("weight")) for i, c in enumerate(model.labels)])
    own = spark.createDataFrame([(None, c, float(b)) for c, b in zip(model.labels, classifier.interceptVector.toArray())],
                                "token string, class string, weight double")
    return (hashed.select("token", index.alias("_i")).join(by_index, "_i", "left").select("token", F.inline(weights))
            .unionByName(own))


def score_by_weights(df: DataFrame, weights: DataFrame, key: str = "id", text_col: str = "text",
                     threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """``(key, sentiment, confidence)`` of every text; texts of one key are scored as one.

    Tokens that the table does not know count nothing. The best class wins (the alphabetically first one of equals); ``confidence`` is its
    probability. A null key has a row too. An empty table of weights makes everything neutral.
    """
    classes = [r["class"] for r in weights.where(F.col("token").isNull()).select("class").distinct().orderBy("class").collect()]
    if not classes:
        return df.select(F.col(key), F.lit("neutral").alias("sentiment"), F.lit(0.0).alias("confidence")).distinct()
    own = {r["class"]: r["weight"] for r in weights.where(F.col("token").isNull()).collect()}
    wide = weights.where(F.col("token").isNotNull()).groupBy(F.col("token").alias("_t")).agg(
        *[F.sum(F.when(F.col("class") == c, F.col("weight"))).alias(f"w{i}") for i, c in enumerate(classes)])
    # a small table goes to the texts; words then meet their weights where they stand, and only the sums of texts are shuffled
    size = wide.agg(F.coalesce(F.sum(F.octet_length("_t") + F.lit(WEIGHT_ROW_OVERHEAD)), F.lit(0))).first()[0]
    if size <= WEIGHTS_BROADCAST_BYTES:
        wide = F.broadcast(wide)
    # a score is a sum over word occurrences, so they are counted in their row, and not once more by key and token
    sums = row_tokens(df, key, text_col).join(wide, F.col("token") == F.col("_t"), "left").groupBy("key").agg(
        *[(F.lit(own[c]) + F.coalesce(F.sum(F.col("tf") * F.col(f"w{i}")), F.lit(0.0))).alias(f"s{i}") for i, c in enumerate(classes)])
    scores = [F.col(f"s{i}") for i in range(len(classes))]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    confidence = F.lit(1.0) / reduce(lambda a, b: a + b, [F.exp(s - top) for s in scores])
    best = F.coalesce(*[F.when(s == top, F.lit(c)) for s, c in zip(scores, classes)])
    return sums.select(F.col("key").alias(key), F.when(confidence < threshold, "neutral").otherwise(best).alias("sentiment"),
                       confidence.alias("confidence"))


def calibration(scored: DataFrame, label_col: str, bins: int = 10) -> DataFrame:
    """``(bin, n, correct, confidence)``: by confidence, how often the prediction is right and what it said, for scored rows with a label."""
    at = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sentiment") == F.col(label_col)).alias("correct"),
                                               F.avg("confidence").alias("confidence"))
