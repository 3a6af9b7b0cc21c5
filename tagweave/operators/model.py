"""A trained sentence-level sentiment classifier (``pyspark.ml``).

Stages: regex tokenizer (lower-cased words) -> hashing term frequencies ->
IDF -> label indexer -> logistic regression. Scoring keeps the input
columns and adds ``sentiment``; a prediction whose top class probability
is below ``threshold`` (0.6 by default) is ``neutral``. Fitting and scoring
are distributed ``pyspark.ml`` jobs; no row reaches the driver.
A trained model holds no training summary: that refers to the session, which
goes with every scoring task and cannot once a query of it was observed.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StringIndexer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WORD_PATTERN
from ..session import remove, scratch_path

DEFAULT_THRESHOLD = 0.6
NUM_FEATURES = 1 << 18


class SentimentModel:
    """A fitted feature + classifier pipeline, its class names and the threshold."""

    def __init__(self, pipeline_model: PipelineModel, labels: list[str], text_col: str = "text",
                 threshold: float = DEFAULT_THRESHOLD):
        self.pipeline_model = pipeline_model
        self.labels = list(labels)
        self.text_col = text_col
        self.threshold = float(threshold)

    def transform(self, df: DataFrame) -> DataFrame:
        keep = [c for c in df.columns if c != "sentiment"]
        scored = self.pipeline_model.transform(
            df.withColumn("_text", F.coalesce(F.col(self.text_col).cast("string"), F.lit(""))))
        top = F.array_max(vector_to_array("_prob"))
        label = F.element_at(F.array(*[F.lit(x) for x in self.labels]), F.col("_pred").cast("int") + 1)
        return scored.select(*keep, F.when(top < F.lit(self.threshold), F.lit("neutral"))
                             .otherwise(label).alias("sentiment"))

    def save(self, path: str) -> None:
        self.pipeline_model.write().overwrite().save(f"{path}/pipeline")
        StringIndexerModel.from_labels(self.labels, inputCol="sentiment", outputCol="_y") \
            .write().overwrite().save(f"{path}/labels")

    @classmethod
    def load(cls, path: str, text_col: str = "text", threshold: float = DEFAULT_THRESHOLD) -> "SentimentModel":
        labels = StringIndexerModel.load(f"{path}/labels").labels
        return cls(PipelineModel.load(f"{path}/pipeline"), labels, text_col, threshold)


def sentiment_pipeline(num_features: int = NUM_FEATURES, max_iter: int = 50,
                       reg_param: float = 0.01) -> Pipeline:
    """Feature and classifier stages; the label column is ``_y`` (class index)."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol="_text", outputCol="_tok", pattern=WORD_PATTERN, gaps=False,
                       toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_feat"),
        LogisticRegression(featuresCol="_feat", labelCol="_y", predictionCol="_pred",
                           probabilityCol="_prob", rawPredictionCol="_raw",
                           maxIter=max_iter, regParam=reg_param, family="multinomial"),
    ])


def train_sentiment_model(train: DataFrame, text_col: str = "text", label_col: str = "sentiment",
                          threshold: float = DEFAULT_THRESHOLD, **params) -> SentimentModel:
    """Fit on labelled rows (``label_col`` holds sentiment names)."""
    data = train.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
                        F.col(label_col).alias("sentiment")).where(F.col("sentiment").isNotNull())
    indexer = StringIndexer(inputCol="sentiment", outputCol="_y",
                            stringOrderType="alphabetAsc").fit(data)
    model = sentiment_pipeline(**params).fit(indexer.transform(data))
    *features, classifier = model.stages
    return SentimentModel(PipelineModel([*features, _without_summary(train.sparkSession, classifier)]), indexer.labels, text_col, threshold)


def _without_summary(spark: SparkSession, model: LogisticRegressionModel) -> LogisticRegressionModel:
    """The fitted classifier as it is read back from storage, which keeps no training summary."""
    path = scratch_path(spark, "classifier")
    model.write().save(path)
    try:
        return LogisticRegressionModel.load(path)
    finally:
        remove(spark, path)
