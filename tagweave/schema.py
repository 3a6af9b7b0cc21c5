"""Fixed schemas of the data this package reads and writes."""

from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType,
                               TimestampType)

# Raw post, positional CSV (no header) and JSON/Parquet by name. All strings:
# a junk label must stay a row (it maps to neutral), ids keep leading zeros,
# and no inference scan is needed.
RAW_POST = StructType([
    StructField("sentiment_label", StringType(), True),
    StructField("id", StringType(), True),
    StructField("date", StringType(), True),
    StructField("query", StringType(), True),
    StructField("user", StringType(), True),
    StructField("text", StringType(), True),
])

RAW_COLUMNS = [f.name for f in RAW_POST.fields]
REQUIRED_COLUMNS = ("id", "text")
OPTIONAL_COLUMNS = ("date", "sentiment_label")

# Stream wire record: hashtags travel as a JSON array inside a string.
WIRE = StructType([
    StructField("id", StringType(), True),
    StructField("text", StringType(), True),
    StructField("hashtags", StringType(), True),
    StructField("created_at", StringType(), True),
    StructField("sentiment", StringType(), True),
])

STREAM_OUT = StructType([
    StructField("id", StringType(), True),
    StructField("text", StringType(), True),
    StructField("hashtags", ArrayType(StringType(), True), True),
    StructField("sentiment", StringType(), True),
    StructField("processing_time", TimestampType(), True),
])

VERTEX = StructType([
    StructField("id", StringType(), True),
    StructField("degree", LongType(), True),
    StructField("dominant_sentiment", StringType(), True),
])

EDGE = StructType([
    StructField("src", StringType(), True),
    StructField("dst", StringType(), True),
    StructField("weight", LongType(), True),
])

# The three sentiment classes, in the alphabetical order that
# also breaks ties of the dominant sentiment.
SENTIMENTS = ("negative", "neutral", "positive")
