"""Post loading: CSV / JSON / Parquet into one normalised schema."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from ..functions.dates import constant_created_at, parse_post_date
from ..functions.labels import label_to_sentiment
from ..functions.text import has_hash, hashtags
from ..schema import OPTIONAL_COLUMNS, RAW_COLUMNS, RAW_POST, REQUIRED_COLUMNS

SUPPORTED_FORMATS = ("csv", "json", "parquet")
# Fixed value: seed of the Bernoulli sample.
SAMPLE_SEED = 42
_RECORD = "_record"


def read_raw(spark: SparkSession, path, fmt: str = "csv", *, encoding: str = "UTF-8",
             multiline: bool | None = None, mode: str | None = None) -> DataFrame:
    """Scan raw posts with a fixed schema (no inference pass).

    CSV is headerless and positional (``sentiment_label,id,date,query,user,text``),
    quoted with ``"`` and doubled quotes inside. A quoted text may hold line
    ends, so CSV is read ``multiline`` by default; that makes every file one
    task, so write large inputs as many files, or as JSON Lines or Parquet.
    ``multiline=False`` splits files at line ends. ``encoding`` matters for
    non-UTF-8 files (e.g. ``ISO-8859-1``).

    Every record is checked: a CSV record without six fields, wherever it
    stands, or a line that is no JSON object fails the job, so no column is ever shifted or filled in without a word.
    ``mode="DROPMALFORMED"`` skips such records, ``mode="PERMISSIVE"`` keeps what
    can be read of them; :func:`read_records` returns them as a table of their own.

    A CSV file whose first record has another number of fields, and JSON in
    which no record has a required field, raise ``ValueError`` here.
    """
    if fmt.lower() == "parquet":
        return spark.read.parquet(path)
    reader, kind = _checked_reader(spark, path, fmt, encoding, multiline, look=mode is None)
    return reader.schema(RAW_POST).option("mode", mode or "FAILFAST").format(kind).load(path)


def read_records(spark: SparkSession, path, fmt: str = "csv", *, encoding: str = "UTF-8",
                 multiline: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """``(raw posts, rejects)``: every record of the input is in one of the two.

    ``rejects``: ``file, reason, record`` (the record as it stands in the file) of the records for which :func:`read_raw` fails. Parquet has no
    malformed records. Both are lazy and read the input when they are used.
    """
    if fmt.lower() == "parquet":
        return spark.read.parquet(path), spark.createDataFrame([], "file string, reason string, record string")
    reader, kind = _checked_reader(spark, path, fmt, encoding, multiline, look=False)
    rows = (reader.schema(StructType([*RAW_POST.fields, StructField(_RECORD, StringType(), True)]))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).format(kind).load(path))
    reason = f"not {len(RAW_COLUMNS)} fields" if kind == "csv" else "not a JSON object"
    # Spark refuses to read the record column alone; this condition, always true, needs another one
    readable = F.coalesce(F.length("id"), F.lit(0)) >= 0
    rejects = rows.where(F.col(_RECORD).isNotNull() & readable).select(
        F.input_file_name().alias("file"), F.lit(reason).alias("reason"), F.col(_RECORD).alias("record"))
    return rows.where(F.col(_RECORD).isNull()).drop(_RECORD), rejects


def _checked_reader(spark: SparkSession, path, fmt: str, encoding: str, multiline: bool | None, look: bool):
    """A reader for CSV or JSON posts; ``look`` at the first records for files that hold no posts at all."""
    kind = fmt.lower()
    if kind not in SUPPORTED_FORMATS:
        raise ValueError(f"Unsupported data format: {fmt}")
    lines = kind == "json" if multiline is None else not multiline
    reader = spark.read.option("multiLine", str(not lines).lower()).option("encoding", encoding)
    if kind == "json":
        found = _json_fields(spark, path, encoding, lines) if look else None
        if found is not None and (missing := [c for c in REQUIRED_COLUMNS if c not in found]):
            raise _missing(missing, found)
        return reader, kind
    reader = reader.option("header", "false").option("quote", '"').option("escape", '"')
    first = reader.csv(path).columns if look else []  # reads one record
    if first and len(first) != len(RAW_COLUMNS):
        raise _missing(REQUIRED_COLUMNS, [f"{len(first)} unnamed fields, not {len(RAW_COLUMNS)}"])
    # all six fields are parsed whatever a query reads, so that records are checked alike
    return reader.option("columnPruning", "false"), kind


def _json_fields(spark: SparkSession, path, encoding: str, lines: bool) -> list[str] | None:
    """Names of post columns that JSON records have, null or not; None if there is no record.

    Ends at the first record with all required ones; only an input without such a record is read to its end, once.
    """
    if not lines:
        return spark.read.option("multiLine", "true").option("encoding", encoding).json(path).columns or None
    keys = spark.read.option("encoding", encoding).text(path).select(F.json_object_keys("value").alias("keys"))
    has = [F.coalesce(F.array_contains("keys", c), F.lit(False)) for c in RAW_COLUMNS]
    required = [F.array_contains("keys", c) for c in REQUIRED_COLUMNS]
    if not keys.where(reduce(lambda a, b: a & b, required)).isEmpty():
        return list(REQUIRED_COLUMNS)
    row = keys.agg(F.count("keys").alias("n"), *[F.max(h).alias(c) for h, c in zip(has, RAW_COLUMNS)]).first()
    return [c for c in RAW_COLUMNS if row[c]] if row["n"] else None


def _missing(names, found) -> ValueError:
    return ValueError(f"posts need the columns {', '.join(map(repr, names))}; found: {', '.join(found) or 'none'}")


def hash_sample(df: DataFrame, fraction: float, key: str = "id") -> DataFrame:
    """Keep a row when the first 32 bits of ``md5(key)`` fall below ``fraction``.

    Unlike ``DataFrame.sample`` the choice does not depend on partitioning or
    task order, so re-runs, retries and other engines pick the same rows.
    """
    if not 0 < fraction < 1:
        raise ValueError("fraction must lie strictly between 0 and 1")
    # first 32 bits h (an integer) < fraction * 2^32  <=>  h < ceil(fraction * 2^32)
    first = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.where(first < F.lit(math.ceil(fraction * (1 << 32))))


def normalize_posts(df: DataFrame, created_at_mode: str = "parse") -> DataFrame:
    """Project raw posts to ``id, text, hashtags, created_at, original_sentiment, has_hashtags``.

    ``id`` and ``text`` are required (``ValueError`` names the missing and the found ones);
    ``date`` and ``sentiment_label`` are optional and read as null when absent.
    ``created_at_mode``: ``parse`` (default) or ``constant`` (the legacy fixed
    instant). Analysis only; no job runs here.
    """
    if missing := [c for c in REQUIRED_COLUMNS if c not in df.columns]:
        raise _missing(missing, df.columns)
    for name in OPTIONAL_COLUMNS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    if created_at_mode == "parse":
        date_type = df.schema["date"].dataType
        if isinstance(date_type, (TimestampType, TimestampNTZType, DateType)):
            created = F.col("date").cast("timestamp")  # already typed (e.g. Parquet)
        else:
            created = parse_post_date(F.col("date").cast("string"))
    elif created_at_mode == "constant":
        created = constant_created_at()
    else:
        raise ValueError(f"Unknown created_at_mode: {created_at_mode}")
    text = F.col("text").cast("string")
    return df.select(
        F.col("id").cast("string").alias("id"),
        text.alias("text"),
        hashtags(text).alias("hashtags"),
        created.alias("created_at"),
        label_to_sentiment(F.col("sentiment_label")).alias("original_sentiment"),
        has_hash(text).alias("has_hashtags"),
    )


def posts_with_hashtags(posts: DataFrame) -> DataFrame:
    """Keep posts whose text contains a '#' (``has_hashtags``); they may still have no tag."""
    return posts.where(F.col("has_hashtags"))


def load_posts(spark: SparkSession, path, fmt: str = "csv", *, sample_fraction: float | None = None,
               max_rows: int | None = None, encoding: str = "UTF-8", multiline: bool | None = None,
               mode: str | None = None, created_at_mode: str = "parse",
               sample_method: str = "bernoulli") -> DataFrame:
    """Load and normalise posts (lazy, but for the first records that ``read_raw`` checks).

    ``sample_fraction`` in (0, 1) samples before normalisation (a value outside
    is ignored, as in the legacy loader); ``sample_method`` is ``bernoulli``
    (``DataFrame.sample``, seed 42) or ``hash`` (layout independent).
    ``max_rows > 0`` keeps the first rows by ``id`` (a deterministic cap; those rows
    pass through one task, so it is for previews).
    """
    df = read_raw(spark, path, fmt, encoding=encoding, multiline=multiline, mode=mode)
    return _prepared(df, sample_fraction, max_rows, created_at_mode, sample_method)


def load_posts_and_rejects(spark: SparkSession, path, fmt: str = "csv", *, sample_fraction: float | None = None,
                           max_rows: int | None = None, encoding: str = "UTF-8", multiline: bool | None = None,
                           created_at_mode: str = "parse",
                           sample_method: str = "bernoulli") -> tuple[DataFrame, DataFrame]:
    """``load_posts`` of the well-formed records, and the table of all others (see :func:`read_records`)."""
    df, rejects = read_records(spark, path, fmt, encoding=encoding, multiline=multiline)
    return _prepared(df, sample_fraction, max_rows, created_at_mode, sample_method), rejects


def _prepared(df: DataFrame, sample_fraction, max_rows, created_at_mode: str, sample_method: str) -> DataFrame:
    if sample_fraction and 0 < sample_fraction < 1:
        if sample_method == "hash":
            df = hash_sample(df, sample_fraction)
        else:
            df = df.sample(withReplacement=False, fraction=sample_fraction, seed=SAMPLE_SEED)
    if max_rows and max_rows > 0:
        df = df.orderBy(F.col("id").cast("string")).limit(int(max_rows))
    return normalize_posts(df, created_at_mode=created_at_mode)


__all__ = ["RAW_COLUMNS", "SUPPORTED_FORMATS", "read_raw", "read_records", "hash_sample",
           "normalize_posts", "posts_with_hashtags", "load_posts", "load_posts_and_rejects"]
