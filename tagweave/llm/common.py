"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import sysconfig
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

__all__ = ["materialize", "discard", "scratch_path", "table", "without", "fresh", "held_out", "map_arrow", "map_partitions",
           "text_slices", "null_safe"]

FOLDS = 5
#: Bytes of an Arrow batch that a Python worker gets at once (a longer row comes alone).
BATCH_BYTES = "4m"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose names (in any case) an operator uses for its own output."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name in taken:
        name = f"_{name}"
    return name


def held_out(key: Column) -> Column:
    """True for the fifth of the ids that no model may learn from (null ids: held out)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def null_safe(a: DataFrame, b: DataFrame, left: str, right: str) -> Column:
    return a[left].eqNullSafe(b[right])


PACKAGE = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they find it by PYTHONPATH or as an installed one."""
    paths = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(PACKAGE.parent) in [*paths, sysconfig.get_path("purelib")]:
        return
    to = Path(tempfile.mkdtemp(prefix="package-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(to))
    _SHIPPED.add(app)


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with the package sent along and batches limited by bytes.

    The limit is the session setting ``maxBytesPerBatch``, set here: 10,000 long texts at once
    would not fit beside the JVM in an executor.
    """
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(fn, schema)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """``map_partitions`` for functions of one batch; empty batches are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
            del batch
            pa.default_memory_pool().release_unused()  # workers live on between tasks
    return map_partitions(df, run, schema)


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most_bytes`` of text (one row at least)."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    yield batch.slice(start)
