"""Session construction and the shared scratch location.

Everything heavy in this package is a lazy DataFrame transform; the only
things that touch storage outside the caller's own paths are lineage cuts
(iterative PageRank) and scratch data of self-contained demo queries. Both
live under the cluster's shared ``spark.checkpoint.dir``, never under a
machine-local temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Fixed session settings: adaptive execution with skew-join splitting and
# partition coalescing, UTC session time (the oracle compares in UTC).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "tagweave",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    Settings are applied at builder time: a ``SparkConf`` changed after the
    context started does not reach the running session.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else (spark.conf.get("spark.master", "") or "")
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory of this session.

    Read from the context first, then from ``spark.checkpoint.dir``. Only a
    local-mode session (tests, single-box runs) gets a directory of its own
    when none is configured; on a cluster an unset directory is an error,
    because a machine-local folder does not survive executor loss. A session
    without a SparkContext (Spark Connect) uses the configured path as is.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running iterative or streaming jobs")
        conf_dir = tempfile.mkdtemp(prefix="tagweave-ckpt-")
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "tagweave-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` as a Parquet table in the shared checkpoint directory and read it back.

    Cuts the lineage like a checkpoint, but the result is columnar (fast to
    re-read, e.g. every iteration) and survives executor loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


@lru_cache(maxsize=64)
def java_class(jvm, name: str):
    """A class of the JVM, looked up once: every part of its name is a call."""
    for part in name.split("."):
        jvm = getattr(jvm, part)
    return jvm


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop ``Path``, for file operations on the driver (names and sizes, never contents of data files)."""
    return java_class(spark._jvm, "org.apache.hadoop.fs.Path")(path)


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path lies on Hadoop's ``file:`` system."""
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package under the shared checkpoint directory."""
    folder = hadoop_path(spark, path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables) -> None:
    """Delete tables that ``materialize`` wrote and that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df._scratch)
