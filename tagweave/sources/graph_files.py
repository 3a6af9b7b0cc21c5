"""Reading saved graphs (vertices / edges) back."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..schema import EDGE, VERTEX
from ..session import hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath = hadoop_path(spark, path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def read_graph(spark: SparkSession, out_dir: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Vertices and edges saved under ``out_dir`` (``vertices/`` and ``edges/``).

    When either is missing both come back empty (with their schemas); any
    other read error is raised, not hidden.
    """
    vpath, epath = os.path.join(out_dir, "vertices"), os.path.join(out_dir, "edges")
    if not (path_exists(spark, vpath) and path_exists(spark, epath)):
        return (spark.createDataFrame([], VERTEX), spark.createDataFrame([], EDGE))
    reader = spark.read.format(fmt)
    if fmt != "parquet":
        return reader.schema(VERTEX).load(vpath), spark.read.format(fmt).schema(EDGE).load(epath)
    return reader.load(vpath), spark.read.format(fmt).load(epath)
