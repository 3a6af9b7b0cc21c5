"""Writing graphs and post chunks."""

from __future__ import annotations

import json
import os
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import ascii_json, json_value
from ..operators.views import DEFAULT_TOP_N, top_subgraph
from ..session import hadoop_path, materialize


def write_graph(v: DataFrame, e: DataFrame, out_dir: str, fmt: str = "parquet",
                mode: str = "overwrite") -> tuple[str, str]:
    """Write vertices and edges as Spark output directories ``vertices/`` and ``edges/``.

    Each task writes its own files; nothing passes through the driver.
    ``read_graph`` reads them back.
    """
    vpath, epath = os.path.join(out_dir, "vertices"), os.path.join(out_dir, "edges")
    v.write.mode(mode).format(fmt).save(vpath)
    e.write.mode(mode).format(fmt).save(epath)
    return vpath, epath


# Nodes in a JSON array document: its edges grow with the square.
MAX_JSON_N = 1000


def json_array_document(df: DataFrame) -> DataFrame:
    """One row, one column ``value``: the rows of ``df`` as a JSON array.

    Only for bounded inputs (it gathers every row into one value); used for
    the top-N export.
    """
    return df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))


def export_top_json(v: DataFrame, e: DataFrame, out_dir: str, top_n: int = DEFAULT_TOP_N) -> tuple[str, str]:
    """The top-N subgraph as two JSON array documents (``top_vertices.json``, ``top_edges.json``).

    The complete graph is what ``write_graph`` writes; these two are its top-N excerpt for a dashboard, one value a
    file: ``top_n`` nodes and at most ``top_n^2/2`` edges, so ``top_n`` may be at most ``MAX_JSON_N`` here
    (about 100 MB of JSON). Written as a one-partition text output.
    """
    if top_n > MAX_JSON_N:
        raise ValueError(f"a JSON document holds at most the top {MAX_JSON_N}; write_graph writes any size")
    nodes, edges = top_subgraph(v, e, top_n)
    npath, epath = os.path.join(out_dir, "top_vertices.json"), os.path.join(out_dir, "top_edges.json")
    json_array_document(nodes.select("id", "degree", F.col("sentiment").alias("dominant_sentiment"))) \
        .coalesce(1).write.mode("overwrite").text(npath)
    json_array_document(edges.select(F.col("source").alias("src"), F.col("target").alias("dst"), "weight")) \
        .coalesce(1).write.mode("overwrite").text(epath)
    return npath, epath


# Indent of the elements of a JSON document.
INDENT = 2


def write_json_document(df: DataFrame, path: str, order_by: tuple[str, ...]) -> str:
    """All rows as one JSON array, in part files whose concatenation in the order of their names is the document.

    Elements stand in the order of ``order_by`` (rows that are equal in it keep the order of their table), indented by ``INDENT`` and escaped to
    ASCII, with the columns in the order of ``df``. Nothing is collected: the rows are written to a scratch
    table once, sorted by a range shuffle with one row for the opening and one for the closing bracket, and every task writes its part; only the last row, which has no
    comma behind it, is looked up first. An empty table is an empty array.
    """
    pad = " " * INDENT
    fields = [F.concat(F.lit(f"{pad * 2}{json.dumps(c)}: "), json_value(F.col(f"`{c}`"))) for c in df.columns]
    element = F.concat(F.lit(pad + "{\n"), F.concat_ws(",\n", *fields), F.lit("\n" + pad + "}"))
    order = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order_by)], F.monotonically_increasing_id().alias("at"))
    rows = materialize(df.select(order.alias("_order"), ascii_json(element).alias("_json")), "json-document")
    last = rows.select(F.max("_order")).scalar()
    text = F.when(F.col("_order").eqNullSafe(last), F.col("_json")).otherwise(F.concat("_json", F.lit(",")))
    bracket = lambda c, place: rows.sparkSession.range(1).select(
        F.lit(place).alias("_place"), F.lit(None).cast(rows.schema["_order"].dataType).alias("_order"), F.lit(c).alias("value"))
    lines = rows.select(F.lit(1).alias("_place"), "_order", text.alias("value")).unionByName(bracket("[", 0)).unionByName(bracket("]", 2))
    lines.orderBy("_place", "_order").select("value").write.mode("overwrite").text(path)
    return path


def read_json_document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The elements of a document that ``write_json_document`` wrote, read part by part in parallel.

    A line that closes an element cannot stand inside a JSON string, so it separates the elements.
    """
    parts = spark.read.option("lineSep", "\n" + " " * INDENT + "}").text(path).where(F.col("value").contains("{"))
    body = F.concat(F.regexp_extract("value", r"(?s)(\{.*)", 1), F.lit("}"))
    return parts.select(F.from_json(body, schema).alias("_row")).select("_row.*")


def export_graph_json(v: DataFrame, e: DataFrame, out_dir: str) -> tuple[str, str]:
    """The complete graph as two JSON array documents, ``vertices.json`` by id and ``edges.json`` by both ends."""
    return (write_json_document(v, os.path.join(out_dir, "vertices.json"), ("id",)),
            write_json_document(e, os.path.join(out_dir, "edges.json"), ("src", "dst")))


# Tasks that write chunks; more chunks than that share a task. Where there are chunks for all cores, a task writes several, up to CHUNKS_PER_TASK.
MAX_CHUNK_TASKS = 10_000
CHUNKS_PER_TASK = 64


def write_chunks(df: DataFrame, out_dir: str, chunk_size: int = 1000, fmt: str = "json",
                 mode: str = "append", order_by: tuple[str, ...] = ()) -> str:
    """Write rows as a sequence of files of exactly ``chunk_size`` records (the last one may hold fewer), JSON Lines by default.

    Rows stand in the order of ``order_by``, else in that of the partitions of ``df``. They are numbered
    from the counts of the partitions (one scratch table, no sort for it), and each task receives whole chunks. Files
    appear complete, one after the other, as ``chunk-00000000``, ``chunk-00000001`` ... (``append`` goes on after the last one), with rising modification times, so a
    file stream reads them in sequence and never sees a half-written one. The driver renames the files, as a commit does.
    """
    spark, size = df.sparkSession, int(chunk_size)
    if size < 1:
        raise ValueError("chunk_size must be positive")
    ordered = df.orderBy(*order_by) if order_by else df
    rows = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "chunk-rows")
    part = F.shiftright("_at", 33)
    # one row for each partition
    counts = rows.groupBy(part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = materialize(counts.select("_part", (before - F.col("_first")).alias("_shift"), "_n"), "chunk-offsets")
    chunks = -(-(offsets.agg(F.sum("_n")).first()[0] or 0) // size)
    each = max(1, -(-chunks // MAX_CHUNK_TASKS), min(CHUNKS_PER_TASK, chunks // (4 * spark.sparkContext.defaultParallelism)))
    staging = os.path.join(out_dir, f"_staging-{uuid.uuid4().hex[:12]}")
    numbered = rows.join(offsets.drop("_n"), part == F.col("_part")).withColumn("_row", F.col("_at") + F.col("_shift"))
    task = F.floor(F.col("_row") / (size * each)).cast("int")
    (numbered.repartitionById(max(1, -(-chunks // each)), task).sortWithinPartitions("_row").select(*[F.col(f"`{c}`") for c in df.columns])
     .write.format(fmt).option("maxRecordsPerFile", size)
     # tasks move their own files: nobody reads the staging folder before the job is done, and a file's name is the same in every attempt
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").save(staging))
    _publish_chunks(spark, staging, out_dir, mode)
    return out_dir


_PART = re.compile(r"part-(\d+)-.*?-c(\d+)(\..*)?$")
_CHUNK = re.compile(r"chunk-(\d+)")


def _publish_chunks(spark: SparkSession, staging: str, out_dir: str, mode: str) -> None:
    """Move the files of a finished job to their numbered names, oldest first."""
    folder, source = hadoop_path(spark, out_dir), hadoop_path(spark, staging)
    fs, path_in = folder.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path
    there = [(f, m) for f, m in ((f, _CHUNK.match(f.getPath().getName())) for f in fs.listStatus(folder)) if m]
    if mode == "overwrite":
        for f, _ in there:
            fs.delete(f.getPath(), False)
        there = []
    elif mode != "append":
        raise ValueError(f"Unknown mode: {mode}")
    number = max((int(m[1]) for _, m in there), default=-1) + 1
    stamp = max([int(time.time() * 1000), *[f.getModificationTime() + 1 for f, _ in there]])
    found = [(path, _PART.match(path.getName()), f) for f, path in ((f, f.getPath()) for f in fs.listStatus(source))]
    parts = sorted((int(m[1]), int(m[2]), m[3] or "", path) for path, m, f in found if m and f.getLen())
    for i, (_, _, suffix, path) in enumerate(parts):
        target = path_in(folder, f"chunk-{number + i:08d}{suffix}")
        fs.setTimes(path, stamp + i, -1)
        if not fs.rename(path, target):
            raise OSError(f"cannot rename {path.toString()} to {target.toString()}")
    fs.delete(source, True)
