"""The co-occurrence graph kept current from the post stream.

Each micro-batch is reduced to one small additive delta in a folder of its own: tags and sentiment of its posts, written by one job
without a shuffle (level 0). Deltas are summed in levels: as soon as a level holds ``FAN`` of them, they are replaced by one of the next
level, which holds their tag sentiment profile and their pair weights. So what is dear (pairs, shuffles) is done once for
``FAN`` batches; after b batches there are at most ``FAN * log(b)`` snapshots, and each delta is rewritten log(b) times. A reader counts the posts that
lie in level 0 as it sums the levels above.

What counts is listed in one small document, the pointer ``<state_dir>/current/<batch>.json``: the stream it belongs to, the batch it ends with and
the folders of its snapshots. A batch's pointer appears after its data, by a rename, so a reader (which takes the
latest one) sees all of a batch or nothing of it. A replayed batch whose pointer is there has been counted and is left out. The last ``KEEP`` pointers stay, for a replay and
for readers that have begun; folders that none of them lists are deleted. Nothing is kept in streaming state and no aggregate is chained in update mode.

Batch ids belong to one stream: the id that its checkpoint carries. A stream with another checkpoint may not write to the same
state folder, whether that checkpoint is new or not: its batches would be taken for replays.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.labels import normalize_sentiment
from ..functions.text import hashtags
from ..operators.graph import ARRAY_PAIR_LIMIT, post_pairs, sentiment_profile, tag_occurrences, vertices_from_profile
from ..schema import SENTIMENTS
from ..session import hadoop_path, is_local, java_class, remove
from ..sources.graph_files import path_exists
from .event_time import once_each
from .files import _apply_trigger, log_conf, read_wire_stream, start_with, upkeep_conf
from .wire import decode_wire

# Snapshots of a level that are summed into one of the next level (32 folders at most are listed without a job), and pointers that stay readable.
FAN, KEEP = 32, 16
# Tag and pair occurrences that one task counts, about: a small batch takes few tasks and few shuffle files, whatever the session's partitions.
TASK_ROWS = 200_000
# Bytes of a batch, as Spark reckons them, that one task reads and writes at most.
TASK_BYTES, MOST_TASKS = 1 << 20, 1 << 20

PROFILE = "id string, degree long, " + ", ".join(f"{s} long" for s in SENTIMENTS)
PAIRS = "src string, dst string, weight long"
POSTS = "hashtags array<string>, sentiment string"


def _posts_of(decoded: DataFrame, dedupe: bool) -> DataFrame:
    tags = F.col("hashtags") if dedupe else hashtags(F.col("text"))
    return decoded.select(F.coalesce(tags, F.array().cast("array<string>")).alias("hashtags"),
                          normalize_sentiment(F.col("sentiment")).alias("sentiment"))


# --- the pointer: a document of a few kilobytes, read and written on the driver -------------------------------

@lru_cache(maxsize=8)
def _plain(spark: SparkSession, path: str) -> str | None:
    """The path as the driver's own files know it, for Hadoop's ``file:`` system, else None. Hadoop would start a process for the permissions of every file it makes there."""
    return hadoop_path(spark, path).toUri().getPath() if is_local(spark, path) else None


def _fs(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _current(spark: SparkSession, state_dir: str) -> dict | None:
    """The latest pointer, or None for a state folder without batches."""
    last = max(_names(spark, state_dir, "current", r"\d+-\d+\.json"), default=None)
    return json.loads(_read_small(spark, state_dir, os.path.join("current", last))) if last else None


def _names(spark: SparkSession, base: str, folder: str, pattern: str) -> list[str]:
    """Names in a folder below ``base`` that match as a whole, sorted; few calls to the JVM, whatever their number."""
    plain = _plain(spark, base)
    if plain:
        path = os.path.join(plain, folder)
        return sorted(n for n in os.listdir(path) if re.fullmatch(pattern, n)) if os.path.isdir(path) else []
    path = os.path.join(base, folder)
    if not path_exists(spark, path):
        return []
    found = java_class(spark._jvm, "org.apache.hadoop.fs.FileUtil").stat2Paths(_fs(spark, path).listStatus(hadoop_path(spark, path)))
    text = java_class(spark._jvm, "org.apache.commons.lang3.ArrayUtils").toString(found)
    return sorted(re.findall(rf"/({pattern})(?=[,}}])", text))


def _read_small(spark: SparkSession, base: str, name: str) -> str:
    plain = _plain(spark, base)
    if plain:
        with open(os.path.join(plain, name), encoding="utf-8") as f:
            return f.read()
    path = os.path.join(base, name)
    stream = _fs(spark, path).open(hadoop_path(spark, path))
    try:
        return java_class(spark._jvm, "org.apache.commons.io.IOUtils").toString(stream, "UTF-8")
    finally:
        stream.close()


def _publish(spark: SparkSession, base: str, folder: str, name: str, text: str) -> None:
    """A small file that appears complete, by a rename."""
    draft, plain = f"_{uuid.uuid4().hex}", _plain(spark, base)
    if plain:
        path = os.path.join(plain, folder)
        os.makedirs(path, exist_ok=True)
        with open(os.path.join(path, draft), "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.rename(os.path.join(path, draft), os.path.join(path, name))
        return
    fs = _fs(spark, base)
    draft, final = (hadoop_path(spark, os.path.join(base, folder, n)) for n in (draft, name))
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, final):
        raise OSError(f"cannot publish {final.toString()}")


def _point(spark: SparkSession, state_dir: str, pointer: dict) -> None:
    """Publish a pointer. Folders that went out of the list ``KEEP`` batches ago, and older pointers, are deleted."""
    old = [d for d in pointer["dropped"] if d["batch"] <= pointer["batch"] - KEEP]
    for d in old:
        remove(spark, os.path.join(state_dir, "data", d["folder"]))
    pointer = {**pointer, "dropped": [d for d in pointer["dropped"] if d not in old]}
    _publish(spark, state_dir, "current", f"{pointer['batch']:019d}-{pointer['version']:06d}.json", json.dumps(pointer))
    for name in _names(spark, state_dir, "current", r"\d+-\d+\.json")[:-KEEP]:
        remove(spark, os.path.join(state_dir, "current", name))


def _drop_unfinished(spark: SparkSession, state_dir: str, batch: int) -> None:
    """Delete folders of attempts that ended before their pointer appeared: those beyond the last ``batch`` that counts."""
    for name in _names(spark, state_dir, "data", r"\d+-\d+-\w+"):
        if int(name.split("-")[0]) > batch:
            remove(spark, os.path.join(state_dir, "data", name))


@contextmanager
def _shuffles_of(spark: SparkSession, tasks: int | None):
    """Shuffles of adaptive plans begin with ``tasks`` partitions, at most those of the session."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if tasks is None or tasks >= most:
        yield
        return
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(tasks))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _folder(state_dir: str, level: int, upto: int) -> tuple[str, str]:
    folder = f"{upto:012d}-{level}-{uuid.uuid4().hex[:12]}"
    return folder, os.path.join(state_dir, "data", folder)


def _writer(delta: DataFrame):
    """Tasks move their own files, and no mark is left: a snapshot counts when the pointer names it."""
    return (delta.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"))


def _write_posts(state_dir: str, upto: int, posts: DataFrame) -> dict:
    """The snapshot of one batch: its posts as they are, one job without a shuffle."""
    folder, path = _folder(state_dir, 0, upto)
    plain = _plain(posts.sparkSession, state_dir)
    if plain:  # the folders of the commit, see there
        os.makedirs(os.path.join(plain, "data", folder, "_temporary", "0", "_temporary"))
    tasks = 1 + int(posts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // TASK_BYTES
    _writer(posts.coalesce(min(tasks, MOST_TASKS))).mode("append").parquet(path)
    return {"folder": folder, "level": 0, "upto": upto, "posts": True}


def _write_snapshot(spark: SparkSession, state_dir: str, level: int, upto: int, delta: DataFrame, tasks: int | None = None) -> dict:
    """One snapshot: tag rows and pair rows side by side in one job; which of the two there are is noted, and the ``tasks`` its rows are worth."""
    folder, path = _folder(state_dir, level, upto)
    with _shuffles_of(spark, tasks):
        _writer(delta).partitionBy("part").parquet(path)
    has = {part: path_exists(spark, os.path.join(path, f"part={part}")) for part in ("profile", "pairs")}
    return {"folder": folder, "level": level, "upto": upto, "tasks": tasks, **has}


def _delta(profile: DataFrame, pairs: DataFrame) -> DataFrame:
    return (profile.withColumn("part", F.lit("profile"))
            .unionByName(pairs.withColumn("part", F.lit("pairs")), allowMissingColumns=True))


def _extent(posts: DataFrame) -> tuple[bool, int]:
    """Whether one of the posts is long, and how many tasks their tags and pairs are worth: one small job."""
    size = posts.selectExpr("CAST(size(hashtags) AS LONG) AS k").selectExpr("max(k) AS longest", "sum(k + k * (k - 1) DIV 2) AS n").first()
    return (size["longest"] or 0) > ARRAY_PAIR_LIMIT, 1 + int(size["n"] or 0) // TASK_ROWS


def _counted(posts: DataFrame) -> tuple[DataFrame, int]:
    """The sums of posts, and how many tasks their rows are worth: tags and pairs side by side in one aggregate, so they are one shuffle.

    The plan for long posts (more shuffles) is made only where there is one.
    """
    long, tasks = _extent(posts)
    posts = posts if long else posts.coalesce(tasks)
    tags = tag_occurrences(posts, "sentiment").selectExpr(
        "'profile' AS part", "tag AS id", "CAST(NULL AS STRING) AS src", "CAST(NULL AS STRING) AS dst", "1L AS weight", "sentiment")
    pairs = post_pairs(posts, "auto" if long else "array").selectExpr(
        "'pairs' AS part", "CAST(NULL AS STRING) AS id", "src", "dst", "weight", "CAST(NULL AS STRING) AS sentiment")
    counts = [f"count_if(sentiment = '{s}') AS {s}" for s in SENTIMENTS]
    return tags.union(pairs).groupBy("part", "id", "src", "dst").agg(
        F.expr("CAST(sum(weight) AS LONG) AS weight"), F.expr("CAST(sum(weight) AS LONG) AS degree"), *[F.expr(c) for c in counts]), tasks


def write_deltas(posts: DataFrame, state_dir: str, batch_id: int, stream: str = "") -> None:
    """Take in one batch of ``stream``: its snapshot, the sums of levels that are full, then the pointer."""
    spark = posts.sparkSession
    pointer = _current(spark, state_dir) or {"stream": stream, "batch": -1, "version": 0, "snapshots": [], "dropped": []}
    if pointer["stream"] != stream:
        raise ValueError(f"{state_dir} holds batches of another stream; start with an empty state folder")
    if batch_id <= pointer["batch"]:
        return  # a replay of a batch that is counted
    _drop_unfinished(spark, state_dir, pointer["batch"])
    snapshots = [*pointer["snapshots"], _write_posts(state_dir, batch_id, posts)]
    snapshots, dropped = _levelled(spark, state_dir, snapshots)
    _point(spark, state_dir, {"stream": stream, "batch": batch_id, "version": 0, "snapshots": snapshots,
                              "dropped": [*pointer["dropped"], *[{"folder": d, "batch": batch_id} for d in dropped]]})


def _levelled(spark: SparkSession, state_dir: str, snapshots: list[dict]) -> tuple[list[dict], list[str]]:
    """Sum the levels that hold ``FAN`` snapshots, from the bottom up."""
    dropped, level = [], 0
    while any(s["level"] >= level for s in snapshots):
        full = [s for s in snapshots if s["level"] == level]
        if len(full) >= FAN:
            snapshots, gone = _merged(spark, state_dir, snapshots, full, level + 1)
            dropped += gone
        level += 1
    return snapshots, dropped


def _merged(spark: SparkSession, state_dir: str, snapshots: list[dict], some: list[dict], level: int) -> tuple[list[dict], list[str]]:
    one = _sum_of(spark, state_dir, some, level)
    return [*[s for s in snapshots if s not in some], one], [s["folder"] for s in some]


def _sum_of(spark: SparkSession, state_dir: str, some: list[dict], level: int) -> dict:
    """One snapshot in place of ``some``; posts are counted first, on their own."""
    raw, upto = [s for s in some if s.get("posts")], max(s["upto"] for s in some)
    if len(raw) == len(some):
        return _write_snapshot(spark, state_dir, level, upto, *_counted(_read_posts(spark, state_dir, raw)))
    counted = [s for s in some if not s.get("posts")]
    if raw:
        first = _sum_of(spark, state_dir, raw, 1)
        one = _sum_of(spark, state_dir, [*counted, first], level)
        remove(spark, os.path.join(state_dir, "data", first["folder"]))
        return one
    tasks = [s.get("tasks") for s in some]
    summed = _delta(_sum_profile(spark, state_dir, some), _sum_pairs(spark, state_dir, some))
    return _write_snapshot(spark, state_dir, level, upto, summed, sum(tasks) if all(tasks) else None)


def compact(spark: SparkSession, state_dir: str) -> None:
    """Sum all batches published so far into one snapshot. Not needed for bounded reads; run it between batches, never beside one."""
    pointer = _current(spark, state_dir)
    if pointer and len(pointer["snapshots"]) > 1:
        snapshots, dropped = _merged(spark, state_dir, pointer["snapshots"], pointer["snapshots"],
                                     max(s["level"] for s in pointer["snapshots"]) + 1)
        _point(spark, state_dir, {**pointer, "version": pointer["version"] + 1, "snapshots": snapshots,
                                  "dropped": [*pointer["dropped"], *[{"folder": d, "batch": pointer["batch"]} for d in dropped]]})


def _stream_id(spark: SparkSession, checkpoint_dir: str) -> str | None:
    """The id that a checkpoint gives its stream; None before its first start."""
    path = os.path.join(checkpoint_dir, "metadata")
    return json.loads(_read_small(spark, checkpoint_dir, "metadata"))["id"] if path_exists(spark, path) else None


def start_graph_stream(spark: SparkSession, input_dir: str, state_dir: str, checkpoint_dir: str,
                       dedupe: bool = True, trigger: str | None = "30 seconds",
                       max_files_per_trigger: int | None = None, dedupe_within: str | None = None) -> StreamingQuery:
    """Maintain the graph of a folder of wire files.

    ``dedupe=True`` uses the wire's (distinct) tags; ``dedupe=False``
    re-extracts tags from the text, so the graph equals the batch graph of
    the same posts. ``dedupe_within`` (an interval of event time): a post that is sent again counts once. Raises ``ValueError`` for a
    checkpoint other than the one that the state folder's batches belong to.
    """
    pointer = _current(spark, state_dir)
    if pointer and pointer["stream"] != _stream_id(spark, checkpoint_dir):
        raise ValueError(f"{state_dir} holds batches of another checkpoint; start with an empty state folder")
    decoded = decode_wire(read_wire_stream(spark, input_dir, max_files_per_trigger), keep_event_time=bool(dedupe_within))
    if dedupe_within:
        decoded = once_each(decoded, dedupe_within)

    stream: list[str | None] = []

    def on_batch(posts: DataFrame, batch_id: int) -> None:
        if not stream:
            stream.append(_stream_id(spark, checkpoint_dir))
        write_deltas(posts, state_dir, batch_id, stream[0])

    writer = (_posts_of(decoded, dedupe).writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint_dir))
    return start_with(spark, _apply_trigger(writer, trigger), log_conf(spark, checkpoint_dir) | upkeep_conf(spark))


def _read_posts(spark: SparkSession, state_dir: str, snapshots: list[dict]) -> DataFrame:
    return spark.read.schema(POSTS).parquet(*[os.path.join(state_dir, "data", s["folder"]) for s in snapshots if s.get("posts")])


def _read_part(spark: SparkSession, state_dir: str, snapshots: list[dict], part: str, schema: str) -> DataFrame:
    paths = [os.path.join(state_dir, "data", s["folder"], f"part={part}") for s in snapshots if s.get(part)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _sum_profile(spark: SparkSession, state_dir: str, snapshots: list[dict]) -> DataFrame:
    prof = _read_part(spark, state_dir, snapshots, "profile", PROFILE)
    if any(s.get("posts") for s in snapshots):
        prof = prof.unionByName(sentiment_profile(_read_posts(spark, state_dir, snapshots)))
    return prof.groupBy("id").agg(F.sum("degree").alias("degree"), *[F.sum(s).alias(s) for s in SENTIMENTS])


def _sum_pairs(spark: SparkSession, state_dir: str, snapshots: list[dict]) -> DataFrame:
    pairs = _read_part(spark, state_dir, snapshots, "pairs", PAIRS)
    if any(s.get("posts") for s in snapshots):
        posts = _read_posts(spark, state_dir, snapshots)
        pairs = pairs.unionByName(post_pairs(posts, "auto" if _extent(posts)[0] else "array"))
    return pairs.groupBy("src", "dst").agg(F.sum("weight").cast("long").alias("weight"))


def _snapshots(spark: SparkSession, state_dir: str) -> list[dict]:
    pointer = _current(spark, state_dir)
    return pointer["snapshots"] if pointer else []


def live_vertices(spark: SparkSession, state_dir: str) -> DataFrame:
    """Current vertices ``(id, degree, dominant_sentiment)``; to be read before ``KEEP`` more batches."""
    return vertices_from_profile(_sum_profile(spark, state_dir, _snapshots(spark, state_dir)))


def live_edges(spark: SparkSession, state_dir: str) -> DataFrame:
    """Current edges ``(src, dst, weight)``; to be read before ``KEEP`` more batches."""
    return _sum_pairs(spark, state_dir, _snapshots(spark, state_dir))
