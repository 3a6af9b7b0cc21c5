"""Hashtag co-occurrence graph: vertices, pairs, edges, summary.

Input is a DataFrame of posts with an ``array<string>`` column ``hashtags``
(order and duplicates as extracted) and, for vertex sentiment, a
``sentiment`` column. Everything is lazy.

Pair semantics: the pairs of one post are ``combinations(sorted(tags), 2)``,
so a repeated tag yields a self-loop ``(a, a)`` and multiplies its pairs:
``[b, a, a]`` gives ``(a, a)`` once and ``(a, b)`` twice. Edges are canonical
(``src <= dst``) and weighted by the number of pair occurrences.

Plans. Short posts (at most ``array_pair_limit`` tag occurrences) make their
pairs inside the row they live in; the only shuffle is the one of the edge
aggregate, after map-side partial sums. Long posts (whole documents with
thousands of distinct words) would put k^2/2 pairs into one task, so they
are reduced to distinct tags with multiplicities m (a self-loop weighs
``m(m-1)/2``, a pair ``m_a * m_b``) and cut into blocks of left tags that a
hash repartition spreads over tasks (see ``_block_pairs``).

Those plans shuffle pairs, after partial sums. Where the vocabulary is large, partial sums save little, and edges of a
written table (``keys="auto"``) are summed on a grid of tag groups instead, which shuffles tags only (see ``pair_grid``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import SENTIMENTS
from ..session import materialize as write_table
from .pair_grid import grid_edges, groups_for

# Tunables (not semantics): posts with more tag occurrences than this use the
# block plan; each block of such a post owns this many distinct left tags.
ARRAY_PAIR_LIMIT = 64
SALT_BLOCK = 256
# Hash-keyed edges: only for vocabularies of at least this many tags, and
# only when the dictionary (tag bytes + per-row overhead) fits this bound,
# which is what makes broadcasting it safe.
HASH_MIN_TAGS = 1024
DICT_BROADCAST_BYTES = 64 << 20
DICT_ROW_OVERHEAD = 32


def tag_occurrences(posts: DataFrame, *extra: str) -> DataFrame:
    """One row per tag occurrence: ``(tag, *extra)``. Posts without tags vanish.

    ``explode_outer`` plus a null filter instead of ``explode``: the optimizer
    would put a ``size(hashtags) > 0`` filter before an inner explode, which
    evaluates the tag regex a second time per row.
    """
    return (posts.select(F.explode_outer("hashtags").alias("tag"), *extra)
            .where(F.col("tag").isNotNull()))


def tag_counts(posts: DataFrame) -> DataFrame:
    """``(id, degree)``: occurrences per tag, repeats inside a post included."""
    return (tag_occurrences(posts).groupBy(F.col("tag").alias("id"))
            .agg(F.count(F.lit(1)).alias("degree")))


def tag_sentiment_counts(posts: DataFrame) -> DataFrame:
    """``(id, sentiment, n)``: occurrences per tag and post sentiment."""
    return (tag_occurrences(posts, "sentiment")
            .groupBy(F.col("tag").alias("id"), "sentiment")
            .agg(F.count(F.lit(1)).alias("n")))


def _argmax_sentiment(counts: list[tuple[Column, str]]) -> Column:
    """The sentiment with the largest count; a tie goes to the alphabetically first."""
    ranked = sorted(counts, key=lambda cs: cs[1])
    keys = [F.struct(c.alias("n"), F.lit(len(ranked) - i).alias("r"), F.lit(s).alias("s"))
            for i, (c, s) in enumerate(ranked)]
    return F.greatest(*keys).getField("s") if len(keys) > 1 else keys[0].getField("s")


def sentiment_profile(posts: DataFrame, sentiments: tuple[str, ...] = SENTIMENTS) -> DataFrame:
    """``(id, degree, <one count column per sentiment>)`` per tag, one aggregate.

    Additive: profiles of disjoint post sets sum to the profile of their
    union (the streaming graph keeps per-batch profiles).
    """
    occ = tag_occurrences(posts, "sentiment")
    return occ.groupBy(F.col("tag").alias("id")).agg(
        F.count(F.lit(1)).alias("degree"),
        *[F.count_if(F.col("sentiment") == F.lit(s)).alias(s) for s in sentiments])


def vertices_from_profile(profile: DataFrame, sentiments: tuple[str, ...] = SENTIMENTS) -> DataFrame:
    """``(id, degree, dominant_sentiment)`` from a (summed) sentiment profile."""
    named = [(F.col(s), s) for s in sentiments]
    return profile.select("id", F.col("degree").cast("long").alias("degree"),
                          _argmax_sentiment(named).alias("dominant_sentiment"))


def vertices(posts: DataFrame, sentiments: tuple[str, ...] | None = SENTIMENTS) -> DataFrame:
    """``(id, degree, dominant_sentiment)`` per tag.

    With the sentiment domain known (the default; ``with_sentiment`` only
    produces these three values) this is a single aggregate keyed by tag with
    one conditional count per sentiment: one shuffle, and a hot tag collapses
    to one partial row per task before it. ``sentiments=None`` accepts any
    label values and runs the general two-step plan (counts per tag and
    sentiment, then the argmax per tag). Ties go to the alphabetically first
    sentiment in both plans.
    """
    if sentiments is None:
        return _vertices_general(posts)
    return vertices_from_profile(sentiment_profile(posts, sentiments), sentiments)


def _vertices_general(posts: DataFrame) -> DataFrame:
    ts = tag_sentiment_counts(posts)
    return ts.groupBy("id").agg(
        F.sum("n").cast("long").alias("degree"),
        F.min_by("sentiment", F.struct(-F.col("n"), F.col("sentiment"))).alias("dominant_sentiment"))


def dominant_sentiment(posts: DataFrame, sentiments: tuple[str, ...] | None = SENTIMENTS) -> DataFrame:
    """``(id, dominant_sentiment)``."""
    return vertices(posts, sentiments).select("id", "dominant_sentiment")


def _sorted(posts: DataFrame, presorted: bool, *extra: str) -> DataFrame:
    tags = F.col("hashtags") if presorted else F.array_sort("hashtags")
    return posts.select(tags.alias("_s"), *extra)


def _array_pairs(posts: DataFrame, *extra: str, presorted: bool = False,
                 max_tags: int | None = None) -> DataFrame:
    """Row-local pairs: ``combinations(sorted(tags), 2)``, weight 1 per occurrence.

    Rows with more than ``max_tags`` tags are skipped inside the generator
    (a ``when``), not by a filter: a filter would be pushed below the
    projection and evaluate the tag regex a second time.
    """
    s = _sorted(posts, presorted, *extra)
    sorted_tags = F.col("_s")
    pairs = F.flatten(F.transform(
        sorted_tags,
        lambda x, i: F.transform(F.slice(sorted_tags, i + 2, F.size(sorted_tags)),
                                 lambda y: F.struct(x.alias("src"), y.alias("dst")))))
    if max_tags is not None:
        pairs = F.when(F.size(sorted_tags) <= max_tags, pairs)
    return (s.select(F.explode_outer(pairs).alias("_p"), *extra)
            .where(F.col("_p").isNotNull())
            .select(F.col("_p.src").alias("src"), F.col("_p.dst").alias("dst"),
                    F.lit(1).cast("long").alias("weight"), *extra))


def _block_pairs(posts: DataFrame, *extra: str, block: int = SALT_BLOCK, partitions: int | None = None,
                 presorted: bool = False, min_tags: int = 2) -> DataFrame:
    """Pairs of long posts over distinct tags with multiplicities, split into blocks.

    Copies of a post are collapsed first, with map-side combine. The sorted tag array gives its distinct tags ``d``
    and multiplicities ``m`` from run lengths (linear in the post). The post
    then becomes ``ceil(n / block)`` block rows; block ``b`` owns the left
    tags ``d[b*block : (b+1)*block]`` and carries only the suffix of ``d``/``m``
    it needs. A hash repartition on (post fingerprint, block) with an
    explicit partition count (which adaptive execution leaves as is) spreads
    the blocks of one hot post over many tasks before the pairs are exploded.
    Posts with fewer than ``min_tags`` tags make no block (a ``when`` inside
    the expressions, not a filter, so the tag regex runs once per row). Columns ``extra`` are kept beside
    the pairs; copies are then posts that agree in them too.
    """
    spark = posts.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = _sorted(posts, presorted, *extra)
    srt = F.col("_s")
    k = F.size(srt)
    starts = F.filter(F.sequence(F.lit(0), k - 1),
                      lambda i: (i == 0) | (F.get(srt, i) != F.get(srt, i - 1)))
    # copies of a post are one row with a count: a post that was shared ten thousand times is paired once
    # (a generated column: the null filter is not pushed below it, so the tag regex runs once per row)
    long_posts = s.select(F.explode_outer(F.array(F.when(k >= min_tags, srt))).alias("_s"), *extra)
    same = long_posts.groupBy("_s", *extra).agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_s").isNotNull())
    runs = same.select("_s", "_copies", starts.alias("_st"), *extra)
    st = F.col("_st")
    # distinct tags with their multiplicity, as one sorted array of structs
    dm = runs.select(
        F.xxhash64("_s", *extra).alias("_fp"), "_copies", *extra,
        F.transform(st, lambda p, j: F.struct(
            F.get(srt, p).alias("tag"),
            (F.coalesce(F.get(st, j + 1), k) - p).cast("long").alias("m"))).alias("_dm"))
    n = F.size("_dm")
    nblocks = F.greatest(F.lit(1), F.ceil(n / F.lit(block))).cast("int")
    block_ids = F.when(F.col("_dm").isNotNull(), F.sequence(F.lit(0), nblocks - 1))
    blocks = (dm.select("_fp", "_copies", *extra, "_dm", F.explode_outer(block_ids).alias("_b"))
              .where(F.col("_b").isNotNull()))
    lo = F.col("_b") * F.lit(block)
    blocks = blocks.select("_fp", "_copies", *extra, "_b", F.slice("_dm", lo + 1, n).alias("_sfx"),
                           F.least(F.lit(block), n - lo).alias("_cnt"))
    spread = blocks.repartition(parts, "_fp", "_b")
    left = spread.select("_copies", *extra, "_sfx", F.posexplode(F.slice("_sfx", F.lit(1), F.col("_cnt"))).alias("_i", "_a"))
    tail = F.slice("_sfx", F.col("_i") + 1, F.size("_sfx") - F.col("_i"))
    pairs = left.select("_copies", *extra, "_a", F.posexplode(tail).alias("_j", "_z"))
    ma, mb = F.col("_a.m"), F.col("_z.m")
    weight = F.when(F.col("_j") == 0, F.floor(ma * (ma - 1) / 2)).otherwise(ma * mb)
    return (pairs.select(F.col("_a.tag").alias("src"), F.col("_z.tag").alias("dst"),
                         (weight * F.col("_copies")).cast("long").alias("weight"), *extra)
            .where(F.col("weight") > 0))


def post_pairs(posts: DataFrame, method: str = "auto", array_pair_limit: int = ARRAY_PAIR_LIMIT,
               salt_block: int = SALT_BLOCK, presorted: bool = False) -> DataFrame:
    """Weighted pair rows ``(src, dst, weight)``; their sum per pair is the edge weight.

    ``method``: ``array`` (row-local, one row per pair occurrence), ``blocks``
    (distinct tags with multiplicities, one row per post and distinct pair,
    hot posts split over tasks) or ``auto`` (array for posts with at most
    ``array_pair_limit`` tags, blocks for longer ones). Posts with fewer
    than two tags contribute nothing. ``presorted``: ``hashtags`` is already
    in the order that defines ``src <= dst`` (equal tags adjacent); its
    elements may be of any orderable type.
    """
    tagged = posts.select("hashtags")
    if method == "array":
        return _array_pairs(tagged, presorted=presorted)
    if method == "blocks":
        return _block_pairs(tagged, block=salt_block, presorted=presorted)
    if method != "auto":
        raise ValueError(f"Unknown pair method: {method}")
    return _array_pairs(tagged, presorted=presorted, max_tags=array_pair_limit).unionByName(
        _block_pairs(tagged, block=salt_block, presorted=presorted, min_tags=array_pair_limit + 1))


# Occurrences of a pair that one row lists at once.
_LISTED = 4096


def pair_occurrences(posts: DataFrame, array_pair_limit: int = ARRAY_PAIR_LIMIT) -> DataFrame:
    """``(src, dst, sentiment)``, one row per pair occurrence of each post.

    The unaggregated pair list; its size is the square of a post's tags, and :func:`edges` never lists it. Short posts list their pairs in
    their own row; long ones go through blocks that are spread over tasks, and a pair that occurs often is listed in several steps.
    """
    tagged = posts.select("hashtags", "sentiment")
    short = _array_pairs(tagged, "sentiment", max_tags=array_pair_limit).select("src", "dst", "sentiment")
    long = _block_pairs(tagged, "sentiment", min_tags=array_pair_limit + 1)
    first = long.select("src", "dst", "sentiment", "weight", F.explode(F.sequence(F.lit(1), F.col("weight"), F.lit(_LISTED))).alias("_at"))
    left = F.least(F.col("weight") - F.col("_at") + 1, F.lit(_LISTED)).cast("int")
    return short.unionByName(first.select("src", "dst", "sentiment", F.explode(F.array_repeat(F.lit(True), left)).alias("_one")).drop("_one"))


def tag_keys(posts: DataFrame) -> DataFrame:
    """``(tag, key)``: the distinct tags with their 64-bit key ``xxhash64(tag)``."""
    return tag_occurrences(posts).select("tag").distinct().select("tag", F.xxhash64("tag").alias("key"))


def key_stats(posts: DataFrame) -> dict:
    """One job over the distinct tags: their number, the number of distinct keys, total bytes."""
    row = tag_keys(posts).agg(
        F.count(F.lit(1)).alias("tags"), F.count_distinct("key").alias("keys"),
        F.coalesce(F.sum(F.octet_length("tag") + F.lit(DICT_ROW_OVERHEAD)), F.lit(0)).alias("bytes")).first()
    return row.asDict()


def _hash_plan_ok(st: dict) -> bool:
    return (st["tags"] == st["keys"] and st["tags"] >= HASH_MIN_TAGS
            and st["bytes"] <= DICT_BROADCAST_BYTES)


def _collapsed(posts: DataFrame, min_tags: int) -> DataFrame:
    """``(tags, copies)``: posts with at least two tags; copies of a post with ``min_tags`` tags or more are one row with their number."""
    s = _sorted(posts, False)
    k = F.size("_s")
    short = s.where(k.between(2, min_tags - 1)).select(F.col("_s").alias("tags"), F.lit(1).cast("long").alias("copies"))
    return short.unionByName(s.where(k >= F.lit(max(2, min_tags))).groupBy(F.col("_s").alias("tags")).agg(F.count(F.lit(1)).alias("copies")))


def _grid(posts: DataFrame, min_tags: int = ARRAY_PAIR_LIMIT + 1) -> DataFrame:
    """Edges by the grid plan; one small job counts the posts' distinct tags, which the number of groups follows from."""
    n_tags = posts.agg(F.coalesce(F.sum(F.size(F.array_distinct("hashtags")).cast("long")), F.lit(0))).first()[0]
    return grid_edges(_collapsed(posts, min_tags), groups_for(n_tags, posts.sparkSession.sparkContext.defaultParallelism))


def edges(posts: DataFrame, method: str = "auto", array_pair_limit: int = ARRAY_PAIR_LIMIT,
          salt_block: int = SALT_BLOCK, keys: str = "string") -> DataFrame:
    """``(src, dst, weight)`` with ``src <= dst``: pair occurrences per tag pair.

    ``keys``:

    * ``string`` (default) -- pairs are made and summed on the tag strings:
      one pass over the posts, one shuffle. Right for any vocabulary.
    * ``hash`` -- each post's tags are sorted as strings and encoded as
      ``xxhash64`` longs; pairs are made and summed on fixed-width keys
      (about half the cost per pair) and the strings are joined back from
      the distinct-tag dictionary, which is broadcast. Used only when one
      small job over the distinct tags proves the keys collision-free (so the
      result is exact) and the dictionary at most ``DICT_BROADCAST_BYTES``;
      otherwise ``string`` runs.
    * ``auto`` -- when the vocabulary holds at least ``HASH_MIN_TAGS`` tags (a
      small one has few distinct pairs, which partial sums collapse): with
      ``method="auto"`` the grid plan, which shuffles no pair, else ``hash``.
      The checks and the
      dictionary read ``posts`` again, so use ``hash``/``auto`` on a
      materialised tagged table (as the batch job does), not on raw text.
    """
    if keys not in ("auto", "hash", "string"):
        raise ValueError(f"Unknown key mode: {keys}")
    if keys != "string":
        st = key_stats(posts)
        if keys == method == "auto" and st["tags"] >= HASH_MIN_TAGS:
            return _grid(posts, array_pair_limit + 1)
        exact_and_bounded = st["tags"] == st["keys"] and st["bytes"] <= DICT_BROADCAST_BYTES
        keys = "hash" if (_hash_plan_ok(st) if keys == "auto" else exact_and_bounded) else "string"
    if keys == "string":
        return (post_pairs(posts, method, array_pair_limit, salt_block)
                .groupBy("src", "dst").agg(F.sum("weight").cast("long").alias("weight")))
    encoded = posts.select(F.transform(F.array_sort("hashtags"), lambda x: F.xxhash64(x)).alias("hashtags"))
    summed = (post_pairs(encoded, method, array_pair_limit, salt_block, presorted=True)
              .groupBy(F.col("src").alias("_hs"), F.col("dst").alias("_hd"))
              .agg(F.sum("weight").cast("long").alias("weight")))
    # written once: both sides read the same rows, however often a job recomputes its input
    dictionary = write_table(tag_keys(posts), "tag-dictionary")
    s_side, d_side = F.broadcast(dictionary.alias("_s")), F.broadcast(dictionary.alias("_d"))
    return (summed.join(s_side, F.col("_hs") == F.col("_s.key"))
            .join(d_side, F.col("_hd") == F.col("_d.key"))
            .select(F.col("_s.tag").alias("src"), F.col("_d.tag").alias("dst"), "weight"))


def pair_totals(posts: DataFrame) -> DataFrame:
    """One row: ``posts, tag_occurrences, total_pairs, self_loops``, without making a pair.

    A post with k tags has k(k-1)/2 pairs, and a tag that occurs twice in a post makes a
    self-loop, so both follow from the posts' own tag arrays.
    """
    # sorted once a row: an expression is evaluated again for every element of a lambda, a generated column is not
    posts = posts.select(F.explode_outer(F.array(F.array_sort("hashtags"))).alias("hashtags"))
    tags = F.col("hashtags")
    rows = posts.select(F.size("hashtags").cast("long").alias("k"),
                        F.array_distinct(F.filter(tags, lambda t, i: (i > 0) & (t == F.get(tags, i - 1)))).alias("twice"))
    sums = rows.agg(F.count_if(F.col("k") > 0).alias("posts"),
                    F.coalesce(F.sum("k"), F.lit(0)).alias("tag_occurrences"),
                    F.coalesce(F.sum(F.floor(F.col("k") * (F.col("k") - 1) / 2)), F.lit(0)).cast("long").alias("total_pairs"))
    loops = rows.select(F.explode("twice").alias("tag")).agg(F.count_distinct("tag").alias("self_loops"))
    cols = ["posts", "tag_occurrences", "total_pairs", "self_loops"]
    return sums.unionByName(loops, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in cols])


def graph_summary(v: DataFrame, e: DataFrame) -> DataFrame:
    """One row: ``vertices, tag_occurrences, edges, total_pairs, self_loops``.

    Two one-row aggregates stacked and folded; no join between them.
    """
    va = v.agg(F.count(F.lit(1)).alias("vertices"),
               F.coalesce(F.sum("degree"), F.lit(0)).cast("long").alias("tag_occurrences"))
    ea = e.agg(F.count(F.lit(1)).alias("edges"),
               F.coalesce(F.sum("weight"), F.lit(0)).cast("long").alias("total_pairs"),
               F.count_if(F.col("src") == F.col("dst")).alias("self_loops"))
    cols = ["vertices", "tag_occurrences", "edges", "total_pairs", "self_loops"]
    return (va.unionByName(ea, allowMissingColumns=True)
            .agg(*[F.max(c).cast("long").alias(c) for c in cols]))


def build_graph(posts: DataFrame, method: str = "auto", keys: str = "string") -> tuple[DataFrame, DataFrame]:
    """``(vertices, edges)`` of a post DataFrame with ``hashtags`` and ``sentiment``."""
    return vertices(posts), edges(posts, method, keys=keys)
