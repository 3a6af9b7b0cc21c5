"""URL filtering by rules and, where none fits, by a path-template tree for each host.

Every path becomes a sequence of typed segments (numbers and identifiers as ``{n}`` and ``{id}``, extensions
kept). Urls are reduced to distinct (host, typed path) rows with their counts first; the tree is grown on those. Level by level, below each
node, segments that are many and each rare become the wildcard ``*``, and branches that look alike, by
what follows them and by the share of blocked urls in them, merge. A template's share of urls that the rules block is smoothed towards
its host's share, and that towards the share of all urls; templates whose smoothed share reaches the threshold are rejected.

DataFrame functions only. Counts are combined before they shuffle and templates come back by plain equi-joins with
written tables, so a host with a third of all urls spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

#: (verdict, host, path): the host and all its subdomains, paths that start so.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Levels of the tree; what lies deeper in a path is one last segment, ``**`` if there is any.
LEVELS = 4
#: A node's children are variable if there are so many and each has at most twice its even share.
MANY = 12
#: Largest Hellinger distance between what follows a branch and what follows its group.
ALIKE = 0.25
#: Weight of the host's share in a template's, and of the overall share in a host's.
PRIOR = 4.0
THRESHOLD = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLLOWS = ("end", "number", "id", "word")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path after the first ``://``; both empty for a null url or one without it."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none does) and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # the last that fits wins
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        name, verdict = F.when(fits, f"{domain}{start}").otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def typed_path(path: Column, levels: int = LEVELS) -> Column:
    """The path's segments with numbers and identifiers replaced by their kind."""
    def typed(segment: Column) -> Column:
        end = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
        stem = F.substr(segment, F.lit(1), F.length(segment) - F.length(end))
        kind = F.when(stem.rlike(r"^[0-9]+$"), "{n}").when(
            stem.rlike(r"^(?=.*[0-9])[0-9A-Za-z_-]{6,}$") | stem.rlike(r"^[0-9]+[-_.][0-9._-]+$"), "{id}").otherwise(stem)
        return F.concat(kind, end)
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    segments = F.when(path == "", F.array().cast("array<string>")).otherwise(F.transform(segments, typed))
    deep = F.when(F.size(segments) > levels, F.concat(F.slice(segments, 1, levels), F.array(F.lit("**"))))
    return F.array_join(F.coalesce(deep, segments), "/")


def _grow(paths: DataFrame, level: int) -> DataFrame:
    """Generalise the segments of one level: ``paths(host, typed, n, bad, template)`` with one more segment in ``template``."""
    at = lambda i: F.get(F.split("typed", "/"), F.lit(i))
    rows = paths.withColumn("segment", F.coalesce(at(level), F.lit("")))
    nxt = at(level + 1)
    kind = F.when(nxt.isNull(), "end").when(nxt.startswith("{n}"), "number").when(nxt.startswith("{id}"), "id").otherwise("word")
    key = ["host", "template", "segment"]
    child = rows.withColumn("kind", kind).groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"),
        *[F.sum(F.when(F.col("kind") == f, F.col("n")).otherwise(0)).alias(f) for f in _FOLLOWS])
    child = materialize(child.withColumn("like", F.concat_ws(":",
        F.array_max(F.array(*[F.struct(F.col(f).alias("n"), F.lit(f).alias("kind")) for f in _FOLLOWS]))["kind"],
        F.floor((F.col("bad") + 0.5) / (F.col("n") + 1) * 3).cast("string"))), "children")
    parent = materialize(child.groupBy("host", "template").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("children")), "parents")
    group = materialize(child.groupBy("host", "template", "like").agg(
        F.count(F.lit(1)).alias("alike"), F.sum("n").alias("g_n"), *[F.sum(f).alias(f"g_{f}") for f in _FOLLOWS]), "groups")
    apart = F.sqrt(F.greatest(F.lit(0.0), 1 - sum(F.sqrt(F.col(f) / F.col("n") * F.col(f"g_{f}") / F.col("g_n")) for f in _FOLLOWS)))
    literal = ~F.col("segment").startswith("{") & ~F.col("segment").isin("", "**")
    variable = literal & (F.col("children") >= MANY) & (F.col("n") * F.col("children") <= 2 * F.col("all"))
    merged = literal & (F.col("alike") > 1) & (apart <= ALIKE)
    general = child.join(parent, ["host", "template"]).join(group, ["host", "template", "like"]).select(
        *key, F.when(variable, "*").when(merged, F.concat(F.lit("<"), "like", F.lit(">"))).otherwise(F.col("segment")).alias("general"))
    general = materialize(general, "general")
    out = rows.join(general, key)
    more = F.size(F.split("typed", "/")) > level
    grown = materialize(out.select("host", "typed", "n", "bad", F.when(
        more, F.concat("template", F.lit("/"), "general")).otherwise(F.col("template")).alias("template")), "paths")
    discard(paths, child, parent, group, general)
    return grown


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, blocked_share)`` for each row of ``pages(page_id, url)``.

    ``rule`` is the longest rule that fits, else null; ``verdict`` is the rule's, else ``block`` if the smoothed share of blocked urls
    of the url's template reaches ``threshold``, else ``allow``. Urls that no rule decides count as not blocked in the
    shares. Null, empty and malformed urls have an empty host and path and form a template of their own. Rows repeat as
    they come; other columns are ignored. Rules of equal length: the last in alphabetical order of (verdict, host, path) wins.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": rule, "rule_verdict": verdict, "typed": typed_path(F.col("path"))})
    paths = materialize(urls.groupBy("host", "typed").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("bad"))
        .withColumn("template", F.lit("")), "paths")
    total = paths.agg(F.sum("bad"), F.sum("n"), F.max(F.size(F.split("typed", "/")))).first()
    overall = (total[0] or 0) / (total[1] or 1)
    for level in range(total[2] or 0):  # LEVELS + 1 at most
        paths = _grow(paths, level)
    hosts = materialize(paths.groupBy("host").agg(
        ((F.sum("bad") + PRIOR * overall) / (F.sum("n") + PRIOR)).alias("host_share")), "hosts")
    templates = paths.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(hosts, "host")
    templates = materialize(templates.select("host", "template", ((F.col("bad") + PRIOR * F.col("host_share"))
                                                                  / (F.col("n") + PRIOR)).alias("blocked_share")), "templates")
    known = materialize(paths.select("host", "typed", "template").join(templates, ["host", "template"]), "judged-paths")
    discard(paths, hosts, templates)
    return urls.join(known, ["host", "typed"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("blocked_share") >= threshold, "block").otherwise("allow")).alias("verdict"),
        "template", "blocked_share")
