"""Merkle manifest of a dataset: checkpoint-and-recompute.

Rows are hashed to leaves, ordered within their group, and every two consecutive nodes are hashed
to one until a group has one node, its subroot; the subroots, ordered by group, are reduced likewise to the root.
Only every ``SPAN``-th level is stored. A stored row holds one aligned subtree: the at most ``2^SPAN`` nodes of
a level that end in one node of the next stored level. A proof regenerates the levels between from that row, takes the
siblings of its nodes and drops the rest; then the path of the subtree's top follows, from the next stored level.

All of it is joins, grouping and higher-order functions, a row never holds more than a subtree, and the driver
sees the number of rows and the largest group's size alone. Nodes are lowercase hex digests.

Edge cases: an empty table has an empty manifest; a null field counts as ``-``; null group and null key come first; rows with one
key are ordered by leaf, and equal rows hold neighbouring places; a group or a table of one row is its own root, with an empty path.
Extra columns pass by unread unless ``carry`` names them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

#: Levels from one stored level to the next; a subtree has at most 2^SPAN nodes at its bottom.
SPAN = 8
#: Nodes that a task regenerates, about.
TASK_NODES = 1 << 14
MOST_TASKS = 20_000


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """The hash of a row's fields, in this order."""
    return digest(*[field(c) for c in columns])


@dataclass
class Manifest:
    """Stored levels of the groups' trees (bottom first) and of the tree over the subroots, each a table of subtrees."""

    groups: list[DataFrame]
    top: list[DataFrame]
    carry: tuple[str, ...]


def _numbered(nodes: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``nodes`` with ``_pos`` (place within ``_g`` by ``order``, from 0) and ``_size`` (rows of ``_g``).

    A range shuffle puts the rows in order over all tasks, a hot group or key over many of them (``_row`` parts equal rows);
    places follow from the rows that each task holds of a group.
    """
    sorted_ = materialize(nodes.repartitionByRange("_g", *order, "_row").sortWithinPartitions("_g", *order, "_row")
                          .withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("_at", 33)
    runs = sorted_.groupBy("_g", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(runs.select("_g", "_part", "_first", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                                   F.sum("_n").over(Window.partitionBy("_g")).alias("_size")), "merkle-runs")
    out = sorted_.withColumn("_part", part).join(runs, ["_g", "_part"]).withColumn(
        "_pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_first", "_n", "_before", "_at", "_row")
    out._reads = (sorted_, runs)
    return out


def _height(size: Column) -> Column:
    """Levels above the leaves of a tree of ``size`` leaves."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0)


def _blocks(nodes: DataFrame, n: int, *payload: str) -> DataFrame:
    """One row for each subtree: ``_g, _b, _rest`` (levels up to the group's top), ``_items`` in order.

    ``n``: about how many nodes there are; they are dealt over so many tasks, whatever their bytes.
    """
    items = F.array_sort(F.collect_list(F.struct("_pos", "_node", *payload)))
    dealt = nodes.withColumn("_b", F.shiftright("_pos", SPAN)).repartition(min(1 + n // TASK_NODES, MOST_TASKS), "_g", "_b")
    return dealt.groupBy("_g", "_b").agg(F.first("_rest").alias("_rest"), items.alias("_items"))


def _regenerated(blocks: DataFrame) -> DataFrame:
    """Adds the levels ``_l0`` .. of every subtree as arrays; those above ``_rest`` repeat the last one."""
    out = blocks.withColumn("_l0", F.transform("_items", lambda x: x["_node"]))
    for k in range(SPAN):
        # every two consecutive nodes hashed to one, a last one alone
        out = out.selectExpr("*", f"""CASE WHEN _rest > {k} THEN transform(sequence(0, (size(_l{k}) - 1) DIV 2), i ->
            sha2(concat(get(_l{k}, CAST(2 * i AS INT)), coalesce(get(_l{k}, CAST(2 * i + 1 AS INT)), '')), 256)) ELSE _l{k} END AS _l{k + 1}""")
    return out


def _stored_levels(numbered: DataFrame, n: int, height: int, payload: tuple[str, ...]) -> list[DataFrame]:
    """Level 0, SPAN, 2 SPAN ... as tables of subtrees; the last one ends in the tops of the groups."""
    levels = [materialize(_blocks(numbered.withColumn("_rest", _height(F.col("_size"))), n, *payload), "merkle-level")]
    while height > SPAN:
        height, n = height - SPAN, n >> SPAN
        levels.append(materialize(_blocks(_tops(levels[-1]), n), "merkle-level"))
    return levels


def _tops(blocks: DataFrame) -> DataFrame:
    """The nodes that the subtrees of a stored level end in, with their place in the level SPAN above."""
    return _regenerated(blocks).select("_g", F.col("_b").alias("_pos"), F.get(f"_l{SPAN}", F.lit(0)).alias("_node"),
                                       F.greatest(F.col("_rest") - SPAN, F.lit(0)).alias("_rest"))


def _tree(nodes: DataFrame, order: tuple[str, ...], payload: tuple[str, ...] = ()) -> list[DataFrame]:
    numbered = _numbered(nodes, order)
    n, size = numbered._reads[1].agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_size"), F.lit(0))).first()
    levels = _stored_levels(numbered, n, max(size - 1, 0).bit_length(), payload)
    discard(*numbered._reads)
    return levels


def build(df: DataFrame, group: Column, key: Column, leaf: Column, carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``df``: leaves grouped by ``group`` and ordered by ``key``, then leaf.

    ``carry``: more columns to be kept beside each leaf, returned by ``proofs``.
    """
    carry = carry or {}
    names = {n: f"_c{i}" for i, n in enumerate(carry)}
    # written first: the rows are read and hashed once, and the range shuffle may be run again on the same leaves
    leaves = materialize(df.select(F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")).alias("_g"), key.alias("_k"),
                                   leaf.alias("_node"), *[c.alias(names[n]) for n, c in carry.items()],
                                   F.monotonically_increasing_id().alias("_row")), "merkle-leaves")
    groups = _tree(leaves, ("_k", "_node"), ("_k", *names.values()))
    discard(leaves)
    subroots = materialize(_tops(groups[-1]).select(F.lit("").alias("_g"), F.col("_g").alias("_k"), "_node", F.lit(0).alias("_row")), "merkle-subroots")
    top = _tree(subroots, ("_k",), ("_k",))
    discard(subroots)
    return Manifest(groups, top, tuple(carry))


def _paths(blocks: DataFrame) -> DataFrame:
    """Every node of a stored level with its siblings inside its subtree: ``_g, _b, _item, _path``.

    A step of the path is ``(sibling, left)``; a node alone in its run has the sibling ``''``.
    """
    steps = ", ".join(f"struct(coalesce(get(_l{k}, shiftright(i, {k}) ^ 1), '') AS sibling, shiftright(i, {k}) & 1 = 1 AS left)" for k in range(SPAN))
    return _regenerated(blocks).selectExpr("_g", "_b", f"inline(transform(_items, (x, i) -> struct(x AS _item, slice(array({steps}), 1, least(_rest, {SPAN})) AS _path)))")


def _down(levels: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """Paths of the bottom nodes of a tree to its top: those inside each subtree, then those of the subtree's top.

    ``above``: ``_g, _node, _over`` and the path from each group's top on; each level is joined with the
    one above it, which is smaller by 2^SPAN, on (group, subtree).
    """
    for level in reversed(levels):
        here = _paths(level)
        if above is None:
            above = here
        else:
            here = here.join(above.select(F.col("_g").alias("_ug"), F.col("_item._pos").alias("_ub"), F.col("_path").alias("_up")),
                             (F.col("_g") == F.col("_ug")) & (F.col("_b") == F.col("_ub")))
            above = here.select("_g", "_b", "_item", F.concat("_path", "_up").alias("_path"))
    return above


def proofs(manifest: Manifest) -> DataFrame:
    """``key, leaf, subroot, root, path`` and the carried columns of every row; ``path``: steps ``(sibling, left)`` from the leaf to the root."""
    tops = _tops(manifest.top[-1]).select(F.col("_g").alias("_rg"), F.col("_node").alias("root"))
    # one row for each group: its subroot and the path from there to the root
    groups = materialize(_down(manifest.top, None).join(tops, F.col("_g") == F.col("_rg")).select(
        F.col("_item._k").alias("_sg"), F.col("_item._node").alias("subroot"), "root", F.col("_path").alias("_last")), "merkle-groups")
    rows = _down(manifest.groups, None)
    names = [F.col(f"_item._c{i}").alias(n) for i, n in enumerate(manifest.carry)]
    return rows.join(groups, F.col("_g") == F.col("_sg")).select(
        F.col("_item._k").alias("key"), F.col("_item._node").alias("leaf"), "subroot", "root", F.concat("_path", "_last").alias("path"), *names)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of a path give."""
    return F.aggregate(path, leaf, lambda node, s: F.when(s["left"], digest(s["sibling"], node)).otherwise(digest(node, s["sibling"])))


def proof_digest(path: Column) -> Column:
    """The hash of a path's siblings, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s["sibling"]), ""), 256)


DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_proofs(docs: DataFrame) -> DataFrame:
    """Leaves, roots and proofs of ``documents``, and whether rows still fold to the root after a tampering.

    Rows whose id's crc32 is a multiple of 7 are folded from a leaf with ``n_chars + 1`` in place of ``n_chars``; a null
    ``doc_id`` or ``n_chars`` stays as it is.
    """
    columns = {c: F.col(c) for c in DOCUMENT_FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    forged = leaf(*({**columns, "n_chars": F.col("n_chars") + 1}).values())
    manifest = build(docs, F.col("lang"), F.col("doc_id"), leaf(*columns.values()), {"forged": F.when(hit, forged)})
    found = proofs(manifest).select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                                    fold(F.coalesce("forged", "leaf"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


#: DuckDB twin of ``document_proofs``. The leaves' order needs doc_id to be unique within a lang, or equal ids to differ in their leaf.
MERKLE_SQL = """
WITH RECURSIVE
fields AS (
  SELECT doc_id, lang, doc_id IS NOT NULL AND n_chars IS NOT NULL AS can_differ,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS n,
         coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR), '-') AS n_more,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents),
-- crc32 of the decimal id, bit by bit: eight shifts a byte, in the reflected polynomial
crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, 4294967295::BIGINT AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, i + 1, list_reduce(list_prepend(xor(c, ascii(substr(s, i + 1, 1))::BIGINT), [1::BIGINT, 1, 1, 1, 1, 1, 1, 1]),
         lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
  FROM crc WHERE i < length(s)),
hit AS (SELECT doc_id FROM crc WHERE i = length(s) AND xor(c, 4294967295::BIGINT) % 7 = 0),
leaves AS (
  SELECT f.doc_id, f.lang, sha256(head || n || tail) AS leaf,
         CASE WHEN h.doc_id IS NOT NULL THEN sha256(head || n_more || tail) ELSE sha256(head || n || tail) END AS used
  FROM fields f LEFT JOIN hit h ON f.doc_id = h.doc_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
tree AS (
  SELECT lang, 0 AS level, pos, n, leaf AS node FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(node, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY lang, level, pos // 2),
subroots AS (SELECT lang, node AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, n, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 2),
heights AS (SELECT lang, max(level) AS h FROM tree GROUP BY lang),
steps AS (
  SELECT p.lang, p.pos, t.level, (p.pos >> t.level) & 1 = 1 AS is_right, s.node AS sibling
  FROM placed p JOIN heights h ON p.lang IS NOT DISTINCT FROM h.lang
  JOIN (SELECT DISTINCT lang, level FROM tree) t ON p.lang IS NOT DISTINCT FROM t.lang AND t.level < h.h
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = t.level AND s.pos = xor(p.pos >> t.level, 1)
  UNION ALL
  SELECT p.lang, p.pos, h.h + t.level, (r.pos >> t.level) & 1 = 1, s.node
  FROM placed p JOIN heights h ON p.lang IS NOT DISTINCT FROM h.lang JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
  JOIN (SELECT DISTINCT level FROM top WHERE n > 1) t ON true
  LEFT JOIN top s ON s.level = t.level AND s.pos = xor(r.pos >> t.level, 1)),
path AS (
  SELECT lang, pos, list(coalesce(sibling, '') ORDER BY level) AS siblings, list(is_right ORDER BY level) AS rights FROM steps GROUP BY lang, pos),
folding AS (
  SELECT p.doc_id, p.lang, p.pos, p.leaf, coalesce(a.siblings, []) AS siblings, coalesce(a.rights, []) AS rights, 0 AS i, p.used AS node
  FROM placed p LEFT JOIN path a ON p.lang IS NOT DISTINCT FROM a.lang AND p.pos = a.pos
  UNION ALL
  SELECT doc_id, lang, pos, leaf, siblings, rights, i + 1,
         sha256(CASE WHEN rights[i + 1] THEN siblings[i + 1] || node ELSE node || siblings[i + 1] END)
  FROM folding WHERE i < len(siblings))
SELECT f.doc_id, f.leaf, r.subroot, t.node AS root, sha256(coalesce(array_to_string(f.siblings, ''), '')) AS proof_sha256,
       f.node AS folded_root, f.node = t.node AS verified
FROM folding f JOIN subroots r ON f.lang IS NOT DISTINCT FROM r.lang JOIN top t ON t.n = 1
WHERE f.i = len(f.siblings)
"""
