"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on the driver's pre-registered views (``orders``,
``lineitem``, ``part``, ``documents``, ``labels``, ``conversations`` ...).
The SQL is written independently of the Spark plans: edges come from the
multiplicity self-join, the dominant sentiment from a ranking window,
PageRank from unrolled iterations.
"""

from __future__ import annotations

from ..sources.fixtures import ORACLE_RAW, oracle_scored

TOP_N = 20

# Spelled out here, not shared with the Spark side: a wrong pattern there must not pass its own check.
TAG_PATTERN = r"#([\p{L}\p{N}_]+)"
SPACE_RUN_PATTERN = r"[\t\n\x0B\f\r ]+"
TOKEN_PATTERN = r"[\p{L}\p{N}_]+(?:'\p{L}+)?|[^\t\n\x0B\f\r \p{L}\p{N}_]"
PIECE_PATTERN = TOKEN_PATTERN + "|" + SPACE_RUN_PATTERN


def _with(body: str, view: str = "posts", *ctes: str) -> str:
    parts = [f"sp AS ({oracle_scored(view)})"] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + body


def _raw(body: str, view: str = "posts") -> str:
    return f"WITH rp AS ({ORACLE_RAW[view]})\n" + body


VERTICES = """
occ_v AS (SELECT unnest(hashtags) AS tag, sentiment FROM sp),
ts AS (SELECT tag AS id, sentiment, count(*) AS n FROM occ_v GROUP BY tag, sentiment),
ranked AS (SELECT id, sentiment, n, sum(n) OVER (PARTITION BY id) AS degree,
                  row_number() OVER (PARTITION BY id ORDER BY n DESC, sentiment) AS rk FROM ts),
vertices AS (SELECT id, CAST(degree AS BIGINT) AS degree, sentiment AS dominant_sentiment
             FROM ranked WHERE rk = 1)"""

EDGES = """
occ_e AS (SELECT id, unnest(hashtags) AS tag FROM sp),
mult AS (SELECT id, tag, count(*) AS m FROM occ_e GROUP BY id, tag),
pw AS (SELECT a.tag AS src, b.tag AS dst,
              CASE WHEN a.tag = b.tag THEN a.m * (a.m - 1) // 2 ELSE a.m * b.m END AS w
       FROM mult a JOIN mult b ON a.id = b.id AND a.tag <= b.tag),
edges AS (SELECT src, dst, CAST(sum(w) AS BIGINT) AS weight FROM pw WHERE w > 0 GROUP BY src, dst)"""

TOP = f"""
top AS (SELECT * FROM vertices ORDER BY degree DESC, id LIMIT {TOP_N})"""

SUMMARY = """
SELECT (SELECT count(*) FROM vertices) AS vertices,
       CAST((SELECT coalesce(sum(degree), 0) FROM vertices) AS BIGINT) AS tag_occurrences,
       (SELECT count(*) FROM edges) AS edges,
       CAST((SELECT coalesce(sum(weight), 0) FROM edges) AS BIGINT) AS total_pairs,
       (SELECT count(*) FROM edges WHERE src = dst) AS self_loops"""

COLOR = """CASE {c} WHEN 'positive' THEN '#4CAF50' WHEN 'negative' THEN '#F44336'
           WHEN 'neutral' THEN '#9E9E9E' ELSE '#9E9E9E' END"""

CENTRALITY_CTE = """
nbr AS (SELECT id, count(*) AS nd, sum(weight) AS wd FROM (
    SELECT src AS id, weight FROM edges WHERE src <> dst
    UNION ALL SELECT dst AS id, weight FROM edges WHERE src <> dst) u GROUP BY id)"""

CENTRALITY = """
SELECT v.id, CAST(coalesce(a.nd, 0) AS BIGINT) AS neighbor_degree,
       CAST(coalesce(a.wd, 0) AS BIGINT) AS weighted_degree,
       round(CAST(coalesce(a.nd, 0) AS DOUBLE) / CAST((SELECT count(*) FROM vertices) - 1 AS DOUBLE), 9)
         AS centrality
FROM vertices v LEFT JOIN nbr a ON v.id = a.id"""


def _pagerank_sql(iterations: int) -> str:
    ctes = ["""und AS (SELECT src AS s, dst AS d FROM edges WHERE src <> dst
                UNION ALL SELECT dst AS s, src AS d FROM edges WHERE src <> dst)""",
            "deg AS (SELECT s, count(*) AS k FROM und GROUP BY s)",
            "adj AS (SELECT u.s, u.d, CAST(1.0 AS DOUBLE) / CAST(deg.k AS DOUBLE) AS inv "
            "FROM und u JOIN deg ON u.s = deg.s)",
            "r0 AS (SELECT id, CAST(1.0 AS DOUBLE) AS rank FROM vertices)"]
    for i in range(1, iterations + 1):
        ctes.append(
            f"r{i} AS (SELECT v.id, CAST(0.15 AS DOUBLE) + CAST(0.85 AS DOUBLE) * coalesce(c.t, 0.0) AS rank "
            f"FROM vertices v LEFT JOIN (SELECT a.d AS id, sum(r.rank * a.inv) AS t FROM adj a "
            f"JOIN r{i - 1} r ON a.s = r.id GROUP BY a.d) c ON v.id = c.id)")
    return ",\n".join(ctes), f"SELECT id, round(rank, 6) AS rank FROM r{iterations}"


def _graph_sql(view: str, body: str, *extra: str) -> str:
    return _with(body, view, VERTICES, EDGES, *extra)


def _pagerank(view: str) -> str:
    ctes, body = _pagerank_sql(5)
    return _graph_sql(view, body, ctes)


def _centrality(view: str) -> str:
    return _graph_sql(view, CENTRALITY, CENTRALITY_CTE)


def _top_subgraph_edges(view: str) -> str:
    return _graph_sql(view, """
SELECT e.src AS source, e.dst AS target, e.weight,
       greatest(1.0, least(10.0, e.weight / 2.0)) AS width, '#666' AS color
FROM edges e WHERE e.src IN (SELECT id FROM top) AND e.dst IN (SELECT id FROM top)""", TOP)


def _top_vertices(view: str) -> str:
    return _with(f"SELECT * FROM vertices ORDER BY degree DESC, id LIMIT {TOP_N}", view, VERTICES)


# posts as they travel on the wire: distinct sorted tags, tagged posts only
DISTINCT = """
sd AS (SELECT id, text, list_sort(list_distinct(hashtags)) AS hashtags, sentiment, date
       FROM sp WHERE len(hashtags) > 0)"""


def _on_wire(cte: str) -> str:
    return cte.replace("FROM sp)", "FROM sd)")


def _strip_zone(c: str) -> str:
    t = f"regexp_extract_all({c}, '\\S+')"
    return (f"CASE WHEN len({t}) > 0 THEN array_to_string({t}[1:greatest(len({t}) - 2, 0)], ' ')"
            f" || ' ' || {t}[len({t})] END")


TOKEN_SPANS = f"""
WITH p AS (SELECT doc_id, pieces[k] AS piece, k
           FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{PIECE_PATTERN.replace("'", "''")}', 0)
                 AS pieces FROM documents) d, range(1, len(pieces) + 1) g(k)),
s AS (SELECT doc_id, k, piece,
             CASE WHEN regexp_full_match(piece, '{SPACE_RUN_PATTERN}') THEN 0 ELSE 1 END AS tok,
             coalesce(sum(length(piece)) OVER w, 0) AS "begin",
             coalesce(sum(CASE WHEN regexp_full_match(piece, '{SPACE_RUN_PATTERN}') THEN 0 ELSE 1 END)
                      OVER w, 0) AS pos
      FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id AS id, pos, "begin", "begin" + length(piece) - 1 AS "end", piece AS token FROM s WHERE tok = 1"""

_SLIDER = """
placed AS (SELECT *, row_number() OVER (ORDER BY degree DESC, id) AS rk FROM vertices),
settings AS (SELECT unnest(range(5, 51, 5)) AS top_n)"""

SLIDER_EDGES = """
SELECT CAST(n.top_n AS INTEGER) AS top_n, e.src AS source, e.dst AS target, e.weight,
       greatest(1.0, least(10.0, e.weight / 2.0)) AS width, '#666' AS color
FROM edges e JOIN placed a ON e.src = a.id JOIN placed b ON e.dst = b.id JOIN settings n ON a.rk <= n.top_n AND b.rk <= n.top_n"""

_FIELD = """'"' || replace(coalesce(CAST({c} AS VARCHAR), ''), '"', '""') || '"'"""
_SIX = [_FIELD.format(c=c) for c in ("sentiment_label", "id", "date", "query", '"user"', "replace(text, ' ', chr(10))")]

# minutes east of UTC, by id modulo ten
_ZONE_MINUTES = ("0", "-480", "-420", "-300", "-240", "60", "120", "540", "-210", "345")

_LOADED = """
SELECT id, text, array_to_string(hashtags, ' ') AS hashtags,
       CAST(epoch(try_strptime(date, '%a %b %d %H:%M:%S UTC %Y')) AS BIGINT) AS created_at_epoch,
       original_sentiment, has_hashtags FROM """

_BY_VALUE = "CASE WHEN {x} = 0 THEN 'negative' WHEN {x} = 4 THEN 'positive' ELSE 'neutral' END"

# naive Bayes on the labelled documents whose md5 fold is not 0, and its scores of all documents
_WEIGHTS = """
WITH labelled AS (
  SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS label,
         CAST('0x' || substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0 AS held_out
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
tf AS (SELECT doc_id, token, count(*) AS tf FROM (
         SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+')) AS token FROM documents) t GROUP BY doc_id, token),
seen AS (SELECT token, label, sum(tf) AS n FROM tf JOIN labelled USING (doc_id) WHERE NOT held_out GROUP BY token, label),
vocabulary AS (SELECT DISTINCT token FROM seen),
classes AS (SELECT label, count(*) AS texts FROM labelled WHERE NOT held_out GROUP BY label),
sizes AS (SELECT c.label, ln(c.texts / (SELECT sum(texts) FROM classes)) AS own,
                 (SELECT coalesce(sum(n), 0) FROM seen s WHERE s.label = c.label) + (SELECT count(*) FROM vocabulary) AS whole FROM classes c),
weights AS (SELECT v.token, z.label, ln((coalesce(s.n, 0) + 1) / z.whole) AS weight
            FROM vocabulary v CROSS JOIN sizes z LEFT JOIN seen s ON s.token = v.token AND s.label = z.label),
sums AS (SELECT d.doc_id, z.label, any_value(z.own) + coalesce(sum(t.tf * w.weight), 0) AS score
         FROM documents d CROSS JOIN sizes z LEFT JOIN tf t ON t.doc_id = d.doc_id LEFT JOIN weights w ON w.token = t.token AND w.label = z.label
         GROUP BY d.doc_id, z.label),
best AS (SELECT doc_id, arg_min(label, (-score, label)) AS label, max(score) AS top FROM sums GROUP BY doc_id),
scored AS (SELECT b.doc_id, any_value(b.label) AS best, 1 / sum(exp(s.score - b.top)) AS confidence FROM best b JOIN sums s ON s.doc_id = b.doc_id GROUP BY b.doc_id),
named AS (SELECT doc_id, CASE WHEN confidence < 0.6 THEN 'neutral' ELSE best END AS sentiment, confidence FROM scored),
kept AS (SELECT n.*, l.label FROM named n JOIN labelled l USING (doc_id) WHERE l.held_out)
"""

_CONVERGED = """
und AS (SELECT src AS s, dst AS d FROM edges WHERE src <> dst UNION ALL SELECT dst AS s, src AS d FROM edges WHERE src <> dst),
deg AS (SELECT s, count(*) AS k FROM und GROUP BY s),
adj AS MATERIALIZED (SELECT u.s, u.d, 1.0::DOUBLE / deg.k AS inv FROM und u JOIN deg ON u.s = deg.s),
steps AS (
  SELECT 0 AS i, id, 1.0::DOUBLE AS rank FROM vertices
  UNION ALL
  SELECT any_value(r.i) + 1, a.d, 0.15::DOUBLE + 0.85::DOUBLE * sum(r.rank * a.inv) FROM steps r JOIN adj a ON a.s = r.id WHERE r.i < 160 GROUP BY a.d)"""

ORACLE: dict[str, str] = {
    "pagerank_tol": _graph_sql("posts", """
SELECT v.id, round(coalesce(r.rank, 0.15), 6) AS rank FROM vertices v LEFT JOIN steps r ON r.id = v.id AND r.i = 160""",
                               _CONVERGED).replace("WITH ", "WITH RECURSIVE ", 1),
    "token_weights": _WEIGHTS + """
SELECT token, label, round(weight, 6) AS weight FROM weights UNION ALL SELECT NULL, label, round(own, 6) FROM sizes""",
    "weights_sentiment": _WEIGHTS + "SELECT doc_id, sentiment, round(confidence, 6) AS confidence FROM named",
    "heldout_confusion": _WEIGHTS + "SELECT label AS original_sentiment, sentiment, count(*) AS n FROM kept GROUP BY label, sentiment",
    "heldout_calibration": _WEIGHTS + """
SELECT CAST(least(floor(confidence * 10), 9) AS INTEGER) AS bin, count(*) AS n, count(*) FILTER (sentiment = label) AS correct,
       round(avg(confidence), 6) AS confidence FROM kept GROUP BY 1""",
    "load_csv": _with(_LOADED + "(SELECT * REPLACE (replace(text, ' ', chr(10)) AS text) FROM sp) p"),
    "load_json": _with(_LOADED + "(SELECT * REPLACE (replace(text, ' ', chr(10)) AS text) FROM sp) p"),
    "load_csv_latin1": _with(_LOADED + """(SELECT * REPLACE (
        'café #é ' || text AS text, CASE WHEN text IS NULL THEN [] ELSE list_concat(['é'], hashtags) END AS hashtags) FROM sp) p"""),
    "load_rejects": _raw(f"""
SELECT 'post' AS kind, id, replace(text, ' ', chr(10)) AS text FROM rp WHERE sentiment_label = 0
UNION ALL
SELECT 'not 6 fields', NULL, {" || ',' || ".join(_SIX[:5])} || CASE WHEN sentiment_label = 4 THEN '' ELSE ',' || {_SIX[5]} || ',"more"' END
FROM rp WHERE sentiment_label <> 0"""),
    "created_at_zones": _raw(f"""
SELECT id, CAST(epoch(try_strptime(date, '%a %b %d %H:%M:%S UTC %Y')) AS BIGINT)
           - 60 * [{", ".join(_ZONE_MINUTES)}][CAST(id AS BIGINT) % 10 + 1] AS created_at_epoch FROM rp"""),
    "slider_nodes": _with(f"""
SELECT CAST(top_n AS INTEGER) AS top_n, id, '#' || id AS label, degree, dominant_sentiment AS sentiment,
       {COLOR.format(c='dominant_sentiment')} AS color, greatest(20, least(80, degree * 2)) AS size
FROM placed JOIN settings ON rk <= top_n""", "posts", VERTICES, _SLIDER),
    "slider_edges": _graph_sql("posts", SLIDER_EDGES, _SLIDER),
    "turn_slider_edges": _graph_sql("turn_posts", SLIDER_EDGES, _SLIDER),
    "graph_json_vertices": _with("SELECT * FROM vertices", "posts", VERTICES),
    "graph_json_edges": _with("SELECT * FROM edges", "posts", EDGES),
    "chunk_sequence": _raw("""
SELECT CAST(k // 1000 AS INTEGER) AS chunk, count(*) AS n, min(id) AS first_id, max(id) AS last_id
FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS k FROM rp) r GROUP BY 1"""),
    "stream_once": _with("SELECT id, text, array_to_string(hashtags, ' ') AS hashtags, sentiment, true AS stamped FROM sd", "posts", DISTINCT),
    "load_dropmalformed": _with(_LOADED + "sp WHERE original_sentiment <> 'neutral'"),
    "load_sampled": _raw("""
SELECT id FROM rp WHERE CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) < ceil(0.999 * 4294967296) ORDER BY id LIMIT 100"""),
    "hash_sample_edges": _raw("""
SELECT f AS fraction, (SELECT count(*) FROM rp WHERE CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) < ceil(x * 4294967296::DOUBLE)) AS n
FROM (VALUES ('0.1', 0.1::DOUBLE), ('0.999', 0.999::DOUBLE), ('0.9999999999', 0.9999999999::DOUBLE)) v(f, x)"""),
    "label_by_value": f"""
SELECT l_orderkey, l_linenumber, {_BY_VALUE.format(x='l_quantity')} AS by_quantity, {_BY_VALUE.format(x='l_discount * 100')} AS by_discount,
       {_BY_VALUE.format(x='CAST(l_quantity AS INTEGER)')} AS by_text, 'neutral' AS by_junk FROM lineitem""",
    "posts_with_hashtags": f"""
SELECT CAST(doc_id AS VARCHAR) AS id, len(regexp_extract_all(lower(text), '{TAG_PATTERN}', 1)) AS n_tags
FROM documents WHERE contains(text, '#')""",
    "graph_roundtrip_vertices": _with("SELECT * FROM vertices", "posts", VERTICES),
    "batch_counts": _with("""
SELECT count(*) AS posts, count(*) FILTER (has_hashtags) AS posts_with_hash, count(*) FILTER (len(hashtags) > 0) AS posts_with_tags FROM sp"""),
    "batch_edges": _with("SELECT * FROM edges", "posts", EDGES),
    "finisher": f"""
SELECT doc_id, f AS finished, CASE WHEN contains(f, 'positive') THEN 'positive' WHEN contains(f, 'negative') THEN 'negative' ELSE 'neutral' END AS sentiment
FROM (SELECT doc_id, array_to_string(regexp_extract_all(coalesce(text, ''), '{TOKEN_PATTERN.replace("'", "''")}', 0), ' ') AS f FROM documents) d""",
    "model_invariants": """
SELECT count(*) AS n, count(*) AS in_domain, count(*) AS same_after_load, count(*) AS neutral_below_threshold FROM documents""",
    "stream_restart_posts": _with("SELECT id, text, array_to_string(hashtags, ' ') AS hashtags, sentiment, true AS stamped FROM sd", "posts", DISTINCT),
    "stream_restart_vertices": _with("SELECT * FROM vertices", "posts", DISTINCT, _on_wire(VERTICES)),
    "stream_restart_edges": _with("SELECT * FROM edges", "posts", DISTINCT, _on_wire(EDGES)),
    "doc_pair_totals": _with("""
SELECT count(*) FILTER (len(hashtags) > 0) AS posts, CAST(sum(len(hashtags)) AS BIGINT) AS tag_occurrences,
       CAST(sum(len(hashtags) * (len(hashtags) - 1) // 2) AS BIGINT) AS total_pairs,
       (SELECT count(DISTINCT tag) FROM (SELECT tag FROM (SELECT id, unnest(hashtags) AS tag FROM sp) o GROUP BY id, tag HAVING count(*) > 1) t) AS self_loops
FROM sp""", "doc_posts"),
    "load_parquet_normalized": _with("""
SELECT id, text, array_to_string(hashtags, ' ') AS hashtags,
       CAST(epoch(try_strptime(date, '%a %b %d %H:%M:%S UTC %Y')) AS BIGINT) AS created_at_epoch,
       original_sentiment, has_hashtags FROM sp"""),
    "hash_sample": _raw("SELECT id FROM rp WHERE substr(md5(id), 1, 8) < '1999999a'"),
    "limit_ordered": _raw("SELECT id FROM rp ORDER BY id LIMIT 100"),
    "hashtags_extract": _with("SELECT id, array_to_string(hashtags, ' ') AS tags, len(hashtags) AS n_tags FROM sp"),
    "hashtags_distinct": _with(
        "SELECT id, array_to_string(list_sort(list_distinct(hashtags)), ' ') AS tags FROM sp"),
    "turn_hashtags": _with(
        "SELECT id, array_to_string(hashtags, ' ') AS tags, len(hashtags) AS n_tags FROM sp", "turn_posts"),
    "created_at_parse": _with("""
SELECT id, CAST(epoch(try_strptime(date, '%a %b %d %H:%M:%S UTC %Y')) AS BIGINT) AS created_at_epoch FROM sp"""),
    "created_at_constant": _with(
        "SELECT id, CAST(epoch(TIMESTAMP '2009-01-01 00:00:00') AS BIGINT) AS created_at_epoch FROM sp"),
    "date_strip_zone": _raw("""
SELECT id, CASE WHEN len(t) > 0 THEN array_to_string(t[1:greatest(len(t) - 2, 0)], ' ') || ' ' || t[len(t)] END
         AS created_at
FROM (SELECT id, regexp_extract_all(date, '\\S+') AS t FROM rp) x"""),
    "sentiment_label": _with("SELECT id, sentiment FROM sp"),
    "sentiment_from_text": """
SELECT doc_id, CASE WHEN contains(lower(text), 'positive') THEN 'positive'
                    WHEN contains(lower(text), 'negative') THEN 'negative' ELSE 'neutral' END AS sentiment
FROM documents""",
    "sentiment_distribution": _with("""
SELECT sentiment, count, round(100.0 * count / sum(count) OVER (), 4) AS pct
FROM (SELECT sentiment, count(*) AS count FROM sp GROUP BY sentiment) g"""),
    "confusion_counts": _with(
        "SELECT original_sentiment, sentiment, count(*) AS n FROM sp GROUP BY original_sentiment, sentiment"),
    "has_hashtags_vs_tags": f"""
SELECT doc_id, coalesce(contains(text, '#'), false) AS has_hashtags,
       len(regexp_extract_all(lower(coalesce(text, '')), '{TAG_PATTERN}', 1)) AS n_tags
FROM documents""",
    "pages_has_hashtags": f"""
SELECT page_id, coalesce(contains(html, '#'), false) AS has_hashtags,
       len(regexp_extract_all(lower(coalesce(html, '')), '{TAG_PATTERN}', 1)) AS n_tags
FROM pages""",
    "text_shrink": f"SELECT doc_id, trim(regexp_replace(text, '{SPACE_RUN_PATTERN}', ' ', 'g')) AS text FROM documents",
    "token_counts": f"""
SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{TOKEN_PATTERN.replace("'", "''")}', 0)) AS n_tokens
FROM documents""",
    "tag_counts": _with(
        "SELECT tag AS id, count(*) AS degree FROM (SELECT unnest(hashtags) AS tag FROM sp) o GROUP BY tag"),
    "tag_sentiment_counts": _with("""
SELECT tag AS id, sentiment, count(*) AS n
FROM (SELECT unnest(hashtags) AS tag, sentiment FROM sp) o GROUP BY tag, sentiment"""),
    "dominant_sentiment": _with("SELECT id, dominant_sentiment FROM vertices", "posts", VERTICES),
    "vertices": _with("SELECT * FROM vertices", "posts", VERTICES),
    "vertices_general": _with("SELECT * FROM vertices", "posts", VERTICES),
    "pairs": _with("""
SELECT s[i] AS src, s[j] AS dst, sentiment
FROM (SELECT list_sort(hashtags) AS s, sentiment FROM sp WHERE len(hashtags) >= 2) t,
     range(1, len(s) + 1) a(i), range(1, len(s) + 1) b(j)
WHERE i < j"""),
    "edges": _with("SELECT * FROM edges", "posts", EDGES),
    "edges_by_multiplicity": _with("SELECT * FROM edges", "posts", EDGES),
    "graph_summary": _graph_sql("posts", SUMMARY),
    "top_vertices": _top_vertices("posts"),
    "top_subgraph_nodes": _graph_sql("posts", f"""
SELECT id, '#' || id AS label, degree, dominant_sentiment AS sentiment,
       {COLOR.format(c='dominant_sentiment')} AS color,
       greatest(20, least(80, degree * 2)) AS size
FROM top WHERE EXISTS (SELECT 1 FROM edges)""", TOP),
    "top_subgraph_edges": _top_subgraph_edges("posts"),
    "top_bar": _with(f"""
SELECT degree, '#' || id AS label, {COLOR.format(c='dominant_sentiment')} AS color,
       dominant_sentiment AS text
FROM (SELECT * FROM vertices ORDER BY degree DESC, id LIMIT {TOP_N}) t""", "posts", VERTICES),
    "vertex_sentiment_split": _with(
        "SELECT dominant_sentiment, count(*) AS count FROM vertices GROUP BY dominant_sentiment",
        "posts", VERTICES),
    "degree_centrality": _centrality("posts"),
    "pagerank_5": _pagerank("posts"),
    "turn_vertices": _with("SELECT * FROM vertices", "turn_posts", VERTICES),
    "turn_edges": _with("SELECT * FROM edges", "turn_posts", EDGES),
    "turn_graph_summary": _graph_sql("turn_posts", SUMMARY),
    "turn_top_subgraph_edges": _top_subgraph_edges("turn_posts"),
    "turn_degree_centrality": _centrality("turn_posts"),
    "turn_pagerank_5": _pagerank("turn_posts"),
    "graph_roundtrip_edges": _with("SELECT * FROM edges", "posts", EDGES),
    "token_spans": TOKEN_SPANS,
    "to_wire": _with(f"""
SELECT id, text, CAST(to_json(hashtags) AS VARCHAR) AS hashtags, {_strip_zone('date')} AS created_at,
       sentiment FROM sd""", "posts", DISTINCT),
    "stream_posts": _with("SELECT id, text, array_to_string(hashtags, ' ') AS hashtags, sentiment, true AS stamped FROM sd",
                          "posts", DISTINCT),
    "stream_graph_vertices": _with("SELECT * FROM vertices", "posts", DISTINCT, _on_wire(VERTICES)),
    "stream_graph_edges": _with("SELECT * FROM edges", "posts", DISTINCT, _on_wire(EDGES)),
    "doc_graph_summary": _graph_sql("doc_posts", SUMMARY),
    "doc_top_vertices": _top_vertices("doc_posts"),
}
