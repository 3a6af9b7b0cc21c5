"""Plain-Python reference model of the graph (test-only, small inputs)."""

import re
from collections import Counter, defaultdict
from itertools import combinations

TAG = re.compile(r"#(\w+)")


def tags_of(text):
    return TAG.findall((text or "").lower())


def graph(posts):
    """posts: list of (tags, sentiment) -> (vertices dict, edges dict)."""
    deg, sent, pairs = Counter(), defaultdict(Counter), Counter()
    for tags, s in posts:
        for t in tags:
            deg[t] += 1
            sent[t][s] += 1
        for a, b in combinations(sorted(tags), 2):
            pairs[(a, b)] += 1
    verts = {t: (deg[t], sorted(sent[t].items(), key=lambda kv: (-kv[1], kv[0]))[0][0]) for t in deg}
    return verts, dict(pairs)


def pagerank(vertices, edges, iters, reset=0.15):
    nbrs = defaultdict(set)
    for (a, b) in edges:
        if a != b:
            nbrs[a].add(b)
            nbrs[b].add(a)
    r = {v: 1.0 for v in vertices}
    for _ in range(iters):
        r = {v: reset + (1 - reset) * sum(r[u] / len(nbrs[u]) for u in nbrs[v]) for v in vertices}
    return r
