import random
import zlib
from hashlib import sha256

import pytest
from llm_fixtures import edge_docs, no_docs, small_docs  # noqa: F401
from pyspark.sql import functions as F

from repotrend.llm import merkle
from repotrend.llm.queries import tampered

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, pos string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def grow(nodes):
    """The tree over nodes: for each the siblings (left, right) level by level, and the top."""
    trails, owners = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for a in range(0, len(nodes), 3):
            for k in range(a, min(a + 3, len(nodes))):
                for o in owners[k]:
                    trails[o].append(("".join(nodes[a:k]), "".join(nodes[k + 1 : a + 3])))
            up.append(h(*nodes[a : a + 3]))
            held.append([o for own in owners[a : a + 3] for o in own])
        nodes, owners = up, held
    return trails, nodes[0]


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = (own, *grow([leaf(r) for r in own]))
    outer, root = grow([trees[s][2] for s in names])
    out = []
    for s, above in zip(names, outer, strict=True):
        own, trails, subroot = trees[s]
        for r, trail in zip(own, trails, strict=True):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            node = leaf((*r[:4], r[4].replace("\n", ""))) if bad else leaf(r)
            for left, right in trail + above:
                node = h(left, node, right)
            out.append((r[0], leaf(r), subroot, root, h(*[x for p in trail + above for x in p]), node, node == root))
    return sorted(out, key=str)


def got(docs, **more):
    found = merkle.manifest(docs, received=tampered(), **more)
    return sorted((tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), "folded_root", "verified").collect()), key=str)


def random_rows(n, groups, seed):
    rng = random.Random(seed)
    names = [None, "", *[f"s{k}é" for k in range(groups)]]
    return [(rng.choice([None, *range(n)]), rng.choice(names) if rng.random() < 0.7 else "hot", rng.choice([None, "en"]), rng.choice([None, 1, -5]),
             rng.choice([None, "", "a\nb\n", f"text {k}\n", "long " * 3000]), k, "p") for k in range(n)]


@pytest.mark.parametrize(("n", "groups", "height"), [(1, 1, 1), (30, 40, 1), (400, 3, 1), (400, 30, 2), (900, 2, 8)])
def test_equals_brute_force(spark, n, groups, height):
    rows = random_rows(n, groups, n + groups)
    rows += rows[: n // 3] + [rows[0]] * 5  # repeated rows are leaves each
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), height=height) == brute([r[:5] for r in rows])


def test_query_over_a_table(spark, small_docs):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in small_docs.collect()]
    want = brute(rows)
    assert got(small_docs) == want and {r[6] for r in want} == {True, False}


def test_edge_rows(spark, edge_docs, no_docs):
    docs = edge_docs.withColumns({"n_chars": F.lit(None).cast("long"), "lang": F.lit("en")})
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert got(docs) == brute(rows)
    assert merkle.manifest(no_docs).collect() == []


def test_depths():
    assert [merkle.depth(n) for n in (0, 1, 2, 3, 4, 9, 10, 6561, 6562)] == [0, 0, 1, 1, 2, 2, 3, 8, 9]
