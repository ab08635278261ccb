import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import SMALL, edge_docs, no_docs, small_docs  # noqa: F401

from repotrend.llm import lexical

PATTERN = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return PATTERN.findall((text or "").translate(UPPER))


def brute(docs, items, k=10):
    held = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    total, df = sum(n for *_, n in held), Counter(t for _, c, _ in held for t in c)
    texts = {}
    for i, t in items:
        texts.setdefault(i, set()).add(t or "")
    out = []
    for i, own in texts.items():
        wanted, ranked = Counter(w for t in own for w in words(t)), []
        for d, count, n in held:
            m = 25 + 75 * n * len(held) // total
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[w] + 1))) * (10**9 * count[w] // (1000 * count[w] + 8 * m)) * c
                        for w, c in wanted.items() if count[w])
            if score > 0:
                ranked.append((-score, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(ranked, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, **more):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(4) if isinstance(docs, list) else docs
    items = spark.createDataFrame(items, "item_id long, text string") if isinstance(items, list) else items
    return sorted((tuple(r) for r in lexical.search(docs, items, **more).collect()), key=str)


def made(seed, n=400, kinds=60):
    rng = random.Random(seed)
    name = lambda: rng.choice(["Wort", "ÄÖ", "x_y", "e-mail", "数"]) + str(min(int(rng.expovariate(0.08)), kinds))
    docs = [(rng.choice([None, *range(n)]), " ".join(name() for _ in range(rng.choice([0, 1, 5, 40])))) for _ in range(n)]
    docs += [(10_000 + k, "same words in many ties Wort1") for k in range(40)] + [(5, None), (6, ""), (7, "-- !"), (8, "Wort1 " * 20_000)]
    items = [(k, " ".join(name() for _ in range(rng.choice([1, 4, 30])))) for k in range(25)]
    return docs, items + [(30, "same ties"), (31, None), (32, "?"), (33, "unheard"), (None, "Wort1 e"), (0, "another text of item 0"), items[1], items[1], (34, "Wort1 " * 3000 + "same")]


@pytest.mark.parametrize(("seed", "more"), [
    (1, {}), (2, {"block_bytes": 700, "document_tile": 16}), (3, {"vocabulary_tile": 3, "limit": 20_000}), (4, {"k": 3, "limit": 2000})])
def test_equals_brute_force(spark, seed, more):
    docs, items = made(seed)
    assert got(spark, docs, items, **more) == brute(docs, items, more.get("k", 10))


def test_whole_table_of_documents(spark, small_docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in small_docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert got(spark, small_docs, bench) == want and want


def test_edge_rows(spark, edge_docs, no_docs):
    items = [(1, "a row with words"), (2, "word"), (None, "one text")]
    assert got(spark, edge_docs, items) == brute([(r.doc_id, r.text) for r in edge_docs.collect()], items)
    assert got(spark, no_docs, items) == []
    assert got(spark, edge_docs, spark.createDataFrame([], "item_id long, text string")) == []


def test_partial_sums_stay_exact():
    """Sums far beyond 2**53 come out exact, as parts are bounded."""
    rng = np.random.default_rng(1)
    items = [(k, {int(t): int(rng.integers(1, 10**7)) for t in rng.choice(50, 20, replace=False)}) for k in range(7)]
    weights = rng.integers(1, 30_000, 50)
    impacts = rng.integers(1, lexical.IMPACT, (50, 9))
    want = {i: [sum(c * int(weights[t]) * int(impacts[t, d]) for t, c in own.items()) for d in range(9)] for i, own in items}
    assert max(map(max, want.values())) > lexical.EXACT
    term, doc = (x.ravel() for x in np.mgrid[0:50, 0:9])
    for tile in lexical.tiles(items, weights, most=16):
        for part in tile.parts:
            sums = np.bincount(part.rows, part.entries, len(tile.ids))
            assert len(part.vocabulary) <= 16 and sums.max() * lexical.IMPACT <= lexical.EXACT
        found = lexical.scores(tile, term, doc, impacts.ravel(), 9)
        assert [row.tolist() for row in found] == [want[i] for i in tile.ids]


def test_terms():
    for text in ("Aé-b_c 1.5\x85\xa0x", "ÀB\x7fZ[`{@/:", "\x00\x1f数数 ok"):
        assert [t.decode() for t in lexical.terms(text.encode())] == words(text)
