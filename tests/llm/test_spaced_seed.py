import itertools
import math
import random

import numpy as np

from llm_fixtures import edge_docs, no_docs, small_docs  # noqa: F401

from repotrend.llm import spaced_seed as ss


def brute(doc, item):
    """The matches of the best stretch over all offsets, by plain loops over the rule.

    Of one offset that with the most matches less four for each other word, the one
    that ends, then starts first; of all offsets that with the most matches.
    """
    d, t = doc.lower().split(), item.lower().split()
    need, best = min(ss.OVERLAP, math.ceil(0.8 * len(t))), None
    for offset in range(-len(t) + 1, len(d)):
        match = [t[k] == d[k + offset] for k in range(max(0, -offset), min(len(t), len(d) - offset))]
        found = [(n - 4 * (e - s - n), -e, -s, n) for e in range(len(match) + 1) for s in range(e - need + 1) if 5 * (n := sum(match[s:e])) >= 4 * (e - s)]
        if found:
            best = max(best or 0, max(found)[3])
    return best


def test_replaced_words_are_found(spark):
    rng = random.Random(1)
    items = [(k, " ".join(f"w{rng.randrange(400)}" for _ in range(n))) for k, n in enumerate([40, 25, 15, 12, 9, 6, 4])] + [(None, "a b c d e f"), (99, None)]
    docs = []
    for k, (_, text) in enumerate(items[:7]):
        for j in range(6):
            w = text.split()
            for _ in range(j):
                w[rng.randrange(len(w))] = "other"
            docs.append((100 * k + j, " ".join([f"v{rng.randrange(400)}" for _ in range(rng.randrange(30))] + w + ["end"])))
    docs += [(9000 + j, " ".join(f"w{rng.randrange(400)}" for _ in range(300))) for j in range(20)]
    found = ss.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.n_matches for r in found.collect()}
    want = {(d, i): m for d, t in docs for i, x in items if x and i is not None and (m := brute(t, x))}
    assert got == want and {(0, 0), (1, 0), (2, 0), (300, 3), (400, 4), (500, 5), (600, 6)} <= set(got)


def test_short_items_are_found_whole(spark):
    rng = random.Random(3)
    items = [(n, " ".join(f"W{rng.randrange(4)}" for _ in range(n))) for n in (1, 2, 3, 4)] + [(12, "w1 w2"), (13, "w1 w2 W3"), (14, "w0 w1 w2 w3 w0")]
    docs = [(k, " ".join(f"w{rng.randrange(4)}" for _ in range(rng.randrange(8)))) for k in range(300)] + [(1000 + i, t) for i, t in items]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_words, r.n_matches, r.doc_start, r.item_start) for r in ss.contaminated(*frames).where("item_id < 14").collect()}
    want = {}
    for d, text in docs:
        for i, item in items[:-1]:
            a, b = text.lower().split(), item.lower().split()
            if starts := [s for s in range(len(a) - len(b) + 1) if a[s : s + len(b)] == b]:
                want[d, i] = (len(b), len(b), starts[0], 0)
    assert got == want and {(1000 + i, i) for i, _ in items[:-1]} <= set(got)
    assert {r.item_id for r in ss.contaminated(*frames, least_words=5).collect()} == {14}


def test_blocks_give_the_same(spark, small_docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = sorted(map(tuple, ss.contaminated(small_docs, bench).collect()))
    assert one and one == sorted(map(tuple, ss.contaminated(small_docs, bench, block_seeds=2000).collect()))
    texts = {r.item_id: r.text.lower() for r in bench.collect()}
    whole = {(r.doc_id, i) for r in small_docs.collect() for i, t in texts.items() if " ".join(t.split()) in " ".join(r.text.lower().split())}
    assert whole <= {(r[0], r[1]) for r in one}


def test_edge_rows(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "a text without an id that has some words in it", 3)], "item_id long, text string, id int")
    rows = ss.contaminated(edge_docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.n_words, r.doc_start) for r in rows] == [(None, 1, 11, 0)]
    assert ss.contaminated(no_docs, bench).count() == 0
    assert ss.contaminated(edge_docs, bench.limit(0)).count() == 0
    assert len(ss.seeds(np.empty(0, np.uint64), ss.MASKS[0], 1)) == 0


def allowed(match, n):
    """Whether some stretch of 13 words, or 4/5 of a shorter item of n words, has at least 4/5 matching."""
    need = min(13, math.ceil(n * 4 / 5))
    return any(5 * sum(match[a:b]) >= 4 * (b - a) for a in range(len(match)) for b in range(a + need, len(match) + 1))


def patterns():
    """Which words of an item match: few replaced anywhere, and random ones."""
    for n, most in ((5, 1), (7, 2), (9, 2), (10, 2), (13, 3), (15, 3), (16, 2), (20, 3)):
        for k in range(most + 1):
            for gone in itertools.combinations(range(n), k):
                yield [j not in gone for j in range(n)]
    yield [j % 5 != 4 for j in range(40)]
    rng = random.Random(2)
    for _ in range(2000):
        n, share = rng.randrange(5, 45), rng.uniform(0.6, 0.95)
        yield [rng.random() < share for _ in range(n)]


def test_any_stretch_long_enough_counts():
    for match in patterns():
        item = np.arange(1, len(match) + 1, dtype=np.uint64)
        words = np.where(match, item, np.uint64(0))
        found = ss.stretch(item, words, 0)
        assert (found is not None) == allowed(match, len(match)), match
        if found:
            start, length, matches = found
            assert matches == sum(match[start : start + length]) and 5 * matches >= 4 * length >= 4 * min(13, math.ceil(len(match) * 4 / 5))
    assert ss.stretch(np.arange(9, dtype=np.uint64), np.arange(3, dtype=np.uint64), 0) is None


def test_every_allowed_pattern_has_a_seed():
    for match in patterns():
        if allowed(match, len(match)):
            item = np.arange(1, len(match) + 1, dtype=np.uint64)
            table = ss.SeedTable([(1, item)])
            words = np.where(match, item, np.uint64(0))
            assert any(place == at for place, _, at in table.hits(words)), match


def test_equals_brute_force_over_all_offsets(spark):
    rng = random.Random(4)
    items = [(n, " ".join(f"w{rng.randrange(30)}" for _ in range(n))) for n in (5, 6, 8, 9, 10, 13, 15, 20, 40)]
    docs = []
    for n, text in items:
        for j in range(30):
            w = text.split()
            for at in rng.sample(range(n), rng.randrange(0, 1 + n // 3)):
                w[at] = "other"
            docs.append((1000 * n + j, " ".join([f"w{rng.randrange(30)}" for _ in range(rng.randrange(20))] + w[rng.randrange(0, 3) :] + ["end"])))
    want = set()
    for d, text in docs:
        for i, item in items:
            a, b = text.split(), item.split()
            want |= {(d, i) for o in range(-len(b) + 1, len(a))
                     if allowed([b[k] == a[k + o] for k in range(max(0, -o), min(len(b), len(a) - o))], len(b))}
    found = ss.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want and {1000 * n for n, _ in items} & {d for d, _ in want}
