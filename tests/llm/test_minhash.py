import random
import tracemalloc

import numpy as np
import pyarrow as pa

from llm_fixtures import edge_docs, no_docs, small_docs  # noqa: F401

from repotrend.llm import components, minhash, tokens
from repotrend.llm.scratch import Scratch


def shingle_set(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n, percent=80):
    """id -> (size, least id reachable) by comparing all pairs."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i]) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_word_hashes_follow_words():
    texts = ["A b\tC  a", "", "ab\x0bc", "É é a\x85b", "a b c a"]
    column = pa.chunked_array([texts]).combine_chunks()
    data, offsets = tokens.text_buffer(column)
    hashes, first = tokens.word_hashes(data, offsets)
    words = [w for t in texts for w in t.encode().lower().split()]
    assert len(hashes) == len(words) and first[-1] == len(words)
    assert {h: w for h, w in zip(hashes.tolist(), words, strict=True)} == dict(zip(hashes.tolist(), words, strict=True))
    assert len(set(hashes.tolist())) == len(set(words))


def test_sliced_column():
    column = pa.array(["zero", "one two", None, "three"]).slice(1, 3)
    assert [len(s) for s in tokens.text_shingles(column, 1)] == [2, 0, 1]


def test_equals_brute_force_on_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):  # one large group of copies with more and more words replaced
        w = list(base)
        for _ in range(rng.randrange(0, 8)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    passage = " ".join(f"p{k}" for k in range(50))
    for i in range(200, 240):  # texts that share a passage but are different
        rows.append((i, passage + " " + " ".join(f"q{i}-{k}" for k in range(rng.randrange(5, 60)))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (4, 5):
        assert got(minhash.near_duplicates(df, n=n)) == brute(rows, n)


def test_equals_brute_force_on_documents(spark, small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    result = minhash.near_duplicates(small_docs, n=4)
    assert got(result) == brute(rows, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in result.collect())


def test_edge_rows(edge_docs, no_docs):
    rows = minhash.near_duplicates(edge_docs, n=4).collect()
    assert len(rows) == edge_docs.count()
    by = {r.doc_id: r for r in rows}
    assert [r.component_id for r in rows if r.doc_id is None] == [None, None] and all(r.kept for r in rows if r.doc_id is None)
    assert all(by[i].n_shingles == 0 and by[i].component_id == i for i in (1, 2, 3))
    assert by[7].component_id == 6 and not by[7].kept and by[5].n_shingles == 1
    assert minhash.near_duplicates(no_docs).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 200), (200, 150), (7, 7), (None, 3)] + [(500, k) for k in range(501, 560)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark))
    label = {r.id: r.component for r in found.collect()}
    assert all(label[k] == 0 for k in range(61)) and label[200] == label[150] == 100 and all(label[k] == 500 for k in range(500, 560))
    assert components.components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def test_recall_of_tensored_tables():
    s = 0.8
    assert (1 - (1 - s**minhash.ROWS) ** minhash.BANDS) ** 2 > 1 - 1e-5
    assert np.unique(minhash._multipliers(8)[0] % 2).tolist() == [1]


def test_unequal_own_parts_around_one_pivot(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"p{k}" for k in range(100)]
    rows = [(0, " ".join(base))]
    for k in range(60):  # x and y share 90 of 110 words and neither links with the pivot; then pairs of other sizes
        own = [f"own{k}-{j}" for j in range(25)]
        some = rng.sample(base, 85)
        n = 15 if k < 40 else rng.randrange(10, 26)
        rows += [(2 * k + 1, " ".join(some[:75] + own)), (2 * k + 2, " ".join(some + own[:n]))]
    docs = spark.createDataFrame(rows, "id long, text string")
    cells = spark.createDataFrame([(0, i, len(t.split()), float(i == 0), i) for i, t in rows], "key long, id long, n long, pop double, rep long")
    monkeypatch.setattr(minhash, "_cells", lambda sig, bands: cells)
    scratch = Scratch(spark)
    label = {r.id: r.component for r in components.components(minhash.links(docs, None, 1, 0.8, 1, scratch), scratch).collect()}
    assert {i: label.get(i, i) for i, _ in rows} == {i: c for i, (_, c) in brute(rows, 1).items()}
    # With words that many members have, which are put last.
    shared = [f"many{k}" for k in range(6)]
    rows = [(i, t if i == 0 else t + " " + " ".join(shared)) for i, t in rows]
    docs = spark.createDataFrame(rows, "id long, text string")
    cells = spark.createDataFrame([(0, i, len(t.split()), float(i == 0), i) for i, t in rows], "key long, id long, n long, pop double, rep long")
    scratch = Scratch(spark)
    label = {r.id: r.component for r in components.components(minhash.links(docs, None, 1, 0.8, 1, scratch), scratch).collect()}
    assert {i: label.get(i, i) for i, _ in rows} == {i: c for i, (_, c) in brute(rows, 1).items()}


def test_an_id_of_two_texts_keeps_the_links_of_both(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (5, c), (4, c), (5, a + " y"), (6, c + " z"), (1, a), (9, "alone here")]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        found = minhash.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(3), n=4).collect()
        assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 9: 9}
        assert len(found) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_memory_of_hashed_texts_follows_the_chunk():
    rng = random.Random(3)
    column = pa.array([" ".join(str(rng.randrange(10**6)) for _ in range(300)) for _ in range(2_000)])
    assert column.nbytes > 4_000_000
    tokens._tables(tokens.CHUNK_BYTES)
    tracemalloc.start()
    try:
        n = sum(len(s) for s in tokens.text_shingles(column, 5))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 2_000 * 296
    assert most < 24 << 20


def test_pairs_are_taken_in_slices():
    sizes = [3, 0, 5, 40, 1, 2, 2]
    batch = pa.RecordBatch.from_pydict({"a": list(range(7)), "sa": [b"x" * k for k in sizes], "sb": [b"y" * 2] * 7})
    parts = list(minhash._slices(batch, 10))
    assert [p.column("a").to_pylist() for p in parts] == [[0, 1], [2], [3], [4, 5], [6]]
    assert list(minhash._slices(batch.slice(0, 0), 10)) == []


def test_frequent_shingles_of_a_pivot_are_put_last(spark):
    def packed(values):
        return np.array(values, np.uint64).tobytes()

    sets = spark.createDataFrame([(0, packed(range(100, 110))), (1, packed([1, 2, 3, *range(100, 107)])), (2, packed([1, 5, *range(100, 108)])),
                                  (3, packed([7, *range(100, 109)]))], "id long, s binary")
    pairs = spark.createDataFrame([(1, 0), (2, 0), (1, 3)], "a long, b long")
    often = spark.createDataFrame([(0, [1])], "b long, often array<long>")
    rows = minhash._own_shingles(pairs, sets, 0.95, often).select("b", "a", "h", "more").collect()
    assert sorted(map(tuple, rows)) == [(0, 1, 2, 2), (0, 2, 5, 1)]


def test_joins_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    made = []
    sharing, inside = minhash._sharing, minhash._inside

    def counted(f):
        def run(*args):
            made.append(f(*args).count())
            return f(*args)
        return run

    monkeypatch.setattr(minhash, "_sharing", counted(sharing))
    monkeypatch.setattr(minhash, "_inside", counted(inside))
    base = [f"p{k}" for k in range(100)]

    def links_of(rows, pivot=0):
        docs = spark.createDataFrame(rows, "id long, text string")
        cells = spark.createDataFrame([(0, i, len(t.split()), float(i == pivot), i) for i, t in rows], "key long, id long, n long, pop double, rep long")
        monkeypatch.setattr(minhash, "_cells", lambda sig, bands: cells)
        made.clear()
        scratch = Scratch(spark)
        label = {r.id: r.component for r in components.components(minhash.links(docs, None, 1, 0.8, 1, scratch), scratch).collect()}
        assert {i: label.get(i, i) for i, _ in rows} == {i: c for i, (_, c) in brute(rows, 1).items()}
        return sum(made)

    # The pivot lacks words that the other members share: 17 words of their own each, so they are linked with none.
    def with_own(k, words):
        return " ".join([*words[:-17], *(f"own{k}-{j}" for j in range(17))])

    rows = [(0, " ".join(base[:60]))] + [(k, with_own(k, base)) for k in range(1, 241)]
    assert links_of(rows) < 20 * len(rows)
    # Copies that are linked with each other, but not with the pivot.
    rng = random.Random(8)
    rows = [(0, " ".join(base[:60]))]
    for k in range(1, 241):
        w = list(base)
        w[rng.randrange(100)] = f"x{k}"
        rows.append((k, " ".join(w)))
    assert links_of(rows) < 20 * len(rows)
    # Four such groups, none of them most of the members, around a pivot that they share some words with.
    rows = [(0, " ".join(base[:40]))]
    for k in range(1, 321):
        rows.append((k, with_own(k, base[:40] + [f"g{k % 4}-{j}" for j in range(60)])))
    assert links_of(rows) < 20 * len(rows)


def test_the_pivot_does_not_depend_on_the_order_of_rows(spark):
    sig = [(i, 9, i, [k if i % 3 else k + i for k in range(28)]) for i in range(12)]
    tables = [minhash._cells(spark.createDataFrame(order, "id long, n_shingles long, rep long, bands array<long>").repartition(n), 14) for order, n in ((sig, 1), (sig[::-1], 5))]
    pops = [{r.id: r["pop"] for r in t.select("id", "pop").distinct().collect()} for t in tables]
    assert pops[0] == pops[1] and all(isinstance(v, int) for v in pops[0].values())
