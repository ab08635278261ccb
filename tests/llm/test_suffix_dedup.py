import collections
import hashlib
import random
import re

import numpy as np
import pytest

from llm_fixtures import edge_docs, no_docs, small_docs  # noqa: F401

from repotrend.llm import induced_sort, suffix_dedup


def naive(text):
    order = sorted(range(len(text)), key=lambda i: bytes(text[i:]))
    common = [0]
    for a, b in zip(order, order[1:], strict=False):
        k = 0
        while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        common.append(k)
    return order, common


@pytest.mark.parametrize("memory", [1 << 20, 200])
def test_suffixes_and_common_lengths(memory):
    rng = random.Random(4)
    for case in range(120):
        n = rng.randrange(0, 150)
        text = bytes(rng.choice(b"ab" if case % 3 else b"abcdef") for _ in range(n))
        if case % 5 == 0:
            text = text * 3 + b"a" * 30
        sorted_ = list(induced_sort.Sorter(np.frombuffer(text, np.uint8).astype(np.int16), 257, memory).sort())
        order = np.concatenate([a for a, _ in sorted_]) if sorted_ else np.empty(0)
        common = np.concatenate([c for _, c in sorted_]) if sorted_ else np.empty(0)
        want = naive(text)
        assert order.tolist() == want[0]
        if text:
            assert common[1:].tolist() == want[1][1:]


def brute(rows, length):
    where = collections.Counter()
    for _, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - length + 1):
            where[raw[k : k + length]] += 1
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - length + 1):
            if where[raw[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, length):
    return sorted(map(tuple, suffix_dedup.digests(suffix_dedup.without_repeats(df, length)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def planted(n=60):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(25)) for _ in range(3)]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 40))) for _ in range(3)]
        for p in passages:
            if rng.random() < 0.5:
                cut = rng.randrange(0, 30)
                parts.insert(rng.randrange(len(parts) + 1), p[cut : len(p) - rng.randrange(30)])
        rows.append((i, " ".join(parts)))
    rows += [(900, "ab" * 300), (901, "z" * 500), (902, rows[3][1]), (903, rows[3][1]), (903, rows[3][1])]
    return rows


@pytest.mark.parametrize("wide", [256, 2])
def test_equals_brute_force(spark, monkeypatch, wide):
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (2000, wide))
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(df, 60) == brute(rows, 60)


def test_equals_brute_force_on_documents(spark, small_docs):
    assert result(small_docs, 400) == brute([(r.doc_id, r.text) for r in small_docs.collect()], 400)


def test_long_texts_in_parts(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    whole = [np.concatenate(x) for x in zip(*suffix_dedup._runs(data, 100, 32), strict=True)]
    monkeypatch.setattr(suffix_dedup, "_PLACE", 10)
    parts = list(suffix_dedup._runs(data, 100, 32))
    anchor = lambda runs: np.repeat(np.concatenate([r[3] for r in runs]), np.concatenate([r[1] for r in runs]))
    assert len(parts) > 3 and (anchor(parts) == np.repeat(whole[3], whole[1])).all()


def test_edge_rows(edge_docs, no_docs):
    got = suffix_dedup.without_repeats(edge_docs, 400).collect()
    assert len(got) == edge_docs.count()
    by = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got if r.doc_id}
    assert by[4] == (150_000, 150_000, 1) and by[5] == (60_000, 60_000, 1) and by[1] == by[2] == (0, 0, 0) and by[7][1] == 0
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def brute_passages(rows, words):
    spell = [[w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t in rows]
    where = collections.defaultdict(set)
    for k, own in enumerate(spell):
        for at in range(len(own) - words + 1):
            where[tuple(own[at : at + words])].add(k)
    out = []
    for (i, _), own in zip(rows, spell, strict=True):
        met = np.zeros(len(own) + 1, bool)
        for at in range(len(own) - words + 1):
            if len(where[tuple(own[at : at + words])]) > 1:
                met[at : at + words] = True
        out.append((i, int((met[1:] & ~met[:-1]).sum() + met[0]), int(met.sum())))
    return sorted(out, key=str)


def passages(df, words):
    got = suffix_dedup.digests(suffix_dedup.without_repeats(df, 400, words=words))
    return sorted(map(tuple, got.select("doc_id", "n_passages", "n_passage_words").collect()), key=str)


@pytest.mark.parametrize("words", [4, 12])
def test_passages_of_other_rows_equal_brute_force(spark, words):
    own = " ".join(f"own{k}" for k in range(20))  # twice in one row only
    rows = planted() + [(910, f"{own} x {own}"), (None, planted()[5][1].upper().replace(" ", "\n ")), (912, None), (913, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert passages(df, words) == brute_passages(rows, words)


def test_passage_shorter_than_the_bytes_is_reported(spark):
    shared = " ".join(f"s{k}" for k in range(51))
    rows = [(1, f"a b {shared} c"), (2, f"d {shared}"), (3, f"e {shared[:-4]} f"), (4, f"{shared[3:]} g")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.digests(suffix_dedup.without_repeats(df, 400, words=51)).collect()}
    assert {k: (r.n_passages, r.n_passage_words, r.n_removed) for k, r in got.items()} == {1: (1, 51, 0), 2: (1, 51, 0), 3: (0, 0, 0), 4: (0, 0, 0)}
    assert got[1].text == rows[0][1]
