import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from llm_fixtures import edge_docs, no_docs, small_docs  # noqa: F401

from repotrend.llm import lattice_lm as lm

PATH = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(word, pieces):
    if not word:
        yield ()
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for rest in segmentations(word[k:], pieces):
                yield (word[:k], *rest)


def small():
    pieces = [b" ", b"a", b"b", b" a", b"ab", b"bb", b" ab", b"bab"]
    return pieces, np.log(np.array([3, 2, 2, 4, 5, 1, 6, 2]) / 25)


WORDS = [b"abab", b"a", b"bbbb", b"babab" * 3, b"ab" * 30]


def test_marginals_are_sums_over_segmentations():
    pieces, weights = small()
    lattice, weight = lm.Lattice(pieces, weights), dict(zip(pieces, np.exp(weights), strict=True))
    for word, p in zip(WORDS[:4], lattice.log_probabilities(WORDS[:4]), strict=True):
        want = sum(math.prod(weight[x] for x in s) for s in segmentations(b" " + word, weight))
        assert p == pytest.approx(math.log(want), rel=1e-12) and lattice._one(b" " + word) == pytest.approx(p, rel=1e-12)


def test_expected_counts():
    pieces, weights = small()
    lattice, weight = lm.Lattice(pieces, weights), dict(zip(pieces, np.exp(weights), strict=True))
    times, want = np.array([2, 5, 1, 3]), Counter()
    for word, n in zip(WORDS[:4], times, strict=True):
        all_ = [(s, math.prod(weight[x] for x in s)) for s in segmentations(b" " + word, weight)]
        for s, p in all_:
            for x in s:
                want[x] += n * p / sum(q for _, q in all_)
    assert lattice.expected(WORDS[:4], times) == pytest.approx([want[p] for p in pieces], rel=1e-9)
    one = np.zeros(len(pieces) + 1)
    lattice._one(b" " + WORDS[4], one, 2.0)
    held = lm.SHORT
    try:
        lm.SHORT = 1000
        assert lattice.expected([WORDS[4]], np.array([2])) == pytest.approx(one[:-1], rel=1e-9)
    finally:
        lm.SHORT = held


def base_scores(rows):
    counts = Counter()
    tokens = {k: [*(t or "").encode().lower().split(), None] for k, (_, t) in enumerate(rows)}
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    for k in tokens:
        if not held[k]:
            counts.update(tokens[k])
    n, v = sum(counts.values()), len(counts)
    return sorted(((i, held[k], len(tokens[k]), sum(counts[w] > 0 for w in tokens[k]), n,
                    round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[k]), 6)) for k, (i, _) in enumerate(rows)), key=str)


def scored(df, **more):
    return lm.scores(df, PATH, **more).collect()


@pytest.mark.parametrize("block_bytes", [1 << 24, 20_000])
def test_base_scores_and_model(spark, small_docs, block_bytes):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    got = scored(small_docs, block_bytes=block_bytes)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == base_scores(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    unfitted = {r.doc_id: r.score for r in scored(small_docs, block_bytes=block_bytes, rounds=0)}
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(unfitted[r.doc_id] for r in held)


def test_fitting_raises_the_likelihood(spark, small_docs):
    pieces, weights = lm.read_pieces(PATH)
    assert np.logaddexp.reduce(weights) == pytest.approx(0)
    words = Counter(w for r in small_docs.collect() for w in lm.words_of(r.text))
    df = spark.createDataFrame([(bytearray(w), c) for w, c in words.items()], "word binary, c long")
    scores = []
    for rounds in (0, 1, 2):
        fitted, end = lm.fitted(pieces, weights, df, 200, rounds)
        p = lm.Lattice(pieces, fitted).log_probabilities(list(words))
        scores.append(float(p @ np.array(list(words.values()))))
        assert np.logaddexp(np.logaddexp.reduce(fitted), end) == pytest.approx(0, abs=1e-6)
    assert scores[0] < scores[1] < scores[2]


def test_rows_of_one_heading_are_dealt_to_all_blocks(spark, monkeypatch):
    seen = {}
    real = lm._block_words
    monkeypatch.setattr(lm, "_block_words", lambda docs: seen.update({r.block: r["count"] for r in docs.groupBy("block").count().collect()}) or real(docs))
    heading = "the same heading of more than sixty-four characters, as many files of one project have, and "
    rows = [(None, f"{heading}{k}") for k in range(4000)]
    got = lm.scores(spark.createDataFrame(rows, "doc_id long, text string"), PATH, block_bytes=10_000, rounds=0)
    assert got.count() == 4000 and len(seen) > 30 and max(seen.values()) < 3 * 4000 / len(seen)


def test_edge_rows(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = scored(edge_docs)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == base_scores(rows)
    assert scored(no_docs) == []
