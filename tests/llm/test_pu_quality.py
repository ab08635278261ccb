import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm_fixtures import edge_docs, no_docs  # noqa: F401

from repotrend.llm import pu_quality as pq


@pytest.fixture(scope="module")
def small(spark):
    return tuple(spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in pq.quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    marked = [(rows[r.doc_id], r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    right = np.mean([x.predicted == y for x, y in marked])
    bad = np.mean([x.predicted == 0 for x, y in marked if y == 0])
    assert right > 0.95 and bad > 0.8, (right, bad)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())


def test_risk_finds_the_bad_without_bad_examples():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (6000, 2)), rng.normal(-1.5, 1, (2000, 2))
    model = pq.fit(good[:2000], np.concatenate((good[2000:], bad)), 2 / 3)
    assert (model.scores(good) > 0.5).mean() > 0.9 and (model.scores(bad) < 0.5).mean() > 0.9


def test_risk_and_gradient_by_brute_force():
    rng = np.random.default_rng(4)
    params = [rng.normal(0, 1, (3, 5)), rng.normal(0, 1, 5), rng.normal(0, 1, 5), np.array([0.3])]
    x, n, prior = rng.normal(0, 1, (40, 3)), 15, 0.6

    def margin(row):
        return sum(params[2][j] * np.tanh(sum(row[k] * params[0][k, j] for k in range(3)) + params[1][j]) for j in range(5)) + params[3][0]

    def loss(g, good):
        return np.log(1 + np.exp(-g if good else g))

    def plain():
        as_good = prior * sum(loss(margin(r), True) for r in x[:n]) / n
        return as_good, sum(loss(margin(r), False) for r in x[n:]) / (40 - n) - prior * sum(loss(margin(r), False) for r in x[:n]) / n

    for shift in (0.3, -6.0):  # with the second part above 0, and clamped below it
        params[3][0] = shift
        if shift < 0:
            params[2][:] = np.abs(params[2])
            x[:n], x[n:] = 2 * np.sign(params[0].sum(1)), -2 * np.sign(params[0].sum(1))
            params[3][0] = 0.0
        assert np.allclose(pq.risk(params, x, n, prior), plain())
        clamped = plain()[1] < 0
        assert clamped == (shift < 0)
        found = pq.slopes(params, x, n, prior)
        for which, own in enumerate(params):
            for at in np.ndindex(own.shape):
                held, ends = own[at], []
                for step in (1e-6, -1e-6):
                    own[at] = held + step
                    good, bad = plain()
                    ends.append(-bad if clamped else good + bad)
                own[at] = held
                assert abs((ends[0] - ends[1]) / 2e-6 - found[which][at]) < 1e-6


def test_all_unlabelled_texts_can_be_streamed(spark, small, monkeypatch):
    docs, labels = small
    monkeypatch.setattr(pq, "UNLABELLED", 300)  # rows of a block
    model = pq.trained(docs, labels, unlabelled=None)
    bounded = pq.trained(docs, labels, positives=10, unlabelled=10)
    whole = {r.doc_id: r.score for r in pq.with_scores(docs, model).collect()}
    assert isinstance(model, pq.Classifier) and isinstance(bounded, pq.Classifier)
    marked = [(whole[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in whole]
    assert np.mean([(s >= pq.THRESHOLD) == (y == 1) for s, y in marked]) > 0.9
    blocks, (mean, deviation), n = pq._streamed(docs.select(docs.doc_id.alias("id"), "text"))
    rows = np.concatenate(list(blocks))
    want = pq.features(pa.array([r.text for r in docs.collect()]))
    assert n == len(rows) == len(want) and np.allclose(np.sort(rows.sum(1)), np.sort(want.sum(1)))
    assert np.allclose(mean, want.mean(0)) and np.allclose(deviation, want.std(0))


def test_features_of_empty_texts():
    assert not pq.features(pa.array([None, "", "ab\ncd"]))[:2].any()


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(3, 1), (6, 1), (6, 0), (7, None), (None, 1)], "doc_id long, quality int")
    rows = pq.quality(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert {r.score for r in pq.quality(edge_docs, labels.limit(0)).collect()} == {0.5}
    assert pq.quality(no_docs, labels).count() == 0
