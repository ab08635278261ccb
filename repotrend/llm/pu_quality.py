"""Document quality by positive-unlabelled learning.

Only texts trusted to be good are used as examples, beside unlabelled web text
in which good and bad are mixed.  With the share of good texts (the class prior)
known, the risk of a classifier over bad texts is that over unlabelled texts as
bad less the share that good ones have in it; that difference can't be negative,
so where the sample makes it so the step goes the other way (the non-negative
estimator).  The loss is logistic, so the score estimates a probability.

The prior is the share of label 1 among labelled training rows; it stands for that
among unlabelled texts, so labels are taken to be drawn like the texts.  The classifier
is a network of one hidden layer over style features of the whole text: shares
of character classes and of each ASCII mark, repetition of words and lines, and
lengths.  Labels, language, source and ids are never inputs.

Bounds (arguments): the fit takes at most ``positives`` trusted and ``unlabelled``
other texts, chosen by a hash of the id; the second bound can be switched off.
Scoring covers all rows.

Defined results: a null or empty text is scored as an empty one; a null id is not
held out and is passed through; repeated rows give repeated results; with no
trusted text to learn from every score is the prior (0.5 without labels); an
empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotrend.llm.scratch import Scratch
from repotrend.llm.tokens import chunks, text_buffer, word_hashes

POSITIVES, UNLABELLED = 8_000, 12_000
FOLDS = 5
THRESHOLD = 0.3
HIDDEN, STEPS, BATCH, RATE, DECAY = 24, 3_000, 1_024, 0.01, 1e-4
OWN = 13  # features besides the marks
MARKS = np.array([c for c in range(33, 127) if not chr(c).isalnum()], np.int64)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _line_repetition(text: bytes) -> tuple[float, float]:
    """(share of bytes in lines that came before, mean line length in bytes)."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    if not lines:
        return 0.0, 0.0
    seen, again, total = set(), 0, 0
    for line in lines:
        total += len(line)
        if line in seen:
            again += len(line)
        seen.add(line)
    return again / total, total / len(lines)


def features(column: pa.Array) -> np.ndarray:
    """A row of style features for each text."""
    data, offsets = text_buffer(column)
    out = np.zeros((len(column), len(MARKS) + OWN))
    for row, end in chunks(offsets):
        words, first = word_hashes(data, offsets[row : end + 1])
        for k in range(row, end):
            raw = data[offsets[k] : offsets[k + 1]]
            if not len(raw):
                continue
            count = np.bincount(raw, minlength=256)
            n, own = len(raw), words[first[k - row] : first[k - row + 1]]
            letters = count[65:91].sum() + count[97:123].sum() + count[128:].sum()
            w = max(1, len(own))
            times = np.unique(own, return_counts=True)[1]
            repeated, line = _line_repetition(raw.tobytes())
            out[k, : len(MARKS)] = np.sqrt(count[MARKS] / w)
            out[k, len(MARKS) :] = (
                np.log1p(len(own)), count[65:91].sum() / max(1, letters), count[48:58].sum() / n, count[128:].sum() / n,
                count[10] / w, letters / n, len(times) / w, times.max(initial=0) / w, len(times) / np.sqrt(w),
                n / w / 10, repeated, np.log1p(line), np.sqrt((own[1:] == own[:-1]).sum() / w),
            )
    return out


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    offset: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.hidden + self.bias) @ self.out + self.offset

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -40, 40)))


def risk(params: list[np.ndarray], x: np.ndarray, n: int, prior: float) -> tuple[float, float]:
    """The risk of ``x``, whose first ``n`` rows are trusted and the others unlabelled: (as good, as bad).

    As good: ``prior`` times the mean loss of trusted texts scored as bad.  As bad:
    the mean loss of unlabelled texts scored as good, less ``prior`` times that of
    the trusted ones, which estimates the loss of the bad texts among them.
    """
    g = np.tanh(x @ params[0] + params[1]) @ params[2] + params[3]
    return prior * np.logaddexp(0, -g[:n]).mean(), np.logaddexp(0, g[n:]).mean() - prior * np.logaddexp(0, g[:n]).mean()


def slopes(params: list[np.ndarray], x: np.ndarray, n: int, prior: float) -> list[np.ndarray]:
    """The gradient of the non-negative risk: of both parts, or, where the second is below 0, that which brings it back up."""
    h = np.tanh(x @ params[0] + params[1])
    g = h @ params[2] + params[3]
    sigmoid = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
    p, u = sigmoid[:n], sigmoid[n:]
    bad = np.logaddexp(0, g[n:]).mean() - prior * np.logaddexp(0, g[:n]).mean()
    grad = np.concatenate((-prior * (1 - p) - prior * p, u) if bad >= 0 else (prior * p, -u))
    grad /= np.concatenate((np.full(n, n), np.full(len(u), len(u))))
    back = grad[:, None] * params[2] * (1 - h * h)
    return [x.T @ back, back.sum(axis=0), h.T @ grad, np.array([grad.sum()])]


def _drawn(rows: np.ndarray, rng: np.random.Generator) -> Iterator[np.ndarray]:
    while True:
        yield rows[rng.integers(len(rows), size=BATCH)]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 0) -> Classifier:
    """Minimise the non-negative risk with Adam over batches drawn from both."""
    rng = np.random.default_rng(seed)
    mean, scale = unlabelled.mean(axis=0), np.maximum(np.concatenate((positive, unlabelled)).std(axis=0), 1e-3)
    return _fitted(positive, mean, scale, _drawn(unlabelled, rng), STEPS, prior, rng)


def fit_stream(positive: np.ndarray, unlabelled: Iterator[np.ndarray], blocks: int, moments: tuple[np.ndarray, np.ndarray], prior: float, seed: int = 0) -> Classifier:
    """As :func:`fit`, over all unlabelled rows in one pass: equally many batches are drawn from each of their ``blocks``.

    ``moments`` are the rows' means and deviations.
    """
    rng = np.random.default_rng(seed)
    draws = max(-(-STEPS // blocks), UNLABELLED // BATCH)
    batches = (rows[rng.integers(len(rows), size=BATCH)] for rows in unlabelled for _ in range(draws))
    return _fitted(positive, moments[0], np.maximum(moments[1], 1e-3), batches, draws * blocks, prior, rng)


def _fitted(positive: np.ndarray, mean: np.ndarray, scale: np.ndarray, unlabelled: Iterator[np.ndarray], steps: int, prior: float, rng: np.random.Generator) -> Classifier:
    p = np.clip((positive - mean) / scale, -8, 8)
    batches = (np.clip((x - mean) / scale, -8, 8) for x in unlabelled)
    d = p.shape[1]
    params = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.array([np.log(prior / (1 - prior))])]
    first, second = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    for step in range(1, steps + 1):
        x = np.concatenate((p[rng.integers(len(p), size=BATCH)], next(batches)))
        grads = slopes(params, x, BATCH, prior)
        grads[0] += DECAY * params[0]
        grads[2] += DECAY * params[2]
        rate = RATE * (1 - step / (steps + 1))
        for k, slope in enumerate(grads):
            first[k] += 0.1 * (slope - first[k])
            second[k] += 0.001 * (slope * slope - second[k])
            params[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Classifier(mean, scale, params[0], params[1], params[2], float(params[3][0]))


def _features_of(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features of the documents with the given ids (a bounded number, at most a text an id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x.tobytes() for x in features(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["x"])

    chosen = docs.join(F.broadcast(ids), "id", "left_semi").dropDuplicates(["id"]).select("text")
    rows = [np.frombuffer(r.x, np.float64) for r in chosen.mapInArrow(run, "x binary").collect()]
    return np.stack(rows) if rows else np.zeros((0, len(MARKS) + OWN))


def _streamed(docs: DataFrame) -> tuple[Iterator[np.ndarray], tuple[np.ndarray, np.ndarray], int]:
    """(the features of all texts in a hashed order, ``UNLABELLED`` at a time; their means and deviations; their number)."""
    width = len(MARKS) + OWN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.tolist() for x in features(batch.column("text"))], pa.list_(pa.float64()))], ["x"])

    scratch = Scratch(docs.sparkSession)
    rows = scratch.save(docs.orderBy(F.xxhash64("id"), "id").select("text").mapInArrow(run, "x array<double>"), "features")
    parts = [F.struct(F.count("*").alias("n"), F.avg(F.col("x")[k]).alias("m"), F.stddev_pop(F.col("x")[k]).alias("s")).alias(f"c{k}") for k in range(width)]
    found = rows.agg(*parts).first()
    mean, deviation = (np.array([c[k] or 0.0 for c in found]) for k in ("m", "s"))

    def blocks() -> Iterator[np.ndarray]:
        held = []
        for r in rows.toLocalIterator():
            held.append(r.x)
            if len(held) == UNLABELLED:
                yield np.array(held)
                held = []
        if held:
            yield np.array(held)

    return blocks(), (mean, deviation), found[0]["n"]


def trained(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
            positives: int = POSITIVES, unlabelled: int | None = UNLABELLED) -> Classifier | float:
    """A classifier fitted to trusted and unlabelled texts outside the held-out fold, or the prior alone.

    It is fitted to at most ``positives`` trusted texts and ``unlabelled`` others,
    those of the least hashes of their ids, which the driver holds; with
    ``unlabelled=None`` to every unlabelled text, whose features are written and
    read through the driver block by block.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
    marked = marked.where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    # A row an id; where labels of an id differ, it isn't trusted.
    marked = marked.groupBy("id").agg(F.min("y").alias("y"))
    prior = marked.agg(F.avg("y")).first()[0]
    if prior is None:
        return 0.5
    order = F.xxhash64("id"), F.col("id")
    good = marked.where("y = 1").select("id").orderBy(*order).limit(positives)
    positive, prior = _features_of(docs, good), float(np.clip(prior, 0, 1))
    if unlabelled is None:
        blocks, moments, n = _streamed(docs)
        return fit_stream(positive, blocks, -(-n // UNLABELLED), moments, float(np.clip(prior, 0.01, 0.99))) if len(positive) and n else prior
    other = docs.select("id").distinct().orderBy(*order).limit(unlabelled)
    rest = _features_of(docs, other)
    return fit(positive, rest, float(np.clip(prior, 0.01, 0.99))) if len(positive) and len(rest) else prior


def with_scores(documents: DataFrame, model: Classifier | float, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The documents with the column ``score``."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if isinstance(model, float):
            return pa.array(np.full(len(texts), model))
        return pa.array(model.scores(features(texts)))

    return documents.withColumn(score_col, scored(F.col(text_col).cast("string")))


def quality(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
            positives: int = POSITIVES, unlabelled: int | None = UNLABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``documents``; see :func:`trained` for the bounds."""
    model = trained(documents, labels, id_col, text_col, positives=positives, unlabelled=unlabelled)
    docs = documents.select(F.col(id_col), F.col(text_col))
    out = with_scores(docs, model, text_col)
    return out.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
