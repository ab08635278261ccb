"""Language-model scores from the lattice of all segmentations into known pieces.

The pieces are those of an existing subword vocabulary, and their scores in the
file are the first weights (its scores are merge ranks, read as a Zipf law).
The weights are then fitted to the training texts: an expectation step sums,
over all training words and all their segmentations, how often each piece is
expected, and the new weights are in proportion.  No tokenizer is trained and no
piece is added.

A text is its words and an end.  A word is written with a leading space byte, and
a piece spans no space but at its start, so the sum over the segmentations of a
text is a product over its words.  A word's probability is found by the forward
recursion, in logarithms, over the bytes of the word: from every place each piece
that stands there leads on, single bytes always do.  It is worked out once for
each distinct word of the corpus, many words at a time.

Beside it, word counts of the training texts give the add-half score of the
contract.  Words are runs of bytes other than space and 0x09-0x0D, A-Z as a-z.
Counts are joined to texts by blocks of texts: a block's distinct words are
looked up once, so neither the vocabulary nor a hot word meets in one task.

Defined results: a null text counts as empty and is the end alone; a null id is
training text and is passed through; repeated rows count each; without training
texts the first weights and zero counts are used; an empty table gives none.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotrend.llm.scratch import Scratch

FOLDS, HELD = 5, 1
BLOCK_BYTES = 16 << 20  # of text looked up together
ROUNDS = 1  # expectation steps
PRIOR = 0.01  # added to each piece's expected count
SHORT = 48  # bytes of the words that are scored many at a time
TOGETHER = 1 << 13
_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def read_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """(pieces that can stand in a word, log weights that sum to one less the end's share) of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores: dict[bytes, list[float]] = {}
    for k in range(model.get_piece_size()):
        if model.is_byte(k):
            piece = bytes([int(model.id_to_piece(k)[1:-1], 16)])
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            continue
        else:
            piece = model.id_to_piece(k).replace("▁", " ").encode()
            if b" " in piece[1:] or piece.lower() != piece:
                continue
        scores.setdefault(piece, []).append(model.get_score(k))
    for k in range(256):
        scores.setdefault(bytes([k]), []).append(min(min(x) for x in scores.values()))
    pieces = sorted(scores)
    best = np.array([max(scores[p]) for p in pieces])
    if (best == np.round(best)).all():  # merge ranks, not logarithms
        best = -np.log(2.0 + np.argsort(np.argsort(-best, kind="stable"), kind="stable"))
    return pieces, best - np.logaddexp.reduce(best)


class Lattice:
    """Pieces with their log weights."""

    def __init__(self, pieces: list[bytes], weights: np.ndarray):
        self.pieces, self.weights = pieces, np.append(weights, -np.inf)
        self.longest = max(map(len, pieces))
        self.place = {p: k for k, p in enumerate(pieces)}
        keys = np.array([self._key(p) for p in pieces], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        steps = np.full(self.longest + 1, _BASE)
        steps[0] = 1
        self.powers = np.multiply.accumulate(steps)

    @staticmethod
    def _key(piece: bytes) -> int:
        out = 0
        for k, c in enumerate(reversed(piece)):
            out += int(_VALUE[c]) * pow(int(_BASE), k, 2**64)
        return out % 2**64

    def _ending(self, words: np.ndarray) -> list[list[np.ndarray]]:
        """For each end, the piece of each length before it, for all words (rows of equal length); -1 where none."""
        values = _VALUE[words]
        out = []
        for end in range(1, words.shape[1] + 1):
            key, row = np.zeros(len(words), np.uint64), []
            for size in range(1, min(end, self.longest) + 1):
                key = key + values[:, end - size] * self.powers[size - 1]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                row.append(np.where(self.keys[at] == key, self.order[at], -1))
            out.append(row)
        return out

    def _forward(self, n: int, rows: int, ending: list[list[np.ndarray]]) -> np.ndarray:
        alpha = np.full((n + 1, rows), -np.inf)
        alpha[0] = 0
        for end in range(1, n + 1):
            for size, piece in enumerate(ending[end - 1], 1):
                step = alpha[end - size] + self.weights[piece]
                alpha[end] = step if size == 1 else np.logaddexp(alpha[end], step)
        return alpha

    def _one(self, word: bytes, counts: np.ndarray | None = None, times: float = 0.0) -> float:
        """A long word by itself; adds its expected pieces to ``counts`` if given."""
        n, alpha = len(word), [0.0]
        found: list[list[tuple[int, int, float]]] = []
        for end in range(1, n + 1):
            row = []
            for start in range(max(0, end - self.longest), end):
                k = self.place.get(word[start:end])
                if k is not None:
                    row.append((start, k, float(self.weights[k])))
            top = max(alpha[s] + w for s, _, w in row)
            alpha.append(top + math.log(sum(math.exp(alpha[s] + w - top) for s, _, w in row)))
            found.append(row)
        if counts is not None:
            beta = [-math.inf] * n + [0.0]
            for end in range(n, 0, -1):
                for s, k, w in found[end - 1]:
                    counts[k] += times * math.exp(alpha[s] + w + beta[end] - alpha[n])
                    x, y = beta[s], w + beta[end]
                    beta[s] = max(x, y) + math.log1p(math.exp(-abs(x - y)))
        return alpha[n]

    def _groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, rows of bytes) of the short words of each length, with the space before them."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(sizes[sizes <= SHORT]):
            at = np.flatnonzero(sizes == n)
            for k in range(0, len(at), TOGETHER):
                part = at[k : k + TOGETHER]
                rows = np.frombuffer(b"".join(b" " + words[i] for i in part), np.uint8).reshape(len(part), n + 1)
                yield part, rows

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithms of the marginal probabilities."""
        out = np.zeros(len(words))
        for at, rows in self._groups(words):
            out[at] = self._forward(rows.shape[1], len(rows), self._ending(rows))[-1]
        for k, word in enumerate(words):
            if len(word) > SHORT:
                out[k] = self._one(b" " + word)
        return out

    def expected(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """Expected number of each piece in the words, each as often as it occurs."""
        counts = np.zeros(len(self.pieces) + 1)
        for at, rows in self._groups(words):
            n, ending = rows.shape[1], self._ending(rows)
            alpha = self._forward(n, len(rows), ending)
            beta = np.full((n + 1, len(rows)), -np.inf)
            beta[n] = 0
            for end in range(n, 0, -1):
                rest = beta[end] - alpha[n]
                for size, piece in enumerate(ending[end - 1], 1):
                    some = np.flatnonzero(piece >= 0)
                    if len(some):
                        k, start = piece[some], end - size
                        step = self.weights[k]
                        share = np.exp(alpha[start, some] + step + rest[some]) * times[at[some]]
                        counts += np.bincount(k, share, len(counts))
                        beta[start, some] = np.logaddexp(beta[start, some], step + beta[end, some])
        for k, word in enumerate(words):
            if len(word) > SHORT:
                self._one(b" " + word, counts, float(times[k]))
        return counts[:-1]


def _block_words(docs: DataFrame) -> DataFrame:
    """(block, word, c): distinct words of each block of (block, train, text), and how often training texts of it have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, tuple[Counter, set]] = {}
            for block, train, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                own = counts.setdefault(block.as_py(), (Counter(), set()))
                words = words_of(text.as_py())
                own[0].update(words) if train.as_py() else own[1].update(words)
            for block, (known, other) in counts.items():
                other -= known.keys()
                words, times = [*known, *other], [*known.values(), *[0] * len(other)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(words), pa.int32()), pa.array(words, pa.binary()), pa.array(times, pa.int64())], ["block", "word", "c"])

    return docs.select("block", "train", "text").mapInArrow(run, "block int, word binary, c long")


def fitted(pieces: list[bytes], weights: np.ndarray, words: DataFrame, ends: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """(log weights of the pieces, log weight of the end) after ``rounds`` expectation steps over (word, c)."""
    sc = words.sparkSession.sparkContext
    end = math.log(0.01)
    weights = weights + math.log(0.99)
    for _ in range(rounds if ends else 0):
        shared = sc.broadcast((pieces, weights))  # the vocabulary of the file: its size is fixed

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(*shared.value)
            total = np.zeros(len(lattice.pieces))
            for batch in batches:
                total += lattice.expected(batch.column("word").to_pylist(), batch.column("c").to_numpy())
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["piece", "n"])

        sums = words.where("c > 0").select("word", "c").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = np.full(len(pieces), PRIOR)
        for row in sums.collect():  # a row a piece
            counts[row.piece] += row.n
        everything = counts.sum() + ends
        weights, end = np.log(counts / everything), math.log(ends / everything)
    return weights, end


def scores(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row; ``path`` is the vocabulary."""
    spark = documents.sparkSession
    scratch = Scratch(spark)
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    place = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")
    docs = rows.select("id", (~held_out(F.col("id"))).alias("train"), place.alias("block"), "text")

    own = scratch.save(_block_words(docs).groupBy("block", "word").agg(F.sum("c").alias("c")), "block-words")
    words = scratch.save(own.groupBy("word").agg(F.sum("c").alias("c")), "words")
    ends = docs.where("train").count()
    known = words.where("c > 0").agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = (known.n or 0) + ends, known.v + (1 if ends else 0)
    below = math.log10(n + 0.5 * (v + 1))
    end_base = math.log10(ends + 0.5) - below

    pieces, weights = read_pieces(path)
    weights, end = fitted(pieces, weights, words, ends, rounds)
    shared = spark.sparkContext.broadcast((pieces, weights))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in batches:
            p = lattice.log_probabilities(batch.column("word").to_pylist()) / math.log(10)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(p)], ["word", "c", "p"])

    looked_up = own.select("block", "word").join(words.mapInArrow(weighed, "word binary, c long, p double"), "word")

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        some = found.num_rows > 0
        at = {w: k for k, w in enumerate(found.column("word").to_pylist())} if some else {}
        c, p = (found.column(x).to_numpy() if some else np.empty(0) for x in ("c", "p"))
        base = np.log10(c + 0.5) - below
        out = []
        for text in texts.column("text"):
            ks = np.fromiter(map(at.__getitem__, words_of(text.as_py())), np.int64)
            out.append((len(ks) + 1, int((c[ks] > 0).sum()) + (ends > 0), float(base[ks].sum()) + end_base,
                        float(p[ks].sum()) + end / math.log(10)))
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table([texts.column("id").cast(pa.int64()), texts.column("train"), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))],
                        names=["id", "train", "n_tokens", "n_known", "base_score", "score"])

    done = docs.groupBy("block").cogroup(looked_up.groupBy("block")).applyInArrow(
        score, "id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return done.select(F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                       F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
