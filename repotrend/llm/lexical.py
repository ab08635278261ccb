"""Ranked lexical search: queries (items) against all documents by dense blocked multiplication.

Terms are maximal runs of characters other than the ASCII ones that are neither
letters nor digits, A-Z as a-z.  A term's weight comes from the number of documents
that hold it, its impact in a document from its occurrences and the document's
length; both are integers, and an item's score for a document is the sum of weight
times impact over the item's terms, repeats included.

Items are taken in blocks of bounded size.  For a block the documents are scanned
once and kept as (id, number of terms, places in the block's vocabulary,
occurrences), which gives the document frequencies as well.  Items with a common
compact vocabulary are a tile: a dense matrix (items x vocabulary) of repeats times
weight.  A tile of documents is a dense matrix (vocabulary x documents) of impacts,
and BLAS multiplies the two in float64.  An impact is below 10^6, and the columns of
a tile are dealt to parts such that no item's sum can reach 2^53 in one of them: so
each product is an exact integer, whatever the order of summation, and parts are
added as 64-bit integers.

Of each tile the ``k`` best documents of each item are kept, equal scores by
ascending id, and merged with the best so far; each task returns ``k`` an item at
most, and those are merged over tasks in two steps, dealt by item and a hash of the
document first.

Defined results: null or empty texts and texts without a term take no part; rows of
one document id are documents each, and a null id comes last among equal scores; an
item is an item id (a null id is one too) with the terms of all its distinct texts;
an item without a term, or without a document that scores above 0, has no rows, nor
have empty tables; other columns are ignored.  The distinct terms of one item are
held in a task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repotrend.llm.scratch import Scratch

BLOCK_BYTES = 1 << 21  # of items' distinct terms in a block, which the driver and every task hold
ITEMS = 256  # of an item tile
VOCABULARY = 2048  # terms of an item tile
DOCUMENTS = 2048  # of a document tile
SALTS = 32
IMPACT = 10**6  # no impact reaches it
EXACT = 2**53

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: every byte of a character beyond ASCII belongs to one."""
    return text.translate(_FOLD).split()


def weight(n_documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * frequency + 1)))


@dataclass
class Part:
    """Columns of an item tile: ``vocabulary`` sorted, and the entries (row, column, repeats times weight)."""

    vocabulary: np.ndarray
    rows: np.ndarray
    columns: np.ndarray
    entries: np.ndarray


@dataclass
class Tile:
    ids: list[int | None]
    parts: list[Part]


def _parts(items: list[dict[int, int]], most: int, limit: int) -> list[Part]:
    """The tile's columns in parts of at most ``most`` terms and row sums of at most ``limit``."""
    columns: dict[int, dict[int, int]] = {}
    for row, own in enumerate(items):
        for term, entry in own.items():
            columns.setdefault(term, {})[row] = entry
    parts, now, sums = [], {}, Counter()

    def close() -> None:
        names = np.array(sorted(now), np.int64)
        flat = [(row, at, entry) for at, term in enumerate(names.tolist()) for row, entry in now[term].items()]
        rows, places, entries = (np.array(x) for x in zip(*flat, strict=True))
        parts.append(Part(names, rows, places, entries.astype(np.float64)))
        now.clear()
        sums.clear()

    left = sorted(columns.items())
    while left:
        later = []
        for term, column in left:
            if over := {row: entry - limit for row, entry in column.items() if entry > limit}:
                later.append((term, over))  # one term may need several columns
                column = {row: min(entry, limit) for row, entry in column.items()}
            if now and (len(now) == most or any(sums[row] + entry > limit for row, entry in column.items())):
                close()
            now[term] = column
            sums.update(column)
        if now:
            close()
        left = later
    return parts


def tiles(items: list[tuple[int | None, dict[int, int]]], weights: np.ndarray, most: int = VOCABULARY, limit: int = EXACT // IMPACT) -> list[Tile]:
    """Items (id, {place in the vocabulary: repeats}) in tiles; terms of weight 0 and items without any other are left out."""
    weighed = [(i, {t: c * int(weights[t]) for t, c in own.items() if weights[t]}) for i, own in items]
    out, held, seen = [], [], set()
    for i, own in sorted((x for x in weighed if x[1]), key=lambda x: min(x[1])):
        if held and (len(held) == ITEMS or len(seen | own.keys()) > most):
            out.append(held)
            held, seen = [], set()
        held.append((i, own))
        seen |= own.keys()
    if held:
        out.append(held)
    return [Tile([i for i, _ in group], _parts([own for _, own in group], most, limit)) for group in out]


def scores(tile: Tile, vocabulary: np.ndarray, documents: np.ndarray, impacts: np.ndarray, n: int) -> np.ndarray:
    """int64 (items x documents) from the entries (term, document, impact) of ``n`` documents."""
    total = np.zeros((len(tile.ids), n), np.int64)
    for part in tile.parts:
        at = np.searchsorted(part.vocabulary, vocabulary)
        own = part.vocabulary[np.minimum(at, len(part.vocabulary) - 1)] == vocabulary
        if own.any():
            right = np.zeros((len(part.vocabulary), n))
            right[at[own], documents[own]] = impacts[own]
            left = np.zeros((len(tile.ids), len(part.vocabulary)))
            left[part.rows, part.columns] = part.entries
            total += (left @ right).astype(np.int64)
    return total


class Best:
    """The ``k`` best (score, id) of each item of a tile so far; a score of 0 is none."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), np.int64)
        self.id = np.zeros((items, k), np.int64)
        self.none = np.zeros((items, k), bool)

    def add(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        """Scores of documents that are sorted by id, those without one last."""
        if not (score > self.score[:, -1:]).any() and not ((score == self.score[:, -1:]) & (score > 0)).any():
            return
        top = np.argsort(-score, axis=1, kind="stable")[:, : self.k]  # stable: equal scores stay by id
        score = np.concatenate((self.score, np.take_along_axis(score, top, 1)), 1)
        id_, null = np.concatenate((self.id, ids[top]), 1), np.concatenate((self.none, none[top]), 1)
        order = np.lexsort((id_, null, -score), axis=1)[:, : self.k]
        self.score, self.id, self.none = (np.take_along_axis(x, order, 1) for x in (score, id_, null))


_TERMS = "item_id long, term binary, repeats long"
_POSTINGS = "id long, n long, terms array<int>, tfs array<long>"
_RANKED = "item_id long, doc_id long, score long"


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, term, repeats) over the distinct texts of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i.as_py(), t, c) for i, text in zip(batch.column("i"), batch.column("t"), strict=True) for t, c in Counter(terms(text.as_py().encode())).items()]
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64()), strict=True)], ["item_id", "term", "repeats"])

    rows = items.select(F.col(f"`{item_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t")).where("t IS NOT NULL")
    return rows.distinct().mapInArrow(run, _TERMS).groupBy("item_id", "term").agg(F.sum("repeats").alias("repeats"))


def postings(documents: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(id, n, terms, tfs) of each document (id, text) with a term: its length, and places in the vocabulary with occurrences."""
    shared = documents.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            ids, lengths, places, tfs, offsets = [], [], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [0]
            for id_, text in zip(batch.column("id"), batch.column("text"), strict=True):
                words = terms(text.as_py().encode())
                if words:
                    own, count = np.unique([place[w] for w in words if w in place], return_counts=True)
                    ids.append(id_.as_py())
                    lengths.append(len(words))
                    places.append(own)
                    tfs.append(count)
                    offsets.append(offsets[-1] + len(own))
            ends = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(places).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tfs).astype(np.int64)))], ["id", "n", "terms", "tfs"])

    return documents.where("text IS NOT NULL").mapInArrow(run, _POSTINGS)


def _ranked(index: DataFrame, own: list[Tile], n_documents: int, n_terms: int, k: int, size: int) -> DataFrame:
    """The ``k`` best documents of each item in each partition of the index."""
    shared = index.sparkSession.sparkContext.broadcast(own)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """Tiles: ids, which have none, and the entries (term, document, impact)."""
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                rows = batch.slice(first, size)
                none = np.asarray(rows.column("id").is_null())
                ids = rows.column("id").fill_null(0).to_numpy()
                order = np.lexsort((ids, none))
                places, tfs = rows.column("terms"), rows.column("tfs").flatten().to_numpy()
                lengths = np.diff(places.offsets.to_numpy())
                row = np.empty(len(order), np.int64)
                row[order] = np.arange(len(order))
                at = np.repeat(row, lengths)
                m = np.array([25 + 75 * n * n_documents // n_terms for n in rows.column("n").to_pylist()], np.int64)
                impacts = 10**9 * tfs // (1000 * tfs + 8 * np.repeat(m, lengths))
                yield ids[order], none[order], places.flatten().to_numpy(), at, impacts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best = [Best(len(t.ids), k) for t in own]
        for ids, none, vocabulary, at, impacts in documents(batches):
            for tile, top in zip(own, best, strict=True):
                top.add(scores(tile, vocabulary, at, impacts, len(ids)), ids, none)
        for tile, top in zip(own, best, strict=True):
            row, column = np.nonzero(top.score)
            yield pa.RecordBatch.from_arrays(
                [pa.array([tile.ids[r] for r in row], pa.int64()), pa.array(top.id[row, column], mask=top.none[row, column]), pa.array(top.score[row, column])],
                ["item_id", "doc_id", "score"])

    return index.mapInArrow(run, _RANKED)


def search(
    documents: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES, vocabulary_tile: int = VOCABULARY, document_tile: int = DOCUMENTS, limit: int = EXACT // IMPACT,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = documents.sparkSession
    scratch = Scratch(spark)
    docs = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    wanted = scratch.save(item_terms(items, item_col, item_text_col), "items")
    size = wanted.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = math.ceil(size / block_bytes)
    found, totals = None, None
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # about block_bytes
        vocabulary = sorted({bytes(r.term) for r in rows})
        place = {t: j for j, t in enumerate(vocabulary)}
        index = scratch.save(postings(docs, vocabulary), f"postings-{block}")
        totals = totals or index.agg(F.count("*"), F.sum("n")).first()
        frequency = np.zeros(len(vocabulary), np.int64)
        for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            frequency[r[0]] = r[1]
        weights = np.array([weight(totals[0], f) if f else 0 for f in frequency.tolist()], np.int64)
        counts: dict[int | None, dict[int, int]] = {}
        for r in rows:
            counts.setdefault(r.item_id, {})[place[bytes(r.term)]] = r.repeats
        own = tiles(list(counts.items()), weights, vocabulary_tile, limit)
        part = scratch.save(_ranked(index, own, totals[0], totals[1], k, document_tile), f"ranked-{block}")
        scratch.drop(f"postings-{block}")
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], _RANKED)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    dealt = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*best))).where(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best))).where(F.col("rank") <= k)
    return last.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
