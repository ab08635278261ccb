"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over four or five consecutive words: the hash of the words
at its ones, whatever stands at its zero.  Seeds of benchmark items are joined
with those of the documents.  The masks cover five words with any one of them
replaced, and a stretch with at least four in five words matching has five such
words in a row (else each of its whole fives had two others), or is four words
of an item of five; so every stretch of the rule has a seed.  Around each
hit, item and document are laid against each other at the hit's offset, and the
best stretch is kept: of those of at least ``OVERLAP`` words, or four fifths of
a shorter item, in which at least four in five words match, the one with the
most matching words less four for each other word.  Any such stretch is
contamination.

The documents are scanned once for each block of items of at most
``BLOCK_SEEDS`` seeds, whose sorted table every task has; this bounds what is
sent to tasks however large the benchmark is, and nothing of the documents is
shuffled.

Words are runs of bytes other than space and 0x09-0x0D, A-Z as a-z.  An item of
one to four words has one seed, of all its words, and is found where it stands
whole, at its first place in a document.  Such an item can be ordinary text;
``least_words`` leaves shorter items out.

Defined results: null or empty texts and null items are never found; a null id is
passed through, and its rows count as one document; of repeated ids the best
stretch is returned once; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotrend.llm.tokens import chunks, mix, text_buffer, word_hashes

MASKS = ("1111", "11101", "11011", "10111")  # an end or a middle word of five replaced
SHORT = ("1", "11", "111", "1111")  # a whole item of one to four words
SPAN = max(map(len, MASKS))
OVERLAP = 13
MISMATCH = 4  # matching words that make up for another
BLOCK_SEEDS = 1_000_000
_BITS = 22  # of the table that a hash is looked up in first


def seeds(words: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The hash of each window of ``words`` under the mask."""
    n = len(words) - len(mask) + 1
    out = np.full(max(n, 0), salt, np.uint64)
    if n > 0:
        for k, one in enumerate(mask):
            if one == "1":
                out = mix(out + words[k : k + n])
    return out


def stretch(item: np.ndarray, words: np.ndarray, offset: int) -> tuple[int, int, int] | None:
    """(start in the item, length, matches) of the best stretch with item[k] laid on words[offset + k]; None if it's too short."""
    lo, hi = max(0, -offset), min(len(item), len(words) - offset)
    match = item[lo:hi] == words[lo + offset : hi + offset]
    need = min(OVERLAP, -(-4 * len(item) // 5))
    if len(match) < need:
        return None
    total = np.concatenate(([0], np.cumsum(np.where(match, 1, -MISMATCH))))
    gain = total[need:] - np.minimum.accumulate(total[: len(total) - need])
    end = need + int(gain.argmax())
    if gain[end - need] < 0:
        return None
    start = int(total[: end - need + 1].argmin())
    return lo + start, end - start, int(match[start:end].sum())


class SeedTable:
    """Items' words and the sorted table of their seeds."""

    def __init__(self, items: list[tuple[int, np.ndarray]], least_words: int = 1):
        self.items = [(i, w) for i, w in items if len(w) >= max(1, least_words)]
        keys, owners, places = [], [], []
        self.short = sorted({len(w) for _, w in self.items if len(w) < SPAN})
        for k, (_, words) in enumerate(self.items):
            for kind, mask in [(-len(words), SHORT[len(words) - 1])] if len(words) < SPAN else enumerate(MASKS, 1):
                own = seeds(words, mask, kind % 2**64)
                keys.append(own)
                owners.append(np.full(len(own), k))
                places.append(np.arange(len(own)))
        flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, owners, places)]
        order = np.argsort(flat[0], kind="stable")
        self.keys, self.owners, self.places = (x[order] for x in flat)
        self.keys = self.keys.astype(np.uint64)
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self.keys >> np.uint64(64 - _BITS)] = True

    def _hits(self, words: np.ndarray, mask: str, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """(place in words, place in the table) of each equal seed."""
        own = seeds(words, mask, salt)
        at = np.flatnonzero(self.seen[own >> np.uint64(64 - _BITS)])
        lo = np.searchsorted(self.keys, own[at], "left")
        n = np.searchsorted(self.keys, own[at], "right") - lo
        return np.repeat(at, n), np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place in words, item, place in the item) of each equal seed of the longer items."""
        for kind, mask in enumerate(MASKS, 1):
            at, k = self._hits(words, mask, kind)
            yield from zip(at.tolist(), self.owners[k].tolist(), self.places[k].tolist(), strict=True)

    def whole(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, word) where a short item stands first in each of the texts that begin at ``first``."""
        for n in self.short:
            at, k = self._hits(words, SHORT[n - 1], -n % 2**64)
            text = np.searchsorted(first, at, "right") - 1
            inside = at + n <= first[text + 1]
            text, item, at = text[inside], self.owners[k][inside], at[inside]
            _, least = np.unique(text * len(self.items) + item, return_index=True)
            yield from zip(text[least].tolist(), item[least].tolist(), (at - first[text])[least].tolist(), strict=True)


def _word_lists(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: (first row, end, all their words, first word of each row and the end)."""
    data, offsets = text_buffer(column)
    for row, end in chunks(offsets):
        yield row, end, *word_hashes(data, offsets[row : end + 1])


_FOUND = "item_id long, n_words long, n_matches long, doc_start long, item_start long"


def _scan(docs: DataFrame, table: SeedTable) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(table)
    binary = isinstance(docs.schema["id"].dataType, T.BinaryType)
    names = ["id", *(x.split()[0] for x in _FOUND.split(", "))]
    types = [pa.binary() if binary else pa.int64(), *[pa.int64()] * (len(names) - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            ids, out = batch.column("id"), []
            for row, end, words, first in _word_lists(batch.column("text")):
                # Seeds of many texts at once; one that reaches over the end of its text is no seed.
                offsets: dict[tuple[int, int], set[int]] = {}
                for place, item, at in table.hits(words):
                    k = int(np.searchsorted(first, place, "right")) - 1
                    offsets.setdefault((k, item), set()).add(place - int(first[k]) - at)
                for (k, item), tries in offsets.items():
                    own, name = words[first[k] : first[k + 1]], table.items[item]
                    best = max(((s[2], -(t + s[0]), s, t) for t in tries if (s := stretch(name[1], own, t))), default=None)
                    if best:
                        (start, length, matches), t = best[2:]
                        out.append((ids[row + k].as_py(), name[0], length, matches, t + start, start))
                for k, item, start in table.whole(words, first):
                    name, own = table.items[item]
                    out.append((ids[row + k].as_py(), name, len(own), len(own), start, 0))
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.mapInArrow(run, f"id {'binary' if binary else 'long'}, {_FOUND}")


def contaminated(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_seeds: int = BLOCK_SEEDS, least_words: int = 1,
) -> DataFrame:
    """(doc_id, item_id, n_words, n_matches, doc_start, item_start): the best stretch of each item in each document, in words.

    Items of fewer than ``least_words`` words are left out.  Ids are whole numbers, or binary.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    key = "binary" if isinstance(documents.schema[id_col].dataType, T.BinaryType) else "long"
    docs = documents.select(F.col(id_col).cast(key).alias("id"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 * len(MASKS) / block_seeds))  # a word takes two bytes at least
    found = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).distinct().collect()
        texts = pa.array([r.text for r in part], pa.string())
        lists = [w[first[k] : first[k + 1]] for _, _, w, first in _word_lists(texts) for k in range(len(first) - 1)]
        own = _scan(docs, SeedTable([(r.item, w) for r, w in zip(part, lists, strict=True)], least_words))
        found = own if found is None else found.union(own)
    best = F.max(F.struct("n_matches", (-F.col("n_words")).alias("w"), (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i"))).alias("b")
    return found.groupBy("id", "item_id").agg(best).select(
        F.col("id").alias(id_col), "item_id", (-F.col("b.w")).alias("n_words"), F.col("b.n_matches").alias("n_matches"),
        (-F.col("b.d")).alias("doc_start"), (-F.col("b.i")).alias("item_start"))
