"""Nearest neighbours of query vectors by a block matrix join with quantised products.

Rows of equal vectors are one class.  Classes that hold a query are dealt to stripes,
all classes to blocks, by hash; a cell is a stripe and a block, joined on the cell's
key (cogrouped), so a task holds one block and one stripe, each of bounded bytes, and
every stripe meets every block once.

In a cell, vectors are rounded to int8 with a scale of their own, and the error of
each is kept as its Euclidean length.  Tiles of int8 products (exact in float32 BLAS,
as sums stay below 2^24) give the distance of two rounded vectors; the true distance
is within the sum of the two errors of it.  A query's bound is the least of what its
heap holds as ``k``-th nearest and the ``k``-th least upper bound of the tile; pairs
whose lower bound is not above that survive, are recomputed from the original
vectors in float64, component by component, and pushed to the query's heap of ``k``.
The heaps of a query's cells are merged in two steps.  Nothing is approximate: a pair
that is dropped can't be among the nearest.

Copies: of a class only the ``k + 1`` least ids can be among the nearest of any
query, as every other member is as far and comes later; so a vector that a third of
all rows share costs one row.  What is found for a class holds for each query in it.

Defined results: a null or zero vector, or one with a null or non-finite component,
takes no part; vectors of different lengths aren't compared; equal rows (id and
vector) count once; rows of one id with different vectors are rows each, as queries
and as candidates, and a query's own row isn't its candidate; a null id is no query
and comes last among equal distances; empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotrend.llm.scratch import Scratch

BLOCK_BYTES = 1 << 24  # of original vectors, as doubles, in a block or a stripe
TILE = 2048  # candidates of a product tile
ROWS = 512  # queries of a product tile
EXACT_PRODUCTS = 1024  # components whose int8 products add up below 2^24
SLACK = 1e-12  # relative error of float64 sums, with room
PAIRS = 1 << 16  # recomputed at a time
SALTS = 16


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 vectors, their scales, the lengths of what rounding took away, rounded up) of the rows of ``x``."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        scale = np.abs(x).max(1) / 127
        q = np.where(scale[:, None] > 0, np.rint(x / scale[:, None]), 0)
        left = x - scale[:, None] * q
        error = np.sqrt((left * left).sum(1)) * (1 + 1e-9) + np.abs(x).max(1) * SLACK
    return q.astype(np.int8), scale, error


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 rows, in float64."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT_PRODUCTS):
        out += a[:, k : k + EXACT_PRODUCTS].astype(np.float32) @ b[:, k : k + EXACT_PRODUCTS].astype(np.float32).T
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, squares added in the order of the components."""
    total = np.zeros(len(a))
    with np.errstate(over="ignore"):
        for k in range(a.shape[1]):
            total += (a[:, k] - b[:, k]) ** 2
    return np.sqrt(total)


class Rounded:
    """Vectors with what the bounds need of them."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.q, self.scale, self.error = quantised(x)
        with np.errstate(over="ignore"):
            self.square = products_with_itself(self.q) * self.scale**2

    def bounds(self, rows: slice, other: Rounded, columns: slice) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) of the distances between rows of the two."""
        with np.errstate(over="ignore", invalid="ignore"):
            sum_ = self.square[rows, None] + other.square[None, columns]
            inner = products(self.q[rows], other.q[columns]) * (self.scale[rows, None] * other.scale[None, columns])
            square, slack = sum_ - 2 * inner, sum_ * SLACK
            error = self.error[rows, None] + other.error[None, columns]
            lower = np.sqrt(np.maximum(square - slack, 0)) * (1 - SLACK) - error
            upper = np.sqrt(np.maximum(square, 0) + slack) * (1 + SLACK) + error
        return np.where(np.isfinite(lower), lower, -np.inf), np.where(np.isfinite(upper), upper, np.inf)


def products_with_itself(q: np.ndarray) -> np.ndarray:
    wide = q.astype(np.float64)
    return (wide * wide).sum(1)


class Heap:
    """The ``k`` least entries; the greatest is on top."""

    def __init__(self, k: int):
        self.k = k
        self.held: list[tuple] = []

    def worst(self) -> float:
        return -self.held[0][0] if len(self.held) == self.k else math.inf

    def push(self, distance: float, none: bool, id_: int, place: int) -> None:
        entry = (-distance, -none, -id_, place)
        if len(self.held) < self.k:
            heapq.heappush(self.held, entry)
        elif entry[:3] > self.held[0][:3]:
            heapq.heapreplace(self.held, entry)


def nearest(queries: np.ndarray, own: np.ndarray, candidates: np.ndarray, classes: np.ndarray, ids: np.ndarray, none: np.ndarray, k: int,
            tile: int = TILE, rows: int = ROWS) -> Iterator[tuple[int, float, int]]:
    """(query, distance, candidate): the ``k`` nearest candidates of each query, those of its own class (``own``) left out.

    Of equal distances that with the least of ``ids`` (``none``: it has none) comes first.
    """
    left, right = Rounded(queries), Rounded(candidates)
    heaps = [Heap(k) for _ in queries]
    for first in range(0, len(queries), rows):
        for start in range(0, len(candidates), tile):
            a, b = slice(first, first + rows), slice(start, start + tile)
            lower, upper = left.bounds(a, right, b)
            same = own[a, None] == classes[None, b]
            upper[same] = np.inf
            n = upper.shape[1]
            bound = np.partition(upper, k - 1, axis=1)[:, k - 1] if n >= k else np.full(len(upper), np.inf)
            bound = np.minimum(bound, [h.worst() for h in heaps[a]])
            i, j = np.nonzero((lower <= bound[:, None]) & ~same)
            i, j = i + first, j + start
            for at in range(0, len(i), PAIRS):
                p, c = i[at : at + PAIRS], j[at : at + PAIRS]
                d = distances(queries[p], candidates[c])
                order = np.lexsort((ids[c], none[c], d, p))
                starts = np.flatnonzero(np.concatenate(([True], p[order][1:] != p[order][:-1])))
                rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
                for m in order[rank < k].tolist():  # k a query at most
                    heaps[p[m]].push(float(d[m]), bool(none[c[m]]), int(ids[c[m]]), int(c[m]))
    for i, heap in enumerate(heaps):
        for distance, _, _, place in heap.held:
            yield i, -distance, place


_FOUND = "query long, distance double, ids array<long>"
_EMPTY = pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.float64()), pa.array([], pa.list_(pa.int64()))], ["query", "distance", "ids"])


def _matrix(vectors: pa.ChunkedArray, size: int) -> np.ndarray:
    return vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size) + 0.0


def _cells(queries: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(query class, distance, ids): the ``k`` nearest classes of each query class, in each cell."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [pa.Table.from_batches([_EMPTY])]
        for size in set(left.column("size").to_pylist()):
            a = left.filter(pc.equal(left.column("size"), size))
            b = right.filter(pc.equal(right.column("size"), size))
            if not b.num_rows:
                continue
            least = pc.list_element(b.column("ids"), 0)
            found = list(nearest(
                _matrix(a.column("v"), size), a.column("class").to_numpy(), _matrix(b.column("v"), size), b.column("class").to_numpy(),
                least.fill_null(0).to_numpy(), np.asarray(least.is_null()), k))
            if found:
                i, d, j = zip(*found, strict=True)
                out.append(pa.table({"query": a.column("class").take(list(i)), "distance": pa.array(d), "ids": b.column("ids").take(list(j))}))
        return pa.concat_tables([t.cast(out[0].schema) for t in out])

    return queries.groupBy("stripe", "block").cogroup(classes.groupBy("stripe", "block")).applyInArrow(run, _FOUND)


def _finite(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _least(frame: DataFrame, by: str, k: int, order: list[Column]) -> DataFrame:
    """The ``k`` first rows of each key; each task keeps its own ``k`` before the shuffle."""
    return frame.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k).drop("rank")


def neighbours(embeddings: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of each row for which ``is_query`` (of the id) holds."""
    spark = embeddings.sparkSession
    scratch = Scratch(spark)
    stored = embeddings.schema[vector_col].dataType
    number = "float" if isinstance(stored, T.ArrayType) and isinstance(stored.elementType, T.FloatType) else "double"
    rows = embeddings.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast(number) + F.lit(0).cast(number)).alias("v"))  # -0.0 as 0.0
    key = F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b"))
    rows = scratch.save(rows.where(_finite(F.col("v"))).withColumn("key", key), "rows")
    asked = scratch.save(rows.where("asks AND id IS NOT NULL").select("key", "id").distinct(), "asked")
    least = _least(rows.select("key", "id").distinct(), "key", k + 1, [F.asc_nulls_last("id")])
    ids = least.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.isnull("id").alias("none"), "id"))).alias("ids"))
    classes = rows.groupBy("key").agg(F.first("v").alias("v")).join(ids, "key").join(asked.select("key").distinct().withColumn("asks", F.lit(True)), "key", "left")
    classes = scratch.save(classes.select(
        F.monotonically_increasing_id().alias("class"), "key", "v", F.size("v").alias("size"), F.col("ids.id").alias("ids"), F.coalesce("asks", F.lit(False)).alias("asks")), "classes")
    scratch.drop("rows")

    held = classes.agg(F.count("*").alias("n"), F.sum(F.col("size") * 8).alias("bytes"), F.sum(F.when(F.col("asks"), F.col("size") * 8)).alias("asking")).first()
    blocks = max(min(2 * spark.sparkContext.defaultParallelism, held.n // (2 * TILE)), math.ceil((held.bytes or 0) / block_bytes), 1)
    stripes = max(1, math.ceil((held.asking or 0) / block_bytes))
    own = F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int").alias("block")
    to_stripes = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe")
    to_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    stripe = F.pmod(F.xxhash64("class", F.lit(1)), F.lit(stripes)).cast("int").alias("stripe")
    found = scratch.save(_cells(
        classes.where("asks").select("class", "v", "size", stripe, to_blocks), classes.select("class", "v", "size", "ids", own, to_stripes), k), "found")

    order = [F.col("distance"), F.asc_nulls_last(F.col("ids")[0])]
    dealt = found.withColumn("salted", F.struct("query", F.pmod(F.xxhash64("ids"), F.lit(SALTS))))
    best = _least(_least(dealt, "salted", k, order).drop("salted"), "query", k, order)
    best = best.groupBy("query").agg(F.collect_list(F.struct("distance", "ids")).alias("others"))  # k at most
    near = classes.where("asks").join(best, F.col("class") == F.col("query"), "left")

    def entries(distance: Column, members: Column, own: bool) -> Column:
        return F.transform(members, lambda x: F.struct(distance.alias("distance"), F.isnull(x).alias("none"), x.alias("id"), F.lit(own).alias("own")))

    others = F.flatten(F.transform("others", lambda o: entries(o["distance"], o["ids"], False)))
    every = F.concat(entries(F.lit(0.0), F.col("ids"), True), F.coalesce(others, F.array().cast("array<struct<distance:double,none:boolean,id:bigint,own:boolean>>")))
    near = near.select("key", F.slice(F.array_sort(every), 1, k + 1).alias("near"))
    mine = F.filter("near", lambda x: ~(x["own"] & x["id"].eqNullSafe(F.col("id"))))
    listed = asked.join(near, "key").select(F.col("id").alias("query_id"), F.posexplode(F.slice(mine, 1, k)).alias("at", "hit"))
    return listed.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias(id_col), F.col("hit.distance").alias("score"))
