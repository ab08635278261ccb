"""Near-duplicate documents by MinHash with tensored banding.

Method
------
Two small collections of ``bands`` hashes are computed per document, each hash
being ``rows`` minima of the shingle set.  A table key combines hash i of the
first collection with hash j of the second, so ``2 * bands * rows`` minima
serve ``bands ** 2`` tables of ``2 * rows`` minima each: about the square root
of what independent tables would need.  A pair of similarity s meets in some
table with probability ``(1 - (1 - s**rows) ** bands) ** 2``; at s = 0.8 with
2 rows and 14 bands that is 1 - 1.2e-6.

Every candidate link is confirmed on the full shingle sets.  Only the class of
a document is asked for, so a bucket of n documents is not expanded into n**2
pairs:

1. documents with the same shingle set are one class, kept by its least id;
2. hashes that no other class shares are dropped before keys are formed;
3. in each bucket all members are compared with one pivot, the member whose
   hashes are most shared (n - 1 pairs), and components are formed;
4. what is left are pairs in one bucket but in different components.  What each
   of them shares with the pivot bounds the similarity of the pair from above,
   and most pairs need a common shingle that the pivot hasn't;
5. such shingles that most members of a pivot share count as the pivot's, and
   these members are compared with the one that has the most of them; many members
   that share another get a pivot of their own, the one with the most of these
   shingles, and are treated as in 3 to 5 again, a few times, unless the pairs of
   all such members are few beside the rows;
6. the others are joined on these shingles, as far as they are in different
   components by then; the pairs that the bounds allow are compared one by one.

Defined results: a null or empty text, or one without words, has an empty set
and links with nothing; a text of fewer than ``n`` words is one shingle.  A
null id is returned with a null component and kept.  Equal rows count as one
document; an id whose rows differ is one document with the links of all of them.
An empty table gives an empty result.  Columns other than the id and the text are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotrend.llm.components import components
from repotrend.llm.scratch import Scratch
from repotrend.llm.tokens import mix, text_shingles

ROWS, BANDS = 2, 14
OFTEN, MOST_OFTEN = 32, 4096  # members of a pivot that make a shingle frequent; how many such are put last
CROWD, TURNS = 32, 4  # members of a pivot that share a shingle and get a pivot of their own; how often at most
SET_BYTES = 1 << 22  # of sets whose shingles are in a task's memory, and one batch, at a time


def _multipliers(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, k, dtype=np.uint64)


def signatures(docs: DataFrame, n: int, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """(id, t, n_shingles, digest, bands) of (id, text, t); digest and bands are null for an empty set."""
    k = 2 * bands * rows
    times, plus = _multipliers(k)
    salt = np.arange(2 * bands, dtype=np.uint64) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, hashes = [], [], []
            for s in text_shingles(batch.column("text"), n):
                counts.append(len(s))
                if not len(s):
                    digests.append(None)
                    hashes.append(None)
                    continue
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                least = np.fromiter(((s * a + b).min() for a, b in zip(times, plus, strict=True)), np.uint64, k)
                band = salt
                for r in range(rows):
                    band = mix(band * np.uint64(0x9E3779B97F4A7C15) + least[r :: rows])
                hashes.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("t"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(hashes, pa.list_(pa.int64()))], ["id", "t", "n_shingles", "digest", "bands"])

    return docs.mapInArrow(run, "id long, t binary, n_shingles long, digest binary, bands array<long>")


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """(id, s): the sorted shingle hashes of (id, text) as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in text_shingles(batch.column("text"), n)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["id", "s"])

    return docs.mapInArrow(run, "id long, s binary")


def _met(pairs: DataFrame, sets: DataFrame, run, schema: str, often: DataFrame | None = None) -> DataFrame:
    """``run`` over the sets sa and sb of each pair (a, b), with ``often`` (b, often, joint) only of those b, whose lists go with its set and not with each pair."""
    right = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    right = right if often is None else right.join(often, "b")
    right = right.withColumns({c: F.lit(None).cast("array<long>") for c in ("often", "joint") if c not in right.columns})
    both = pairs.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(right, "b")
    return both.select("a", "b", "often", "joint", "sa", "sb").mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, most: int = SET_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``most`` bytes of sets; a larger pair is a run of its own."""
    ends = np.cumsum(pc.add(pc.binary_length(batch.column("sa")), pc.binary_length(batch.column("sb"))).to_numpy(zero_copy_only=False), dtype=np.int64)
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + most, side="right")))
        yield batch.slice(row, end - row)
        row = end


def _pairs_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
        yield np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)


def compared(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, na, nb, common, linked): set sizes, shingles in common, and whether they reach the threshold."""
    percent = round(threshold * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, common = [], [], []
            for x, y in _pairs_of(batch):
                z = np.concatenate((x, y))
                z.sort(kind="stable")
                na.append(len(x))
                nb.append(len(y))
                common.append(int((z[1:] == z[:-1]).sum()))
            linked = [100 * k >= percent * (i + j - k) for i, j, k in zip(na, nb, common, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(na, pa.int64()), pa.array(nb, pa.int64()),
                 pa.array(common, pa.int64()), pa.array(linked, pa.bool_())], ["a", "b", "na", "nb", "common", "linked"])

    return _met(pairs, sets, run, "a long, b long, na long, nb long, common long, linked boolean")


def _own_shingles(pairs: DataFrame, sets: DataFrame, threshold: float, often: DataFrame | None = None) -> DataFrame:
    """(b, h, a, more, last): shingles h of a that b hasn't, how many there are besides, and the place of the last of them in the order.

    They are the least ones, with those in ``often`` (b, often, joint) counted as larger than any other: so many that every partner in reach
    of a has one among its own.  With a threshold of 0, all of them.  Those in joint count as b's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            parts, more, ends = [], [], []
            for (x, y), often, joint in zip(_pairs_of(batch), batch.column("often"), batch.column("joint"), strict=True):
                own = np.sort(np.setdiff1d(x, y, assume_unique=True))
                if joint.is_valid:
                    own = own[~np.isin(own, joint.values.to_numpy().view(np.uint64))]
                late = np.zeros(len(own), bool)
                if often.is_valid:
                    late = np.isin(own, often.values.to_numpy().view(np.uint64))
                    own, late = np.concatenate((own[~late], own[late])), np.sort(late)
                parts.append(own[: len(x) - int(threshold * len(x) - 1e-6)])
                more.append(len(own) - len(parts[-1]))
                k = len(parts[-1]) - 1
                ends.append(int(own[k]) >> 2 | int(late[k]) << 62 if k >= 0 else 0)
            times = [len(p) for p in parts]
            b, a = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), times) for c in ("b", "a"))
            flat = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b, pa.int64()), pa.array(flat), pa.array(a, pa.int64()),
                 *(pa.array(np.repeat(np.array(c, np.int64), times)) for c in (more, ends))],
                ["b", "h", "a", "more", "last"])

    return _met(pairs, sets, run, "b long, h long, a long, more long, last long", often)


def _joint_shingles(pairs: DataFrame, sets: DataFrame, joint: DataFrame) -> DataFrame:
    """(b, a, extra): how many shingles of a are in ``joint`` (b, joint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = [int(np.isin(x, joint.values.to_numpy().view(np.uint64)).sum()) for (x, _), joint in zip(_pairs_of(batch), batch.column("joint"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("b"), batch.column("a"), pa.array(extra, pa.int64())], ["b", "a", "extra"])

    return _met(pairs, sets, run, "b long, a long, extra long", joint)


def _rarest_own_shingles(pairs: DataFrame, sets: DataFrame, threshold: float, scratch: Scratch, turn: int) -> tuple[DataFrame, DataFrame]:
    """``_own_shingles``, with those that many members of a pivot share last, where there are such, and ``_joint_shingles``.

    Those that most members of a pivot share are joint ones: they count as the pivot's.
    """
    own = scratch.save(_own_shingles(pairs, sets, threshold), f"own-plain-{turn}")
    crowded = own.groupBy("b", "h").agg(F.count("*").alias("n")).where(F.col("n") > OFTEN).select("b").distinct()
    crowded = scratch.save(crowded, f"crowded-{turn}")
    again = pairs.join(crowded, "b")
    counts = _own_shingles(again, sets, 0.0).groupBy("b", "h").agg(F.count("*").alias("n")).where(F.col("n") > OFTEN)
    counts = counts.join(again.groupBy("b").agg(F.count("*").alias("size")), "b").withColumn("most", F.expr("2 * n > size"))
    top = F.row_number().over(Window.partitionBy("b", "most").orderBy(F.desc("n"), F.desc("h")))
    lists = counts.withColumn("top", top).where((F.col("top") <= MOST_OFTEN) | F.col("most")).groupBy("b").agg(
        F.collect_list(F.when(~F.col("most"), F.col("h"))).alias("often"), F.collect_list(F.when(F.col("most"), F.col("h"))).alias("joint"))  # joint: at most as many as two sets of members
    lists = scratch.save(lists, f"often-{turn}")
    extra = scratch.save(_joint_shingles(again, sets, lists.where(F.size("joint") > 0).drop("often")), f"joint-{turn}")
    rest = own.join(crowded, "b", "left_anti")
    return scratch.save(rest.union(_own_shingles(again, sets, threshold, lists)), f"own-{turn}"), extra


def _weight(count: str) -> Column:
    """The logarithm of a count as a whole number, so that sums are the same in any order."""
    return F.round(F.log2(count) * 4096).cast("long")


def _cells(sig: DataFrame, bands: int) -> DataFrame:
    """(key, id, n, pop, rep): the table keys of each class, of hashes that another class shares."""
    flat = sig.select("id", "n_shingles", "rep", F.posexplode("bands").alias("pos", "band"))
    shared = flat.groupBy("band").count().where("count > 1")
    own = flat.join(shared, "band").groupBy("id").agg(
        F.first("n_shingles").alias("n"),
        F.first("rep").alias("rep"),
        F.collect_list(F.struct("pos", "band")).alias("h"),
        F.sum(_weight("count")).alias("pop"),
    )
    own = own.withColumns({"l": F.filter("h", lambda x: x.pos < bands), "r": F.filter("h", lambda x: x.pos >= bands)})
    left = own.select("id", "n", "pop", "rep", "r", F.explode("l.band").alias("x"))
    return left.select("id", "n", "pop", "rep", "x", F.explode("r.band").alias("y")).select(
        F.xxhash64("x", "y").alias("key"), "id", "n", "pop", "rep")


def _texts(docs: DataFrame, ids: DataFrame, speaks: DataFrame | None) -> DataFrame:
    """(id, text) of those ids; with ``speaks`` (class, id, t) they are classes, each with the text of its row."""
    if speaks is None:
        return docs.join(ids, "id", "left_semi")
    wanted = speaks.join(ids.withColumnRenamed("id", "class"), "class", "left_semi")
    return docs.dropDuplicates(["id", "t"]).join(wanted, ["id", "t"]).select(F.col("class").alias("id"), "text")


def _still_apart(member: DataFrame, threshold: float) -> DataFrame:
    """``member`` with least and main, of those pivots whose members are in several components."""
    least = F.min(F.when(F.expr(f"i >= {threshold} * n - 1e-6"), F.col("n"))).alias("least")
    main = F.max(F.when(F.col("id") == F.col("p"), F.col("c"))).alias("main")
    still = member.groupBy("p").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), least, main).where("lo < hi").drop("lo", "hi")
    return member.join(still, "p")


def _members(star: DataFrame, label: DataFrame, threshold: float, scratch: Scratch, turn: int) -> DataFrame:
    """(p, id, n, i, c, least, main, top): members of each pivot, size n, shingles i in common with the pivot, component c so far."""
    member = star.select(F.col("b").alias("p"), F.col("a").alias("id"), F.col("na").alias("n"), F.col("common").alias("i")).union(
        star.select(F.col("b").alias("p"), F.col("b").alias("id"), F.col("nb").alias("n"), F.col("nb").alias("i")).distinct())
    member = member.join(label, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
    member = scratch.save(member, f"members-{turn}")
    # A pair is looked at with one pivot: that of the most members if it is the same for both.
    size = member.groupBy("p").agg(F.count("*").alias("size"))
    top = member.join(size, "p").groupBy("id").agg(F.max(F.struct("size", "p")).alias("top")).select("id", F.col("top.p").alias("top"))
    return scratch.save(_still_apart(member, threshold).join(top, "id"), f"member-{turn}")


def _crowds(own: DataFrame, member: DataFrame) -> DataFrame:
    """(p, h, id, leader): members of a pivot that share a shingle which it lacks, where they are many and not in one component.

    The leader is the member with the most such shingles, counted by how many share them.
    """
    cell = own.select("p", "h", "id").join(member.select("p", "id", "c"), ["p", "id"])
    many = cell.groupBy("p", "h").agg(F.count("*").alias("k"), F.min("c").alias("lo"), F.max("c").alias("hi")).where((F.col("k") > CROWD) & (F.col("lo") < F.col("hi")))
    held = own.join(many.select("p", "h", _weight("k").alias("weight")), ["p", "h"]).select("p", "h", "id", "weight")
    pop = held.groupBy("p", "id").agg(F.sum("weight").alias("pop"))
    leader = held.join(pop, ["p", "id"]).groupBy("p", "h").agg(F.max(F.struct("pop", (-F.col("id")).alias("minus"))).alias("l"))
    return held.join(leader.select("p", "h", (-F.col("l.minus")).alias("leader")), ["p", "h"]).select("p", "h", "id", "leader")


def _pairs_within(rows: DataFrame, *by: str) -> float:
    """About how many pairs of rows are equal in those columns."""
    return rows.groupBy(*by).count().agg(F.sum(F.col("count") * F.col("count") / 2)).first()[0] or 0


def _around_leaders(crowds: DataFrame) -> DataFrame:
    """Pairs (a, b) of each member of a crowd and its leader."""
    return crowds.where("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()


def _around_hubs(extra: DataFrame) -> DataFrame:
    """Pairs (a, b) of each member that has joint shingles and the one of its pivot that has the most."""
    hub = extra.groupBy("p").agg(F.max(F.struct("extra", (-F.col("id")).alias("minus"))).alias("h")).select("p", (-F.col("h.minus")).alias("b"))
    return extra.where("extra > 0").join(hub, "p").where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def _enough(need: float) -> str:
    return f"{need} * (x.n + y.n) - 1e-6"


def _apart(need: float) -> Column:
    """What the sizes and the pivot allow: the part of the pivot that only one of them has counts against the pair."""
    enough = _enough(need)
    return F.expr("x.c <> y.c AND x.id <> y.id AND (x.top <> y.top OR x.top = x.p)") & F.expr(f"x.i + {enough} <= y.i + x.n AND y.i + {enough} <= x.i + y.n")


def _inside(member: DataFrame, need: float) -> DataFrame:
    """Pairs (a, b) that can be linked without a common shingle outside the pivot's."""
    odd = member.where(f"c <> main AND i >= {need} * (n + least) - 1e-6").alias("x")
    met = odd.join(member.alias("y"), F.expr("x.p = y.p") & _apart(need) & F.expr(f"least(x.i, y.i) >= {_enough(need)}"))
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def _sharing(own: DataFrame, member: DataFrame, need: float) -> DataFrame:
    """Pairs of members in different components, as x and y, once for each shingle they share that the pivot lacks."""
    own = own.join(member, ["p", "id"])
    return own.alias("x").join(own.alias("y"), F.expr("x.p = y.p AND x.h = y.h AND x.id < y.id") & _apart(need))


def _beside(own: DataFrame, member: DataFrame, need: float) -> DataFrame:
    """Pairs (a, b) that can be linked with some common shingles outside the pivot's."""
    # Common shingles not counted come after the listed ones that end first, so they are among what that member has more.
    uncounted = "CASE WHEN x.last < y.last THEN x.more WHEN x.last > y.last THEN y.more ELSE greatest(x.more, y.more) END"
    met = _sharing(own, member, need).groupBy("x.p", "x.id", "y.id").agg(
        F.count("*").alias("shared"), F.expr(f"max(least(x.i, y.i) + {uncounted})").alias("i"), F.expr(f"max({_enough(need)})").alias("enough"))
    return met.where("i + shared >= enough").select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def links(docs: DataFrame, sig: DataFrame, n: int, threshold: float, bands: int, scratch: Scratch, speaks: DataFrame | None = None) -> DataFrame:
    """Verified links (a, b) that connect all near-duplicate classes of ``sig`` (one row per class).

    ``docs`` has the text of each class by its id, or by the row that ``speaks`` for it.
    """
    need = threshold / (1 + threshold)  # a linked pair has at least need * (sum of sizes) in common
    found = scratch.save(_cells(sig, bands), "cells")
    sets = scratch.save(shingle_sets(_texts(docs, found.select("id").distinct(), speaks), n), "sets")

    # Of equally shared members that of the least document: the others are rather its copies than it is one of theirs.
    best = F.max(F.struct("pop", (-F.col("rep")).alias("first"), (-F.col("id")).alias("minus"))).alias("p")
    pivots = found.groupBy("key").agg(best, F.count("*").alias("size")).where("size > 1").select("key", (-F.col("p.minus")).alias("p"))
    found = scratch.save(found.join(pivots, "key").select("key", "p", "id", "n"), "placed")
    pairs = found.where("id <> p").select(F.col("id").alias("a"), F.col("p").alias("b")).distinct()

    stars, first, around, groups = [], [], [], pairs
    while pairs is not None:
        turn = len(stars)
        stars.append(scratch.save(compared(pairs, sets, threshold), f"star-{turn}"))
        first.append(stars[-1].where("linked").select("a", "b"))
        label = components(reduce(DataFrame.union, first), scratch, f"cc-star-{turn}")
        if groups is None:
            break
        member = _members(stars[-1].join(groups, ["a", "b"], "left_semi") if turn else stars[-1], label, threshold, scratch, turn)
        own = member.where("id <> p").select(F.col("id").alias("a"), F.col("p").alias("b"))
        own, extra = (t.withColumnsRenamed({"b": "p", "a": "id"}) for t in _rarest_own_shingles(own, sets, threshold, scratch, turn))
        most = own.count() / 4
        crowds = scratch.save(_crowds(own, member), f"crowds-{turn}")
        crowds = crowds if turn + 1 < TURNS and _pairs_within(crowds, "p", "h") > most else None
        groups = None if crowds is None else scratch.save(_around_leaders(crowds), f"groups-{turn}")
        hubs = _around_hubs(extra) if _pairs_within(extra.where("extra > 0"), "p") > most else None
        around.append((member, own, extra, crowds))
        pairs = [t for t in (groups, hubs) if t is not None]
        pairs = reduce(DataFrame.union, pairs).distinct() if pairs else None

    rest = []
    for turn, (member, own, extra, crowds) in enumerate(around):
        # The components are those of the last turn, the pivot that with the joint shingles.
        member = member.drop("c", "least", "main").join(label, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
        member = member.join(extra, ["p", "id"], "left").withColumn("i", F.col("i") + F.coalesce("extra", F.lit(0))).drop("extra")
        member = scratch.save(_still_apart(member, threshold), f"member-again-{turn}")
        if crowds is not None:
            own = own.join(crowds.select("p", "h").distinct(), ["p", "h"], "left_anti")
        rest += [_inside(member, need), _beside(own, member, need)]
    done = reduce(DataFrame.union, stars).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = scratch.save(reduce(DataFrame.union, rest).distinct().join(done, ["a", "b"], "left_anti"), "rest")
    rest = compared(rest, sets, threshold).where("linked").select("a", "b")
    return scratch.save(reduce(DataFrame.union, [*first, rest]), "links")


def near_duplicates(
    documents: DataFrame, n: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    rows: int = ROWS, bands: int = BANDS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``documents``."""
    scratch = Scratch(documents.sparkSession)
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("t", F.unhex(F.md5(F.col("text").cast("binary"))))
    sig = scratch.save(signatures(docs, n, rows, bands), "sig")
    full = sig.where("id IS NOT NULL AND digest IS NOT NULL")
    # A class goes by a number of its own: an id whose rows differ is in several, and may be the least id of each.
    made = full.groupBy("digest").agg(F.min(F.struct("id", "t")).alias("m"))
    classes = scratch.save(made.select("digest", F.col("m.id").alias("rep"), F.col("m.t").alias("t"), F.monotonically_increasing_id().alias("class")), "classes")
    speaks = classes.select("class", F.col("rep").alias("id"), "t")
    reps = full.dropDuplicates(["id", "t"]).join(speaks, ["id", "t"]).select(F.col("class").alias("id"), F.col("id").alias("rep"), "n_shingles", "digest", "bands")
    edges = links(docs.where("id IS NOT NULL"), reps, n, threshold, bands, scratch, speaks)
    known = classes.select("class", "rep")
    for end in ("a", "b"):
        edges = edges.join(known.select(F.col("class").alias(end), F.col("rep").alias(f"{end}_rep")), end)
    edges = edges.select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b"))
    same = full.join(classes, "digest").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    twice = same.groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("top"))
    edges = edges.union(twice.where("b < top").select(F.col("b").alias("a"), F.col("top").alias("b")))
    label = components(edges, scratch, "cc").select(F.col("id").alias("rep"), "component")
    placed = sig.join(classes, "digest", "left").join(label, "rep", "left")
    component = F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "rep", "id"))
    out = placed.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
