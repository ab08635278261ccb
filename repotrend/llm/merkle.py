"""Merkle manifest of a dataset: leaves, roots and proofs, by cogrouped exchange of subtrees.

Each row is a leaf: the SHA-256 of its columns.  The leaves of a group (a source)
in order of their ids are the first row of nodes of its tree; every three nodes in
succession (the last run may be shorter, even one) become their digest until one
is left, the group's subroot.  The subroots in the order of their groups make the
root in the same way.

A superblock is ``3 ** HEIGHT`` successive nodes of a tree.  Upwards, each
superblock is reduced to one node, and those nodes are the next round's, so three
rounds do for 10^11 leaves.  Downwards, what a superblock needs of the rest of the
tree is the path of its own node: at each level the siblings around it.  The nodes
of a superblock and that path are cogrouped; one task finishes the local
reduction, joins local and outer siblings into the proof of each leaf and folds
the leaf that was received into the root it implies.  No task holds more than a
superblock.

Places in the order come from one range sort of the leaf digests (never the texts),
whose parts are counted and offset; the sort key ends with the digest and the row's
place in the input, so a group or an id that holds a third of all rows, or one row
that many equal, is split over parts.

Defined results: a null column is ``-`` in its leaf, a null group is a group of its
own and the first, a null id is the first of its group; rows of one id are ordered
by digest, and equal rows are leaves each; empty and very long texts are hashed
whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotrend.llm.scratch import Scratch

ARITY = 3
HEIGHT = 8  # levels of a superblock, of 6,561 nodes at most
MARK = "*"  # the place of a node among its siblings
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_BITS = 33  # of a monotonically increasing id: the row within its part

_NODES = "tree long, pos long, total long, node string"
_PATHS = "tree long, pos long, path array<string>, subroot string"
_PROOFS = "id string, leaf string, subroot string, path array<string>, folded_root string"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns, each ``-`` or its bytes' number, a colon and itself."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def digest(nodes: str) -> str:
    return sha256(nodes.encode()).hexdigest()


def depth(total: int) -> int:
    """Levels above ``total`` nodes."""
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def reduced(nodes: list[str], total: int, height: int) -> list[list[str]]:
    """The rows of nodes of a superblock of a tree with ``total`` nodes in this round, its own first, the top last."""
    rows = [nodes]
    for _ in range(min(height, depth(total))):
        rows.append([digest("".join(rows[-1][k : k + ARITY])) for k in range(0, len(rows[-1]), ARITY)])
    return rows


def path_of(rows: list[list[str]], place: int) -> list[str]:
    """For a node of the first row, the siblings of each level's run around a mark for its own place."""
    out = []
    for row in rows[:-1]:
        first = place - place % ARITY
        out.append("".join(row[first:place]) + MARK + "".join(row[place + 1 : first + ARITY]))
        place //= ARITY
    return out


def fold(node: str, path: list[str]) -> str:
    """The root that a node and its siblings imply."""
    for level in path:
        node = digest(level.replace(MARK, node))
    return node


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos DIV {ARITY**height}"))


def _up(nodes: DataFrame, height: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """The nodes of every round; the last has one node a tree."""

    def run(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        total = int(own["total"].iloc[0])
        rows = reduced(own.sort_values("pos")["node"].tolist(), total, height)
        levels = len(rows) - 1
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "total": [-(-total // ARITY**levels)], "node": rows[-1]})

    rounds = [nodes]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        rounds.append(scratch.save(_blocks(rounds[-1], height).groupBy("tree", "block").applyInPandas(run, _NODES), f"{name}-{len(rounds)}"))
        most = -(-most // ARITY**height)
    return rounds


def _down(nodes: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """The paths of all nodes, from those of their superblocks."""

    def run(key: tuple, own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("pos")
        rows = reduced(own["node"].tolist(), int(own["total"].iloc[0]), height)
        above = list(outer["path"].iloc[0])
        return pd.DataFrame({"tree": key[0], "pos": own["pos"], "path": [path_of(rows, k) + above for k in range(len(own))], "subroot": outer["subroot"].iloc[0]})

    return _blocks(nodes, height).groupBy("tree", "block").cogroup(paths.groupBy("tree", "pos")).applyInPandas(run, _PATHS)


def _proofs(leaves: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """Local reduction, proofs and folding of each superblock of leaves."""

    def run(key: tuple, own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("pos")
        nodes = own["node"].tolist()
        rows = reduced(nodes, int(own["total"].iloc[0]), height)
        above = list(outer["path"].iloc[0])
        proofs = [path_of(rows, k) + above for k in range(len(nodes))]
        return pd.DataFrame({
            "id": own["id"].tolist(), "leaf": nodes, "subroot": outer["subroot"].iloc[0], "path": proofs,
            "folded_root": [fold(leaf, path) for leaf, path in zip(own["received"], proofs, strict=True)]})

    return _blocks(leaves, height).groupBy("tree", "block").cogroup(paths.groupBy("tree", "pos")).applyInPandas(run, _PROOFS)


def ranked(rows: DataFrame, order: Sequence[Column], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``at``, their place in the order from 0: sorted into parts, whose sizes give each part's first place."""
    kept = scratch.save(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), name)
    kept = kept.withColumn("part", F.shiftright("at", _ROW_BITS))
    sizes = kept.groupBy("part").agg(F.count("*").alias("n"))  # one row a part
    firsts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_first"))
    place = F.col("part_first") + F.col("at").bitwiseAND((1 << _ROW_BITS) - 1)
    return kept.join(F.broadcast(firsts), "part").withColumn("at", place).drop("part", "part_first")


def manifest(
    documents: DataFrame, columns: Sequence[str] = COLUMNS, group_col: str = "source", id_col: str = "doc_id",
    received: Mapping[str, Column] | None = None, height: int = HEIGHT,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root, verified) of each row.

    ``path`` is the proof: for each level from the leaf to the root the siblings,
    joined, around ``*`` for the node itself.  ``received`` names columns whose
    values arrived otherwise than the manifest was made of; ``folded_root`` is
    recomputed from that leaf, and ``verified`` says whether it is the root.
    """
    scratch = Scratch(documents.sparkSession)
    received = received or {}
    cell = {c: F.col(f"`{c}`") for c in (*columns, group_col, id_col)}
    hashed = documents.select(
        cell[group_col].cast("string").alias("grp"), cell[id_col].alias("id"),
        leaf_digest([cell[c] for c in columns]).alias("node"),
        leaf_digest([received.get(c, cell[c]) for c in columns]).alias("received"),
        F.monotonically_increasing_id().alias("tie"))
    first = [F.asc_nulls_first("grp"), F.asc_nulls_first("id"), F.col("node"), F.col("tie")]
    leaves = ranked(scratch.save(hashed, "hashed"), first, scratch, "sorted")
    groups = scratch.save(leaves.groupBy("grp").agg(F.min("at").alias("first"), F.count("*").alias("total")), "groups")
    trees = ranked(groups, [F.asc_nulls_first("grp")], scratch, "trees").select(F.col("grp").alias("own"), F.col("at").alias("tree"), "first", "total")
    leaves = leaves.join(trees, F.col("grp").eqNullSafe(F.col("own"))).select(
        "tree", (F.col("at") - F.col("first")).alias("pos"), "total", F.col("id").cast("string").alias("id"), "node", "received")
    leaves = scratch.save(leaves, "leaves")
    for name in ("hashed", "sorted"):
        scratch.drop(name)

    rounds = _up(leaves.select("tree", "pos", "total", "node"), height, scratch, "nodes")
    subroots = rounds[-1].select("tree", F.col("node").alias("subroot"))
    tops = rounds[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(groups.count()).cast("long").alias("total"), "node")
    outer = _up(tops, height, scratch, "tops")
    top = outer[-1].select("node").first()
    paths = outer[-1].select("tree", "pos", F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"))
    for k, nodes in enumerate(reversed(outer[:-1])):
        paths = scratch.save(_down(nodes, paths, height), f"top-paths-{k}")
    paths = paths.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path").join(subroots, "tree")
    for k, nodes in enumerate(reversed(rounds[1:-1])):
        paths = scratch.save(_down(nodes, paths, height), f"paths-{k}")
    root = F.lit(top.node if top else None).cast("string")
    return _proofs(leaves, paths, height).select(
        F.col("id").cast(documents.schema[id_col].dataType).alias(id_col), "leaf", "subroot", root.alias("root"), "path", "folded_root",
        (F.col("folded_root") == root).alias("verified"))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings of a path, left to right from the leaf to the root."""
    return F.sha2(F.replace(F.array_join(path, ""), F.lit(MARK), F.lit("")).cast("binary"), 256)
