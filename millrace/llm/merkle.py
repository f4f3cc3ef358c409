"""Merkle manifests of a dataset: checkpoint every few levels, recompute the rest.

Rows are leaves of one binary tree per group (a language, say), in the order of
their ids; the roots of these trees are the leaves of one more tree, whose root
stands for the dataset. Of a tree only every ``stride``-th level is stored: the
leaves, the roots of their aligned subtrees of two to the ``stride`` leaves, the
roots of the subtrees of those, and so on. A proof needs the siblings of all
levels. They are taken from the top down: each stored level is cut into its
aligned subtrees, a subtree's missing inner nodes are computed again from its
stored nodes, each node is given its siblings in there, followed by the path of
the subtree's own root, and the inner nodes are forgotten.

All work is on subtrees of bounded size, whatever the size of a group, so a hot
group is many subtrees. Leaves are numbered by a range sort and the counts of
the ranges before; no group passes through one task. Leaves are hashed once, in
the scan of their texts, and stored; everything after starts from there.

A node is the SHA-256, in lower-case hex, of its children's hex digests; one
child without a sibling is hashed alone. A tree of one leaf has that leaf as its
root. Fields are hashed as ``-`` for null, else as their length in UTF-8 bytes, a
colon and their text.

Defined results: null groups come first and are a group of their own, null ids
come first in it; rows with one id follow each other by digest, and equal rows
are a leaf each, in any order (it makes no difference). Empty and very long
texts are fields like others. Without rows there is no proof, and the root is
null. Columns that are not named take no part; those to keep travel in a
structure of their own, so that their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import saved
from millrace.session import scratch_path

#: Levels from one stored level to the next.
STRIDE = 8

#: Row numbers hold the number of the partition above these bits.
ROW_BITS = 33


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(column: Column) -> Column:
    """A value as it is hashed."""
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    """The digest of a row of these values."""
    return digest(F.concat(*[field(c) for c in columns]))


def parents(nodes: Column) -> Column:
    """The next level of a run of nodes that begins at an even place."""
    last = F.shiftright(F.size(nodes) - 1, 1)
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: digest(F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit("")))),
    )


def regenerated(nodes: Column, steps: Column) -> Column:
    """A run of nodes and the ``steps`` (one at least) levels above it."""
    return F.aggregate(
        F.sequence(F.lit(1), steps),
        F.array(nodes),
        lambda levels, _: F.concat(levels, F.array(parents(F.element_at(levels, -1)))),
    )


def siblings(levels: Column, steps: Column, at: Column) -> Column:
    """What stands left and right of a node and of its ancestors; empty where nothing does."""

    def beside(nodes: Column, level: Column) -> Column:
        place = F.call_function("shiftright", at, level)
        odd = place % 2 == 1
        left = F.when(odd, F.get(nodes, place - 1)).otherwise("")
        right = F.when(odd, "").otherwise(F.coalesce(F.get(nodes, place + 1), F.lit("")))
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(F.slice(levels, 1, steps), beside)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def path_digest(path: Column) -> Column:
    """The digest of a path's siblings, level by level from the leaf."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def numbered(rows: DataFrame, order: Sequence[str], folder: str) -> DataFrame:
    """Stored rows with their place (``pos``) in their tree and its height.

    Rows are sorted by range; a tree's rows in a range begin where those of the
    ranges before have ended. Equal rows are told apart by where they are stored, so
    that ranges can part them.
    """
    told = rows.withColumn("_stored", F.monotonically_increasing_id())
    keys = ["tree", *order, "_stored"]
    ranged = told.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = ranged.drop("_stored").withColumn("_row", F.monotonically_increasing_id())
    ranged = saved(ranged, f"{folder}/sorted").withColumns(
        {"_part": F.shiftright("_row", ROW_BITS), "_row": F.col("_row").bitwiseAND((1 << ROW_BITS) - 1)}
    )
    starts = ranged.groupBy("tree", "_part").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    leaves = F.sum("_rows").over(tree)
    starts = starts.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(0).alias("height"),
    )
    return (
        ranged.join(starts, ["tree", "_part"])
        .withColumn("pos", F.col("_row") + F.col("_shift"))
        .drop("_part", "_row", "_shift")
    )


def subtrees(nodes: DataFrame, level: int, stride: int, *columns: str) -> DataFrame:
    """The aligned subtrees over a stored level, with the steps to their roots.

    ``place`` is that of the subtree's root on the next stored level.
    """
    return (
        nodes.where(F.col("height") > level)
        .groupBy("tree", F.shiftright("pos", stride).alias("place"))
        .agg(
            F.max("height").alias("height"),
            F.array_sort(F.collect_list(F.struct("pos", "digest", *columns))).alias("nodes"),
        )
        .withColumn("steps", F.least(F.lit(stride), F.col("height") - level))
    )


def stored_levels(leaves: DataFrame, stride: int, folder: str) -> list[DataFrame]:
    """Every ``stride``-th level of all trees; a tree's last one is its root."""
    found = [leaves]
    tallest = leaves.agg(F.max("height")).first()[0] or 0
    for level in range(0, tallest, stride):
        under = subtrees(found[-1], level, stride)
        top = F.element_at(regenerated(F.col("nodes.digest"), F.col("steps")), -1)
        up = under.select("tree", F.col("place").alias("pos"), F.get(top, 0).alias("digest"), "height")
        found.append(saved(up, f"{folder}/level-{level + stride}"))
    return found


def roots(levels: list[DataFrame], stride: int) -> DataFrame:
    """The root of every tree."""
    found = [
        nodes.where(F.col("height") <= n * stride).select("tree", "digest")
        for n, nodes in enumerate(levels)
    ]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def descended(
    levels: list[DataFrame], tops: DataFrame, stride: int, folder: str, *columns: str
) -> DataFrame:
    """Every leaf with its path: the siblings in its tree, then the path of its root.

    ``tops`` has the path of every tree's root, and more columns that all leaves
    of the tree are given.
    """
    shared = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for n in reversed(range(len(levels))):
        own = columns if n == 0 else ()
        done = levels[n].where(F.col("height") <= n * stride)
        below = done.select("tree", "pos", "digest", *own).join(tops, "tree")
        if above is not None:
            subs = subtrees(levels[n], n * stride, stride, *own).join(
                above.select("tree", F.col("pos").alias("place"), "path", *shared), ["tree", "place"]
            )

            def with_path(steps: Column, inner: Column) -> Column:
                return F.transform(
                    F.col("nodes"),
                    lambda x, i: F.struct(
                        x["pos"].alias("pos"),
                        x["digest"].alias("digest"),
                        *[x[c].alias(c) for c in own],
                        siblings(inner, steps, i).alias("within"),
                    ),
                )

            # bound as the variable of a lambda, the inner nodes are computed once a subtree
            inner = F.array(regenerated(F.col("nodes.digest"), F.col("steps")))
            each = F.flatten(F.transform(inner, lambda x: with_path(F.col("steps"), x)))
            found = subs.select("tree", "path", *shared, F.explode(each).alias("node")).select(
                "tree",
                *[F.col(f"node.{c}").alias(c) for c in ("pos", "digest", *own)],
                F.concat("node.within", "path").alias("path"),
                *shared,
            )
            below = found.unionByName(below)
        above = saved(below, f"{folder}/paths-{n}") if n else below
    return above


@dataclass(frozen=True)
class Manifest:
    """The stored levels of the groups' trees and of the tree of their roots."""

    groups: list[DataFrame]
    top: list[DataFrame]
    stride: int
    folder: str

    def root(self) -> str | None:
        """The digest that stands for all rows."""
        row = roots(self.top, self.stride).first()
        return row and row["digest"]

    def prove(self) -> DataFrame:
        """A row per leaf: kept, leaf, path, subroot and root.

        ``path`` lists the siblings left and right, from the leaf to the root of its
        group and on to the root of all.
        """
        end = roots(self.top, self.stride).select(
            "tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
            F.col("digest").alias("root"),
        )
        tops = descended(self.top, end, self.stride, f"{self.folder}/top", "kept").select(
            F.col("kept.tree").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
        )
        tops = saved(tops, f"{self.folder}/tops")
        proofs = descended(self.groups, tops, self.stride, f"{self.folder}/groups", "kept")
        return proofs.select("kept", F.col("digest").alias("leaf"), "path", "subroot", "root")


def build(
    rows: DataFrame, fields: Sequence[Column], group: str, order: str, kept: Sequence[Column] = (),
    stride: int = STRIDE,
) -> Manifest:
    """The manifest of a dataset; ``kept`` columns (of orderable types) come back with the proofs."""
    folder = scratch_path(rows.sparkSession, "merkle")
    name = F.col(group)
    leaves = rows.select(
        F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name.cast("string"))).alias("tree"),
        F.col(order).alias("key"),
        leaf(*fields).alias("digest"),
        (F.struct(*kept) if kept else F.struct(F.col(order))).alias("kept"),
    )
    leaves = saved(leaves, f"{folder}/leaves")
    placed = numbered(leaves, ["key", "digest"], f"{folder}/groups").drop("key")
    groups = stored_levels(placed, stride, f"{folder}/groups")
    tops = roots(groups, stride).select(
        F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.struct("tree").alias("kept")
    )
    tops = saved(tops, f"{folder}/roots")
    placed = numbered(tops, ["key"], f"{folder}/top").drop("key")
    return Manifest(groups, stored_levels(placed, stride, f"{folder}/top"), stride, folder)
