"""Merkle manifest of a dataset: a content-addressed DAG of digest-to-children records, and proofs by descent.

Rows are the leaves of one tree per group (a language, say); the groups' roots,
in the groups' order, are the leaves of a tree above them, whose root names the
whole dataset. A node's children are kept as the text of their hexadecimal
digests, one after the other, and its digest is the SHA-256 of that text, so a
record ``(digest, children)`` says nothing about places and equal subtrees are
stored once.

A proof starts at the root and follows the base-8 digits of a leaf's rank: at
every node the digit picks the child to go on with, and the children beside it
are a segment of the path. Leaves of one subtree share their way down: a
position is looked up once, however many leaves lie under it, so the first
levels have one row and no hot key. Reversed, the segments are the proof from
the leaf up.

Defined cases. A null field is ``-``. A null group is a group of its own, before
all others; null order keys come first. Rows equal in all order keys follow each
other by their digest; rows equal in all fields are leaves of their own. A group
of one leaf has that leaf as its root, a dataset of one group has the group's
root. An empty table has no root and no proofs. Further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.tables import cut

FAN = 8                 # children of a node
HEX = 64                # characters of a digest
_PATH = "array<struct<left:string,right:string>>"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields: each ``-`` if null, else its UTF-8 byte count, a colon and its text."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in fields]), 256)


def group_key(col: Column) -> Column:
    """The group's value as a text that is never null and sorts null first, else by its UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit(""))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``rank`` (0, 1, ... within ``grp``, by ``order``, nulls first) and ``n``, the rows of the group.

    A range exchange sorts the rows over all tasks; they are written once with
    their partition and place, and each partition's first rank in a group
    follows from one count per partition and group. Runs one job.
    """
    keys = [F.col("grp"), *[F.col(c).asc_nulls_first() for c in order]]
    cols = rows.columns
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .select(*cols, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "merkle-ranked")
    per = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("first"))
    before = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = per.select("grp", "part", (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("base"),
                      F.sum("here").over(W.partitionBy("grp")).alias("n"))
    return placed.join(base, ["grp", "part"]).select(*cols, (F.col("at") + F.col("base")).alias("rank"), "n")


@dataclass
class Tree:
    """One tree per group. ``levels[k]`` holds the nodes of height k + 1: grp, i (place in the level), n (nodes
    of the group's level), digest, children. ``roots``: grp, height, digest."""
    levels: list[DataFrame]
    roots: DataFrame

    def records(self, height: int) -> DataFrame:
        """The content-addressed records ``(digest, children)`` of the nodes of that height."""
        return self.levels[height - 1].select("digest", "children").distinct()


def build(leaves: DataFrame, most: int) -> Tree:
    """The trees over ``leaves`` (grp, rank, n, digest); ``most``: the leaves of the largest group.

    A level has an eighth of the rows of the one below; each is written once.
    """
    level = leaves.select("grp", F.col("rank").alias("i"), "n", "digest")
    levels, roots = [], [level.where("n = 1").select("grp", F.lit(0).alias("height"), "digest")]
    while most > 1:
        children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "digest"))), lambda x: x.digest), "")
        runs = (level.where("n > 1").groupBy("grp", F.expr(f"i div {FAN}").alias("run"))
                .agg(children.alias("children"), F.max("n").alias("n")))
        level = cut(runs.select("grp", F.col("run").alias("i"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
                                F.sha2("children", 256).alias("digest"), "children"), "merkle-level")
        levels.append(level)
        roots.append(level.where("n = 1").select("grp", F.lit(len(levels)).alias("height"), "digest"))
        most = -(-most // FAN)
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return Tree(levels, out)


def _segment(children: Column, digit: Column) -> Column:
    """The children beside the one at ``digit``."""
    at = (digit * HEX).cast("int")
    return F.struct(F.substring(children, F.lit(1), at).alias("left"),
                    F.substring(children, at + HEX + 1, F.lit(FAN * HEX)).alias("right"))


def descend(tree: Tree, start: DataFrame, requests: DataFrame, part: bool = False) -> DataFrame:
    """``requests`` (grp, rank, n and more) with ``path``, the segments from the root down.

    ``start``: grp, height, digest and path of each group's root (the path that
    leads there from above). Records are joined by digest alone, height by
    height; a request meets its run of children by its rank's leading digits
    and picks its own by the last. ``part``: ``requests`` are few of all
    leaves, so positions above none of them are left out on the way.

    Both sides of these joins grow with the dataset, so they are shuffled at
    every size and none turns from a broadcast into a shuffle on the way up.
    """
    at = None
    for height in range(len(tree.levels), 0, -1):
        enter = start.where(F.col("height") == height).select("grp", F.lit(0).cast("long").alias("i"), "digest", "path")
        at = enter if at is None else at.unionByName(enter)
        if part:
            asked = requests.select("grp", F.expr(f"rank div {FAN ** height}").alias("i")).distinct()
            at = at.join(asked, ["grp", "i"], "left_semi")
        at = at.join(tree.records(height).hint("merge"), "digest").select("grp", "i", "children", "path")
        if height > 1:
            digits = F.sequence(F.lit(0), F.expr(f"cast(length(children) div {HEX} as int)") - 1)
            at = at.withColumn("digit", F.explode(digits)).select(
                "grp", (F.col("i") * FAN + F.col("digit")).alias("i"),
                F.substring("children", F.col("digit") * HEX + 1, F.lit(HEX)).alias("digest"),
                F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"))
    lone = start.where("height = 0").select("grp", F.lit(0).cast("long").alias("i"), F.col("digest").alias("children"), "path")
    runs = lone if at is None else at.unionByName(lone)
    asked = requests.withColumn("i", F.expr(f"rank div {FAN}"))
    own = F.array(_segment(F.col("children"), F.expr(f"rank % {FAN}")))
    path = F.when(F.col("n") > 1, F.concat("path", own)).otherwise(F.col("path"))
    return asked.join(runs.hint("merge"), ["grp", "i"]).select(*requests.columns, path.alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path (root first) lead to."""
    return F.aggregate(F.reverse(path), leaf, lambda h, s: F.sha2(F.concat(s.left, h, s.right), 256))


def proof(path: Column) -> Column:
    """The siblings' digests in one text, left to right, from the leaf's level up."""
    return F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s.left, s.right)), "")


@dataclass
class Manifest:
    """A dataset's manifest: ``leaves`` (the rows' own columns, grp, leaf, rank, n), the groups' trees, the tree
    above them with its places, and the root's digest (None for an empty table)."""
    leaves: DataFrame
    tree: Tree
    groups: DataFrame
    above: Tree
    root: str | None

    def subroots(self) -> DataFrame:
        """grp, height, digest and path (from the root) of every group's root."""
        top = self.above.roots.select("grp", "height", "digest", F.array().cast(_PATH).alias("path"))
        named = self.groups.select(F.lit("").alias("grp"), "rank", "n", F.col("name"), F.col("height").alias("of"), "digest")
        found = descend(self.above, top, named)
        return found.select(F.col("name").alias("grp"), F.col("of").alias("height"), "digest", "path")

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """Leaves with ``subroot`` and ``path``; ``requests``: a part of ``leaves`` (all if None)."""
        start = self.subroots()
        found = descend(self.tree, start, self.leaves if requests is None else requests, part=requests is not None)
        return found.join(start.select("grp", F.col("digest").alias("subroot")), "grp")


def manifest(rows: DataFrame, order: list[str]) -> Manifest:
    """The manifest of ``rows``: grp (``group_key``), leaf, the columns of ``order`` and any others.

    Runs the jobs that rank the leaves and write the levels; the driver gets
    the size of the largest group and the root.
    """
    tie = "tie"         # rows equal in everything still sort over many tasks
    rows = cut(rows.withColumn(tie, F.monotonically_increasing_id()), "merkle-leaves")
    leaves = cut(ranked(rows, [*order, "leaf", tie]).drop(tie), "merkle-leaf-ranks")
    tree = build(leaves.withColumn("digest", F.col("leaf")), leaves.agg(F.max("n")).first()[0] or 0)
    named = tree.roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "height", "digest")
    groups = cut(ranked(named, ["name"]), "merkle-groups")
    above = build(groups, groups.agg(F.max("n")).first()[0] or 0)
    top = above.roots.first()
    return Manifest(leaves, tree, groups, above, top.digest if top else None)
